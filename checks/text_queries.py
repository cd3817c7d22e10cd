"""Memo cleaning, memo features and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, big, rnd, with_views
from checks.bindings import text as as_text
from ledgerloom.operators import profile, sampling, text
from ledgerloom.plans import bayes
from ledgerloom.session import staged

registry = Registry()
query = registry.add

DATE_SQL = r"\b(?:CA\s+)?(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12]\d|3[01])(?:/\d{2,4})?\b"


def clean_sql(column: str = "memo", x_run: str = "X{3,}", keep: str = "") -> str:
    step = f"regexp_replace({column}, '{DATE_SQL}', '', 'g')"
    step = f"regexp_replace({step}, '{x_run}', '', 'g')"
    step = f"regexp_replace({step}, '[^a-zA-Z0-9\\s./{keep}]', '', 'g')"
    step = f"trim(regexp_replace({step}, '\\s+', ' ', 'g'))"
    step = f"lower(regexp_replace({step}, '\\s[A-Z]{{2}}$', ''))"
    step = f"regexp_replace({step}, '(pos withdrawal|debit card withdrawal)', '', 'g')"
    return f"regexp_replace({step}, '(purchase)', '', 'g')"


# Bank-like memos: the order's fields as a card statement line, next to the documents' plain texts.
STATEMENT = """statement AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 0 THEN substr(o_orderpriority, 3) ELSE
    (CASE o_orderkey % 4 WHEN 0 THEN 'POS WITHDRAWAL ' WHEN 1 THEN 'DEBIT CARD WITHDRAWAL PURCHASE ' WHEN 2 THEN 'CA ' ELSE '' END)
    || strftime(o_orderdate, '%m/%d/%Y') || ' #' || repeat('X', CAST(o_orderkey % 6 AS INTEGER)) || o_custkey || ' STORE-' || o_orderpriority
    || CASE WHEN o_orderkey % 3 = 0 THEN ' pay@shop' || o_custkey || '.com' ELSE ' shop' || o_custkey || '.com' END
    || CASE WHEN o_orderkey % 2 = 0 THEN '  CA' ELSE ' Inc.' END END AS memo,
    substr(o_orderpriority, 3) AS category, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS posted_date
  FROM orders)"""


def statement(spark, sf_dir):
    key = F.col("o_orderkey")
    lead = (
        F.when(key % 4 == 0, "POS WITHDRAWAL ")
        .when(key % 4 == 1, "DEBIT CARD WITHDRAWAL PURCHASE ")
        .when(key % 4 == 2, "CA ")
        .otherwise("")
    )
    line = F.concat(
        lead,
        F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.lit(" #"),
        F.expr("repeat('X', cast(o_orderkey % 6 as int))"),
        F.col("o_custkey").cast("string"),
        F.lit(" STORE-"),
        F.col("o_orderpriority"),
        F.when(key % 3 == 0, F.lit(" pay@shop")).otherwise(F.lit(" shop")),
        F.col("o_custkey").cast("string"),
        F.lit(".com"),
        F.when(key % 2 == 0, F.lit("  CA")).otherwise(F.lit(" Inc.")),
    )
    label = F.expr("substr(o_orderpriority, 3)")
    return b.table(spark, sf_dir, "orders").select(
        key.alias("id"),
        F.when(key % 11 == 0, label).otherwise(line).alias("memo"),
        label.alias("category"),
        F.col("o_totalprice").cast(b.MONEY).alias("amount"),
        F.col("o_orderdate").cast("date").alias("posted_date"),
    )


CLEAN_VARIANTS = {
    "clean_memo": ({}, clean_sql()),
    "clean_memo_x2": ({"x_run": "x2"}, clean_sql(x_run="#?XX+")),
    "clean_memo_x1": ({"x_run": "x1"}, clean_sql(x_run="#?X+")),
    "clean_memo_keep_at": ({"x_run": "x1", "keep_at": True}, clean_sql(x_run="#?X+", keep="@")),
}


def _clean(options):
    def run(spark, sf_dir):
        return text.clean_memo(statement(spark, sf_dir), **options).select("id", "memo")

    return run


for _name, (_options, _sql) in CLEAN_VARIANTS.items():
    query(_name, with_views(STATEMENT, body=f"SELECT id, {_sql} AS memo FROM statement WHERE memo <> category"))(
        _clean(_options)
    )


@query(
    "clean_memo_documents",
    with_views(b.MEMO, body=f"SELECT id, {clean_sql()} AS memo FROM memo WHERE memo <> category"),
)
def clean_memo_documents(spark, sf_dir):
    return text.clean_memo(b.memo(spark, sf_dir)).select("id", "memo")


@query(
    "memo_tokens",
    with_views(
        STATEMENT,
        body="""SELECT id, memo || CASE WHEN amount % 1 = 0 THEN ' <W_D>' ELSE '' END
  || ' <D_' || day(posted_date) || '> <M_' || month(posted_date) || '>' AS memo FROM statement""",
    ),
)
def memo_tokens(spark, sf_dir):
    return text.memo_tokens(statement(spark, sf_dir)).select("id", "memo")


EMAIL_SQL = r"nullif(regexp_extract(memo, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'), '')"
LINK_SQL = r"nullif(regexp_extract(memo, '\b\w+\.com\b'), '')"
FEATURED_SQL = f"""SELECT id, category, dayname(posted_date) AS weekday, day(posted_date) AS day_of_month,
  CASE WHEN amount = floor(amount) THEN 1 ELSE 0 END AS dollar_amount, {EMAIL_SQL} AS email,
  {LINK_SQL} IS NOT NULL AS has_link, {LINK_SQL} AS link FROM """


@query("memo_features", with_views(STATEMENT, body=FEATURED_SQL + "statement"))
def memo_features(spark, sf_dir):
    return text.memo_features(statement(spark, sf_dir)).select(
        "id", "category", "weekday", big("day_of_month"), big("dollar_amount"), "email", "has_link", "link"
    )


@query(
    "link_counts_by_category",
    with_views(
        STATEMENT,
        body=f"""SELECT category, count(link) AS n_links, count(email) AS n_emails FROM ({FEATURED_SQL} statement)
GROUP BY 1 HAVING count(link) > 0 OR count(email) > 0""",
    ),
)
def link_counts_by_category(spark, sf_dir):
    return text.link_counts_by_category(text.memo_features(statement(spark, sf_dir)))


@query(
    "distinct_emails",
    with_views(STATEMENT, body=f"SELECT DISTINCT email FROM ({FEATURED_SQL} statement) WHERE email IS NOT NULL"),
)
def distinct_emails(spark, sf_dir):
    return text.distinct_emails(text.memo_features(statement(spark, sf_dir)))


@query(
    "frequent_label_filter",
    with_views(
        """named AS (SELECT event_id, replace(props, ' ', '_') AS category FROM events)""",
        body="""SELECT event_id, category FROM named
WHERE category IN (SELECT category FROM named GROUP BY 1 HAVING count(*) >= 100)""",
    ),
)
def frequent_label_filter(spark, sf_dir):
    labels = b.table(spark, sf_dir, "events").select("event_id", F.col("props").alias("category"))
    return text.frequent_label_filter(labels, min_rows=100).select("event_id", "category")


@query(
    "union_flows",
    with_views(STATEMENT, b.MEMO, body="SELECT memo, category FROM statement UNION ALL SELECT memo, category FROM memo"),
)
def union_flows(spark, sf_dir):
    return text.union_flows(statement(spark, sf_dir), b.memo(spark, sf_dir))


@query(
    "distinct_categories",
    with_views(STATEMENT, b.MEMO, body="SELECT category FROM statement UNION SELECT category FROM memo"),
)
def distinct_categories(spark, sf_dir):
    return text.union_flows(statement(spark, sf_dir), b.memo(spark, sf_dir)).select("category").distinct()


SIDE_SQL = "CASE WHEN CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END"

# The vectoriser is fitted on the training side and applied to all documents.
TERMS = f"""tokens AS (
  SELECT id, {SIDE_SQL.format(key='id')} AS side, unnest(regexp_extract_all(lower(memo), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM memo),
tf AS (SELECT id, side, term, count(*) AS tf FROM tokens GROUP BY 1, 2, 3),
size AS (SELECT count(*) AS n FROM memo WHERE {SIDE_SQL.format(key='id')} = 'train'),
vocab AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS frequency, ln((max(n) + 1.0) / (count(*) + 1)) + 1 AS idf
  FROM tf, size WHERE side = 'train' GROUP BY 1 HAVING count(*) >= 5 AND count(*) <= max(n) * 0.95
  ORDER BY frequency DESC, term LIMIT 2000)"""


def train_docs(spark, sf_dir):
    return sampling.split_side(b.memo(spark, sf_dir), "id").filter("side = 'train'")


def fitted_terms(spark, sf_dir):
    return text.vocabulary(train_docs(spark, sf_dir), max_terms=2000)


@query("vocabulary", with_views(b.MEMO, TERMS, body="SELECT term, df, frequency, round(idf, 6) AS idf FROM vocab"))
def vocabulary(spark, sf_dir):
    return fitted_terms(spark, sf_dir).select("term", "df", "frequency", rnd("idf"))


@query(
    "tfidf_terms",
    with_views(
        b.MEMO,
        TERMS,
        "raw AS (SELECT id, term, tf * idf AS w FROM tf JOIN vocab USING (term))",
        body="""SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw""",
    ),
)
def tfidf_terms(spark, sf_dir):
    return text.tfidf_terms(b.memo(spark, sf_dir), fitted_terms(spark, sf_dir)).select("id", "term", rnd("weight"))


@query(
    "bayes_scores",
    with_views(
        b.MEMO,
        TERMS,
        "raw AS (SELECT id, side, term, tf * idf AS w FROM tf JOIN vocab USING (term))",
        "tfidf AS (SELECT id, side, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)",
        f"""labelled AS (SELECT id, category FROM memo WHERE category IS NOT NULL AND {SIDE_SQL.format(key='id')} = 'train')""",
        "classes AS (SELECT category, ln(count(*) / (SELECT count(*) FROM labelled)) AS prior FROM labelled GROUP BY 1)",
        "weights AS (SELECT category, term, sum(weight) AS w FROM tfidf JOIN labelled USING (id) GROUP BY 1, 2)",
        "known AS (SELECT DISTINCT term FROM weights)",
        """below AS (
  SELECT category, coalesce(sum(w), 0) + (SELECT count(*) FROM known) AS total FROM classes LEFT JOIN weights USING (category) GROUP BY 1)""",
        """model AS (
  SELECT c.category, k.term, ln((coalesce(w, 0) + 1) / total) AS ll FROM classes c JOIN below USING (category) CROSS JOIN known k
  LEFT JOIN weights v ON v.category = c.category AND v.term = k.term)""",
        """sums AS (
  SELECT id, model.category, sum(weight * ll) AS s FROM tfidf JOIN model USING (term) WHERE side = 'test' GROUP BY 1, 2)""",
        f"""scores AS (
  SELECT memo.id, memo.category, c.category AS predicted, coalesce(s, 0) + prior AS score
  FROM memo CROSS JOIN classes c LEFT JOIN sums ON sums.id = memo.id AND sums.category = c.category
  WHERE {SIDE_SQL.format(key='memo.id')} = 'test')""",
        body="""SELECT id, category, predicted, round(1 / total, 6) AS confidence, round(score, 6) AS log_score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, predicted) AS rn,
    sum(exp(score - best)) OVER (PARTITION BY id) AS total
  FROM (SELECT *, max(score) OVER (PARTITION BY id) AS best FROM scores)) WHERE rn = 1""",
    ),
)
def bayes_scores(spark, sf_dir):
    sides = sampling.split_side(b.memo(spark, sf_dir), "id")
    # The fit and the prediction both read the vocabulary: it is counted once.
    weights = text.tfidf_terms(sides, staged(fitted_terms(spark, sf_dir), "vocabulary"))
    model = bayes.fit_bayes(sides.filter("side = 'train'"), weights)
    out = model.predict(sides.filter("side = 'test'"), weights)
    return out.select("id", "category", "predicted", rnd("confidence"), rnd(F.array_max("class_log_scores"), "log_score"))


@query(
    "label_index",
    with_views(
        STATEMENT,
        b.MEMO,
        body="""SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS label_index
FROM (SELECT category FROM statement UNION SELECT category FROM memo)""",
    ),
)
def label_index(spark, sf_dir):
    labels = text.union_flows(statement(spark, sf_dir), b.memo(spark, sf_dir))
    return text.label_index(labels).select("category", big("label_index"))


@query(
    "top_memo_per_category",
    with_views(
        b.EVTXN,
        body="""SELECT category, memo AS top_memo, n FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY n DESC, memo) AS rn
  FROM (SELECT category, memo, count(*) AS n FROM evtxn GROUP BY 1, 2)) WHERE rn = 1""",
    ),
)
def top_memo_per_category(spark, sf_dir):
    return profile.top_memo_per_category(b.evtxn(spark, sf_dir))


@query(
    "head_per_category",
    with_views(
        STATEMENT,
        body="""SELECT category, memo, id, CAST(posted_date AS VARCHAR) AS posted_date, rn AS row_no FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY posted_date, id) AS rn FROM statement
  WHERE memo <> category) WHERE rn <= 15""",
    ),
)
def head_per_category(spark, sf_dir):
    rows = statement(spark, sf_dir).filter(F.col("memo") != F.col("category"))
    return profile.head_per_category(rows, ["posted_date", "id"]).select(
        "category", "memo", "id", as_text("posted_date"), big("row_no")
    )
