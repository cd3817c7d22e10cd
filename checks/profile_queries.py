"""Profiles, frequencies, calendars, histograms, trimming and binned target rates."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import bindings as b
from checks.bindings import Registry, big, dbl, rnd, text, with_views
from checks.text_queries import SIDE_SQL
from ledgerloom.operators import bins, flows, profile, sampling

registry = Registry()
query = registry.add

CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "dq_target")
CUSTOMER_TYPES = ("bigint", "string", "int", "double", "string", "double")
CUST = """cust AS (SELECT *, CAST(CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS dq_target FROM customer)"""


def cust(spark, sf_dir):
    target = F.when(F.col("c_custkey") % 10 == 9, None).when(F.col("c_acctbal") < 0, 1.0).otherwise(0.0)
    return b.table(spark, sf_dir, "customer").withColumn("dq_target", target.cast("double"))


@query(
    "column_profile",
    with_views(
        CUST,
        body=" UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
  count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS n_distinct FROM cust"""
            for c, t in zip(CUSTOMER_COLUMNS, CUSTOMER_TYPES)
        ),
    ),
)
def column_profile(spark, sf_dir):
    return profile.column_profile(cust(spark, sf_dir))


@query(
    "column_profile_lineitem",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
  count(DISTINCT {c}) AS n_distinct FROM lineitem"""
        for c in ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    ),
)
def column_profile_lineitem(spark, sf_dir):
    items = b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    return profile.column_profile(items).drop("data_type")


@query(
    "coerce_casts",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k, TRY_CAST(event_type AS DOUBLE) AS kind,
  CAST(TRY_CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS VARCHAR) AS day, TRY_CAST(props AS DATE) IS NULL AS bad_date FROM events""",
)
def coerce_casts(spark, sf_dir):
    raw = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.regexp_extract("props", "[0-9]+", 0).alias("k"),
        F.col("event_type").alias("kind"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("day"),
        F.col("props").alias("bad"),
    )
    out = profile.coerce(raw, {"k": "double", "kind": "double", "day": "date", "bad": "date"})
    return out.select("event_id", "k", "kind", text("day"), F.col("bad").isNull().alias("bad_date"))


DIRTY = """dirty AS (
  SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN CAST('inf' AS DOUBLE)
      WHEN c_custkey % 13 = 0 THEN CAST('-inf' AS DOUBLE) ELSE c_acctbal END AS balance,
    CAST(c_nationkey AS DOUBLE) AS nation, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 97 AS DOUBLE) END AS slot
  FROM customer)"""


def dirty(spark, sf_dir):
    key = F.col("c_custkey")
    return b.table(spark, sf_dir, "customer").select(
        key,
        F.when(key % 7 == 0, None)
        .when(key % 11 == 0, F.lit(float("inf")))
        .when(key % 13 == 0, F.lit(float("-inf")))
        .otherwise(F.col("c_acctbal"))
        .alias("balance"),
        F.col("c_nationkey").cast("double").alias("nation"),
        F.when(key % 3 == 0, None).otherwise((key % 97).cast("double")).alias("slot"),
    )


@query(
    "impute_median",
    with_views(
        DIRTY,
        "finite AS (SELECT c_custkey, CASE WHEN isinf(balance) THEN NULL ELSE balance END AS balance, nation, slot FROM dirty)",
        body="SELECT c_custkey, "
        + ", ".join(f"round(coalesce({c}, (SELECT median({c}) FROM finite)), 6) AS {c}" for c in ("balance", "nation", "slot"))
        + " FROM finite",
    ),
)
def impute_median(spark, sf_dir):
    out = profile.impute_median(dirty(spark, sf_dir), ["balance", "nation", "slot"])
    return out.select("c_custkey", rnd("balance"), rnd("nation"), rnd("slot"))


@query("drop_null_columns", with_views(DIRTY, body="SELECT c_custkey, nation FROM dirty"))
def drop_null_columns(spark, sf_dir):
    return profile.drop_null_columns(dirty(spark, sf_dir))


@query("drop_null_rows", with_views(DIRTY, body="SELECT * FROM dirty WHERE balance IS NOT NULL AND slot IS NOT NULL"))
def drop_null_rows(spark, sf_dir):
    return profile.drop_null_rows(dirty(spark, sf_dir))


@query(
    "category_frequency",
    with_views(
        b.TXN,
        b.CATMAP,
        "t AS (SELECT category FROM txn LEFT JOIN catmap USING (category_id))",
        body="""SELECT category, count(*) AS n, round(count(*) / (SELECT count(category) FROM t), 6) AS share
FROM t WHERE category IS NOT NULL GROUP BY 1""",
    ),
)
def category_frequency(spark, sf_dir):
    rows = flows.with_category(b.txn(spark, sf_dir), b.catmap(spark, sf_dir), ["-"])
    return profile.value_frequency(rows, "category").select("category", "n", rnd("share"))


@query(
    "class_balance",
    with_views(b.CONSUMER, body="SELECT dq_target, count(*) AS n FROM consumer WHERE dq_target IS NOT NULL GROUP BY 1"),
)
def class_balance(spark, sf_dir):
    return profile.class_balance(b.consumer(spark, sf_dir))


@query(
    "category_totals",
    with_views(b.LTXN, body="SELECT category, CAST(sum(amount) AS DOUBLE) AS total_amount FROM ltxn GROUP BY 1"),
)
def category_totals(spark, sf_dir):
    return profile.category_totals(b.ltxn(spark, sf_dir)).select("category", dbl("total_amount"))


SIDED = f"sided AS (SELECT *, {SIDE_SQL.format(key='consumer_id')} AS side FROM ltxn)"


def sided(spark, sf_dir):
    return sampling.split_side(b.ltxn(spark, sf_dir), "consumer_id")


@query(
    "split_category_drift",
    with_views(
        b.LTXN,
        SIDED,
        body="""SELECT category,
  round(count(*) FILTER (WHERE side = 'train') * 100.0 / (SELECT count(*) FROM sided WHERE side = 'train'), 6) AS train_percent,
  round(count(*) FILTER (WHERE side = 'test') * 100.0 / (SELECT count(*) FROM sided WHERE side = 'test'), 6) AS test_percent
FROM sided GROUP BY 1""",
    ),
)
def split_category_drift(spark, sf_dir):
    return profile.side_category_drift(sided(spark, sf_dir)).select(
        "category", rnd("train_percent"), rnd("test_percent")
    )


@query(
    "split_amount_drift",
    with_views(
        b.LTXN,
        SIDED,
        body="""SELECT side, count(v) AS "count", round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS std, min(v) AS min,
  round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75,
  max(v) AS max FROM (SELECT side, CAST(amount AS DOUBLE) AS v FROM sided) GROUP BY 1""",
    ),
)
def split_amount_drift(spark, sf_dir):
    return flows.describe(sided(spark, sf_dir), keys=["side"]).select(
        "side", "count", rnd("mean", digits=4), rnd("std", digits=4), "min", rnd("p25"), rnd("p50"), rnd("p75"), "max"
    )


@query(
    "ks_two_sample",
    with_views(
        b.LTXN,
        SIDED,
        body="""SELECT round(max(abs(a / na - b / nb)), 6) AS statistic, CAST(max(na) AS BIGINT) AS n_first, CAST(max(nb) AS BIGINT) AS n_second FROM (
  SELECT sum(x) OVER (ORDER BY amount) AS a, sum(y) OVER (ORDER BY amount) AS b, sum(x) OVER () AS na, sum(y) OVER () AS nb FROM (
    SELECT amount, count(*) FILTER (WHERE side = 'train') AS x, count(*) FILTER (WHERE side = 'test') AS y FROM sided GROUP BY 1))""",
    ),
)
def ks_two_sample(spark, sf_dir):
    return profile.ks_two_sample(sided(spark, sf_dir), "amount", "side", "train", "test").select(
        rnd("statistic"), "n_first", "n_second"
    )


@query(
    "ks_p_value",
    with_views(
        b.LTXN,
        SIDED,
        """gap AS (
  SELECT max(abs(a / na - b / nb)) * sqrt(max(na) * max(nb) / (max(na) + max(nb))) AS x, max(abs(a / na - b / nb)) AS statistic FROM (
    SELECT sum(x) OVER (ORDER BY amount) AS a, sum(y) OVER (ORDER BY amount) AS b, sum(x) OVER () AS na, sum(y) OVER () AS nb FROM (
      SELECT amount, count(*) FILTER (WHERE side = 'train') AS x, count(*) FILTER (WHERE side = 'test') AS y FROM sided GROUP BY 1)))""",
        body="""SELECT round(statistic, 6) AS statistic, round(CASE WHEN x < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, (
  SELECT sum((CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * x * x)) FROM range(1, 101) AS r(k)))) END, 6) AS p_value FROM gap""",
    ),
)
def ks_p_value(spark, sf_dir):
    compared = profile.ks_two_sample(sided(spark, sf_dir), "amount", "side", "train", "test")
    return profile.ks_p_value(compared).select(rnd("statistic"), rnd("p_value"))


@query(
    "category_by_month",
    with_views(
        b.LTXN,
        body="""SELECT CAST(CAST(date_trunc('month', posted_date) AS DATE) AS VARCHAR) AS month, category, count(*) AS n_transactions,
  round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS mean_amount FROM ltxn GROUP BY 1, 2""",
    ),
)
def category_by_month(spark, sf_dir):
    return profile.category_by_month(b.ltxn(spark, sf_dir)).select(
        text("month"), "category", "n_transactions", rnd("mean_amount", digits=4)
    )


@query(
    "amount_by_month_name",
    with_views(
        b.LTXN,
        body="""SELECT month(posted_date) AS month_number, monthname(posted_date) AS month_name,
  round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS mean_amount, CAST(sum(amount) AS DOUBLE) AS total_amount FROM ltxn GROUP BY 1, 2""",
    ),
)
def amount_by_month_name(spark, sf_dir):
    return profile.amount_by_month_name(b.ltxn(spark, sf_dir)).select(
        big("month_number"), "month_name", rnd("mean_amount", digits=4), dbl("total_amount")
    )


@query(
    "count_by_weekday",
    with_views(
        b.LTXN,
        body="""SELECT isodow(posted_date) - 1 AS weekday_number, dayname(posted_date) AS weekday, count(*) AS n FROM ltxn GROUP BY 1, 2""",
    ),
)
def count_by_weekday(spark, sf_dir):
    return profile.count_by_weekday(b.ltxn(spark, sf_dir)).select(big("weekday_number"), "weekday", "n")


@query(
    "amount_by_day",
    with_views(
        b.LTXN,
        body="SELECT day(posted_date) AS day, round(CAST(sum(amount) AS DOUBLE) / count(*), 4) AS mean_amount FROM ltxn GROUP BY 1",
    ),
)
def amount_by_day(spark, sf_dir):
    return profile.amount_by_day(b.ltxn(spark, sf_dir)).select(big("day"), rnd("mean_amount", digits=4))


def histogram_sql(source: str, value: str, bins_: int, keys: str = "") -> str:
    lead = f"{keys}, " if keys else ""
    over = f"PARTITION BY {keys}" if keys else ""
    return f"""SELECT {lead}bin, round(lo + bin * w, 6) AS low_edge, n, round(n / (sum(n) OVER ({over}) * w), 12) AS density FROM (
  SELECT {lead}CAST(least({bins_ - 1}, floor((v - lo) / ((hi - lo) / {bins_}.0))) AS INTEGER) AS bin, lo,
    (hi - lo) / {bins_}.0 AS w, count(*) AS n
  FROM (SELECT {lead}{value} AS v FROM {source}), (SELECT min({value}) AS lo, max({value}) AS hi FROM {source})
  GROUP BY ALL)"""


@query(
    "amount_histogram",
    with_views(b.LTXN, SIDED, body=histogram_sql("sided", "CAST(amount AS DOUBLE)", 100, "side")),
)
def amount_histogram(spark, sf_dir):
    return profile.histogram(sided(spark, sf_dir), "amount", 100, ["side"]).select(
        "side", "bin", rnd("low_edge"), "n", rnd("density", digits=12)
    )


SLICE = "slice AS (SELECT * FROM ltxn WHERE posted_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31')"


@query(
    "year_slice_histogram",
    with_views(
        b.LTXN, SLICE, body=histogram_sql("slice", "CAST(posted_date - DATE '1970-01-01' AS DOUBLE)", 10)
    ),
)
def year_slice_histogram(spark, sf_dir):
    year = profile.date_slice(b.ltxn(spark, sf_dir), "1998-01-01", "1998-12-31")
    return profile.date_histogram(year, 10).select("bin", rnd("low_edge"), "n", rnd("density", digits=12))


@query(
    "box_stats",
    with_views(
        b.LTXN,
        """v AS (SELECT CAST(amount AS DOUBLE) AS v FROM ltxn),
q AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM v)""",
        body="""SELECT round(max(q1), 6) AS q1, round(max(q2), 6) AS median, round(max(q3), 6) AS q3,
  min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers FROM v, q""",
    ),
)
def box_stats(spark, sf_dir):
    return profile.box_stats(b.ltxn(spark, sf_dir)).select(
        rnd("q1"), rnd("median"), rnd("q3"), "whisker_low", "whisker_high", "n_outliers"
    )


def _trim(name: str, q: float, keep: str, op: str) -> None:
    sql = with_views(
        b.TXN,
        body=f"""SELECT txn_id, CAST(amount AS DOUBLE) AS amount FROM txn
WHERE CAST(amount AS DOUBLE) {op} (SELECT quantile_cont(CAST(amount AS DOUBLE), {q}) FROM txn)""",
    )

    @query(name, sql)
    def run(spark, sf_dir):
        return profile.trim_global_quantile(b.txn(spark, sf_dir), "amount", q, keep).select("txn_id", dbl("amount"))


_trim("trim_global_quantile", 0.99, "below", "<")
_trim("trim_global_quantile_upto", 0.95, "upto", "<=")
_trim("trim_global_quantile_tail", 0.999, "above", ">")


@query(
    "tail_by_category",
    with_views(
        b.TXN,
        body="""SELECT txn_id, category_id, CAST(amount AS DOUBLE) AS amount FROM txn JOIN (
  SELECT category_id, quantile_cont(CAST(amount AS DOUBLE), 0.98) AS edge FROM txn GROUP BY 1) USING (category_id)
WHERE CAST(amount AS DOUBLE) > edge""",
    ),
)
def tail_by_category(spark, sf_dir):
    return profile.tail_by_category(b.txn(spark, sf_dir), "category_id").select("txn_id", "category_id", dbl("amount"))


@query(
    "sample_consumers",
    with_views(
        b.TXN,
        body="""SELECT consumer_id FROM (SELECT DISTINCT consumer_id FROM txn)
ORDER BY CAST('0x' || substr(md5(CAST(consumer_id AS VARCHAR)), 1, 8) AS BIGINT), consumer_id LIMIT 20""",
    ),
)
def sample_consumers(spark, sf_dir):
    return profile.sample_consumers(b.txn(spark, sf_dir), 20)


@query(
    "nonzero_counts",
    with_views(
        b.TXN,
        "spend AS (SELECT consumer_id, "
        + ", ".join(f"sum(CASE WHEN category_id = {c} THEN amount ELSE 0 END) AS s{c}" for c in range(1, 6))
        + " FROM txn GROUP BY 1)",
        body=" UNION ALL ".join(
            f"SELECT 'category_{c}_spending' AS column_name, count(*) FILTER (WHERE s{c} <> 0) AS n_nonzero FROM spend"
            for c in range(1, 6)
        ),
    ),
)
def nonzero_counts(spark, sf_dir):
    spend = flows.spend_windows(b.txn(spark, sf_dir), (), range(1, 6), "category_id")
    return profile.nonzero_counts(spend, [c for c in spend.columns if c.startswith("category_")])


TARGETS = """feat AS (SELECT c.*, t.a AS amount, t.n AS n_transactions FROM consumer c JOIN (
  SELECT consumer_id, CAST(sum(amount) AS DOUBLE) AS a, count(*) AS n FROM txn GROUP BY 1) t USING (consumer_id)
  WHERE dq_target IS NOT NULL)"""
TARGET_VIEWS = (b.CONSUMER, b.TXN, TARGETS)


def feat(spark, sf_dir):
    totals = b.txn(spark, sf_dir).groupBy("consumer_id").agg(
        F.sum("amount").cast("double").alias("amount"), F.count(F.lit(1)).alias("n_transactions")
    )
    return b.consumer(spark, sf_dir).filter("dq_target is not null").join(totals, "consumer_id")


@query(
    "target_correlation",
    with_views(
        *TARGET_VIEWS,
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, round(corr({c}, dq_target), 6) AS correlation FROM feat"
            for c in ("credit_score", "amount", "n_transactions")
        ),
    ),
)
def target_correlation(spark, sf_dir):
    out = profile.target_correlation(feat(spark, sf_dir), ["credit_score", "amount", "n_transactions"], "dq_target")
    return out.select("feature", rnd("correlation"))


@query(
    "target_rate_by_band",
    with_views(
        b.CONSUMER,
        "low AS (SELECT min(credit_score) AS lo FROM consumer)",
        body="""SELECT CAST(floor((credit_score - lo) / 25) AS INTEGER) AS band, lo + CAST(floor((credit_score - lo) / 25) AS INTEGER) * 25 AS band_start,
  count(*) AS n, count(*) FILTER (WHERE dq_target = 1) AS n_target, round(count(*) FILTER (WHERE dq_target = 1) / count(*), 6) AS target_rate
FROM consumer, low GROUP BY 1, 2""",
    ),
)
def target_rate_by_band(spark, sf_dir):
    return bins.target_rate_by_band(b.consumer(spark, sf_dir), "credit_score", "dq_target").select(
        "band", "band_start", "n", "n_target", rnd("target_rate")
    )


def rate_sql(bin_sql: str, source: str) -> str:
    return f"""SELECT bin, count(*) AS n, round(avg(dq_target), 6) AS target_rate FROM (
  SELECT {bin_sql} AS bin, dq_target FROM {source}) WHERE bin IS NOT NULL GROUP BY 1"""


def width_sql(value: str, lo: str, hi: str, n: int) -> str:
    return f"""CASE WHEN {value} BETWEEN {lo} AND {hi}
    THEN greatest(1, least({n}, CAST(ceil(({value} - {lo}) / (({hi} - {lo}) / {n}.0)) AS INTEGER))) END"""


def rates(df):
    return df.select("bin", "n", rnd("target_rate"))


@query(
    "target_rate_equal_width",
    with_views(
        *TARGET_VIEWS,
        body=rate_sql(width_sql("amount", "lo", "hi", 10), "feat, (SELECT min(amount) AS lo, max(amount) AS hi FROM feat)"),
    ),
)
def target_rate_equal_width(spark, sf_dir):
    return rates(bins.target_rate_equal_width(feat(spark, sf_dir), "amount", "dq_target"))


@query(
    "target_rate_equal_freq",
    with_views(
        *TARGET_VIEWS,
        "edges AS (SELECT list_distinct(list_transform(quantile_cont(CAST(n_transactions AS DOUBLE), [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]), lambda e: round(e, 9))) AS edges FROM feat)",
        body=rate_sql("greatest(1, len(list_filter(edges, lambda e: e < n_transactions)))", "feat, edges"),
    ),
)
def target_rate_equal_freq(spark, sf_dir):
    return rates(bins.target_rate_equal_freq(feat(spark, sf_dir), "n_transactions", "dq_target"))


@query(
    "target_rate_trimmed",
    with_views(
        *TARGET_VIEWS,
        body=rate_sql(
            width_sql("amount", "lo", "hi", 10),
            "feat, (SELECT quantile_cont(amount, 0.01) AS lo, quantile_cont(amount, 0.99) AS hi FROM feat)",
        ),
    ),
)
def target_rate_trimmed(spark, sf_dir):
    return rates(bins.target_rate_trimmed(feat(spark, sf_dir), "amount", "dq_target"))


@query(
    "target_rate_grid",
    with_views(
        *TARGET_VIEWS,
        "edges AS (SELECT min(credit_score) AS rl, max(credit_score) AS rh, min(amount) AS cl, max(amount) AS ch FROM feat)",
        f"""binned AS (SELECT {width_sql('credit_score', 'rl', 'rh', 5)} AS row_bin, {width_sql('amount', 'cl', 'ch', 5)} AS c, dq_target
  FROM feat, edges)""",
        body="SELECT row_bin, "
        + ", ".join(f"round(coalesce(avg(dq_target) FILTER (WHERE c = {i}), 1.0), 6) AS column_bin_{i}" for i in range(1, 6))
        + " FROM binned GROUP BY 1",
    ),
)
def target_rate_grid(spark, sf_dir):
    out = bins.target_rate_grid(feat(spark, sf_dir), "credit_score", "amount", "dq_target")
    return out.select("row_bin", *[rnd(f"column_bin_{i}") for i in range(1, 6)])
