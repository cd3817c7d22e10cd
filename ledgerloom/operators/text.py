"""Memo cleaning, memo tokens, memo features and TF-IDF, all as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import one_row
from ledgerloom.session import checked_broadcast

# The cleaning patterns. (?U) makes \b, \d and \s see all of Unicode; the four separator
# characters \x1c-\x1f count as blanks too.
BLANKS = r"\s\x1c-\x1f"
DATE = r"(?U)\b(?:CA\s+)?(?:0?[1-9]|1[0-2])[/-](?:0?[1-9]|[12]\d|3[01])(?:/\d{2,4})?\b"
X_RUN = {"x3": r"X{3,}", "x2": r"#?XX+", "x1": r"#?X+"}
STATE = r"\s[A-Z]{2}$"
PHRASES = "(pos withdrawal|debit card withdrawal)"
PURCHASE = "purchase"
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
COM_LINK = r"(?U)\b\w+\.com\b"

# Words of at least two letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def cleaned(column: str, x_run: str = "x3", keep_at: bool = False) -> Column:
    """The cleaning steps in their order; blanks left at the ends by the last two steps stay.

    Few texts hold a date, so the costly date pattern only runs where a digit, a separator and a digit
    follow each other.
    """
    text = F.col(column)
    text = F.when(text.rlike("[0-9][/-][0-9]"), F.regexp_replace(text, DATE, "")).otherwise(text)
    text = F.regexp_replace(text, X_RUN[x_run], "")
    text = F.regexp_replace(text, f"(?U)[^a-zA-Z0-9{BLANKS}./{'@' if keep_at else ''}]", "")
    text = F.trim(F.regexp_replace(text, f"(?U)[{BLANKS}]+", " "))
    text = F.lower(F.regexp_replace(text, STATE, ""))
    return F.replace(F.regexp_replace(text, PHRASES, ""), F.lit(PURCHASE), F.lit(""))


def clean_memo(
    df: DataFrame, text: str = "memo", label: str | None = "category", x_run: str = "x3", keep_at: bool = False
) -> DataFrame:
    """Clean a text column; rows whose text is just the label are dropped (``label=None`` keeps all).

    ``x_run`` sets which runs of X go: three or more (x3), two or more (x2) or any (x1); the last two
    also take a leading '#'. ``keep_at`` keeps '@' for e-mail search.
    """
    if not isinstance(df, DataFrame):
        raise TypeError("clean_memo needs a Spark DataFrame")
    if text not in df.columns:
        raise ValueError(f"no column {text!r}")
    if label is not None:
        df = df.filter(F.coalesce(F.col(text) != F.col(label), F.lit(True)))
    return df.withColumn(text, cleaned(text, x_run, keep_at))


def memo_tokens(df: DataFrame, text: str = "memo", amount: str = "amount", date: str = "posted_date") -> DataFrame:
    """Append tokens for a whole-dollar amount, the day and the month."""
    whole = F.when(F.col(amount) % 1 == 0, F.lit(" <W_D>")).otherwise(F.lit(""))
    tokens = F.concat(
        F.col(text),
        whole,
        F.lit(" <D_"),
        F.day(date).cast("string"),
        F.lit("> <M_"),
        F.month(date).cast("string"),
        F.lit(">"),
    )
    return df.withColumn(text, tokens)


def memo_features(df: DataFrame, text: str = "memo", amount: str = "amount", date: str = "posted_date") -> DataFrame:
    """Weekday name, day of month, whole-dollar flag, first e-mail, first .com link and its flag."""
    memo = F.col(text)
    return df.withColumns(
        {
            "weekday": F.date_format(date, "EEEE"),
            "day_of_month": F.day(date),
            "dollar_amount": (F.col(amount) == F.floor(amount)).cast("int"),
            "email": F.nullif(F.regexp_extract(memo, EMAIL, 0), F.lit("")),
            "has_link": memo.rlike(COM_LINK),
            "link": F.nullif(F.regexp_extract(memo, COM_LINK, 0), F.lit("")),
        }
    )


def link_counts_by_category(featured: DataFrame) -> DataFrame:
    """Rows with a link and rows with an e-mail per category, for categories that have either."""
    return (
        featured.groupBy("category")
        .agg(F.count("link").alias("n_links"), F.count("email").alias("n_emails"))
        .filter((F.col("n_links") > 0) | (F.col("n_emails") > 0))
    )


def distinct_emails(featured: DataFrame) -> DataFrame:
    return featured.filter(F.col("email").isNotNull()).select("email").distinct()


def frequent_label_filter(df: DataFrame, label: str = "category", min_rows: int = 2) -> DataFrame:
    """Blanks in labels become '_'; labels with too few rows are dropped with all their rows."""
    named = df.withColumn(label, F.replace(F.col(label), F.lit(" "), F.lit("_")))
    frequent = named.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    # The labels are few: computed first and sent to the rows if they are, so that no memo is shuffled.
    return named.join(checked_broadcast(frequent.select(label)), label, "left_semi")


def union_flows(inflows: DataFrame, outflows: DataFrame) -> DataFrame:
    return inflows.select("memo", "category").unionByName(outflows.select("memo", "category"))


def _words(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), F.lit(0))


def term_counts(docs: DataFrame, doc_id: str = "id", text: str = "memo") -> DataFrame:
    """Occurrences of each lower-case word per document; the whole text is read.

    A text is split and counted where it lies; only (document, word, count) rows are shuffled.
    """
    return (
        docs.select(doc_id, text)
        .select(doc_id, F.explode(_words(text)).alias("term"))
        .groupBy(doc_id, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def vocabulary(
    docs: DataFrame,
    text: str = "memo",
    min_df: int = 5,
    max_df: float = 0.95,
    max_terms: int = 5000,
) -> DataFrame:
    """The most frequent words that are in at least ``min_df`` documents and at most a share of them.

    Smoothed idf = ln((1 + documents) / (1 + df)) + 1. At most ``max_terms`` rows; ties by the word.
    """
    total = one_row(docs, F.count(F.lit(1)).alias("n")).getField("n")
    # Every document is one row, so its distinct words are found in the row. Both counts are combined on
    # the map side, so only the list of words is shuffled, never the texts.
    frequency = docs.select(F.explode(_words(text)).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("frequency")
    )
    in_documents = docs.select(F.explode(F.array_distinct(_words(text))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    per_term = in_documents.join(frequency, "term")
    return (
        per_term.filter((F.col("df") >= min_df) & (F.col("df") <= total * F.lit(max_df)))
        .orderBy(F.desc("frequency"), "term")
        .limit(max_terms)
        .withColumn("idf", F.log((total + 1).cast("double") / (F.col("df") + 1)) + 1)
    )


def tfidf_terms(docs: DataFrame, terms: DataFrame, doc_id: str = "id", text: str = "memo") -> DataFrame:
    """Long-form TF-IDF with unit length per document: (document, term, weight).

    ``terms`` comes from ``vocabulary`` (of the training side), whose size is fixed by ``max_terms``,
    so it is broadcast. A document has at most that many rows in the norm window.
    """
    raw = term_counts(docs, doc_id, text).join(F.broadcast(terms.select("term", "idf")), "term")
    weight = F.col("tf") * F.col("idf")
    norm = F.sqrt(F.sum(weight * weight).over(Window.partitionBy(doc_id)))
    return raw.select(doc_id, "term", (weight / norm).alias("weight"))


def label_index(df: DataFrame, label: str = "category") -> DataFrame:
    """Number of each label in sorted order, from 0. The window runs over the distinct labels only."""
    labels = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return labels.withColumn("label_index", (F.dense_rank().over(Window.orderBy(label)) - 1).cast("int"))
