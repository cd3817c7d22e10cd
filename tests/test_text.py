import math

import pytest

from ledgerloom.operators import text
from ledgerloom.sources import tables


def clean(spark, memo, **options):
    df = spark.createDataFrame([(memo, "FOOD")], "memo string, category string")
    return text.clean_memo(df, **options).first()["memo"]


@pytest.mark.parametrize(
    ("memo", "expected"),
    [
        ("CA 10/27/2023 STARBUCKS #XXXX1234 San Diego  CA", "starbucks 1234 san diego"),
        ("POS WITHDRAWAL 03/14 PURCHASE TARGET T-1234 LA JOLLA CA", "  target t1234 la jolla"),
        ("été 12-31 Ünï code XX Y CA", "t n code xx y"),
        ("DEBIT CARD WITHDRAWAL PURCHASE 1/2/23 A@b.com TX\n", "  ab.com"),
        (" PURCHASE X", " x"),
    ],
)
def test_clean_memo(spark, memo, expected):
    assert clean(spark, memo) == expected


def test_x_runs_and_at_sign(spark):
    memo = "SHOP XX9 #X8 X7 a@b.com"
    assert clean(spark, memo) == "shop xx9 x8 x7 ab.com"
    assert clean(spark, memo, x_run="x2") == "shop 9 x8 x7 ab.com"
    assert clean(spark, memo, x_run="x1") == "shop 9 8 7 ab.com"
    assert clean(spark, memo, x_run="x1", keep_at=True) == "shop 9 8 7 a@b.com"


def test_memo_equal_to_label_is_dropped_and_null_label_kept(spark):
    df = spark.createDataFrame([("FOOD", "FOOD"), ("FOOD", None), ("x", "FOOD")], "memo string, category string")
    assert text.clean_memo(df).count() == 2
    assert text.clean_memo(df, label=None).count() == 3


def test_input_guards(spark):
    with pytest.raises(TypeError):
        text.clean_memo(["memo"])
    with pytest.raises(ValueError):
        text.clean_memo(spark.range(1), "memo")


def test_memo_tokens(spark):
    df = spark.sql(
        "select 'a' memo, cast(12.00 as decimal(18,2)) amount, date'2024-03-05' posted_date"
        " union all select 'b', 12.50, date'2024-03-05'"
    )
    assert sorted(r["memo"] for r in text.memo_tokens(df).collect()) == ["a <W_D> <D_5> <M_3>", "b <D_5> <M_3>"]


def test_memo_features(spark):
    df = spark.sql(
        "select 'pay me.x+y@mail.co.uk at shop.com or b.com' memo, cast(7 as decimal(18,2)) amount, date'2024-03-05' posted_date"
        " union all select 'none', 7.25, date'2024-03-10'"
    )
    first, second = text.memo_features(df).orderBy("posted_date").collect()
    assert (first["weekday"], first["day_of_month"], first["dollar_amount"]) == ("Tuesday", 5, 1)
    assert (first["email"], first["has_link"], first["link"]) == ("me.x+y@mail.co.uk", True, "shop.com")
    assert (second["email"], second["has_link"], second["link"], second["dollar_amount"]) == (None, False, None, 0)


def test_labelled_lines_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("two words", "A_B"), ("", "C"), ("line\nbreak", "D")], "memo string, category string")
    path = str(tmp_path / "lines")
    tables.write_labelled_lines(df, path)
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == [
        "__label__A_B two words",
        "__label__C ",
        "__label__D line break",
    ]
    back = {(r["category"], r["memo"]) for r in tables.read_labelled_lines(spark, path).collect()}
    assert back == {("A_B", "two words"), ("C", ""), ("D", "line break")}


def test_frequent_label_filter(spark):
    df = spark.createDataFrame([("A B",), ("A B",), ("C",)], "category string")
    assert [r[0] for r in text.frequent_label_filter(df).collect()] == ["A_B", "A_B"]


def test_vocabulary_and_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "Red red blue x"), (2, "red green"), (3, "blue GREEN green")], "id long, memo string")
    terms = text.vocabulary(docs, min_df=2, max_df=1.0)
    rows = {r["term"]: (r["df"], r["frequency"], round(r["idf"], 6)) for r in terms.collect()}
    idf = round(math.log(4 / 3) + 1, 6)
    assert rows == {"red": (2, 3, idf), "green": (2, 3, idf), "blue": (2, 2, idf)}
    assert [r["term"] for r in text.vocabulary(docs, min_df=2, max_df=1.0, max_terms=2).collect()] == ["green", "red"]
    weights = {(r["id"], r["term"]): r["weight"] for r in text.tfidf_terms(docs, terms).collect()}
    assert weights[1, "red"] == pytest.approx(2 / 5**0.5)
    assert weights[1, "blue"] == pytest.approx(1 / 5**0.5)


def test_cleaning_runs_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame(
        [("03/14 TARGET T-1 CA", "FOOD", 3.0, "2024-03-05")], "memo string, category string, amount double, d string"
    ).selectExpr("memo", "category", "amount", "cast(d as date) posted_date").write.parquet(source)
    stream = spark.readStream.schema("memo string, category string, amount double, posted_date date").parquet(source)
    out = text.memo_features(text.memo_tokens(text.clean_memo(stream)))
    job = out.writeStream.format("memory").queryName("cleaned").trigger(availableNow=True).start()
    job.awaitTermination(60)
    assert [r["memo"] for r in spark.table("cleaned").collect()] == ["target t1 <W_D> <D_5> <M_3>"]


def test_label_index_is_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "category string")
    assert {r["category"]: r["label_index"] for r in text.label_index(df).collect()} == {"a": 0, "b": 1, "c": 2}


def test_bundle_renames_casts_and_signs(spark, tmp_path):
    def write(name, sql):
        path = str(tmp_path / name)
        spark.sql(sql).write.parquet(path)
        return path

    categories = str(tmp_path / "cats")
    tables.write_csv(spark.sql("select 1 category_id, 'A,B' category"), categories)
    bundle = tables.load_bundle(
        spark,
        categories,
        write("consumers", "select 7 id, '2024-01-31' evaluation_date, 700 credit_score, cast(null as double) DQ"),
        write("accounts", "select 7 id, 'x' account_type, 'bad' balance_date, '12.345' balance"),
        write("txns", "select 7 id, 1 category_id, 5.0 amount, 'CREDIT' credit_or_debit, '2024-01-01' posted_date"),
        columns={"id": "consumer_id", "DQ": "dq_target"},
    )
    assert bundle.categories.first()["category"] == "A,B"
    assert bundle.consumers.first()["consumer_id"] == "7"
    account = bundle.accounts.first()
    assert account["balance_date"] is None and float(account["balance"]) == 12.35
    assert float(bundle.transactions.first()["amount"]) == -5.0
