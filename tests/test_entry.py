"""The registered queries: every SQL text agrees, and plans stay free of per-row Python and pair products."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, normal

# One of each kind; ``check_oracles.py`` runs them all on the larger tables.
SAMPLE = [
    "running_balance", "anchored_balance", "consumer_features", "running_total_stats", "income_per_day",
    "recurring_flags", "category_percent", "flow_pivots", "tfidf_terms", "clean_memo_documents", "memo_features",
    "column_profile", "ks_two_sample", "target_rate_equal_freq", "split_stratified", "roc_auc", "reason_codes",
    "final_scores", "csv_roundtrip", "balance_lists",
]
OWN = {name for module in entry.MODULES for name in module.registry.queries}
MODELS = {name for name in OWN if name not in entry.oracle_sql()}


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, sf_dir, db, name):
    frame = entry.queries()[name](spark, sf_dir)
    result = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert sorted(frame.columns) == order
    mine = sorted(str([normal(r[c]) for c in order]) for r in frame.collect())
    other = sorted(str([normal(r[columns.index(c)]) for c in order]) for r in result.fetchall())
    assert mine == other


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_only_model_queries_lack_sql():
    assert MODELS == {
        "memo_logreg", "memo_forest", "memo_boosted", "memo_bayes", "memo_bigram_linear", "memo_predictions",
        "risk_logreg", "risk_forest", "risk_gbt", "risk_gbt_undersampled", "risk_svm", "model_comparison",
        "memo_softmax_boosted", "risk_balanced_forest", "risk_plain_forest", "tree_reason_codes", "top_features", "tuned_gbt", "model_roundtrip", "scored_consumers", "feature_screening",
    }


NEIGHBOURS = {"smote_neighbors", "smote_rows", "tomek_links"}


@pytest.mark.parametrize("name", sorted(OWN & set(entry.oracle_sql()) - NEIGHBOURS))
def test_plan_has_no_python_and_no_product(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan
