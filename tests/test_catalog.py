"""Registered queries against their SQL on the smallest tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
CHECKED = (
    "token_kinds", "normal_forms", "answers", "meta_pipe", "meta_context", "view_stats_by_lang", "head_coverage", "class_matrix",
    "record_validate", "jsonl_lines", "template_split", "mix_general", "half_split", "batch_numbers", "jaccard_dedup",
    "emb_pair_stats_by_label", "emb_top_pairs", "tfidf_mean", "rouge_scores", "batch_plan", "verdict_parse", "final_report",
    "tfidf_shares", "coverage_matrix", "review_sample", "summary_sections", "sorted_output")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "conversations", "benchmark", "labels", "embeddings", "pages"):
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def table(columns, rows):
    def plain(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return repr(float(v)) if isinstance(v, float) else str(v)

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    result = con.execute(contract.oracle_sql()[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in result.description], result.fetchall())


def test_contract(spark):
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 80
    assert contract.entry(spark).count() == 4
