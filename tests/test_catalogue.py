import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from dialoom.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tidy = lambda v: "none" if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted(str([tidy(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "documents", "pages", "labels", "conversations", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = catalogue.queries()[name](spark, SF)
    expected = con.sql(catalogue.oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(expected.columns), expected.fetchall())


@pytest.mark.parametrize("name", ["issue_counts", "issue_guide", "issue_positions", "issue_records"])
def test_odd_keys_against_oracle(spark, tmp_path, name):
    """Ids below zero, and null ids, turns and roles."""
    text = "please can you tell me what should then be done with it"
    told = [(i, t, "user" if t % 2 else "system", text) for i in range(-4, 3) for t in range(8)] + [(None, t, "user", text) for t in range(3)] + [(9, t, None, text + " too") for t in range(8)] + [(7, None, "user", text)]
    spark.createDataFrame(told, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    df = catalogue.queries()[name](spark, str(tmp_path))
    expected = con.sql(catalogue.oracle_sql()[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(expected.columns), expected.fetchall())


def test_translate_text_takes_long_and_null_turns(spark, tmp_path):
    texts = ["word " * 700, "x" * 6000, None, "", "12 34", "short one"]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    found = {r.row_idx: (r.n, r.status) for r in catalogue.queries()["translate_text"](spark, str(tmp_path)).collect()}
    # three characters for each chunk of at most 2,500
    assert found == {0: (3506, "ok"), 1: (6009, "ok"), 2: (None, "ok"), 3: (0, "ok"), 4: (5, "ok"), 5: (12, "ok")}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
