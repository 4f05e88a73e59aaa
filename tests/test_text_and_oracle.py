"""Text operators on edge fixtures, and every registered query against its DuckDB oracle."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.operators import text as T
from tessera.plans.registry import all_queries
from tessera.tables import TABLES, table_path
from tests.oracle_check import frame_hash, to_records

SMALL = "/root/testdata/sf0.001"


def test_char_chunks_cover_whole_text(spark):
    df = spark.createDataFrame([(1, ""), (2, "abcdef"), (3, "abcdefg"), (4, "é" * 5)], "id int, t string")
    rows = T.char_chunks(df, "t", 3, ["id"]).collect()
    by = {}
    for r in rows:
        by.setdefault(r.id, []).append((r.chunk_id, r.chunk_text))
    assert 1 not in by
    assert [t for _, t in sorted(by[2])] == ["abc", "def"]
    assert [t for _, t in sorted(by[3])] == ["abc", "def", "g"]
    assert "".join(t for _, t in sorted(by[4])) == "é" * 5


def test_encode_pad_truncates_front_and_pads(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "zz!"), (3, "...")], "id int, text string")
    vocab = T.vocabulary(spark.createDataFrame([("a b c d e a",)], "text string"), "text")
    out = {r.id: (r.n_tokens, list(r.padded)) for r in T.encode_pad(docs, "text", ["id"], vocab, 3).collect()}
    v = {r.token: r.token_id for r in vocab.collect()}
    assert v["a"] == 2  # most frequent token takes the first id after OOV
    assert out[1] == (5, [v["c"], v["d"], v["e"]])
    assert out[2] == (1, [0, 0, T.OOV_ID])
    assert out[3] == (0, [0, 0, 0])


def test_top_k_cosine(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0])],
                               "id int, v array<float>")
    r = T.top_k_cosine(df, "v", "id", [(0, [1.0, 0.1])], k=2).orderBy("rank").collect()
    assert [x.id for x in r] == [1, 3]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    return con


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_oracle(spark, oracle, name):
    sdf = entry.queries()[name](spark, SMALL).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(sdf.columns) > 0
        return
    odf = oracle.execute(sql).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    assert len(sdf) == len(odf)
    assert frame_hash(to_records(sdf)) == frame_hash(to_records(odf))
