import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tessera.llm.common import BATCH_BYTES, add_columns, carried, map_texts, written
from tessera.llm.queries import QUERIES, SQL
from tessera.session import checkpoint_dir
from tessera.tables import TABLES, load, table_path
from tests.llm.conftest import DOC_SCHEMA, ODD_TEXTS, SMALL, prose
from tests.llm.test_simhash import brute_components
from tests.llm.test_substrings import brute
from tests.oracle_check import frame_hash, to_records


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    got, want = QUERIES[name](spark, SMALL).toPandas(), con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want) > 0
    assert frame_hash(to_records(got)) == frame_hash(to_records(want))


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))


def test_stages_against_brute_force(spark):
    docs = load(spark, SMALL, "documents")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = written(stage(spark, docs, SMALL), f"test-{name}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name in ("language_id", "toxicity"):
            assert {r.doc_id: r.text for r in after}.items() <= before.items()
            kept.append(len(after) / len(before))
        if name == "simhash_dedup":
            assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute_components(list(before.items()))})
        if name == "substring_dedup":
            want = brute(list(before.items()))
            assert {r.doc_id: r.text for r in after} == {d: t for d, (t, _) in want.items()}
            assert all(r.n_chars == len(r.text) for r in after if want[r.doc_id][1])
        if name == "packing":
            assert {r.doc_id for r in after} == {d for d, t in before.items() if t}
    assert kept[0] > 0.97 and kept[1] > 0.8


#: Columns that documents may have beside their own, with names that operators use.
EXTRA = ["rejected", "score", "predicted", "lang_pred", "n_removed", "_whole_text", "_fp", "c0", "id"]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Documents with odd texts, null columns, null ids, repeated rows, copies and clashing names."""
    rng, root = np.random.default_rng(5), tmp_path_factory.mktemp("odd")
    letters = {"aa": "abcdef", "bb": "uvwxyz"}
    rows = [(i, prose(rng, 60, letters[lang]), lang, "s") for i, lang in enumerate(["aa", "bb"] * 40)]
    rows += [(None, prose(rng, 60, "abcdef"), None, None), (200, rows[0][1], None, None), rows[4], (300, rows[8][1] + " Fedcba abc.", "aa", "s")]
    rows += [(400 + k, t, None, "odd") for k, t in enumerate(ODD_TEXTS)]
    frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOC_SCHEMA)
    frame = frame.select("*", *[F.concat(F.lit("kept "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))).alias(c) for c in EXTRA])
    frame.write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(i, 1, None if i == 3 else int(i % 8 == 1)) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return str(root)


def test_stages_on_odd_rows(spark, odd_dir):
    docs = load(spark, odd_dir, "documents")
    columns, types, counts = docs.columns, docs.dtypes, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text): r for r in docs.collect()}
        docs = written(stage(spark, docs, odd_dir), f"odd-{name}")
        after = docs.collect()
        assert docs.columns == columns and docs.dtypes == types
        assert all(r[c] == f"kept {'-' if r.doc_id is None else r.doc_id}" for r in after for c in EXTRA)
        if name == "language_id":
            assert after and all(r.text and any(ch.isalpha() for ch in r.text) for r in after)
        if name == "simhash_dedup":
            ids = [r.doc_id for r in after]
            assert len(ids) == len(set(ids)) and not {200, 300} & set(ids)
        if name != "substring_dedup":
            assert all(tuple(r) == tuple(before[r.doc_id, r.text]) for r in after)
        assert len(after) <= counts[-1]
        counts.append(len(after))
    assert counts[-1] > 40
    plan = corpus_pipeline.pack(spark, docs, odd_dir).collect()
    assert {r.doc_id for r in plan} == {r.doc_id for r in docs.collect() if r.text}


def test_pipeline_on_empty_tables(spark, odd_dir, tmp_path):
    for t in ("documents", "labels"):
        load(spark, odd_dir, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline_keeps_only_the_last_stage(spark, odd_dir):
    def folders():
        return {f for f in os.listdir(checkpoint_dir(spark).removeprefix("file:")) if f.startswith("pipeline-")}
    before = folders()
    plan = corpus_pipeline.run(spark, odd_dir)
    assert [f.split("-")[1] for f in folders() - before] == ["substring_dedup"]
    assert plan.count() > 40


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_workers_get_texts_by_bytes(spark):
    """3,000 texts of 8 KB come in batches of bounded bytes, not all at once, and all of them come."""
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("eight k "), 1000).alias("text"))
    spark.conf.unset(BATCH)
    held = add_columns(docs, "text", [("held", "long")], lambda column: [np.full(len(column), column.nbytes)]).agg(F.count("text"), F.max("held")).first()
    assert held[0] == 3000 and held[1] <= BATCH_BYTES + 16_000
    one = docs.limit(1).select(F.repeat("text", 1000).alias("text"))  # a longer row goes alone, whole
    assert add_columns(one, "text", [("held", "long")], lambda column: [np.full(len(column), column.nbytes)]).first().held > 8_000_000
    spark.conf.set(BATCH, "1m")  # a smaller setting stays
    map_texts(docs, lambda batches: batches, docs.schema)
    assert spark.conf.get(BATCH) == "1m"
    spark.conf.unset(BATCH)


def test_carried_text_is_sent_once(spark):
    docs = spark.createDataFrame([(1, "a b", b"a b")], "doc_id long, text string, raw binary")
    rows, places, whole = carried(docs, docs.columns, "text")
    assert rows.columns == places == ["c0", "c1", "c2"] and whole == 1
    for kept, text in ((["doc_id"], "text"), (docs.columns, "raw")):
        rows, places, whole = carried(docs, kept, text)
        assert rows.columns == [*places, "text"] and rows.first()[whole] == "a b"
