import tracemalloc

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tessera.llm import langid, quality_gam, toxicity
from tessera.llm.common import span_hashes, word_spans
from tessera.llm.queries import QUERIES
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose

DIR = "/root/testdata/sf0.1"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{DIR}/{name}.parquet'").df().set_index("doc_id")


def auc(y, s):
    r, p = pd.Series(s).rank().to_numpy(), np.asarray(y) == 1
    return (r[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


def test_language_on_held_out_rows(spark):
    got = QUERIES["op2_language_id"](spark, DIR).toPandas().set_index("doc_id")
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    held = got[got.held_out].join(table("documents")[["lang"]])
    assert (held.lang_pred == held.lang).mean() > 0.995
    assert got.rejected.mean() < 0.002


def test_toxicity_on_held_out_rows(spark):
    got = QUERIES["op5_toxicity"](spark, DIR).toPandas().set_index("doc_id")
    held = got[got.held_out].join(table("labels")[["toxic"]], how="inner")
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert auc(held.toxic, held.score) > 0.95 and (held.predicted == held.toxic).mean() > 0.95


def test_quality_on_held_out_rows(spark):
    got = QUERIES["op10_quality_gam"](spark, DIR).toPandas().set_index("doc_id")
    held = got[got.held_out].join(table("labels")[["quality"]], how="inner")
    assert len(got) == 10_000 and got.score.between(0, 1).all()
    assert auc(held.quality, held.score) > 0.98 and (held.predicted == held.quality).mean() > 0.98


def make(spark, rng):
    rows = [(i, prose(rng, 30, "abcdefgh" if i % 2 else "mnopqrst"), "aa" if i % 2 else "mm") for i in range(80)]
    odd = [(1_000 + i, t, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", "aa"), (3, rows[3][1], "aa"), (3, rows[3][1], "aa")]
    return docs_frame(spark, rows + odd)


def test_odd_rows_of_language(spark, rng):
    docs = make(spark, rng).withColumnRenamed("source", "score")
    model = langid.train(langid.learnable(docs), per_language=20)
    out = langid.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "lang_pred", "score", "rejected"]
    got = out.collect()
    assert len(got) == docs.count()
    for r in got:
        letter = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letter) and 0 <= r.score <= 1 and (letter or r.rejected and r.score == 0)
        if r.lang and r.doc_id is not None and r.doc_id < 1_000:
            assert r.lang_pred == r.lang


def test_foreign_text_is_rejected(spark):
    docs = docs_frame(spark, [(i, "the cat sat on the mat and the dog ran " * 5, "en") for i in range(60)]
                      + [(100 + i, "der hund und die katze sind nicht hier " * 5, "de") for i in range(60)])
    model = langid.train(docs, per_language=50)
    got = langid.predict(docs_frame(spark, [(1, "съешь ещё этих мягких французских булок"), (2, "the dog sat on the mat")]), model).collect()
    assert {r.doc_id: r.rejected for r in got} == {1: True, 2: False}


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality_gam, "quality")])
def test_odd_rows_of_scores(spark, rng, module, label):
    rows = [(i, prose(rng, 30) + (" badword badword" if i % 2 else "") + (" ###" * 20 if i % 2 else "")) for i in range(80)]
    docs = docs_frame(spark, rows + [(1_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id"), (3, "x")]).withColumnRenamed("source", "score")
    marks = spark.createDataFrame([(i, i % 2, "extra") for i in range(80)] + [(None, 1, ""), (5, None, ""), (9_999, 1, ""), (7, 1, "")],
                                  f"doc_id long, {label} int, text string")
    model = module.train(docs, marks)
    got = module.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "n_chars", "score", "predicted"]
    found = got.collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    scores = [(r.score, r.doc_id % 2) for r in found if r.doc_id is not None and r.doc_id < 80 and r.doc_id != 3]
    assert auc([y for _, y in scores], [s for s, _ in scores]) > 0.95
    one_class = marks.where(f"{label} = 1")
    assert module.train(docs, one_class) is None and module.train(docs, marks.where("false")) is None
    assert {r.score for r in module.predict(docs, None).collect()} == {0.0}
    assert module.predict(docs.where("false"), model).count() == 0


def test_no_language_at_all(spark):
    docs = docs_frame(spark, [(1, "abc", None), (2, None, "en")])
    assert langid.train(docs) is None
    assert [r.lang_pred for r in langid.predict(docs, None).collect()] == ["und", "und"]
    assert langid.predict(docs.where("false"), None).count() == 0


def test_equal_words_have_equal_hashes(rng):
    text = "one two  one\tthree two " * 50
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, rows = word_spans(data, np.array([0, 37, len(data)]))
    words = [text[a:b] for a, b in zip(starts, ends, strict=True)]
    hashes = span_hashes(data, starts, ends).tolist()
    assert len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes))
    assert all((a < 37) == (r == 0) for a, r in zip(starts, rows, strict=True))


def test_tree_steps_are_the_best_cuts(rng):
    g, h = rng.normal(0, 1, 12), np.ones(12)
    step = quality_gam._steps(g, h, 2)
    gains = [g[:k].sum() ** 2 / (k + 1) + g[k:].sum() ** 2 / (12 - k + 1) for k in range(1, 12)]
    k = 1 + int(np.argmax(gains))
    assert np.allclose(step, np.where(np.arange(12) < k, -g[:k].sum() / (k + 1), -g[k:].sum() / (12 - k + 1)))
    gain, cells = quality_gam._quadrants(np.array([[-5.0, 5], [5, -5]]), np.ones((2, 2)))
    assert np.allclose(cells, [[2.5, -2.5], [-2.5, 2.5]]) and gain > 0


def test_language_scores_hold_little_beside_the_texts():
    """Arrays of n-grams are made for some texts at a time, so a worker of many texts stays small."""
    model = langid.fit([(label, keys, w) for label in ("en", "de") for keys, w in langid._examples(f"{label} some words of this language".encode())])
    column = pa.array(["some words of a language, again and again. " * 200] * 500)
    tracemalloc.start()
    try:
        names, _, _ = langid.score_column(model, column)
        assert len(names) == 500 and tracemalloc.get_traced_memory()[1] < 40e6
    finally:
        tracemalloc.stop()
