import numpy as np
import pytest

SMALL = "/root/testdata/sf0.001"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n_words, letters="abcdefghijklmnop"):
    words = ["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(n_words)]
    out = []
    for i, w in enumerate(words):
        out.append(w.capitalize() if i % 9 == 0 else w)
        if i % 9 == 8:
            out[-1] += "."
    return " ".join(out)


@pytest.fixture(scope="session")
def rng():
    return np.random.default_rng(11)


def docs_frame(spark, rows):
    """rows of (doc_id, text[, lang[, source]]) as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


ODD_TEXTS = [None, "", " \t\n ", "a", "A.", "é", "中文 字", "!!! ***", "x" * 50_000, "word " * 5_000,
             "tail space \n", " ", "🙂 ok", "<|endoftext|> there", "it's we'll  x"]
