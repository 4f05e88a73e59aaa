import hashlib
import tracemalloc

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe
from tessera.llm.queries import tokenizer_path
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose

PATH = tokenizer_path()
PIECES = ["a", "b", "the", " ", "  ", "\n", " \n", "'s", "'", "re", "ll", "ve", "'re", "1", "23", "é", "É", "²", "¿", "\xa0", "\x85", "中文",
          "!", "?!", "<|endoftext|>", "<|", "endof", "text|>", "\t", "🙂", "ing", "xxxxx", "\x1d", "\x00", "ñ'", "''", " '"]


@pytest.fixture(scope="module")
def enc():
    return bpe.encoder(PATH)


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def ids_of(tok, text):
    return tok.encode(text, add_special_tokens=False).ids


def test_store_gives_the_library_ids(enc, tok, rng):
    for _ in range(400):
        texts = ["".join(rng.choice(PIECES, rng.integers(0, 25))) for _ in range(4)]
        assert [x.tolist() for x in enc.encode_many(texts)] == [ids_of(tok, t) for t in texts]


def test_a_full_store_is_emptied(tok):
    small = bpe.TextEncoder(PATH, store=5)
    for text in ("one two three four five six seven", "one two three", "eight nine ten 'tis"):
        assert small.encode_many([text])[0].tolist() == ids_of(tok, text)


def test_concat_at_every_cut(enc, tok, rng):
    for _ in range(60):
        text = "".join(rng.choice(PIECES, 40))
        for k in range(0, len(text) + 1, 3):
            joined = enc.concat(enc.part(text[:k].encode()), enc.part(text[k:].encode()))
            assert joined.ids.tolist() == ids_of(tok, text)


@pytest.mark.parametrize("alphabet", ["abcdefgh", "é中文字", "!?.,;", "0123456789", " \n\t", "ab\n  c'", "<|endoftext>"])
def test_tree_over_long_unsplit_text(enc, tok, rng, alphabet):
    for leaf in (700, 1500):
        text = "".join(rng.choice(list(alphabet), 9_000))
        tree = enc.concat_tree([enc.part(text[i: i + leaf].encode()) for i in range(0, len(text), leaf)])
        assert tree.ids.tolist() == ids_of(tok, text)
        assert tree.heads.sum() == enc.part(text.encode()).heads.sum()


def test_decode_as_the_library(enc, tok, rng):
    for _ in range(300):
        ids = rng.integers(0, 50_257, rng.integers(0, 12))
        assert enc.decode(ids) == tok.decode(ids.tolist(), skip_special_tokens=False)


def test_digests_of_whole_texts(spark, tok, rng):
    texts = [*ODD_TEXTS, "".join(rng.choice(PIECES, 4_000)), "ab cd " * 3_000 + "x" * 9_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[-1]), (None, texts[-1]), (16, texts[-1])]
    docs = docs_frame(spark, rows).withColumnRenamed("source", "n_tokens")
    got = bpe.encode_digests(docs, PATH, long_chars=2_000, leaf_chars=700).collect()
    def digest(text):
        ids = ids_of(tok, text or "")
        decoded = tok.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
    want = sorted(str((d, *digest(t))) for d, t in rows)
    assert sorted(str(tuple(r)) for r in got) == want


def test_encode_then_decode(spark):
    rows = [(1, "plain words"), (2, None), (3, "x" * 5_000)]
    out = bpe.decode_documents(bpe.encode_documents(docs_frame(spark, rows), PATH, long_chars=1_000, leaf_chars=400), PATH)
    assert {r.doc_id: r.decoded for r in out.collect()} == {1: "plain words", 2: "", 3: "x" * 5_000}


def test_empty_table(spark):
    assert bpe.encode_digests(docs_frame(spark, []), PATH).count() == 0


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


@pytest.mark.parametrize("letters", ["ab", "12"])
def test_words_whose_polynomial_hashes_collide(letters):
    """A long word in Thue-Morse order and its complement, in one batch and in two."""
    e = bpe.TextEncoder(tokenizer_path())
    for n in (16, 64, 1024, 2048, 4096):
        pair = [thue_morse(n, letters), thue_morse(n, letters[::-1])]
        want = [np.frombuffer(x, "<u4").tolist() for x in e.direct(pair)]
        assert want[0] != want[1]
        assert [x.tolist() for x in e.encode_many(pair)] == want
        assert [e.encode_many([t])[0].tolist() for t in pair + pair] == want * 2


def test_ids_do_not_rest_on_hashes(monkeypatch, rng):
    """With three hash values in all, every text still gets the library's ids."""
    monkeypatch.setattr(bpe, "span_hashes", lambda data, a, b: ((b - a) % 3).astype(np.uint64))
    e = bpe.TextEncoder(tokenizer_path(), store=50)
    for _ in range(3):
        texts = [prose(rng, 200, "abcde") for _ in range(5)] + ["x" * 100, "y" * 100, ""]
        assert [x.tobytes() for x in e.encode_many(texts)] == e.direct(texts)


def test_a_slice_does_not_copy_the_store(rng):
    """The work of a small slice does not grow with what the store holds."""
    e = bpe.TextEncoder(PATH)
    for _ in range(4):
        e.encode_many([prose(rng, 15_000)])
    peaks = []
    for k in range(20):
        tracemalloc.start()
        e.encode_many([f"some new{k} words"])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert np.median(peaks) < 100_000


def test_new_words_go_to_the_library_together(rng):
    e = bpe.TextEncoder(PATH)
    texts = [prose(rng, 3_000), "don't 'tis, 'x 12é½ \xa0a \n b\tc  d ''"]
    want, given = e.direct(texts), []

    class Counting:
        def encode_batch_fast(self, batch, add_special_tokens):
            given.extend(batch)
            return tok.encode_batch_fast(batch, add_special_tokens=add_special_tokens)

    tok, e.tok = e.tok, Counting()
    assert [x.tobytes() for x in e.encode_many(texts)] == want
    assert len(given) < 20
    # Ids whose lengths do not fit the words are not trusted: the words go alone.
    other = bpe.TextEncoder(PATH)
    other.lengths = other.lengths + 1
    assert [x.tobytes() for x in other.encode_many(texts)] == want


def test_words_of_many_slices(rng):
    """So many words that the store's short level joins the long one more than once."""
    e = bpe.TextEncoder(PATH)
    texts = ["".join(rng.choice(PIECES, 300)) + " " + prose(rng, 9_000) for _ in range(6)]
    want = e.direct(texts)
    for _ in range(2):
        assert [e.encode_many([t])[0].tobytes() for t in texts] == want
