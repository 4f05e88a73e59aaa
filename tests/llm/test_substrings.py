import re

import numpy as np
import pytest

from tessera.llm import substrings
from tessera.llm.common import span_hashes
from tests.llm.conftest import ODD_TEXTS, docs_frame, prose


def brute_words(raw):
    """(word, its first byte, whether it is the first of its line, whether a cut by content or a stop comes before it)."""
    out, stopped = [], True
    for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw):
        w = m[0]
        line = not out or b"\n" in raw[out[-1][1]: m.start()]
        out.append((w, m.start(), line, line or stopped))
        cut = int(span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]) % substrings.CUT == 0
        stopped = cut or w[-1:] in (b".", b"!", b"?") or (w[-1:] in (b'"', b"'", b")", b"]") and w[-2:-1] in (b".", b"!", b"?"))
    return out


def brute_pieces(words, codes):
    """First words of the pieces: after the least hash (of equal ones the last) of each window without another cut."""
    n, size = len(words), substrings.SPACING
    heads = {i for i, w in enumerate(words) if w[3]}
    runs, start = [], 0
    for i in range(1, n + 1):
        if i == n or words[i][3] or codes[i] != codes[i - 1]:
            runs.append((start, i))
            start = i
    long = {i for a, b in runs if b - a >= size for i in range(a, b)}
    for i in range(n - size + 1):
        if not any(words[k][3] for k in range(i + 1, i + size)):
            k = min(range(i, i + size), key=lambda k: (codes[k], -k))
            if k not in long:
                heads.add(k + 1)
    for a, b in runs:
        if b - a >= size:
            heads |= {i + 1 for i in range(a, b) if (i - a) % size == 0 or (b - 1 - i) % size == 0}
    return sorted(h for h in heads if h < n)


def brute_stretches(heads, n, run, least):
    """(first word, end word, last part if it goes back from there) of runs of ``run`` parts and ``least`` words or more."""
    ends, out = heads + [n], []
    for i in range(len(heads)):
        to = next((j for j in range(i + run, len(ends)) if ends[j] - ends[i] >= least), None)
        if to is not None:
            out.append((ends[i], ends[to], None))
        back = next((k for k in range(i + 1 - run, -1, -1) if ends[i + 1] - ends[k] >= least), None)
        if back is not None:
            out.append((ends[back], ends[i + 1], i))
    return out


def brute(rows):
    """doc_id -> (text after removal, sentences cut) of rows of (doc_id, text) with distinct ids."""
    first, made = {}, {}
    for d, text in sorted((r for r in rows if r[1]), key=lambda r: (r[0] is None, r[0])):
        raw = text.encode()
        words = brute_words(raw)
        codes = [int(span_hashes(np.frombuffer(w[0], np.uint8), np.array([0]), np.array([len(w[0])]))[0]) for w in words]
        heads, since = [], 0
        for i, w in enumerate(words):
            since = 0 if w[3] else since + 1
            if since % substrings.MAX_WORDS == 0:
                heads.append(i)
        ends = heads[1:] + [len(words)]
        whole = {(a, b) for a, b, back in brute_stretches(heads, len(words), substrings.RUN, substrings.MIN_WORDS)
                 if back is None or ends[back] == len(words) or words[ends[back]][2]}
        only = {(a, b) for a, b, _ in brute_stretches(brute_pieces(words, codes), len(words), 1, substrings.LEAST)} - whole
        cover, gone = {True: set(), False: set()}, set()
        for a, b in sorted(whole | only):
            key = tuple(w[0] for w in words[a:b])
            owner, at = first.setdefault(key, (d, a))
            if (owner, at) != (d, a):
                # A run of pieces that overlaps the first one of its kind leaves that one as it is.
                start = max(a, at + b - a) if owner == d and (a, b) in only else a
                cover[(a, b) in whole] |= set(range(start, b))

        def parts(marked, least):
            out, run = set(), []
            for i in range(len(words) + 1):
                if i in marked:
                    run.append(i)
                else:
                    out |= set(run) if len(run) >= least else set()
                    run = []
            return out
        gone = cover[True] | parts(parts(cover[True] | cover[False], substrings.LONG) - cover[True], substrings.EDGE)
        made[d] = raw, words, heads, ends, gone
    out = {}
    for d, text in rows:
        if not text or not made[d][1]:
            out[d] = text, 0
            continue
        raw, words, heads, ends, gone = made[d]
        begins = [w[1] for w in words] + [len(raw)]
        out[d] = ((raw[: begins[0]] + b"".join(raw[begins[i]: begins[i + 1]] for i in range(len(words)) if i not in gone)).decode(),
                  sum(any(i in gone for i in range(a, b)) for a, b in zip(heads, ends, strict=True)))
    return out


def make_rows(rng):
    passage = prose(rng, 70)
    rows = [(i, prose(rng, 40) + "\n" + (passage + "\n" if i % 3 == 0 else "") + prose(rng, 30)) for i in range(12)]
    rows += [(50, passage), (51, prose(rng, 5) + ' said "yes." ' + passage), (52, "\n".join(["One line here again and again."] * 9)),
             (53, " ".join(w for w in prose(rng, 60).replace(".", "").split()) + " " + passage), (54, prose(rng, 200)), (None, passage + " end.")]
    return rows + [(100 + i, t) for i, t in enumerate(ODD_TEXTS)]


def test_matches_brute_force(spark, rng):
    rows = make_rows(rng)
    docs = docs_frame(spark, rows).repartition(3).withColumnsRenamed({"source": "n_removed", "lang": "_t", "n_chars": "c0"})
    assert substrings.remove_repeats(docs).columns == ["doc_id", "text", "_t", "c0", "n_removed"]
    got = {r.doc_id: (r.text, r.n_removed) for r in substrings.remove_repeats(docs).collect()}
    want = brute(rows)
    assert got.keys() == want.keys()
    for d in want:
        assert got[d] == want[d], d


def test_passage_stays_once_and_clean_text_is_untouched(spark, rng):
    rows = make_rows(rng)
    got = {r.doc_id: r.text for r in substrings.remove_repeats(docs_frame(spark, rows)).collect()}
    passage = rows[12][1]
    assert [d for d, t in got.items() if t and passage[20:200] in t] == [0]
    assert got[54] == dict(rows)[54] and got[1] == dict(rows)[1]


def test_passages_inside_long_sentences_are_found(spark, rng):
    """A passage of 60 words without any stop, after other words of the same sentence."""
    words = prose(rng, 60).replace(".", "").lower()
    rows = [(i, prose(rng, 20).replace(".", "") + " " + words + " " + prose(rng, 20).replace(".", "")) for i in range(6)]
    got = {r.doc_id: r.text for r in substrings.remove_repeats(docs_frame(spark, rows)).collect()}
    middle = " ".join(words.split()[24:36])
    assert middle in got[0] and all(middle not in got[i] for i in range(1, 6))


@pytest.mark.parametrize("low, high", [(None, None), (12, 24), (25, 40)])
def test_every_passage_of_over_50_words_is_found(spark, low, high):
    """Passages that start inside a sentence, in two texts; no stops, or sentences of ``low`` to ``high`` words."""
    rng = np.random.default_rng(5)

    def words(n):
        return ["".join(rng.choice(list("abcdefghijklmnop"), 7)) for _ in range(n)]

    def stopped(text):
        if low:
            for i in np.cumsum(rng.integers(low, high + 1, len(text))):
                if i < len(text):
                    text[i] += "."
        return text
    rows, passages = [], []
    for i in range(400):
        passage = stopped(words(51 + i % 30))
        passages.append(passage)
        rows += [(i + k, " ".join(stopped(words(int(rng.integers(15, 60)))) + passage + stopped(words(int(rng.integers(15, 60)))))) for k in (0, 1000)]
    got = {r.doc_id: (r.text.split(), r.n_removed) for r in substrings.remove_repeats(docs_frame(spark, rows)).collect()}
    for i, passage in enumerate(passages):
        assert got[i] == (rows[2 * i][1].split(), 0)
        left, n_removed = got[1000 + i]
        before = rows[2 * i + 1][1].split()
        assert n_removed > 0 and set(before) - set(left) <= set(passage)
        stay = [w in set(left) for w in passage]
        assert stay.index(False) <= substrings.MAX_WORDS and stay[::-1].index(False) <= substrings.MAX_WORDS


def test_short_common_lines_are_left_alone(spark, rng):
    line = prose(rng, 18)
    rows = [(i, prose(rng, 40) + "\n" + line + "\n" + prose(rng, 40)) for i in range(8)]
    got = {r.doc_id: r.text for r in substrings.remove_repeats(docs_frame(spark, rows)).collect()}
    assert got == dict(rows)


def test_equal_rows_get_equal_texts(spark, rng):
    text = prose(rng, 60)
    got = [r.text for r in substrings.remove_repeats(docs_frame(spark, [(1, text), (1, text), (2, text)])).collect()]
    assert sorted(got) == sorted([text, text, ""])


def test_empty_table(spark):
    assert substrings.remove_repeats(docs_frame(spark, [])).count() == 0
