"""Substring deduplication (operator 8): sliding spans of sentences.

A text is cut into sentences: after a word that ends with . ! or ?, at a line break, and, so that
long sentences and text without stops are cut alike wherever they stand, after each word whose
hash is a multiple of ``CUT`` and after ``MAX_WORDS`` words at most.  Every run of ``RUN``
consecutive sentences (or more, until it has ``MIN_WORDS`` words) is hashed to 96 bits, from each
sentence on, and back from the last sentence of each line.  Equal runs meet in one shuffle;
sentences that lie in any run but the first of its kind, in the order of (document, position),
are removed.

Such a run may miss a passage that starts inside a long sentence.  So sentences are also cut, by
content only, into pieces of ``SPACING`` words at most: after the word with the smallest hash of
each window of ``SPACING`` words without another cut.  Runs of pieces with ``LEAST`` words or more
go into the same shuffle, from each piece on and back from each piece.  Between the first and the last
window inside a repeat all cuts are the same in every text, so each repeat of over 50 words
holds a stretch of at least ``LONG`` words found in this way, wherever it stands.  What the runs of
sentences leave of a stretch of ``LONG`` words is removed too; a part of it under ``EDGE`` words stays.

Of equal runs in one batch of documents only the first is sent; the others cannot be first
anywhere and are marked on the spot, so a very frequent run sends one row per batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import _powers, map_texts, mix, span_hashes, split_by_keys, text_slices, word_spans, written

#: Sentences in a run, words it has at least (shorter repeats, such as common lines, are left alone),
#: words of the longest sentence, and the share of words (one in CUT) that end one.
RUN, MIN_WORDS, MAX_WORDS, CUT = 3, 20, 24, 16
#: Words of a window that holds a cut between pieces; words of a repeat of 51 that lie between the cuts of
#: its outermost windows; words of a run of pieces; and the smallest part that is cut from a sentence, so
#: that ``MAX_WORDS`` words at most stay at an end of a repeat.
SPACING = 10
LONG = 51 + 1 - 2 * SPACING
LEAST = LONG + 1 - SPACING
EDGE = MAX_WORDS + 1 - SPACING
#: Slices of text (1 MB or so) whose runs are held at a time.
SLICES = 8
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?"]] = True
_CLOSERS = np.zeros(256, bool)
_CLOSERS[[ord(c) for c in "\"')]"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray):
    """Words as (starts, ends, rows, hashes), the number of the first word of each sentence, whether a
    sentence is the last of its line, and whether a word is the first after a cut by content."""
    starts, ends, rows = word_spans(data, offsets)
    code = span_hashes(data, starts, ends)
    if not len(starts):
        return starts, ends, rows, code, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
    last = data[ends - 1]
    before = data[np.maximum(ends - 2, starts)]
    stop = _ENDS[last] | (_CLOSERS[last] & _ENDS[before]) | (code % np.uint64(CUT) == 0)
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    line = np.ones(len(starts), bool)
    line[1:] = (rows[1:] != rows[:-1]) | (lines[starts[1:]] != lines[starts[:-1]])
    first = line.copy()
    first[1:] |= stop[:-1]
    heads = np.flatnonzero(first)
    place = np.arange(len(starts)) - np.repeat(heads, np.diff(np.append(heads, len(starts))))
    heads = np.flatnonzero(place % MAX_WORDS == 0)
    return starts, ends, rows, code, heads, np.append(line[heads[1:]], True), first


def pieces(code: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The number of the first word of each piece."""
    n = len(code)
    cut = np.zeros(n + 1, bool)
    if n >= SPACING:
        size = n + 1 - SPACING
        least, place = code[:size].copy(), np.arange(size)
        for k in range(1, SPACING):  # of equal words the last
            smaller = code[k: k + size] <= least
            least[smaller], place[smaller] = code[k: k + size][smaller], np.flatnonzero(smaller) + k
        part = np.cumsum(first)
        cut[place[part[:size] == part[SPACING - 1:]] + 1] = True
    # Inside a long run of one word, where every window has only equal words, by the distance from its ends.
    new = first.copy()
    new[1:] |= code[1:] != code[:-1]
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, n))
    place, size = np.arange(n) - np.repeat(heads, sizes), np.repeat(sizes, sizes)
    cut[1:] = np.where(size >= SPACING, (place % SPACING == 0) | ((size - 1 - place) % SPACING == 0), cut[1:])
    return np.flatnonzero(first | cut[:n])


def _stretches(heads: np.ndarray, rows: np.ndarray, run: int, least: int):
    """Runs of ``run`` parts or more, until they have ``least`` words, from each part on and back from each:
    first words, end words, whether the run goes back, and its last part."""
    words, row, at = np.append(heads, len(rows)), rows[heads], np.arange(len(heads))
    to = np.maximum(at + run, np.searchsorted(words, words[at] + least, "left"))
    back = np.minimum(at + 1 - run, np.searchsorted(words, words[at + 1] - least, "right") - 1)
    forth_ok, back_ok = to <= np.searchsorted(row, row, "right"), back >= np.searchsorted(row, row, "left")
    return (words[np.concatenate((at[forth_ok], back[back_ok]))], words[np.concatenate((to[forth_ok], at[back_ok] + 1))],
            np.repeat([False, True], [forth_ok.sum(), back_ok.sum()]), np.concatenate((to[forth_ok] - 1, at[back_ok])))


def runs(data: np.ndarray, offsets: np.ndarray):
    """All runs: (row, first word, words, whether only pieces, hash, other hash), words counted from 0 per row."""
    starts, ends, rows, code, heads, last, first = sentences(data, offsets)
    none = np.zeros(0, np.int64)
    if not len(heads):
        return none, none, none, none.astype(bool), none.astype(np.uint64), none.astype(np.uint64)
    # Sentences: from each on, and back from lines' ends.  Pieces: both ways everywhere.
    a, b, back, end = _stretches(heads, rows, RUN, MIN_WORDS)
    whole = ~back | last[end]
    n = np.int64(len(code) + 1)
    known = np.unique(a[whole] * n + b[whole])
    a, b, _, _ = _stretches(pieces(code, first), rows, 1, LEAST)
    only = np.setdiff1d(a * n + b, known)
    both, only = np.concatenate((known, only)), np.repeat([False, True], [len(known), len(only)])
    a, b = both // n, both % n
    powers, inverse = _powers(len(code) + 1)
    found = []
    for values in (code, mix(code + np.uint64(0x632BE59BD9B4E019))):
        total = np.zeros(len(code) + 1, np.uint64)
        np.cumsum(values * powers[: len(code)], out=total[1:])
        found.append(mix((total[b] - total[a]) * inverse[a] + (b - a).astype(np.uint64)))
    return rows[a], a - np.searchsorted(rows, rows[a], "left"), b - a, only, *found


#: A shuffled row: hash; 32 bits of the text's hash over 32 more bits of hash; id; place, negative if
#: the stretch is marked already.  A document's rows follow each other, so what they share, which
#: lies side by side, is compressed in the shuffle.  A place is the first word, a bit for runs of pieces, and the words: at
#: most ``RUN * MAX_WORDS``, so 7 bits hold them.
_FIELDS = ["h", "q", "id", "place"]
_PIECES, _LENGTH_BITS = 1 << 7, 8


def _beyond(place: np.ndarray, own: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Places, those of pieces without words that lie in the first run of the hash too (in one text of few words)."""
    size = place & _PIECES - 1
    shared = (place & _PIECES > 0) & (own[:3] == first[:3]).all(axis=0) & (own[3] > first[3])
    less = np.where(shared, np.maximum(first[3] + size - own[3], 0), 0)
    return place + (less << _LENGTH_BITS) - less


def _runs_of(batches):
    """Rows to shuffle: runs, and stretches already known to be no first ones; ``SLICES`` slices of text at a time."""
    for batch in batches:
        ids, marks = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(0xFFFFFFFF)
        parts = []
        for low, _, data, offsets in text_slices(batch.column(2)):
            row, a, size, only, h, g = runs(data, offsets)
            parts.append((row + low, a, a << _LENGTH_BITS | only * _PIECES | size, h, g))
            if len(parts) == SLICES:
                yield _sent(ids, marks, parts)
                parts = []
        if parts:
            yield _sent(ids, marks, parts)


def _sent(ids, marks: np.ndarray, parts: list[tuple]):
    """The rows for the runs of some slices, in the order of documents and places."""
    row, a, place, h, g = (np.concatenate(x) for x in zip(*parts, strict=True))
    null = ~ids.is_valid().to_numpy(zero_copy_only=False)
    value = np.where(null, 0, ids.fill_null(0).to_numpy(zero_copy_only=False))
    g >>= np.uint64(32)
    q = marks[row] << np.uint64(32) | g
    own = np.stack([null[row].astype(np.int64), value[row].astype(np.int64), marks[row].astype(np.int64), a])
    order = np.lexsort((*own[::-1], g, h))
    own, head = own[:, order], np.ones(len(order), bool)
    head[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    # The same place of an equal row is not a later one: it is neither sent nor marked.
    lead = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
    later = (own != own[:, lead]).any(axis=0)
    place = _beyond(place[order], own, own[:, lead])[head | later]
    order = order[head | later]
    again = np.argsort(order, kind="stable")
    place, sent, order = place[again], head[head | later][again], order[again]
    row, a, h, q = row[order], a[order], h[order], q[order]
    # A marked stretch needs no partner: it is dealt out by its document.
    key = np.where(sent, h, mix(value[row].astype(np.uint64) + a.astype(np.uint64)))
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(q.view(np.int64)), ids.take(pa.array(row)),
                                       pa.array(np.where(sent, place, ~place))], names=_FIELDS)


def _later_runs(batches):
    """(id, t, place) of sorted rows that are not the first of their hash, and the marked ones.

    Rows come sorted by hash, and within one hash by document and place; the first place of a
    hash that goes on from the last batch is held.
    """
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h, q, place = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
        g, t, sent, ids = q & 0xFFFFFFFF, (q.view(np.uint64) >> np.uint64(32)).astype(np.int64), place >= 0, batch.column(2)
        own = np.stack([(~ids.is_valid().to_numpy(zero_copy_only=False)).astype(np.int64), ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                        t, place >> _LENGTH_BITS])
        head = np.ones(len(h), bool)
        head[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1]) | ~sent[1:] | ~sent[:-1]
        if held is not None and sent[0] and held[0] == (h[0], g[0]):
            goes_on = int(np.flatnonzero(head[1:])[0]) + 1 if head[1:].any() else len(h)
            first = held[1]
        else:
            goes_on, first = 0, own[:, 0]
        lead = np.maximum.accumulate(np.where(head, np.arange(len(h)), 0))
        firsts = own[:, lead]
        firsts[:, :goes_on] = first[:, None]
        later = ~sent | (own != firsts).any(axis=0)
        held = ((h[-1], g[-1]), first if goes_on == len(h) else own[:, lead[-1]]) if sent[-1] else None
        picked = np.flatnonzero(later)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(picked)), pa.array(t[picked]), pa.array(np.where(sent, _beyond(place, own, firsts), ~place)[picked])],
                                         names=["id", "t", "place"])


def _mark(text: str):
    """32 bits of the text's hash, which tell rows of one id apart."""
    return F.xxhash64(F.col(f"`{text}`").cast("string")).bitwiseAND(F.lit(0xFFFFFFFF))


def repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, t, places): stretches of words found again, of each document that has any.

    A place is ``first word << 8 | only pieces << 7 | words``.  The list is bounded by the document's words.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("id"), _mark(text).alias("t"), F.col(text).cast("string"))
    found = map_texts(rows, _runs_of, f"h long, q long, id {kind}, place long")
    # Within a hash: the rest of the hash, then the order of documents and places; marked rows come first.
    order = ["h", F.expr("place >= 0"), F.col("q").bitwiseAND(F.lit(0xFFFFFFFF)), F.col("id").asc_nulls_last(), F.shiftrightunsigned("q", 32), "place"]
    later = found.repartition("h").sortWithinPartitions(*order).mapInArrow(_later_runs, f"id {kind}, t long, place long")
    return later.groupBy("id", "t").agg(F.collect_set("place").alias("places"))


def _parts(marked: np.ndarray, least: int) -> np.ndarray:
    """The marked words that stand in unbroken rows of ``least`` or more."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))
    sizes = edges[1::2] - edges[::2]
    out = np.zeros(len(marked), bool)
    out[marked] = np.repeat(sizes >= least, sizes)
    return out


def _without(text: str, places: list[int]) -> tuple[str, int]:
    data = np.frombuffer(text.encode(), np.uint8)
    starts, _, _, _, heads, _, _ = sentences(data, np.array([0, len(data)]))
    places = np.array(places)
    first, size, only = places >> _LENGTH_BITS, places & _PIECES - 1, places & _PIECES > 0

    def covered(picked):
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, first[picked], 1)
        np.add.at(change, (first + size)[picked], -1)
        return np.cumsum(change)[:-1] > 0
    whole = covered(~only)
    gone = whole | _parts(_parts(covered(only | ~only), LONG) & ~whole, EDGE)
    begins = np.append(starts, len(data))
    change = np.flatnonzero(np.diff(np.concatenate(([True], gone, [True])).astype(np.int8)))
    keep = [data[: begins[0]].tobytes(), *[data[begins[x]: begins[y]].tobytes() for x, y in zip(change[::2], change[1::2], strict=True)]]
    return b"".join(keep).decode(), int(np.logical_or.reduceat(gone, heads).sum())


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str = "n_removed") -> DataFrame:
    """``docs`` with repeated sentence spans cut out of ``text``, and the number of sentences cut,
    wholly or in part.

    The first span in the order of (id, text hash, position) stays; null ids come last.  Rows that
    are equal in id and text are one document and get the same text.  Null texts stay null;
    texts without a word stay as they are; empty tables stay empty.  All other columns are
    kept; one called ``removed`` is replaced.  What a cut leaves keeps its white space.
    """
    names = [c for c in docs.columns if c != removed]
    kept = [f"c{i}" for i in range(len(names))]  # columns go by their place, so no name can clash
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).toDF(*kept)
    place = names.index(text)
    own, whole = kept[names.index(doc_id)], kept[place]
    found = repeated(rows.select(own, whole), own, whole)
    found = written(found.select(F.col("id").alias("_id"), F.col("t").alias("_t2"), F.col("places").alias("_places")), "repeats")
    rows = rows.withColumn("_t", _mark(whole))
    # Only texts that may have a repeat are shuffled to meet it.
    near, far = split_by_keys(rows, F.xxhash64(own, "_t"), found.select(F.xxhash64("_id", "_t2").alias("key")))
    joined = (near.join(found, near[own].eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_t2")), "left").drop("_id", "_t", "_t2")
              .unionByName(far.drop("_t").withColumn("_places", F.lit(None).cast("array<long>"))))
    schema = joined.drop("_places").withColumn(whole, F.col(whole).cast("string")).withColumn("n", F.lit(0).cast("long")).schema

    def cut(batches):
        for batch in batches:
            places = batch.column(len(kept))
            texts, counts = batch.column(place), np.zeros(batch.num_rows, np.int64)
            hit = np.flatnonzero(places.is_valid().to_numpy(zero_copy_only=False))
            if len(hit):
                new = texts.take(pa.array(hit)).to_pylist()
                for k, (i, s) in enumerate(zip(hit, places.take(pa.array(hit)).to_pylist(), strict=True)):
                    new[k], counts[i] = _without(new[k], s)
                mask = np.zeros(batch.num_rows, bool)
                mask[hit] = True
                import pyarrow.compute as pc
                texts = pc.replace_with_mask(texts, pa.array(mask), pa.array(new, texts.type))
            cols = [texts if i == place else batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(counts)], names=[*kept, "n"])

    return map_texts(joined, cut, schema).toDF(*names, removed)
