"""Byte-level BPE with the tokenizers library (operator 1): exact encoding in pieces.

``TextEncoder`` encodes whole texts.  Three exact ways lead to the same ids:

* ``direct`` hands the text to the library.
* ``encode_many`` cuts a text into pre-tokens by the pre-tokeniser's own pattern and has
  each distinct one encoded by the library once, as long as its bounded store holds it.
* ``concat`` joins the encodings of two neighbouring parts that were cut anywhere.  It
  encodes a window around the join again and lets it grow until it agrees with both
  sides; ``concat_tree`` joins a list of parts pairwise, level by level.

Why ``concat`` is exact.  The pre-tokeniser reads from left to right and looks at few
bytes past a piece's end, so a boundary that lies ``MARGIN`` bytes or more before the
end of what was read is one in the whole text also, and from a common boundary on two
readings are the same.  Within one piece too long to read again, BPE has this property:
ids are the encoding of their bytes if each two neighbours are the encoding of theirs.
A window inside the piece that gives back the outermost ids of both sides therefore
proves that the spliced row is right.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LONG_SPAN, byte_windows, equal_spans, span_hashes, text_slices

#: Bytes past a boundary that can still move it: the longest added token and contraction, doubled.
MARGIN = 32
#: Ids that must agree on each side of a window inside one long piece.
AGREE = 4


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest follows from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(rest)}


# Classes of characters for the byte-level pre-tokeniser.
_LETTER, _NUMBER, _SPACE, _OTHER = range(4)


def _class_of(char: str) -> int:
    kind = unicodedata.category(char)[0]
    # White space up to U+024F.
    return (_SPACE if char in " \t\n\v\f\r\x85\xa0" else _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER)


_CLASS = np.array([_class_of(chr(c)) for c in range(0x250)], np.uint8)
_ASCII_CLASS = np.full(256, _OTHER, np.uint8)
_ASCII_CLASS[:128] = _CLASS[:128]
#: Bytes of characters from U+0250 on, whose class may depend on the Unicode version, and 0x1C to 0x1F.
_ODD_BYTE = np.zeros(256, bool)
_ODD_BYTE[0xC9 + 1:] = True
_ODD_BYTE[0x1C:0x20] = True


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pre-tokens begin, for texts up to U+024F one after the other.

    They are the matches of 's 't 're 've 'm 'll 'd, an optional space with letters, numbers or
    others, and runs of white space without their last character if a word follows.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind = _ASCII_CLASS[data]
    lead = np.flatnonzero(data >= 0xC2)
    wide = _CLASS[(data[lead].astype(np.int64) & 0x1F) << 6 | data[lead + 1] & 0x3F]
    kind[lead], kind[lead + 1] = wide, wide
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    start |= border
    # White space before a word: its last character stands alone, or joins the word if it is a space.
    after = np.flatnonzero(start[1:n] & ~border[1:n] & (kind[:-1] == _SPACE) & (kind[1:] != _SPACE)) + 1
    last = after - 1
    last -= (data[last] & 0xC0) == 0x80
    start[last] = True
    start[after[data[after - 1] == 0x20]] = False
    # Contractions: a lone apostrophe that begins a pre-token, and the letters behind it.
    mark = np.flatnonzero((data[: n - 1] == 0x27) & start[: n - 1] & start[1:n] & ~border[1:n] & (kind[1:] == _LETTER))
    if len(mark):
        one = np.isin(data[mark + 1], np.frombuffer(b"stmd", np.uint8))
        third = np.where(mark + 2 < n, data[np.minimum(mark + 2, n - 1)], 0)
        third[border[np.minimum(mark + 2, n)]] = 0
        two = ((third == 0x65) & np.isin(data[mark + 1], np.frombuffer(b"rv", np.uint8))) | ((third == 0x6C) & (data[mark + 1] == 0x6C))
        for hit, size in ((one, 2), (two, 3)):
            start[mark[hit] + 1] = False
            start[mark[hit] + size] = True
    return np.flatnonzero(start[:n])


@dataclass
class Part:
    """An encoded stretch of a text; ``heads`` marks ids that begin a pre-token."""

    data: bytes
    ids: np.ndarray
    heads: np.ndarray


class _Pile:
    """Values that are only added at the end; what is there is copied when room runs out, not with each addition."""

    def __init__(self, kind):
        self._room, self._n = np.zeros(64, kind), 0

    @property
    def values(self) -> np.ndarray:
        return self._room[: self._n]

    def windows(self) -> np.ndarray:
        """As ``byte_windows``, without a copy; bytes beyond the end may have any value."""
        return np.ndarray((self._n + 1,), "<u8", self._room, strides=(1,))

    def add(self, values: np.ndarray) -> None:
        end = self._n + len(values)
        if end + 8 > len(self._room):
            room = np.zeros(max(end + 8, len(self._room) * 5 // 4), self._room.dtype)
            room[: self._n] = self.values
            self._room = room
        self._room[self._n: end] = values
        self._n = end

    def cut(self, n: int) -> None:
        """Only the first ``n`` values stay."""
        self._n = n


_NO_LEVEL = (np.zeros(0, np.uint64), np.zeros(0, np.int32))


def _merged(keys: np.ndarray, rows: np.ndarray, more: np.ndarray, more_rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted rows of hashes without a common one as one, with what belongs to each."""
    where = np.searchsorted(keys, more)
    return np.insert(keys, where, more), np.insert(rows, where, more_rows)


def _places(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of the spans, one span after the other."""
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class TextEncoder:
    """Encodes and decodes with one tokeniser file; keeps the ids of ``store`` pre-tokens or so."""

    def __init__(self, path: str, store: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        #: Cutting holds for a plain byte-level pre-tokeniser and short added tokens.
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                     and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or set(" \n") & set(t["content"]) for t in added)
                     and all(2 <= len(t["content"].encode()) < MARGIN // 2 for t in added))
        chars = _byte_of_char()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.bytes_of: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            known = all(c in chars for c in token)
            self.bytes_of[i] = bytes(chars[c] for c in token) if known else token.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.added_heads = {tuple(t["content"].encode()[:2]) for t in added}
        self.store = store
        self._forget()

    def direct(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of whole texts as little-endian uint32, by the library alone."""
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def encode_many(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids (uint32) of each whole text; equal to ``direct``."""
        raw = [t.encode() for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
        return self.encode_slice(np.frombuffer(b"".join(raw), np.uint8), offsets)

    def encode_slice(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """As ``encode_many`` for UTF-8 texts that lie one after the other."""
        rows = len(offsets) - 1
        if not self.cuts:
            plain = np.ones(rows, bool)
        else:
            # Other scripts, separators 0x1C to 0x1F and added tokens go to the library as whole texts.
            odd = _ODD_BYTE[data]
            for first, second in self.added_heads:
                odd[:-1] |= (data[:-1] == first) & (data[1:] == second)
            total = np.concatenate(([0], np.cumsum(odd)))
            plain = total[offsets[1:]] > total[offsets[:-1]]
        out: list = [None] * rows
        whole = np.flatnonzero(plain)
        if len(whole):
            texts = [data[offsets[k]: offsets[k + 1]].tobytes().decode() for k in whole]
            for k, ids in zip(whole, self.direct(texts), strict=True):
                out[k] = np.frombuffer(ids, "<u4")
        if len(whole) == rows:
            return out
        if len(whole):
            keep = np.repeat(~plain, np.diff(offsets))
            data, offsets = data[keep], np.concatenate(([0], np.cumsum(np.diff(offsets)[~plain])))
        starts = pre_tokens(data, offsets)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        ids, counts = self._lookup(data, starts, ends)
        edges = np.concatenate(([0], np.cumsum(counts)))[np.searchsorted(starts, offsets)]
        for k, i in enumerate(np.flatnonzero(~plain)):
            out[i] = ids[edges[k]: edges[k + 1]]
        return out

    def _lookup(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens in a row, and how many each has.

        Pre-tokens meet by a 64-bit hash; the bytes of each are then compared with those of its
        representative, here and in the store.  What differs, and what is too long to be worth a comparison,
        is encoded by itself, so a collision of hashes changes no id.
        """
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        size, windows = ends - starts, byte_windows(data)
        keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        ahead = first[inverse]
        alike = np.flatnonzero((size <= LONG_SPAN) & (size == size[ahead]))
        proven = np.zeros(len(starts), bool)
        proven[alike] = equal_spans(windows, starts[alike], windows, starts[ahead[alike]], size[alike])
        short = size[first] <= LONG_SPAN
        keys, place, first = keys[short], np.cumsum(short) - 1, first[short]
        a, n = starts[first], size[first]
        if sum(len(level) for level, _ in self._levels) > self.store:
            self._forget()
        begin, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known, taken = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        for level, rows in self._levels:
            if not len(level):
                continue
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            met = np.flatnonzero(level[at] == keys)
            taken[met] = True
            row = rows[at[met]]
            fits = self._size.values[row] == n[met]
            met, row = met[fits], row[fits]
            equal = equal_spans(windows, a[met], self._bytes.windows(), self._from.values[row], n[met])
            met, row = met[equal], row[equal]
            known[met], begin[met], count[met] = True, self._begin.values[row], self._count.values[row]
        new = np.flatnonzero(~known)
        if len(new):
            fresh, begins, count[new] = self._encoded(data, a[new], n[new])
            begin[new] = len(self._ids.values) + begins
            self._ids.add(fresh)
            # A hash met before with other bytes keeps its first owner in the store.
            self._keep(keys, a, n, begin, count, np.flatnonzero(~known & ~taken), data)
        counts, begins = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        counts[proven], begins[proven] = count[place[inverse[proven]]], begin[place[inverse[proven]]]
        apart, kept = np.flatnonzero(~proven), len(self._ids.values)
        if len(apart):
            once: dict[bytes, int] = {}
            which = [once.setdefault(data[starts[k]: ends[k]].tobytes(), k) for k in apart]
            where, which = np.unique(which, return_inverse=True)
            fresh, begin, count = self._encoded(data, starts[where], size[where])
            counts[apart], begins[apart] = count[which], kept + begin[which]
            self._ids.add(fresh)
        out = self._ids.values[_places(begins, counts)]
        self._ids.cut(kept)
        return out, counts

    def _keep(self, keys, a, n, begin, count, insert, data) -> None:
        """Take pre-tokens into the store: new hashes join a short level, which joins the long one now and then."""
        a, n = a[insert], n[insert]
        row = len(self._from.values) + np.arange(len(insert), dtype=np.int32)
        self._from.add(len(self._bytes.values) + np.cumsum(n) - n)
        self._bytes.add(data[_places(a, n)])
        self._size.add(n)
        self._begin.add(begin[insert])
        self._count.add(count[insert])
        (old, old_rows), late = self._levels
        keys, rows = _merged(*late, keys[insert], row)
        self._levels = [(old, old_rows), (keys, rows)]
        if len(keys) > max(1 << 14, len(old) // 4):
            self._levels = [_merged(old, old_rows, keys, rows), _NO_LEVEL]

    def _encoded(self, data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of single pre-tokens by the library; where those of each begin, and how many it has.

        Pre-tokens go to the library many at a time, as one text in which each is a pre-token again: one
        that begins with a space and goes on with a word just follows, others stand behind a line end (white
        space goes alone).  The lengths of the ids tell which are whose; where they do not fit, each goes alone.
        """
        pieces, begins, counts, have = [np.zeros(0, np.uint32)], np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64), 0
        follows = (data[starts] == 0x20) & (size > 1)
        at = starts + follows
        second = data[np.minimum(at + 1, len(data) - 1)]
        space = (_ASCII_CLASS[data[at]] == _SPACE) | ((data[at] == 0xC2) & ((second == 0x85) | (second == 0xA0)))
        alone, rest = [np.flatnonzero(space)], np.flatnonzero(~space)
        for k in range(0, len(rest), 4096):
            own = rest[k: k + 4096]
            end = np.cumsum(size[own] + ~follows[own])
            text = np.full(end[-1], 0x0A, np.uint8)
            text[_places(end - size[own], size[own])] = data[_places(starts[own], size[own])]
            ids = np.array(self.tok.encode_batch_fast([text.tobytes().decode()], add_special_tokens=False)[0].ids, np.uint32)
            edges = np.concatenate(([0], np.cumsum(self.lengths[ids])))
            lo, hi = (np.minimum(np.searchsorted(edges, x), len(ids)) for x in (end - size[own], end))
            if edges[-1] != end[-1] or (edges[lo] != end - size[own]).any() or (edges[hi] != end).any():
                alone.append(own)
                continue
            begins[own], counts[own] = have + lo, hi - lo
            pieces.append(ids)
            have += len(ids)
        for own in alone:
            for k in range(0, len(own), 4096):
                texts = [data[x: x + m].tobytes().decode() for x, m in zip(starts[own[k: k + 4096]], size[own[k: k + 4096]], strict=True)]
                found = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
                n = np.array([len(f) for f in found])
                begins[own[k: k + 4096]], counts[own[k: k + 4096]] = have + np.cumsum(n) - n, n
                pieces.append(np.fromiter(chain.from_iterable(found), np.uint32))
                have += int(n.sum())
        return np.concatenate(pieces), begins, counts

    def _forget(self) -> None:
        self._bytes, self._ids = _Pile(np.uint8), _Pile(np.uint32)
        self._from, self._size, self._begin, self._count = _Pile(np.int64), _Pile(np.int32), _Pile(np.int64), _Pile(np.int32)
        #: Sorted hashes and their places in the piles: most of them, and those that came last.
        self._levels = [_NO_LEVEL, _NO_LEVEL]

    def decode(self, ids: np.ndarray) -> str:
        """As the library's ``decode(ids, skip_special_tokens=False)``."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")

    def part(self, data: bytes) -> Part:
        """Encode one stretch with the places where pre-tokens begin."""
        e = self.tok.encode(data.decode(), add_special_tokens=False)
        ids = np.array(e.ids, np.uint32)
        words = [-1 if w is None else w for w in e.word_ids]
        heads = np.ones(len(ids), bool)
        if len(ids):
            words = np.array(words, np.int64)
            heads[1:] = (words[1:] != words[:-1]) | (words[1:] < 0)
        return Part(data, ids, heads)

    def _starts(self, part: Part) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.lengths[part.ids])))

    def concat(self, left: Part, right: Part, window: int = 64) -> Part:
        """Encoding of ``left.data + right.data`` from both encodings."""
        if not len(left.ids) or not len(right.ids):
            return right if not len(left.ids) else left
        data = left.data + right.data
        ls, rs = self._starts(left), self._starts(right)
        n, m = len(left.data), len(right.data)
        lheads, rheads = np.flatnonzero(left.heads), np.flatnonzero(right.heads)
        w = max(window, 2 * MARGIN)
        while True:
            # Whole pre-tokens: from a boundary well before the join to one well behind it.
            settled = lheads[ls[lheads] <= n - w]
            a = int(settled[-1]) if len(settled) else 0
            later = rheads[rs[rheads] >= w]
            b = int(later[0]) if len(later) else len(right.ids)
            if (ls[a] < n - 8 * w or rs[b] > 8 * w) and (spliced := self._inside(left, right, ls, rs, w)):
                return Part(data, *spliced)
            mid = self.part(left.data[ls[a]:] + right.data[: rs[b]])
            ms = self._starts(mid)
            join, size = n - int(ls[a]), n - int(ls[a]) + int(rs[b])
            limit = size if b == len(right.ids) else size - MARGIN
            mine = np.flatnonzero(mid.heads)
            mine = mine[(ms[mine] >= join) & (ms[mine] <= limit)]
            both = np.intersect1d(ms[mine], rs[rheads] + join)
            if len(both):
                i, j = int(np.searchsorted(ms, both[0])), int(np.searchsorted(rs, both[0] - join))
                return Part(data, np.concatenate((left.ids[:a], mid.ids[:i], right.ids[j:])),
                            np.concatenate((left.heads[:a], mid.heads[:i], right.heads[j:])))
            if b == len(right.ids):
                return Part(data, np.concatenate((left.ids[:a], mid.ids)), np.concatenate((left.heads[:a], mid.heads)))
            w *= 2

    def _inside(self, left: Part, right: Part, ls: np.ndarray, rs: np.ndarray, w: int):
        """A join inside one pre-token that is long on both sides, or None."""
        n, m = len(left.data), len(right.data)
        lo = ls[np.flatnonzero(left.heads)[-1]]
        others = np.flatnonzero(right.heads)[1:]
        hi = rs[others[0]] if len(others) else m
        while w <= 1 << 16:
            a = int(np.searchsorted(ls, n - w, "right")) - 1
            b = int(np.searchsorted(rs, w))
            while a > 0 and left.data[ls[a]] & 0xC0 == 0x80:
                a -= 1
            while b < len(right.ids) and right.data[rs[b]] & 0xC0 == 0x80:
                b += 1
            if n - w <= lo + MARGIN or w + MARGIN >= hi or ls[a] <= lo or rs[b] >= hi:
                return None
            mid = self.part(left.data[ls[a]:] + right.data[: rs[b]])
            if mid.heads.sum() != 1:
                return None
            k = min(AGREE, b, len(left.ids) - a)
            if (len(mid.ids) >= 2 * k and np.array_equal(mid.ids[:k], left.ids[a: a + k])
                    and np.array_equal(mid.ids[-k:], right.ids[b - k: b])):
                return (np.concatenate((left.ids[:a], mid.ids, right.ids[b:])),
                        np.concatenate((left.heads[:a], np.zeros(len(mid.ids), bool), right.heads[b:])))
            w *= 2
        return None

    def concat_tree(self, parts: Sequence[Part]) -> Part:
        """Join neighbours pairwise until one part is left."""
        level = list(parts) or [Part(b"", np.zeros(0, np.uint32), np.zeros(0, bool))]
        while len(level) > 1:
            level = [self.concat(*level[i: i + 2]) if i + 1 < len(level) else level[i]
                     for i in range(0, len(level), 2)]
        return level[0]


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


def encoded_rows(e: TextEncoder, column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each whole text of an Arrow column in turn (null: none)."""
    for _, _, data, offsets in text_slices(column):
        yield from e.encode_slice(data, offsets)


def _digests(e: TextEncoder, ids: np.ndarray) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
            hashlib.sha256(e.decode(ids).encode()).hexdigest())


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                     long_chars: int = 32_768, leaf_chars: int = 16_384) -> DataFrame:
    """Whole texts as (doc_id, ids): ``ids`` is an array of int, by tree concatenation.

    Texts of up to ``long_chars`` characters are encoded where they are read.  A longer
    one is cut every ``leaf_chars`` characters; the leaves are spread over tasks, encoded
    there, and joined pairwise by ``concat_tree`` with only windows encoded again.

    Null texts give an empty array; null ids are kept; repeated rows give repeated rows;
    an empty table gives an empty table; other columns are not carried, so their names
    cannot clash.
    """
    return _encoded(docs, path, doc_id, text, long_chars, leaf_chars, "ids array<int>",
                    lambda e, ids: (ids.astype(np.int32).tolist(),))


def encode_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text",
                   long_chars: int = 32_768, leaf_chars: int = 16_384) -> DataFrame:
    """As ``encode_documents``, with the digests of ids and of the text decoded from them.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256.
    """
    return _encoded(docs, path, doc_id, text, long_chars, leaf_chars,
                    "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _encoded(docs, path, doc_id, text, long_chars, leaf_chars, fields, result) -> DataFrame:
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"))
    n = F.coalesce(F.length("_text"), F.lit(0))
    schema = f"_id {kind}, {fields}"
    names = ["_id", *[f.split()[0] for f in fields.split(", ")]]
    out_schema = spark.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out_schema)

    def short(batches):
        e = encoder(path)
        for batch in batches:
            ids = batch.column(0)
            found = [result(e, x) for x in encoded_rows(e, batch.column(1))]
            if found:
                columns = [pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays([ids.cast(arrow.field(0).type), *columns], names=names)

    def leaves(batches):
        e = encoder(path)
        for batch in batches:
            cols = {f: batch.column(f) for f in ("_id", "_digest", "_leaf", "_copies")}
            parts = [e.part(x.encode()) for x in batch.column("_part").to_pylist()]
            cols |= {"_data": pa.array([p.data for p in parts], pa.binary()),
                     "_ids": pa.array([p.ids.astype("<u4").tobytes() for p in parts], pa.binary()),
                     "_heads": pa.array([np.packbits(p.heads).tobytes() for p in parts], pa.binary())}
            yield pa.RecordBatch.from_pydict(cols)

    def joined(key, group):
        import pandas as pd

        e = encoder(path)
        parts = []
        for data, ids, heads in zip(*(group.sort_values("_leaf")[c] for c in ("_data", "_ids", "_heads")), strict=True):
            ids = np.frombuffer(ids, "<u4")
            parts.append(Part(data, ids, np.unpackbits(np.frombuffer(heads, np.uint8), count=len(ids)).astype(bool)))
        found = result(e, e.concat_tree(parts).ids)
        first = group["_id"].iloc[0]
        row = pd.DataFrame([(None if pd.isna(first) else first, *found)], columns=names).astype({"_id": object})
        return pd.concat([row] * int(group["_copies"].iloc[0]), ignore_index=True)

    plain = rows.where(n <= long_chars).mapInArrow(short, schema)
    long = rows.where(n > long_chars).withColumn("_digest", F.sha2("_text", 256))
    count = F.ceil(F.length("_text") / F.lit(leaf_chars)).cast("int")
    cut = (long.select("_id", "_digest", "_text", F.explode(F.sequence(F.lit(0), count - 1)).alias("_leaf"))
           .select("_id", "_digest", "_leaf",
                   F.substring(F.col("_text"), F.col("_leaf") * leaf_chars + 1, F.lit(leaf_chars)).alias("_part"))
           .groupBy("_id", "_digest", "_leaf")
           .agg(F.first("_part").alias("_part"), F.count(F.lit(1)).alias("_copies")))
    leaf_schema = f"_id {kind}, _digest string, _leaf int, _copies long, _data binary, _ids binary, _heads binary"
    trees = (cut.mapInArrow(leaves, leaf_schema).groupBy("_id", "_digest")
             .applyInPandas(joined, schema))
    return plain.unionByName(trees).withColumnRenamed("_id", doc_id)


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Adds the text of an id array, as the library decodes it (null ids: null).

    A column that is already called ``name`` is replaced.
    """
    @F.pandas_udf("string")
    def text_of(column):
        e = encoder(path)
        return column.map(lambda x: None if x is None else e.decode(np.asarray(x, np.int64)))

    return encoded.withColumn(name, text_of(F.col(ids)))
