import gzip
import hashlib
import io

import pytest
from pyarrow import fs

from tessera.llm import warc
from tessera.llm.common import written
from tests.llm.conftest import ODD_TEXTS

SCHEMA = "page_id long, url string, html string, size string, record string"


def pages(spark, rows):
    """rows of (page_id, html[, url])."""
    return spark.createDataFrame([(r[0], r[2] if len(r) > 2 else f"http://a.example/{r[0]}", r[1], "x", "y") for r in rows], SCHEMA)


def brute(rows):
    """page_id -> the other four columns; rows with distinct ids."""
    out, first = {}, {}
    for i, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (html or "").encode()
        again = len(data) >= 100 and data in first
        first.setdefault(data, i)
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[data] if again else None)
    return out


def make_rows(rng):
    big = "".join(rng.choice(list("abcdé 中"), 60_000))
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(100, big), (90, big), (101, big[:-1]), (None, big), (110, "x" * 99), (111, "x" * 99), (112, "x" * 100), (113, "x" * 100)]
    return rows + [(200 + i, "copy of one page " * 10) for i in range(40)] + [(300, "WARC/1.1\r\n\r\nWARC/1.1\r\n"), (301, "a\r\n\r\n" * 30, "http://odd /\r\nWARC-Type: x%20é"), (302, "b", None)]


def test_matches_brute_force(spark, rng):
    rows = make_rows(rng)
    got = {r.page_id: tuple(r)[1:] for r in warc.round_trip(pages(spark, rows).repartition(5)).collect()}
    assert got == brute(rows)


def test_chunks_carry_digests_and_archives_give_them_back(spark, rng):
    rows = make_rows(rng)
    chunks = written(warc.carry_digests(warc.chunk_rows(pages(spark, rows), chunk=1000)), "test-chunks")
    assert max(len(r.data) for r in chunks.collect()) == 1000
    manifest = warc.write_archives(chunks, archive=1 << 15, date="2020-01-01T00:00:00Z")
    files = manifest.collect()
    assert len(files) > 2 and sum(f.n_records for f in files) == len(rows)
    back = sorted(warc.read_archives(manifest).collect(), key=lambda r: (r.record, r.chunk))
    want = dict((r[0], (r[1] or "").encode()) for r in rows)
    held = {}
    for r in back:
        if r.record_type == "response":
            held[r.id] = held.get(r.id, b"") + bytes(r.data)
            assert r.size == len(held[r.id]) and r.digest == hashlib.sha256(held[r.id]).hexdigest()
        else:
            assert r.data is None and r.refers_to is not None and want[r.refers_to] == want[r.id] and r.size == len(want[r.id])
    assert all(want[i] == data for i, data in held.items()) and len(held) < len(want)
    uris = {r.id: r.uri for r in back}
    assert uris[301] == "http://odd%20/%0D%0AWARC-Type:%20x%20é" and uris[302] is None and uris[100] == "http://a.example/100"
    # Each record is a gzip member of its own, so any gzip reader gets plain WARC text.
    store, path = fs.FileSystem.from_uri(files[0].path)
    with store.open_input_stream(path) as f:
        text = gzip.decompress(f.read())
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.count(b"\r\nWARC-Date: 2020-01-01T00:00:00Z\r\n") == files[0].n_records + 1


def test_damaged_archives_are_errors():
    head = {"record": 1, "id": 2, "uri": None, "size": 3, "digest": hashlib.sha256(b"abc").hexdigest(), "refers": None}
    good = warc._heads(head, "2020-01-01T00:00:00Z") + b"abc\r\n\r\n"
    assert [r[7:] for r in warc.parsed(io.BytesIO(good * 2), chunk=2)] == [(2, hashlib.sha256(b"ab").hexdigest(), b"ab"), (3, head["digest"], b"c")] * 2
    for bad in (good.replace(b"abc", b"abd"), good[:-6], b"junk\r\n" + good):
        with pytest.raises(ValueError):
            list(warc.parsed(io.BytesIO(bad)))


def test_repeated_rows_and_empty_table(spark):
    long = "same page " * 20
    got = sorted(tuple(r)[1:] for r in warc.round_trip(pages(spark, [(7, long), (7, long), (7, "a"), (7, "a"), (8, long)])).collect())
    digest = hashlib.sha256(long.encode()).hexdigest()
    assert sorted(r for r in got if r[0] == 200) == [(200, digest, "response", None), (200, digest, "revisit", 7), (200, digest, "revisit", 7)] or \
        sorted(r[2] for r in got if r[0] == 200) == ["response", "revisit", "revisit"]
    assert [r[2] for r in got if r[0] == 1] == ["response"] * 2
    assert warc.round_trip(pages(spark, [])).count() == 0
