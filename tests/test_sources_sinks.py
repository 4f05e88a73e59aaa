"""Readers and load patterns on temp-dir fixtures."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera import sinks, sources
from tessera.operators.quality import LoadGuardError


def _write(folder, name, data: bytes):
    p = os.path.join(folder, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="tessera-io-")


def test_tab_and_multichar_delimiters(spark, tmp):
    p = _write(tmp, "a.tsv", b"1\tx\t\n2\ty\tz\n")
    rows = sources.read_delimited(spark, p, ["id", "a", "b"]).orderBy("id").collect()
    assert [(r.id, r.a, r.b) for r in rows] == [("1", "x", None), ("2", "y", "z")]
    q = _write(tmp, "p.txt", b"1+|Ann+|Lee&|\n2+|Bob+|&|\n")
    rows = sources.read_delimited(spark, q, ["id", "first", "last"], sep="+|", record_tail="&|").orderBy("id").collect()
    assert [(r.first, r.last) for r in rows] == [("Ann", "Lee"), ("Bob", "")]


def test_terminated_records_with_crlf_and_embedded_newlines(spark, tmp):
    data = b"1+|line one\r\nline two&|\r\n2+|single&|\r\n\r\n3+|&|"
    p = _write(tmp, "doc.txt", data)
    rows = sources.read_terminated_records(spark, p, ["id", "body"]).orderBy("id").collect()
    assert [(r.id, r.body) for r in rows] == [("1", "line one\nline two"), ("2", "single"), ("3", "")]


def test_records_by_field_count(spark, tmp):
    # the multi-line field is followed by one more field, as in the review export
    data = b"1\tfirst line\r\n\r\ncontinued\tend\n2\tsingle\tend2\n"
    p = _write(tmp, "rev.txt", data)
    rows = sources.read_by_field_count(spark, p, ["id", "comment", "tail"]).orderBy("id").collect()
    assert [(r.id, r.comment, r.tail) for r in rows] == [("1", "first line\ncontinued", "end"),
                                                          ("2", "single", "end2")]


def test_strict_csv_fails_fast_on_short_row(spark, tmp):
    schema = StructType([StructField(c, StringType()) for c in ["LocationID", "Borough", "Zone"]])
    ok = _write(tmp, "ok.csv", b"LocationID,Borough,Zone\n1,N/A,Z\n")
    assert sources.read_csv_strict(spark, ok, schema).first().Borough == "N/A"
    bad = _write(tmp, "bad.csv", b"LocationID,Borough,Zone\n1,B\n")
    with pytest.raises(Exception):
        sources.read_csv_strict(spark, bad, schema).select("LocationID").collect()


def test_parquet_cast_lineage_and_check(spark, tmp):
    path = os.path.join(tmp, "t")
    spark.createDataFrame([(1, "2.5")], "VendorID int, fare string").write.parquet(path)
    df = sources.read_parquet_cast(spark, path, {"VendorID": "bigint", "fare": "double"},
                                   {"VendorID": "vendor_id"})
    assert df.dtypes == [("vendor_id", "bigint"), ("fare", "double")]
    lin = sources.with_file_lineage(spark.read.parquet(path)).first()
    assert lin.source_file.endswith(".parquet") and lin.source_size > 0
    _write(tmp, "junk.parquet", b"PAR")
    checks = {os.path.basename(r.path): r.is_valid
              for r in sources.check_parquet_files(spark, os.path.join(tmp, "*", "*.parquet")).collect()}
    assert checks and all(checks.values())
    bad = sources.check_parquet_files(spark, os.path.join(tmp, "junk.parquet")).first()
    assert bad.is_valid is False


def test_register_inferred_and_corpus(spark, tmp):
    _write(tmp, "Product Cost-History.csv", b"a,b\n1,x\n")
    assert sources.register_inferred(spark, tmp) == ["product_cost_history"]
    assert spark.table("product_cost_history").first().a == 1
    d = os.path.join(tmp, "corpus")
    os.makedirs(d)
    _write(d, "p.html", b"<html><script>x()\n</script>\n<p>Hello\n  <b>world</b></p></html>\n")
    r = sources.read_corpus(spark, d, "html").first()
    assert (r.source, r.text) == ("p.html", "Hello world")


def test_partition_replacement_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "silver")
    a = spark.createDataFrame([("2024-01", 1), ("2024-02", 2)], "source_month string, v int")
    sinks.replace_partitions(a, path, ["source_month"])
    b = spark.createDataFrame([("2024-02", 20), ("2024-02", 21)], "source_month string, v int")
    sinks.replace_partitions(b, path, ["source_month"])
    sinks.replace_partitions(b, path, ["source_month"])
    got = sorted((r.source_month, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01", 1), ("2024-02", 20), ("2024-02", 21)]
    with pytest.raises(LoadGuardError):
        sinks.replace_partitions(b.where("v < 0"), path, ["source_month"])


def test_snapshot_ensure_guard_and_run_log(spark, tmp):
    base = os.path.join(tmp, "bronze")
    for bid, v in (("001", 1), ("002", 2)):
        spark.createDataFrame([(v,)], "v int").write.parquet(os.path.join(base, f"batch_id={bid}"))
    assert sources.read_snapshot(spark, base).first().v == 2
    assert sources.read_snapshot(spark, base, "001").first().v == 1
    schema = StructType([StructField("k", StringType())])
    t = os.path.join(tmp, "t")
    assert sinks.ensure_table(spark, t, schema) is True
    assert sinks.ensure_table(spark, t, schema) is False
    with pytest.raises(LoadGuardError):
        sinks.validated_overwrite(spark.createDataFrame([(1,), (1,)], "id int"), t, "id")
    res = sinks.write_with_run_log(spark.range(5).withColumn("m", F.lit("x")), os.path.join(tmp, "o"),
                                   os.path.join(tmp, "log"), "r1", "unit")
    assert res["rows"] == 5
    assert spark.read.parquet(os.path.join(tmp, "log")).first().rows == 5


def test_submission_checks(spark):
    tmpl = spark.createDataFrame([(1,), (2,)], "id int")
    good = spark.createDataFrame([(1, 0.5), (2, 1.0)], "id int, y double")
    bad = spark.createDataFrame([(1, -1.0), (3, float("nan"))], "id int, y double")
    assert not any(sinks.check_submission(good, tmpl, "id", ["y"]).first().asDict().values())
    c = sinks.check_submission(bad, tmpl, "id", ["y"]).first()
    assert (c.missing_ids, c.extra_ids, c.bad_values) == (1, 1, 2)


def _in_small_splits(spark, read):
    """Run ``read`` with splits of a few hundred bytes, so that one file goes to many tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "300")
        return read()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def test_counted_records_cross_the_splits_of_a_file(spark, tmp):
    """Records with line breaks in a field, blank lines between, one record longer than several splits."""
    rows = [(str(i), f"note {i}\n" + "\n".join(["more text"] * (i % 5)) + ("\nlong line " * 120 if i == 40 else "") + "end", str(i * 7)) for i in range(120)]
    one = _write(tmp, "a.txt", "\n".join("\t".join(r) for r in rows).encode())
    _write(tmp, "b.txt", "\n\n".join("\t".join(r) for r in rows[:50]).encode())

    def read():
        lines = sources.ordered_lines(spark, one, {"_n": F.lit(1)})
        splits = lines.select("_block").distinct().count()
        return splits, [sorted(map(tuple, sources.read_by_field_count(spark, p, ["id", "note", "n"]).collect())) for p in (one, tmp)]
    splits, (alone, both) = _in_small_splits(spark, read)
    clean = [(a, "\n".join(x for x in b.split("\n") if x.strip()), c) for a, b, c in rows]
    assert splits > 10 and alone == sorted(clean) and both == sorted(clean + clean[:50])


def test_numbered_stories(spark, tmp):
    text, want, said, n, number = [], [], [], 0, 0
    for i in range(300):
        n += 1
        if i % 23 == 0:
            n, said, number = 1, [], number + 1
        if i % 3 == 2:
            text.append(f"{n} Where is {i}?\troom {i}\t{n - 1} {n - 2}")
            want.append((number, n, " ".join(said), f"Where is {i}?", f"room {i}", f"{n - 1} {n - 2}"))
        else:
            text.append(f"{n} Person {i} went to room {i}.")
            said.append(f"Person {i} went to room {i}.")
    _write(tmp, "one.txt", "\n".join(text).encode())
    _write(tmp, "two.txt", b"\r\n1 Only this.\r\n2 Was it?\tyes\r\n3 A word\r\n1 Anything?\t\t\r\n")
    got = _in_small_splits(spark, lambda: sources.read_numbered_stories(spark, tmp).collect())
    assert sorted(tuple(r)[1:] for r in got if r.file.endswith("one.txt")) == sorted(want)
    assert sorted(tuple(r)[1:] for r in got if r.file.endswith("two.txt")) == [(1, 2, "Only this.", "Was it?", "yes", None), (2, 1, "", "Anything?", "", "")]
