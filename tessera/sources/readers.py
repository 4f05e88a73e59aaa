"""Readers (S01-S13).

All readers return lazy DataFrames over splittable scans.  Formats whose records are
counted across lines (S04, X20) are counted per split and joined by number.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from tessera.functions.cleaning import table_name
from tessera.functions.text import strip_html


def _string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = "\t",
                   record_tail: str | None = None, quote: str | None = None) -> DataFrame:
    """Headerless delimited text with positional column names.

    ``sep`` may be multi-character (e.g. ``+|``); ``record_tail`` (e.g.
    ``&|``) is stripped from the end of the last field.
    """
    reader = spark.read.schema(_string_schema(columns)).option("sep", sep).option("header", "false")
    if quote is not None:
        reader = reader.option("quote", quote)
    df = reader.csv(path)
    if record_tail:
        last = columns[-1]
        df = df.withColumn(last, F.regexp_replace(last, _regex_escape(record_tail) + "$", ""))
    return df


def _regex_escape(s: str) -> str:
    import re
    return re.escape(s)


def read_terminated_records(spark: SparkSession, path: str, columns: Sequence[str],
                            record_sep: str = "&|", field_sep: str = "+|") -> DataFrame:
    """Records ending in ``record_sep`` that may span lines.

    The text source splits on the terminator (still a splittable scan);
    line breaks after a terminator are stripped, CRLF inside records becomes
    LF, blank records are dropped, and fields are split positionally.
    """
    lines = spark.read.option("lineSep", record_sep).text(path)
    v = F.regexp_replace(F.regexp_replace("value", r"^[\r\n]+", ""), "\r\n", "\n")
    recs = lines.select(v.alias("value")).where(F.trim("value") != "")
    parts = F.split("value", _regex_escape(field_sep), -1)
    return recs.select(*[parts[i].alias(c) for i, c in enumerate(columns)])


def ordered_lines(spark: SparkSession, path: str, counts: dict[str, Column]) -> DataFrame:
    """Non-blank lines with their place in the file, and running counts over all earlier lines of it.

    Returns _file, _block, _line, value and, for each name, the sum of its expression (of ``value``) over the lines
    before.  Files are read in splits: each split sums its own lines, and the sums of the splits before come
    from a table with one row per split, so a large file is counted by as many tasks as read it.
    A line belongs to the split in which it begins; lines of a split keep their order.
    """
    lines = (spark.read.text(path)
             .select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                     F.monotonically_increasing_id().alias("_line"), "value")
             .where(F.trim("value") != "").withColumns({f"_v_{n}": c.cast("long") for n, c in counts.items()}))
    inside = Window.partitionBy("_file", "_block").orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    splits = (lines.groupBy("_file", "_block").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in counts])
              .select("_file", "_block", *[F.coalesce(F.sum(f"_s_{n}").over(earlier), F.lit(0)).alias(f"_o_{n}") for n in counts]))
    local = lines.withColumns({f"_l_{n}": F.coalesce(F.sum(f"_v_{n}").over(inside), F.lit(0)) for n in counts})
    return (local.join(splits, ["_file", "_block"])
            .select("_file", "_block", "_line", "value", *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(n) for n in counts]))


def read_by_field_count(spark: SparkSession, path: str, columns: Sequence[str],
                        n_delims: int | None = None, sep: str = "\t") -> DataFrame:
    """Re-join physical lines into records that hold ``n_delims`` separators.

    Record number = 1 + floor(separators before this line / n_delims) over
    non-blank lines in file order; lines of one record are joined with LF.
    Separators are counted per split (:func:`ordered_lines`), so a record may cross a split: its
    lines meet by file and record number.
    """
    n_delims = n_delims or len(columns) - 1
    lines = ordered_lines(spark, path, {"_before": F.size(F.split("value", _regex_escape(sep), -1)) - 1})
    recs = (lines.groupBy("_file", F.floor(F.col("_before") / n_delims).alias("_record"))
            .agg(F.array_sort(F.collect_list(F.struct("_block", "_line", "value"))).alias("_l")))
    text = F.array_join(F.transform("_l", lambda s: s["value"]), "\n")
    parts = F.split(text, _regex_escape(sep), -1)
    return recs.select(*[parts[i].alias(c) for i, c in enumerate(columns)])


def read_numbered_stories(spark: SparkSession, path: str) -> DataFrame:
    """Questions of numbered story files (X20): file, story_no, line_no, story, question, answer, supporting.

    A line is ``number text``; number 1 begins a new story.  A text with tabs is ``question TAB answer TAB
    supporting numbers``; any other is a statement.  ``story`` joins the statements of the question's story that
    stand before it with spaces (empty if there are none).  Stories are numbered from 1 in each file,
    by counting first lines per split, so a story may cross a split.  Lines before the first number 1
    are story 0.  Blank lines are skipped; a line without a number is an error.  Only one story's
    statements are held together.
    """
    number = F.regexp_extract("value", r"^\s*(\S+)", 1).cast("int")
    lines = ordered_lines(spark, path, {"_starts": (number == 1).cast("long")})
    lines = lines.select("_file", "_block", "_line", number.alias("line_no"), (F.col("_starts") + (number == 1).cast("long")).alias("story_no"),
                         F.split(F.regexp_extract("value", r"^\s*\S+ ?([\s\S]*)$", 1), "\t", -1).alias("_parts"))
    place = F.struct("_block", "_line")
    asked = F.size("_parts") > 1
    story = (lines.groupBy("_file", "story_no")
             .agg(F.array_sort(F.collect_list(F.when(~asked, F.struct(place.alias("at"), F.trim(F.col("_parts")[0]).alias("text"))))).alias("_said"),
                  F.collect_list(F.when(asked, F.struct(place.alias("at"), "line_no", F.col("_parts").alias("parts")))).alias("_asked")))
    one = story.select("_file", "story_no", "_said", F.explode("_asked").alias("q"))
    said = F.transform(F.filter("_said", lambda x: x["at"] < F.col("q.at")), lambda x: x["text"])
    part = F.col("q.parts")
    return one.select(F.col("_file").alias("file"), "story_no", F.col("q.line_no").alias("line_no"), F.array_join(said, " ").alias("story"),
                      F.trim(part[0]).alias("question"), F.get(part, F.lit(1)).alias("answer"), F.get(part, F.lit(2)).alias("supporting"))


def read_csv_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Header CSV checked against a declared schema, failing fast.

    Column pruning is off for this read alone, so that every column of every
    row is parsed (and can fail) even when few are selected.
    """
    return (spark.read.schema(schema).option("header", "true").option("enforceSchema", "false")
            .option("columnPruning", "false").option("mode", "FAILFAST").csv(path))


def read_parquet_cast(spark: SparkSession, path: str, types: dict[str, str],
                      rename: dict[str, str] | None = None) -> DataFrame:
    """Parquet (globs allowed) projected to declared names and types."""
    rename = rename or {}
    df = spark.read.parquet(path)
    return df.select(*[F.col(src).cast(t).alias(rename.get(src, src)) for src, t in types.items()])


def with_file_lineage(df: DataFrame) -> DataFrame:
    """Source path, file name, size, modification time and load time.

    ``df`` must come straight from a file scan (the hidden ``_metadata``
    column is resolved against the scan).
    """
    return df.select("*",
                     F.col("_metadata.file_path").alias("source_path"),
                     F.col("_metadata.file_name").alias("source_file"),
                     F.col("_metadata.file_size").alias("source_size"),
                     F.col("_metadata.file_modification_time").alias("source_modified_at"),
                     F.current_timestamp().alias("loaded_at"))


def read_snapshot(spark: SparkSession, base: str, batch_id: str | None = None,
                  fmt: str = "parquet") -> DataFrame:
    """Pin reads to one immutable ``batch_id=`` directory.

    Without ``batch_id`` the latest committed batch (largest id) is used;
    either way the filter prunes to one partition directory.
    """
    df = spark.read.format(fmt).load(base)
    if batch_id is None:
        batch_id = df.select(F.max("batch_id")).first()[0]
    return df.where(F.col("batch_id") == F.lit(batch_id))


def register_inferred(spark: SparkSession, folder: str, pattern: str = "*.csv", max_files: int = 1000) -> list[str]:
    """Every CSV in ``folder`` becomes a temp view named after its file.

    Names come from Spark's own file listing, so the folder may be in any store.  Views are made on the
    driver, so more than ``max_files`` files are an error; parts of one table are read in one scan instead.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
             .select("path").orderBy("path").limit(max_files + 1).collect())
    if len(files) > max_files:
        raise ValueError(f"more than {max_files} files in {folder}")
    names = []
    for (path,) in files:
        name = table_name(unquote(path.rsplit("/", 1)[-1]))
        (spark.read.option("header", "true").option("inferSchema", "true").csv(path)
         .createOrReplaceTempView(name))
        names.append(name)
    return names


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Inline scenario / assumption table."""
    return spark.createDataFrame(rows, schema)


def check_parquet_files(spark: SparkSession, glob: str) -> DataFrame:
    """Per file: size >= 8 bytes and ``PAR1`` at both ends.

    Only paths and sizes come from the listing; each task then opens its files
    and reads four bytes at either end.
    """
    files = spark.read.format("binaryFile").load(glob).select("path", "length")
    n = max(1, min(files.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def ends(batches):
        import pandas as pd
        from pyarrow import fs

        for batch in batches:
            good = []
            for path, length in zip(batch["path"], batch["length"], strict=True):
                uri = path if "://" in path else path.replace("file:", "file://", 1)
                store, name = fs.FileSystem.from_uri(unquote(uri))
                ok = length >= 8
                if ok:
                    with store.open_input_file(name) as f:
                        ok = f.read_at(4, 0) == b"PAR1" == f.read_at(4, length - 4)
                good.append(ok)
            yield pd.DataFrame({"path": batch["path"], "length": batch["length"], "is_valid": good})

    return files.repartition(n).mapInPandas(ends, "path string, length long, is_valid boolean")


def read_corpus(spark: SparkSession, folder: str, kind: str = "text", carry: Sequence[str] = (), schema: str | None = None) -> DataFrame:
    """Documents with their source name (S13): text/markdown/HTML as whole files, JSON as one multi-line record
    per file, ``jsonl`` as many records per file.

    ``carry`` keeps partition columns of the folder.  A corpus of very many small documents belongs into ``jsonl``
    files, whose number is bounded: each file is listed on the driver.  ``schema`` spares the JSON kinds
    a pass that finds the columns.
    """
    if kind in ("json", "jsonl"):
        reader = spark.read.option("multiLine", kind == "json")
        df = (reader.schema(schema) if schema else reader).json(folder)
        return df.withColumn("source", F.col("_metadata.file_name"))
    df = spark.read.text(folder, wholetext=True)  # an option() of that name is overridden by text()
    df = df.select(*carry, F.col("_metadata.file_name").alias("source"), F.col("value").alias("text"))
    if kind == "html":
        df = df.withColumn("text", strip_html("text"))
    return df
