"""Load patterns.

Writes go to path-addressed parquet tables.  Partition replacement uses
dynamic partition overwrite, so one write replaces exactly the partitions
present in the new data (idempotent reloads without delete + append).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tessera.operators.quality import LoadGuardError, enforce_key_guard
from tessera.session import materialise
from tessera.sources.readers import with_file_lineage


def create_or_replace(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                      fmt: str = "parquet") -> None:
    """Full replacement."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def table_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    try:
        spark.read.format(fmt).load(path).schema  # noqa: B018 - resolves the path
        return True
    except AnalysisException:
        return False


def ensure_table(spark: SparkSession, path: str, schema: StructType,
                 partition_by: Sequence[str] = ()) -> bool:
    """Create an empty table when absent (K02); returns True when created."""
    if table_exists(spark, path):
        return False
    create_or_replace(spark.createDataFrame([], schema), path, partition_by)
    return True


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str],
                       refuse_empty: bool = True) -> None:
    """Atomically replace the partitions present in ``df``.

    Other partitions are untouched; rerunning with the same input is a
    no-op in effect.  An empty input is refused rather than silently
    leaving stale data.
    """
    if refuse_empty:
        # Fixed once, so that the check does not compute the input a second time.
        df = materialise(df, "load")
        if df.isEmpty():
            raise LoadGuardError("empty source; refusing to replace partitions")
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def replace_by_source_file(df: DataFrame, path: str, source: str = "source_file") -> None:
    """Replace the rows that came from the same source files before.

    The table is partitioned by source file, so a reloaded file replaces its own
    partition in one committed overwrite and no other rows are read.
    """
    replace_partitions(df, path, [source])


def validated_overwrite(df: DataFrame, path: str, key: str) -> None:
    """Load guards (empty, invalid ids, duplicates) then one overwrite."""
    enforce_key_guard(df, key)
    create_or_replace(df, path)


def stage(df: DataFrame, path: str) -> None:
    """Overwrite with lineage columns, schema merge off."""
    with_file_lineage(df).write.mode("overwrite").option("mergeSchema", "false").parquet(path)


def insert_select(df: DataFrame, path: str, schema: StructType) -> None:
    """Project to the declared DDL (names and types) and replace."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    create_or_replace(df.select(*cols), path)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Named lazy layer."""
    df.createOrReplaceTempView(name)
    return df


def ensure_layers(spark: SparkSession, layers: Sequence[str] = ("bronze", "silver", "gold"),
                  base: str | None = None) -> None:
    """Namespaces for the medallion layers (K10), below ``base`` if given."""
    for layer in layers:
        place = f" LOCATION '{base}/{layer}'" if base else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`{place}")


def check_submission(df: DataFrame, template: DataFrame, id_col: str,
                     value_cols: Sequence[str], non_negative: bool = True) -> DataFrame:
    """Submission checks in one aggregate (K11): same ids as the template,
    no NULL / non-finite / negative predictions.  Returns the check row."""
    t = template.select(F.col(id_col).alias("_tid"))
    j = t.join(df, t["_tid"] == df[id_col], "full")
    bad = F.lit(False)
    for c in value_cols:
        v = F.col(c)
        bad = bad | v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
        if non_negative:
            bad = bad | (v < 0)
    return j.agg(F.count_if(F.col(id_col).isNull()).alias("missing_ids"),
                 F.count_if(F.col("_tid").isNull()).alias("extra_ids"),
                 F.count_if(F.col(id_col).isNotNull() & bad).alias("bad_values"),
                 (F.count(F.col(id_col)) - F.count_distinct(F.col(id_col))).alias("duplicate_ids"))


def write_submission(df: DataFrame, template: DataFrame, id_col: str, value_cols: Sequence[str],
                     path: str) -> None:
    """Write exactly ``id_col`` + ``value_cols`` as CSV after the checks pass."""
    check = check_submission(df, template, id_col, value_cols).first().asDict()
    if any(check.values()):
        raise LoadGuardError(f"submission checks failed: {check}")
    df.select(id_col, *value_cols).write.mode("overwrite").option("header", "true").csv(path)


def write_with_run_log(df: DataFrame, path: str, log_path: str, run_id: str, source: str,
                       partition_by: Sequence[str] = ()) -> dict:
    """Write ``df`` and append its row count to a run log.

    The count is read back from the written parquet, which needs only the
    file footers (no second pass over the data).  ``Observation`` is avoided
    on purpose: once used it leaves a non-serializable manager on the session
    that breaks later closure-based jobs such as Spark ML fits.
    """
    create_or_replace(df, path, partition_by)
    rows = df.sparkSession.read.parquet(path).count()
    metrics = {"rows": rows}
    log = df.sparkSession.createDataFrame(
        [(run_id, source, path, int(metrics["rows"]))],
        "run_id string, source string, target string, rows long").withColumn(
        "logged_at", F.current_timestamp())
    log.write.mode("append").parquet(log_path)
    return {"run_id": run_id, "rows": int(metrics["rows"])}
