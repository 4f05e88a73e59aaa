"""Readers for delimited, terminated, strict-CSV, parquet and corpus inputs."""

from tessera.sources.readers import (  # noqa: F401
    check_parquet_files, literal_table, ordered_lines, read_by_field_count, read_corpus, read_csv_strict,
    read_delimited, read_numbered_stories, read_parquet_cast, read_snapshot, read_terminated_records, register_inferred,
    with_file_lineage)
