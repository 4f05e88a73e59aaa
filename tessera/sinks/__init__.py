"""Load patterns: replace, partition replacement, guarded overwrite, run log."""

from tessera.sinks.writers import (  # noqa: F401
    check_submission, create_or_replace, create_view, ensure_layers, ensure_table, insert_select,
    replace_by_source_file, replace_partitions, stage, table_exists, validated_overwrite, write_submission,
    write_with_run_log)
