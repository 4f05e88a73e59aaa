"""tessera: a PySpark-native library of analytics operators.

Every operator is a plain function from DataFrames (plus parameters) to a
DataFrame; the work is expressed with the DataFrame / SQL API so Catalyst and
AQE choose the physical plan.  Sub-packages:

* ``sources``   – readers (delimited, terminated records, strict CSV, ...)
* ``sinks``     – load patterns (overwrite, partition replace, SCD writes)
* ``functions`` – column-expression helpers (cleaning, hashing, dates, XML)
* ``operators`` – relational, quality, SCD, statistics, evaluation, text
* ``plans``     – the registered queries over the driver tables
* ``streaming`` – Structured Streaming variants of the quality split
"""

from tessera.session import build_session, checkpoint_dir  # noqa: F401

__all__ = ["build_session", "checkpoint_dir"]
