"""A training-corpus pipeline over ``documents``: five stages, each one operator of ``tessera.llm``.

Each stage takes all rows that its predecessor kept and returns the columns of documents; the
last returns the packing plan.  ``run`` writes each stage's rows as Parquet into the
shared folder and reads them again for the next one; once that one is written, they are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import langid, packing, simhash, substrings, toxicity
from tessera.llm.common import remove_written, shared_path
from tessera.llm.queries import tokenizer_path
from tessera.tables import load


def _kept(docs: DataFrame, predict, model, keep: Column) -> DataFrame:
    """The rows of ``docs`` for which ``keep`` holds after ``predict``, all columns as they were.

    Columns go by their place while ``predict`` runs, so the columns it adds replace none of theirs.
    """
    places = [f"c{i}" for i in range(len(docs.columns))]
    judged = predict(docs.toDF(*places), model, text=places[docs.columns.index("text")])
    return judged.where(keep).select(*places).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with calibrated confidence.

    Null texts and texts without a letter go, and so do all texts if no row has a text and a language to
    learn from.  Whole texts are judged, however long; null ids are judged like others; repeated rows get
    one verdict and stay or go together.  An empty table stays empty.
    """
    model = langid.train(langid.learnable(docs.select("doc_id", "text", "lang")))
    return _kept(docs, langid.predict, model, ~F.col("rejected"))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5.

    Null and empty texts have the intercept's score.  Without labels of both classes nothing can be
    learned and all rows stay.  Null ids are never learned from but judged; repeated rows stay or
    go together.  An empty table stays empty.
    """
    model = toxicity.train(docs.select("doc_id", "text"), toxicity.learnable(load(spark, sf_dir, "labels")))
    return _kept(docs, toxicity.predict, model, F.col("predicted") == 0)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the smallest id (4-word shingles, 4 bits).

    Null texts and texts without a word are one component.  Of repeated rows of the smallest id one stays;
    null ids lose to all others.  An empty table stays empty; no name can clash.
    """
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentences of repeated spans, ``n_chars`` counted again where something was cut.

    Null texts stay null, texts without a word stay as they are; of equal spans the one in the smallest
    (id, text hash, position) stays, null ids last; rows equal in id and text get the same text.  An empty
    table stays empty; a column of the operator's name is kept.
    """
    removed = "n_removed"
    while removed in docs.columns:
        removed += "_"
    cut = substrings.remove_repeats(docs, removed=removed)
    counted = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", F.when(F.col(removed) > 0, counted).otherwise(F.col("n_chars"))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packing plan: doc_id, piece, start, n_tokens, bucket, batch, slot, padding.

    Null and empty texts make no sequence; long ones make several; null ids and repeated rows are
    sequences of their own.  An empty table gives an empty plan; no other column is read.
    """
    return packing.length_buckets(packing.token_counts(docs, tokenizer_path()))


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter), ("simhash_dedup", simhash_dedup),
          ("substring_dedup", substring_dedup), ("packing", pack)]

#: Models and fingerprints have no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs, before = load(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path, kept = shared_path(spark, f"pipeline-{name}"), stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            remove_written(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
