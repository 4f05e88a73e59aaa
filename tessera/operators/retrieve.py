"""Vectors for text chunks and retrieval for tables of questions.

Questions and corpus are dealt into cells: a block of questions and a part of the corpus.  A task
holds one block (as a matrix, or as an inverted index from terms to questions), streams
the corpus rows of its part, and keeps the best ``k`` of each question; the bests of all parts are merged.  No
(question, row) pair and no vector stands in the plan, and both tables may grow.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import tokens
from tessera.session import materialise

#: Questions of a block, corpus rows of a part, corpus rows scored in one step; decimals by which scores are ranked.
BLOCK, PART, STEP, DIGITS = 512, 8192, 256, 9


def term_counts(df: DataFrame, key: Column, text: str) -> DataFrame:
    """(key, term, tf) of each text's terms; texts without a term have no row."""
    return df.select(key.alias("key"), F.explode(tokens(text)).alias("term")).groupBy("key", "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequencies(counts: DataFrame) -> DataFrame:
    """(term, df): in how many texts each term stands, from one pass over ``term_counts``."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf(counts: DataFrame, frequencies: DataFrame, n: int) -> DataFrame:
    """(key, terms, weights): sparse vectors of length 1.

    A weight is ``tf * (ln((1 + n) / (1 + df)) + 1)`` for ``n`` texts; terms that ``frequencies`` lacks are left out, so
    questions are weighted as the corpus is.  A vector is as long as its text has different terms.
    """
    weight = F.col("tf") * (F.log((1.0 + n) / (1.0 + F.col("df"))) + 1.0)
    rows = counts.join(frequencies, "term").select("key", "term", weight.alias("w"))
    kind = dict(rows.dtypes)["key"]
    # A text's terms are sorted once and become a vector in one pass; its length is taken once, not for each term.
    return rows.repartition("key").sortWithinPartitions("key", "term").mapInArrow(_unit_vectors, f"key {kind}, terms array<string>, weights array<double>")


def _differs(column) -> np.ndarray:
    """For each value but the first, whether it differs from the one before; NULLs are equal to each other."""
    if isinstance(column.type, pa.StructType):
        valid = column.is_valid().to_numpy(zero_copy_only=False)
        return np.logical_or.reduce([valid[1:] != valid[:-1], *[_differs(field) for field in column.flatten()]])
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    return pc.not_equal(column[1:], column[:-1]).fill_null(False).to_numpy(zero_copy_only=False) | (valid[1:] != valid[:-1])


def _unit_vectors(batches):
    """Rows of a key follow each other; those of the last key of a batch wait for the next one."""
    held = None

    def vectors(rows, edges):
        weight = rows.column(2).to_numpy(zero_copy_only=False)
        size = np.sqrt(np.add.reduceat(weight ** 2, edges[:-1]))
        edge = pa.array(edges, pa.int32())
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(pa.array(edges[:-1])), pa.ListArray.from_arrays(edge, rows.column(1)),
             pa.ListArray.from_arrays(edge, pa.array(weight / np.repeat(size, np.diff(edges))))], names=["key", "terms", "weights"])
    for batch in batches:
        if batch.num_rows == 0:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        first = np.concatenate(([0], np.flatnonzero(_differs(batch.column(0))) + 1))
        held = batch.slice(int(first[-1]))
        if len(first) > 1:
            yield vectors(batch.slice(0, int(first[-1])), first)
    if held is not None:
        yield vectors(held, np.array([0, held.num_rows]))


class _Dense:
    """Scores rows against a block by a matrix product of unit vectors."""

    def __init__(self, batch):
        self.questions = self._unit(batch)

    @staticmethod
    def _unit(batch):
        x = np.array(batch.column(5).to_pylist(), np.float64).reshape(batch.num_rows, -1)
        size = np.sqrt((x ** 2).sum(axis=1, keepdims=True))
        return np.divide(x, size, out=np.full_like(x, np.nan), where=size > 0)

    def scores(self, batch):
        return self._unit(batch) @ self.questions.T


class _Sparse:
    """Scores rows through an inverted index of a block: term -> questions and weights."""

    def __init__(self, batch):
        flat, owner, weight = self._flat(batch)
        self.count, self.terms = batch.num_rows, pc.unique(flat)
        at = pc.index_in(flat, value_set=self.terms).to_numpy(zero_copy_only=False)
        order = np.argsort(at, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.edges = np.searchsorted(at[order], np.arange(len(self.terms) + 1))

    @staticmethod
    def _flat(batch):
        terms, weights = batch.column(4), batch.column(5)
        sizes = pc.list_value_length(terms).fill_null(0).to_numpy(zero_copy_only=False)
        return terms.flatten(), np.repeat(np.arange(batch.num_rows), sizes), weights.flatten().to_numpy(zero_copy_only=False)

    def scores(self, batch):
        flat, owner, weight = self._flat(batch)
        at = pc.index_in(flat, value_set=self.terms)
        known = at.is_valid().to_numpy(zero_copy_only=False)
        at, owner, weight = at.fill_null(0).to_numpy(zero_copy_only=False)[known], owner[known], weight[known]
        n = self.edges[at + 1] - self.edges[at]
        place = np.repeat(self.edges[at] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        cell = np.repeat(owner, n) * self.count + self.owner[place]
        size = batch.num_rows * self.count
        out = np.bincount(cell, np.repeat(weight, n) * self.weight[place], minlength=size).astype(np.float64)
        # Rows that share no term with a question are no answer.
        out[np.bincount(cell, minlength=size) == 0] = np.nan
        return out.reshape(batch.num_rows, self.count)


def _search(batches, k: int, scorer):
    """Cells come one after the other: a cell's questions, then its corpus rows in the order of their keys."""
    at, held, block, asked, best = None, [], None, None, None

    def result():
        number, score, keys = best
        return pa.RecordBatch.from_arrays([asked.take(pa.array(number)), keys, pa.array(score)], names=["question", "key", "score"])
    for batch in batches:
        cell = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)
        change = np.flatnonzero((cell[1:] != cell[:-1]).any(axis=1)) + 1
        for lo, hi in zip(np.concatenate(([0], change)), np.append(change, len(cell)), strict=True):
            if lo == hi:
                continue
            part = batch.slice(lo, hi - lo)
            if tuple(cell[lo, :2]) != at:
                if best is not None:
                    yield result()
                at, held, block, best = tuple(cell[lo, :2]), [], None, None
            if cell[lo, 2] == 0:
                held.append(part)
                continue
            if not held:
                continue
            if block is None:
                whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                block, asked = scorer(whole), whole.column(3)
            for first in range(0, part.num_rows, STEP):
                some = part.slice(first, STEP)
                found = np.round(block.scores(some), DIGITS)
                row, number = np.nonzero(~np.isnan(found))
                score, keys = found[row, number], some.column(6).take(pa.array(row))
                if best is not None:
                    number, score, keys = np.concatenate((best[0], number)), np.concatenate((best[1], score)), pa.concat_arrays([best[2], keys])
                # Stable: of equal scores those that came first, with smaller keys, stay ahead.
                order = np.lexsort((np.arange(len(score)), -score, number))
                number = number[order]
                new = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1]))) if len(number) else np.zeros(0, np.int64)
                keep = np.arange(len(number)) - np.repeat(new, np.diff(np.append(new, len(number)))) < k
                order = order[keep]
                best = number[keep], score[order], keys.take(pa.array(order))
    if best is not None:
        yield result()


def top_k(questions: DataFrame, corpus: DataFrame, k: int = 3, block: int = BLOCK, part: int = PART) -> DataFrame:
    """question, key, score, rank: the ``k`` corpus rows with the highest cosine for each question.

    ``questions`` has ``key`` and either ``vector`` (array of numbers) or ``terms`` and ``weights`` (:func:`tfidf`); ``corpus`` has the
    same.  Keys may be of any type that can be ordered.  Scores are rounded to ``DIGITS`` decimals and ties go to the smaller key.  Vectors that are NULL,
    hold a NULL or have length zero take no part, nor do sparse rows that share no term with a question.
    Repeated rows are rows of their own; repeated question keys are one question each.
    """
    dense = "vector" in corpus.columns

    def shaped(df):
        if not dense:
            return df.select("key", "terms", "weights")
        v = F.transform("vector", lambda x: x.cast("double"))
        return (df.where(F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull()))
                .select("key", F.lit(None).cast("array<string>").alias("terms"), v.alias("weights")))
    asked = materialise(shaped(questions).withColumn("n", F.monotonically_increasing_id()), "questions")
    rows = materialise(shaped(corpus).withColumn("n", F.monotonically_increasing_id()), "retrieval-rows")
    blocks, parts = max(1, -(-asked.count() // block)), max(1, -(-rows.count() // part))
    kind = dict(rows.dtypes)["key"]

    def spread(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(n):
        return F.pmod(F.xxhash64("n"), F.lit(n)).cast("int")
    cells = (asked.select(dealt(blocks).alias("block"), spread(parts).alias("part"), F.lit(0).alias("kind"), F.col("n").alias("question"), "terms", "weights",
                          F.lit(None).cast(kind).alias("key"))
             .unionByName(rows.select(spread(blocks).alias("block"), dealt(parts).alias("part"), F.lit(1).alias("kind"),
                                      F.lit(None).cast("long").alias("question"), "terms", "weights", "key")))
    scorer = _Dense if dense else _Sparse
    found = (cells.repartition("block", "part").sortWithinPartitions("block", "part", "kind", "key")
             .mapInArrow(lambda b: _search(b, k, scorer), f"question long, key {kind}, score double"))
    w = Window.partitionBy("question").orderBy(F.col("score").desc(), F.col("key").asc())
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.join(asked.select(F.col("n").alias("question"), F.col("key").alias("_asked")), "question").select(
        F.col("_asked").alias("question"), "key", "score", "rank")
