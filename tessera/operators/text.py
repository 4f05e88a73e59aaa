"""Text, sequence and retrieval operators.

Texts are processed whole.  Token-level work is exploded into rows so that
vocabulary counts are partial aggregations and lookups are joins; per-text
regrouping is bounded by the text's own length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.text import tokens
from tessera.operators.windows import global_row_number

# Padding id, out-of-vocabulary id.
PAD_ID = 0
OOV_ID = 1


def char_chunks(df: DataFrame, text: str, size: int, keys: Sequence[str]) -> DataFrame:
    """Fixed-size character chunks without overlap, whole text covered."""
    n = F.length(text)
    starts = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).otherwise(
        F.array().cast("array<int>"))
    x = df.select(*keys, text, F.explode(starts).alias("_i"))
    return x.select(*keys, (F.col("_i") + 1).alias("chunk_id"),
                    F.substring(F.col(text), F.col("_i") * size + 1, F.lit(size)).alias("chunk_text")
                    ).withColumn("chunk_chars", F.length("chunk_text"))


def word_chunks(df: DataFrame, text: str, size: int, keys: Sequence[str]) -> DataFrame:
    """Chunks of ``size`` words, the whole text covered (X27); texts without words give none."""
    x = df.select(*keys, F.regexp_extract_all(F.col(text), F.lit(r"[^\s]+"), F.lit(0)).alias("_w"))
    n = F.size("_w")
    starts = F.when(n > 0, F.sequence(F.lit(0), F.ceil(n / size).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return x.select(*keys, "_w", F.explode(starts).alias("_i")).select(
        *keys, (F.col("_i") + 1).alias("chunk_id"),
        F.array_join(F.slice("_w", F.col("_i") * size + 1, F.lit(size)), " ").alias("chunk_text"))


def paragraph_chunks(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Non-blank lines as chunks with their 1-based line position."""
    x = df.select(*keys, F.posexplode(F.split(F.col(text), "\n")).alias("_p", "paragraph"))
    return (x.where(F.trim("paragraph") != "")
            .select(*keys, (F.col("_p") + 1).alias("paragraph_id"), "paragraph"))


def token_rows(df: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """One row per token with its 0-based position in the text."""
    return df.select(*keys, F.posexplode(tokens(text)).alias("pos", "token"))


def vocabulary(df: DataFrame, text: str, first_id: int = OOV_ID + 1) -> DataFrame:
    """Tokens ranked by frequency (ties alphabetical) with ids from ``first_id``.

    Counting is a partial aggregation (a frequent token is pre-counted per
    task); ids come from a range-partitioned row number over the vocabulary.
    """
    counts = (df.select(F.explode(tokens(text)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("count")))
    ranked = global_row_number(counts, [F.col("count").desc(), F.col("token").asc()], "_rank")
    return ranked.select("token", "count", (F.col("_rank") + first_id - 1).alias("token_id"))


def encode_pad(df: DataFrame, text: str, keys: Sequence[str], vocab: DataFrame,
               max_len: int) -> DataFrame:
    """Token ids (OOV for unknown), pre-padded with zeros and truncated from the
    front to ``max_len`` (X22)."""
    rows = token_rows(df, text, keys)
    v = vocab.select("token", "token_id")
    ids = (rows.join(v, "token", "left")
           .withColumn("token_id", F.coalesce("token_id", F.lit(OOV_ID).cast("long"))))
    seqs = ids.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "token_id"))).alias("_s"))
    seqs = seqs.select(*keys, F.transform("_s", lambda s: s["token_id"]).alias("ids"))
    out = df.select(*keys).join(seqs, list(keys), "left").withColumn(
        "ids", F.coalesce("ids", F.array().cast("array<long>")))
    n = F.size("ids")
    kept = F.when(n > max_len, F.slice("ids", n - max_len + 1, max_len)).otherwise(F.col("ids"))
    pad = F.array_repeat(F.lit(PAD_ID).cast("long"), F.greatest(F.lit(max_len) - n, F.lit(0)))
    return out.select(*keys, n.alias("n_tokens"), F.concat(pad, kept).alias("padded"))


def decode(padded: Column, vocab_map: Column) -> Column:
    """ids -> words, padding dropped (X24); ``vocab_map`` is a map column."""
    return F.array_join(F.transform(F.filter(padded, lambda i: i != PAD_ID),
                                    lambda i: F.coalesce(vocab_map[i], F.lit("<unk>"))), " ")


# Ids 0 to 3 are reserved (padding, start, unknown, unused), words follow after an offset of 3.
RESERVED_IDS, ID_OFFSET = 4, 3


def reserve_ids(ranks: Column) -> Column:
    """Ranks from 1 as ids behind the reserved ones."""
    return F.transform(ranks, lambda r: r + ID_OFFSET)


def unreserve_ids(ids: Column) -> Column:
    """Ids as ranks again; reserved ids are dropped."""
    return F.transform(F.filter(ids, lambda i: i >= RESERVED_IDS), lambda i: i - ID_OFFSET)


def post_pad(ids: Column, max_len: int) -> Column:
    """Cut behind ``max_len`` and filled with the padding id at the end."""
    kept = F.slice(ids, 1, max_len)
    return F.concat(kept, F.array_repeat(F.lit(PAD_ID), F.greatest(F.lit(max_len) - F.size(kept), F.lit(0))))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Sorted distinct labels -> 0..k-1."""
    d = df.select(label).distinct()
    return global_row_number(d, [F.col(label).asc()], "_r").select(
        label, (F.col("_r") - 1).alias("label_index"))


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    return dot / (na * nb)


def top_k_cosine(corpus: DataFrame, vec: str, key: str, queries: list[tuple], k: int = 3) -> DataFrame:
    """Top-``k`` corpus rows by cosine similarity for each query vector.

    ``queries`` is a bounded list of ``(query_id, vector)`` (e.g. a batch of
    questions); each corpus row scores every query in one projection and the
    per-query top-k is a row_number filter that Catalyst turns into a partial
    WindowGroupLimit before the shuffle.
    """
    v = F.transform(vec, lambda x: x.cast("double"))
    scores = F.array(*[F.struct(F.lit(q).alias("query_id"),
                                cosine(v, F.array(*[F.lit(float(x)) for x in qv])).alias("score"))
                       for q, qv in queries])
    x = corpus.select(key, F.explode(scores).alias("s")).select(key, "s.query_id", "s.score")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col(key).asc())
    return x.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def ordered_context(df: DataFrame, keys: Sequence[str], order: str, piece: Column,
                    sep: str = "\n") -> DataFrame:
    """Ordered concatenation of the pieces of each group (X30), e.g. the turns
    of one conversation; a group is one document's own parts."""
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                                     piece.alias("p")))).alias("_s"),
                              F.count(F.lit(1)).alias("pieces"))
    return g.select(*keys, "pieces", F.array_join(F.transform("_s", lambda s: s["p"]), sep).alias("context"))


def stories(df: DataFrame, story_key: str, order: str, text: str, is_question: Column) -> DataFrame:
    """Question rows with the story told before them.

    The story is the ordered text of the earlier rows of the same story,
    joined by spaces.  Each story's rows are gathered once, as one sorted
    array per story (bounded by the conversation or document itself); each
    question then takes the part of it that lies before it.
    """
    rows = df.groupBy(story_key).agg(F.array_sort(F.collect_list(
        F.struct(F.col(order).alias("o"), F.col(text).alias("t"), is_question.alias("q")))).alias("_s"))
    asked = rows.select(story_key, "_s", F.posexplode("_s").alias("_i", "_r")).where("_r.q")
    before = F.transform(F.slice("_s", F.lit(1), F.col("_i")), lambda r: r["t"])
    return asked.select(story_key, F.col("_r.o").alias(order), F.col("_r.t").alias("question"),
                        F.array_join(before, " ").alias("story"), F.col("_i").alias("statements"))


def vocabulary_text_classifier(train: DataFrame, text: str, label: str, vocabulary_size: int = 2**18):
    """Fixed-vocabulary answer classifier (X25): token counts over the training
    split's vocabulary and multinomial logistic regression, the simpler
    alternative the brief offers to a recurrent network.

    The vocabulary and its weights (one per word and class) are held on the driver, so ``vocabulary_size``
    bounds them: the most frequent words have a place of their own; rarer ones, like words that only occur
    after training, count for no class."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer, StringIndexer
    prepared = train.withColumn("_tokens", tokens(text))
    stages = [StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
              CountVectorizer(inputCol="_tokens", outputCol="_features", vocabSize=vocabulary_size),
              LogisticRegression(featuresCol="_features", labelCol="_label", family="multinomial",
                                 regParam=0.01, maxIter=50)]
    return Pipeline(stages=stages).fit(prepared)
