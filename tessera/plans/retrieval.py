"""Text, sequence and retrieval queries: chunking, vocabulary, encoding,
top-k cosine retrieval, HTML text extraction, ordered context, keyed lookups."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera import sources
from tessera.functions.cleaning import round_to
from tessera.functions.text import html_title, strip_html, tokens
from tessera.operators import retrieve
from tessera.operators import text as T
from tessera.operators.windows import latest_per_key
from tessera.plans.registry import register
from tessera.session import materialise, scratch_path
from tessera.tables import Tables

# Chunk size in characters, sequence length, retrieval depth.
CHUNK_CHARS = 500
MAX_LEN = 32
TOP_K = 3

_TOK = r"regexp_extract_all(lower(text), '\p{L}+')"


@register("chunks", "X27", f"""
WITH d AS (SELECT doc_id, source, text,
                  unnest(range(0, CAST(ceil(length(text) / {CHUNK_CHARS}) AS BIGINT))) AS i
           FROM documents)
SELECT doc_id, source, i + 1 AS chunk_id, substring(text, i * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) AS chunk_text,
       length(substring(text, i * {CHUNK_CHARS} + 1, {CHUNK_CHARS})) AS chunk_chars
FROM d""")
def q_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.char_chunks(Tables(spark, sf_dir).documents, "text", CHUNK_CHARS, ["doc_id", "source"])
    return c.select("doc_id", "source", F.col("chunk_id").cast("long").alias("chunk_id"), "chunk_text",
                    F.col("chunk_chars").cast("long").alias("chunk_chars"))


@register("paragraph_chunks", "X27", """
SELECT doc_id, paragraph_id, paragraph FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS paragraph,
         generate_subscripts(string_split(text, chr(10)), 1) AS paragraph_id
  FROM documents)
WHERE trim(paragraph) <> ''""")
def q_paragraph_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.paragraph_chunks(Tables(spark, sf_dir).documents, "text", ["doc_id"])
    return p.select("doc_id", F.col("paragraph_id").cast("long").alias("paragraph_id"), "paragraph")


def training_vocab(t: Tables) -> DataFrame:
    """Vocabulary fitted on user turns only (the training side)."""
    return T.vocabulary(t.conversations.where(F.col("role") == "user"), "text")


_VOCAB_SQL = f"""tok AS (SELECT unnest({_TOK}) AS token FROM conversations WHERE role = 'user'),
cnt AS (SELECT token, COUNT(*) AS count FROM tok GROUP BY 1),
v AS (SELECT token, count, row_number() OVER (ORDER BY count DESC, token) + 1 AS token_id FROM cnt)"""


@register("vocab", "X21 W08", f"WITH {_VOCAB_SQL} SELECT token, count, token_id FROM v")
def q_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_vocab(Tables(spark, sf_dir))


@register("encode_pad", "X22 X21", f"""
WITH {_VOCAB_SQL},
toks AS (SELECT conv_id, turn, unnest({_TOK}) AS token, generate_subscripts({_TOK}, 1) AS pos
         FROM conversations),
ids AS (SELECT toks.conv_id, toks.turn, toks.pos, COALESCE(v.token_id, 1) AS id
        FROM toks LEFT JOIN v ON toks.token = v.token),
seq AS (SELECT conv_id, turn, list(id ORDER BY pos) AS ids FROM ids GROUP BY 1, 2),
full_seq AS (SELECT c.conv_id, c.turn, COALESCE(seq.ids, CAST([] AS BIGINT[])) AS ids
             FROM conversations c LEFT JOIN seq ON c.conv_id = seq.conv_id AND c.turn = seq.turn)
SELECT conv_id, turn, CAST(len(ids) AS BIGINT) AS n_tokens,
       array_to_string(list_concat(
         list_transform(range(greatest({MAX_LEN} - len(ids), 0)), lambda x: CAST(0 AS BIGINT)),
         list_slice(ids, greatest(len(ids) - {MAX_LEN} + 1, 1), len(ids))), ',') AS padded
FROM full_seq""")
def q_encode_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    e = T.encode_pad(t.conversations, "text", ["conv_id", "turn"], training_vocab(t), MAX_LEN)
    return e.select("conv_id", "turn", F.col("n_tokens").cast("long").alias("n_tokens"),
                    F.array_join("padded", ",").alias("padded"))


@register("length_stats", "X26", f"""
SELECT role, COUNT(*) AS turns, ROUND(AVG(len({_TOK})), 4) AS mean_tokens,
       CAST(MAX(len({_TOK})) AS BIGINT) AS max_tokens, ROUND(AVG(length(text)), 4) AS mean_chars
FROM conversations GROUP BY role""")
def q_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations
    n = F.size(tokens("text"))
    return c.groupBy("role").agg(F.count(F.lit(1)).alias("turns"),
                                 round_to(F.avg(n), 4).alias("mean_tokens"),
                                 F.max(n).cast("long").alias("max_tokens"),
                                 round_to(F.avg(F.length("text")), 4).alias("mean_chars"))


@register("label_index", "X23", """
SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label_index FROM (SELECT DISTINCT lang FROM documents)""")
def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.label_index(Tables(spark, sf_dir).documents, "lang")


def label_centroids(t: Tables) -> list[tuple[int, list[float]]]:
    """Mean embedding per label; bounded by labels x dimension."""
    ex = t.embeddings.select("label", F.posexplode("embedding").alias("i", "v"))
    cent = ex.groupBy("label", "i").agg(F.avg("v").alias("cv"))
    rows = (cent.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "cv"))).alias("c"))
            .orderBy("label").collect())
    return [(int(r["label"]), [float(s["cv"]) for s in r["c"]]) for r in rows]


@register("topk_cosine", "X29 X28", f"""
WITH ex AS (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS cv FROM ex GROUP BY 1, 2),
cl AS (SELECT label, list(cv ORDER BY i) AS centroid FROM c GROUP BY 1),
s AS (SELECT cl.label AS query_id, e.vec_id,
             list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), cl.centroid) AS score
      FROM embeddings e CROSS JOIN cl)
SELECT vec_id, query_id, ROUND(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {TOP_K}""")
def q_topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    top = T.top_k_cosine(t.embeddings, "embedding", "vec_id", label_centroids(t), TOP_K)
    return top.select("vec_id", "query_id", round_to("score", 6).alias("score"), "rank")


@register("question_vectors", "X29", f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
s AS (SELECT q.vec_id AS question, x.vec_id, ROUND(list_cosine_similarity(q.e, x.e), 9) AS score FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id % 20 <> 0)
SELECT question, vec_id, ROUND(score, 6) AS score, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, vec_id) AS INTEGER) AS rank
FROM s QUALIFY rank <= {TOP_K}""")
def q_question_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of question vectors (every twentieth) against all other vectors."""
    e = Tables(spark, sf_dir).embeddings.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector"))
    top = retrieve.top_k(e.where("key % 20 = 0"), e.where("key % 20 <> 0"), TOP_K)
    return top.select("question", F.col("key").alias("vec_id"), round_to("score", 6).alias("score"), "rank")


def chunk_counts(t: Tables) -> tuple[DataFrame, int]:
    """Written term counts of all chunks of the documents, keyed by (doc_id, chunk_id), and the number of chunks."""
    chunks = T.char_chunks(t.documents, "text", CHUNK_CHARS, ["doc_id"])
    key = F.struct("doc_id", F.col("chunk_id").cast("long").alias("chunk_id"))
    return materialise(retrieve.term_counts(chunks, key, "chunk_text"), "chunk-terms"), chunks.count()


@register("chunk_retrieval", "X28 X29 X30", f"""
WITH d AS (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / {CHUNK_CHARS}) AS BIGINT))) AS i FROM documents),
c AS (SELECT doc_id, i + 1 AS chunk_id, substring(text, i * {CHUNK_CHARS} + 1, {CHUNK_CHARS}) AS text FROM d),
tf AS (SELECT doc_id, chunk_id, term, COUNT(*) AS tf FROM (SELECT doc_id, chunk_id, unnest({_TOK}) AS term FROM c) GROUP BY 1, 2, 3),
df AS (SELECT term, ln((1 + (SELECT COUNT(*) FROM c)) / (1.0 + COUNT(*))) + 1 AS idf FROM tf GROUP BY 1),
w AS (SELECT doc_id, chunk_id, term, tf * idf AS w FROM tf JOIN df USING (term)),
cn AS (SELECT doc_id, chunk_id, sqrt(sum(w * w)) AS size FROM w GROUP BY 1, 2),
qt AS (SELECT item_id, term, COUNT(*) * any_value(idf) AS w FROM (SELECT item_id, unnest({_TOK}) AS term FROM benchmark) JOIN df USING (term) GROUP BY 1, 2),
qn AS (SELECT item_id, sqrt(sum(w * w)) AS size FROM qt GROUP BY 1),
s AS (SELECT item_id, doc_id, chunk_id, ROUND(sum(qt.w / qn.size * w.w / cn.size), 9) AS score
  FROM qt JOIN qn USING (item_id) JOIN w USING (term) JOIN cn USING (doc_id, chunk_id) GROUP BY 1, 2, 3),
best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_id) AS rank FROM s QUALIFY rank <= {TOP_K})
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, chunk_id, ROUND(score, 6) AS score, c.text AS chunk_text
FROM best JOIN c USING (doc_id, chunk_id)""")
def q_chunk_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best chunks of the documents for each benchmark text, by TF-IDF cosine."""
    t = Tables(spark, sf_dir)
    counts, n = chunk_counts(t)
    frequencies = materialise(retrieve.document_frequencies(counts), "frequencies")  # for the chunks and for the questions
    vectors = retrieve.tfidf(counts, frequencies, n)
    asked = retrieve.tfidf(retrieve.term_counts(t.benchmark, F.col("item_id"), "text"), frequencies, n)
    top = retrieve.top_k(asked, vectors, TOP_K).select("question", "rank", "score", "key.doc_id", "key.chunk_id")
    # Only the retrieved chunks are cut out of their texts again.
    found = top.join(t.documents.select("doc_id", "text"), "doc_id")
    piece = F.substring(F.col("text"), ((F.col("chunk_id") - 1) * CHUNK_CHARS + 1).cast("int"), F.lit(CHUNK_CHARS))
    return found.select(F.col("question").alias("item_id"), "rank", "doc_id", "chunk_id", round_to("score", 6).alias("score"), piece.alias("chunk_text"))


@register("page_text", "P11", """
SELECT page_id, url, NULLIF(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title,
       trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
         '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'),
         '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text
FROM pages""")
def q_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).pages
    return p.select("page_id", "url", html_title("html").alias("title"), strip_html("html").alias("text"))


@register("conversation_context", "X30 A08", """
SELECT conv_id, COUNT(*) AS pieces, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS context
FROM conversations GROUP BY conv_id""")
def q_conversation_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations
    return T.ordered_context(c, ["conv_id"], "turn", F.concat_ws(": ", "role", "text"))


@register("keyed_lookups", "X31 J01 W01", """
WITH lo AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
SELECT e.event_id, e.user_id, c.c_name, c.c_mktsegment, lo.o_orderkey AS latest_orderkey,
       lo.o_orderstatus AS latest_status
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN lo ON lo.o_custkey = e.user_id""")
def q_keyed_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    keys = t.events.select("event_id", "user_id")
    cust = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    latest = latest_per_key(t.orders, ["o_custkey"],
                            [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]).select(
        "o_custkey", F.col("o_orderkey").alias("latest_orderkey"),
        F.col("o_orderstatus").alias("latest_status"))
    j = (keys.join(cust, keys.user_id == cust.c_custkey, "left")
         .join(latest, keys.user_id == latest.o_custkey, "left"))
    return j.select("event_id", "user_id", "c_name", "c_mktsegment", "latest_orderkey", "latest_status")


@register("decode_tokens", "X24 X22", f"""
WITH {_VOCAB_SQL},
toks AS (SELECT conv_id, turn, unnest({_TOK}) AS token, generate_subscripts({_TOK}, 1) AS pos
         FROM conversations),
ids AS (SELECT toks.conv_id, toks.turn, toks.pos, COALESCE(v.token_id, 1) AS id
        FROM toks LEFT JOIN v ON toks.token = v.token),
kept AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos DESC) AS back FROM ids),
dec AS (SELECT k.conv_id, k.turn, k.pos, COALESCE(v.token, '<unk>') AS word
        FROM kept k LEFT JOIN v ON k.id = v.token_id WHERE k.back <= {MAX_LEN})
SELECT conv_id, turn, string_agg(word, ' ' ORDER BY pos) AS decoded FROM dec GROUP BY 1, 2""")
def q_decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode the kept (last ``MAX_LEN``) ids back to words; OOV -> ``<unk>``.

    Ids are mapped back with a join on the vocabulary (not a driver-side map).
    """
    t = Tables(spark, sf_dir)
    vocab = training_vocab(t)
    enc = T.encode_pad(t.conversations, "text", ["conv_id", "turn"], vocab, MAX_LEN)
    ids = enc.select("conv_id", "turn", F.posexplode("padded").alias("pos", "token_id")).where("token_id <> 0")
    v = vocab.select("token", "token_id")
    words = ids.join(v, "token_id", "left").withColumn("word", F.coalesce("token", F.lit("<unk>")))
    out = words.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_w"))
    return out.select("conv_id", "turn", F.array_join(F.transform("_w", lambda s: s["word"]), " ").alias("decoded"))


@register("story_questions", "X20 W04 A08", """
SELECT conv_id, turn, question, story, statements FROM (
  SELECT conv_id, turn, role, text AS question,
         COALESCE(string_agg(text, ' ') OVER w, '') AS story,
         COUNT(*) OVER w AS statements
  FROM conversations
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
WHERE role = 'user'""")
def q_story_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = Tables(spark, sf_dir).conversations
    s = T.stories(c, "conv_id", "turn", "text", F.col("role") == "user")
    return s.withColumn("statements", F.col("statements").cast("long"))


@register("numbered_stories", "X20", """
WITH lines AS (
  SELECT conv_id, role, row_number() OVER w AS line_no, trim(regexp_replace(text, '[\t\r\n]+', ' ', 'g')) AS said,
         COALESCE(lead(trim(regexp_replace(text, '[\t\r\n]+', ' ', 'g'))) OVER w, '') AS answer
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
told AS (SELECT *, COALESCE(string_agg(CASE WHEN role <> 'user' THEN said END, ' ') OVER (PARTITION BY conv_id ORDER BY line_no), '') AS story FROM lines)
SELECT CAST(line_no AS INTEGER) AS line_no, story, said AS question, answer, CAST(line_no - 1 AS VARCHAR) AS supporting FROM told WHERE role = 'user'""")
def q_numbered_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as numbered lines, several stories to a file, read back: user turns are the questions."""
    path = scratch_path(spark, f"stories-{uuid.uuid4().hex[:12]}")
    c = Tables(spark, sf_dir).conversations
    said = F.trim(F.regexp_replace("text", r"[\t\r\n]+", " "))
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = (c.select("conv_id", "turn", "role", said.alias("said"))
            .select("conv_id", "turn", "role", "said", F.row_number().over(w).alias("n"), F.coalesce(F.lead("said").over(w), F.lit("")).alias("answer")))
    line = F.concat(F.col("n").cast("string"), F.lit(" "), F.col("said"),
                    F.when(F.col("role") == "user", F.concat(F.lit("\t"), "answer", F.lit("\t"), (F.col("n") - 1).cast("string"))).otherwise(""))
    rows.repartition("conv_id").sortWithinPartitions("conv_id", "n").select(line.alias("value")).write.text(path)
    return sources.read_numbered_stories(spark, path).select("line_no", "story", "question", "answer", "supporting")


@register("turn_role_classifier", "X25 M22")
def q_turn_role_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    from tessera.operators import evaluate as E
    c = Tables(spark, sf_dir).conversations.withColumn("_key", F.concat_ws(":", "conv_id", "turn"))
    split = materialise(E.stratified_split(c, "role", "_key", 0.8), "turns")
    model = T.vocabulary_text_classifier(split.where("split = 'train'"), "text", "role")
    labels = model.stages[0].labels
    scored = model.transform(split.where("split = 'test'").withColumn("_tokens", tokens("text")))
    pred = scored.select(F.col("role").alias("truth"),
                         F.element_at(F.array(*[F.lit(x) for x in labels]),
                                      F.col("prediction").cast("int") + 1).alias("pred"),
                         F.array_max(vector_to_array("probability")).alias("confidence"))
    return E.macro_metrics(pred, "truth", "pred", mean_of="confidence")
