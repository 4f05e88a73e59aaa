"""Model-fitting queries.

Fits are iterative and have no SQL twin; scaling and assignment by a fitted
model are closed forms and do.  Every model is fitted on a training split and
judged on the rest; invariants are checked in the tests.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.cleaning import round_to
from tessera.operators import evaluate as E
from tessera.operators import model as M
from tessera.operators.cluster import silhouette_widths
from tessera.operators.network import dense_network
from tessera.operators.pruning import importance_table, pruned_tree
from tessera.plans.registry import register
from tessera.session import materialise
from tessera.tables import Tables

SEED = 123
#: All predictors of a document that the quality models use.
PREDICTORS = ["log_chars", "n_lines", "word_length", "capital_share", "digit_share", "symbol_share"]


def document_features(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", "lang", "n_chars", "text")
    lab = t.labels.select("doc_id", "quality", "toxic")
    chars = F.greatest(F.length("text"), F.lit(1))

    def share(pattern: str):
        return F.regexp_count("text", F.lit(pattern)) / chars
    n_lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return (lab.join(d, "doc_id")
            .select("doc_id", "lang", F.col("quality").cast("double").alias("quality"),
                    F.log1p("n_chars").alias("log_chars"), n_lines.cast("double").alias("n_lines"),
                    (chars / F.greatest(F.regexp_count("text", F.lit(r"\S+")), F.lit(1))).alias("word_length"),
                    share("[A-Z]").alias("capital_share"), share("[0-9]").alias("digit_share"),
                    share(r"[^\p{L}\p{N}\s]").alias("symbol_share")))


def quality_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; the split is written once for the passes of the fits."""
    split = materialise(E.stratified_split(document_features(t), "quality", "doc_id", 0.8, SEED), "split")
    return split.where("split = 'train'"), split.where("split = 'test'")


def embedding_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Four fifths of the vectors, by id, and the rest."""
    e = materialise(M.as_vector(t.embeddings, "embedding").withColumn("label_d", F.col("label").cast("double")), "vectors")
    return e.where("vec_id % 5 <> 0"), e.where("vec_id % 5 = 0")


@register("logistic_quality", "M05 M07 M10 M01")
def q_logistic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = quality_split(Tables(spark, sf_dir))
    model = M.logistic_model(train, "quality", PREDICTORS, ["lang"])
    scored = materialise(M.positive_probability(model.transform(test)).select("quality", "score"), "scored")
    c = E.with_rates(E.confusion_counts(scored, "quality", F.col("score") >= 0.5))
    out = c.withColumn("auc", E.auc(scored, "quality", "score").scalar())
    return out.select(*[round_to(x, 6).alias(x) if x not in ("n", "tp", "fp", "fn", "tn") else F.col(x)
                        for x in out.columns])


@register("odds_ratios", "M06")
def q_odds_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    feats = document_features(Tables(spark, sf_dir))
    return spark.createDataFrame(M.odds_ratios(feats, "quality", PREDICTORS))


@register("tree_importance", "M08 M09")
def q_tree_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances of the entropy tree with the penalty of least cross-validated error."""
    rows = M.assembled(document_features(Tables(spark, sf_dir)), "quality", PREDICTORS)
    found = pruned_tree(rows, "quality", seed=SEED)
    return spark.createDataFrame(importance_table(found, PREDICTORS), "feature string, importance double")


@register("tree_pruning", "M08")
def q_tree_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence of pruned trees: penalty, leaves, training and cross-validated error, and the one chosen."""
    found = pruned_tree(M.assembled(document_features(Tables(spark, sf_dir)), "quality", PREDICTORS), "quality", seed=SEED)
    rows = [(k, s["penalty"], s["leaves"], s["errors"], s["cv_error"], k == found.chosen) for k, s in enumerate(found.steps)]
    return spark.createDataFrame(rows, "step int, penalty double, leaves int, train_error double, cv_error double, chosen boolean")


@register("boosted_importance", "M30 M09")
def q_boosted_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = M.boosted_trees(document_features(Tables(spark, sf_dir)), "quality", PREDICTORS, seed=SEED)
    return spark.createDataFrame(M.normalized_importance(m.featureImportances, PREDICTORS),
                                 "feature string, importance double")


#: Fixed value: starts of the reference's clusterings.
KMEANS_STARTS = 50


@register("kmeans", "M18 M20 M21")
def q_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = embedding_split(Tables(spark, sf_dir))
    model = M.kmeans_best_of(train, 10, range(SEED, SEED + KMEANS_STARTS))
    scored = materialise(model.transform(train.unionByName(test)).select("features", "cluster", "label"), "clusters")
    # cluster -> majority label (M20), ties to the smaller label; everything but the silhouette from one count
    cells = materialise(scored.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n")), "cells")
    w = Window.partitionBy("cluster")  # at most one row per label
    major = (cells.withColumn("size", F.sum("n").over(w))
             .withColumn("_r", F.row_number().over(w.orderBy(F.col("n").desc(), F.col("label")))).where("_r = 1"))
    ari = E.adjusted_rand_index(scored, "cluster", "label").select("ari").scalar()
    return major.select("cluster", "size", F.col("label").alias("majority_label"), F.col("n").alias("majority_n"),
                        (F.col("n") / F.col("size")).alias("purity"), ari.alias("ari"),
                        F.lit(M.silhouette(scored)).alias("silhouette"))


@register("cluster_search", "M19")
def q_cluster_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette of each feature subset and number of clusters."""
    subsets = {"first_8": range(8), "first_32": range(32), "all": range(64)}
    rows = M.silhouette_search(Tables(spark, sf_dir).embeddings.select("embedding"), "embedding", subsets, (2, 5, 10))
    return spark.createDataFrame(rows, "subset string, k int, silhouette double, cost double")


#: Every non-empty set of the first four dimensions, and numbers of clusters.
SUBSETS = {"+".join(f"x{d}" for d in range(4) if m >> d & 1): [d for d in range(4) if m >> d & 1] for m in range(1, 16)}
CLUSTERS = range(2, 7)


@register("silhouette_widths", "M19", """
WITH points AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1, embedding[3]::DOUBLE AS x2, embedding[4]::DOUBLE AS x3
  FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL),
pairs AS (SELECT a.vec_id, a.label AS own, b.label AS other, (a.x0 - b.x0) ^ 2 AS s0, (a.x1 - b.x1) ^ 2 AS s1, (a.x2 - b.x2) ^ 2 AS s2, (a.x3 - b.x3) ^ 2 AS s3
  FROM points a JOIN points b ON a.vec_id <> b.vec_id),
subsets(subset, m0, m1, m2, m3) AS (VALUES """ + ", ".join(f"('{n}', {', '.join(str(int(d in p)) for d in range(4))})" for n, p in SUBSETS.items()) + """),
distances AS (SELECT subset, vec_id, own, other, sum(sqrt(m0 * s0 + m1 * s1 + m2 * s2 + m3 * s3)) AS d, COUNT(*) AS n FROM pairs, subsets GROUP BY 1, 2, 3, 4),
means AS (SELECT subset, k, vec_id, own % k AS mine, other % k AS cluster, sum(d) / sum(n) AS d
  FROM distances, (SELECT unnest(range(2, 7)) AS k) GROUP BY 1, 2, 3, 4, 5),
widths AS (SELECT subset, k, vec_id, min(CASE WHEN mine = cluster THEN d END) AS a, min(CASE WHEN mine <> cluster THEN d END) AS b FROM means GROUP BY 1, 2, 3)
SELECT subset, CAST(k AS INTEGER) AS k, ROUND(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM widths GROUP BY 1, 2""")
def q_silhouette_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean silhouette width of groupings of the labels, on every set of four dimensions."""
    e = Tables(spark, sf_dir).embeddings.where(F.col("label").isNotNull())
    e = e.select("embedding", *[(F.col("label") % k).alias(f"k{k}") for k in CLUSTERS])
    found = silhouette_widths(e, "embedding", [f"k{k}" for k in CLUSTERS], SUBSETS)
    return found.select("subset", F.expr("cast(substring(labelling, 2) as int)").alias("k"), round_to("silhouette", 6).alias("silhouette"))


def _pca(spark: SparkSession, sf_dir: str):
    train, test = embedding_split(Tables(spark, sf_dir))
    train, test = M.standardize(train, test)
    return M.fit_pca(train, 20, "scaled"), test


@register("pca", "M23 W09")
def q_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    (_, rows, kept), _ = _pca(spark, sf_dir)
    df = spark.createDataFrame(rows, "component int, explained_variance double, cumulative double")
    return df.withColumn("kept", F.col("component") <= kept)


@register("pca_loadings", "M23")
def q_pca_loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    (model, _, _), _ = _pca(spark, sf_dir)
    m = model.pc.toArray()
    rows = [(c + 1, f, float(m[f, c])) for c in range(m.shape[1]) for f in range(m.shape[0])]
    return spark.createDataFrame(rows, "component int, feature int, loading double")


@register("pca_scores", "M23")
def q_pca_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows on the components that the training rows gave."""
    (model, _, _), test = _pca(spark, sf_dir)
    s = model.transform(test).select("vec_id", F.posexplode(vector_to_array("pcs")).alias("_i", "score"))
    return s.select("vec_id", (F.col("_i") + 1).alias("component"), "score")


_SCALE_SQL = """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
m AS (SELECT dim, avg(v) AS mean, stddev_samp(v) AS sd, min(v) AS lo, max(v) AS hi FROM x WHERE vec_id % 5 <> 0 GROUP BY dim)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, ROUND({z}, 6) AS scaled FROM x JOIN m USING (dim) WHERE vec_id % 5 = 0"""


def _scaled_rows(test: DataFrame) -> DataFrame:
    s = test.select("vec_id", F.posexplode(vector_to_array("scaled")).alias("dim", "v"))
    return s.select("vec_id", "dim", round_to("v", 6).alias("scaled"))


@register("standardized_test", "M17", _SCALE_SQL.format(z="(v - mean) / sd"))
def q_standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test vectors, centred and scaled with what the training vectors gave."""
    return _scaled_rows(M.standardize(*embedding_split(Tables(spark, sf_dir)))[1])


@register("minmax_test", "M32", _SCALE_SQL.format(z="(v - lo) / (hi - lo)"))
def q_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test vectors, scaled by the training vectors' range."""
    return _scaled_rows(M.minmax(*embedding_split(Tables(spark, sf_dir)))[1])


@register("mlp_embeddings", "M31 M32 M22")
def q_mlp(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = M.minmax(*embedding_split(Tables(spark, sf_dir)))
    m = M.mlp_classifier(train, "label_d", 64, 10, features="scaled")
    pred = m.transform(test).select(F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return E.macro_metrics(pred, "truth", "pred")


@register("relu_network", "M31 M32 M22")
def q_relu_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out metrics of a network with 128 ReLU units and a softmax output on scaled vectors."""
    train, test = (d.select("vec_id", "label", vector_to_array("scaled").alias("v"))
                   for d in M.minmax(*embedding_split(Tables(spark, sf_dir))))
    net = dense_network(train, "label", "v", "vec_id", epochs=5, batches=4, rate=0.01, seed=SEED)
    return E.macro_metrics(net.predict(test, "v", "pred").select(F.col("label").alias("truth"), "pred"), "truth", "pred")


@register("model_comparison", "M24 M22 M30")
def q_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four classifiers on the same scaled split, macro metrics of each."""
    train, test = M.standardize(*embedding_split(Tables(spark, sf_dir)))
    train, test = materialise(train, "train"), materialise(test, "test")
    out = None
    for name, model in M.candidates(train, "label_d", "scaled", SEED).items():
        pred = model.transform(test).select(F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
        row = E.macro_metrics(pred, "truth", "pred").select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out
