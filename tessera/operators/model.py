"""Model fitting with Spark ML.

Fits are distributed Spark ML jobs; only the fitted parameters (bounded by
the feature count) live on the driver.  Pre-processing is learned on the
training split only and applied to both splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier)
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (MinMaxScaler, OneHotEncoder, PCA, StandardScaler, StringIndexer,
                                VarianceThresholdSelector, VectorAssembler)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cluster import silhouette_widths
from tessera.operators.profile import profile_odds
from tessera.session import materialise


def preprocessing(numeric: Sequence[str], categorical: Sequence[str],
                  drop_zero_variance: bool = True) -> list:
    """Recipe (M07): unseen levels kept in an extra bucket, one-hot dummies,
    zero-variance features dropped; all learned by ``Pipeline.fit`` on
    training data only."""
    stages = []
    cat_vecs = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCol=f"{c}_idx", outputCol=f"{c}_vec", handleInvalid="keep",
                                    dropLast=True))
        cat_vecs.append(f"{c}_vec")
    stages.append(VectorAssembler(inputCols=[*numeric, *cat_vecs], outputCol="raw_features",
                                  handleInvalid="skip"))
    if drop_zero_variance:
        stages.append(VarianceThresholdSelector(featuresCol="raw_features", outputCol="features",
                                                varianceThreshold=0.0))
    return stages


def logistic_model(train: DataFrame, label: str, numeric: Sequence[str],
                   categorical: Sequence[str]) -> Pipeline:
    """Unregularised logistic regression on all predictors."""
    stages = preprocessing(numeric, categorical)
    stages.append(LogisticRegression(featuresCol="features", labelCol=label, regParam=0.0,
                                      probabilityCol="probability"))
    return Pipeline(stages=stages).fit(train)


def positive_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("score", vector_to_array("probability")[1])


def odds_ratios(train: DataFrame, label: str, features: Sequence[str], top: int = 15) -> list[dict]:
    """Logistic coefficients as odds ratios with profile-likelihood 95% limits, largest |log OR| first."""
    # Written once: each of the fit's passes would compute the features anew.
    rows = materialise(train.select(label, *features).dropna(), "features")
    return sorted(profile_odds(rows, label, features), key=lambda r: -abs(r["log_odds"]))[:top]


def assembled(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Label and one feature vector per row, written once for the passes of an iterative fit."""
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return materialise(va.transform(df).select(label, "features"), "features")


def normalized_importance(importances, names: Sequence[str]) -> list[tuple[str, float]]:
    """importance / sum, largest first."""
    vals = list(importances.toArray())
    total = sum(vals) or 1.0
    total = float(total)
    return sorted(((n, float(v) / total) for n, v in zip(names, vals)), key=lambda x: -x[1])


def random_forest(train: DataFrame, label: str, features: Sequence[str], trees: int = 50, seed: int = 123):
    """Random forest candidate model."""
    return RandomForestClassifier(featuresCol="features", labelCol=label, numTrees=trees, seed=seed).fit(
        assembled(train, label, features))


def boosted_trees(train: DataFrame, label: str, features: Sequence[str], rounds: int = 20, seed: int = 123):
    """Gradient-boosted trees for a 0/1 label."""
    return GBTClassifier(featuresCol="features", labelCol=label, maxIter=rounds, seed=seed).fit(
        assembled(train, label, features))


def standardize(train: DataFrame, test: DataFrame, vec: str = "features"):
    """Centre and scale with training mean and sample sd, applied to both."""
    sc = StandardScaler(inputCol=vec, outputCol="scaled", withMean=True, withStd=True).fit(train)
    return sc.transform(train), sc.transform(test)


def minmax(train: DataFrame, test: DataFrame, vec: str = "features"):
    """Scale to [0, 1] by the training minimum and maximum, applied to both."""
    sc = MinMaxScaler(inputCol=vec, outputCol="scaled").fit(train)
    return sc.transform(train), sc.transform(test)


def as_vector(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.transform(array_col, lambda x: x.cast("double"))))


def kmeans_best_of(df: DataFrame, k: int, seeds: Sequence[int], features: str = "features", parallelism: int = 8):
    """K-means with several starts, keeping the lowest within-cluster cost.

    The starts are independent Spark jobs, some at a time; ties go to the earlier seed.
    """
    with ThreadPool(min(parallelism, len(seeds))) as pool:
        fits = pool.map(lambda s: KMeans(k=k, seed=s, featuresCol=features, predictionCol="cluster").fit(df), seeds)
    return min(fits, key=lambda m: m.summary.trainingCost)


def silhouette_search(df: DataFrame, array_col: str, subsets: dict[str, Sequence[int]], ks: Sequence[int],
                      starts: int = 5, seed: int = 123) -> list[tuple[str, int, float, float]]:
    """(subset, k, silhouette, cost) for every feature subset and number of clusters (M19), best first.

    ``silhouette`` is the mean silhouette width over pairwise distances; all ``ks`` of a subset share one
    pass over the distances.
    """
    out = []
    for name, places in subsets.items():
        part = F.array(*[F.get(F.col(array_col), F.lit(i)).cast("double") for i in places])
        ready = materialise(df.select(part.alias("v"), array_to_vector(part).alias("features")), "subset")
        found = {k: kmeans_best_of(ready, k, range(seed, seed + starts)) for k in ks}
        scored = ready
        for k, m in found.items():
            scored = m.setPredictionCol(f"k{k}").transform(scored)
        widths = {r["labelling"]: r["silhouette"] for r in
                  silhouette_widths(scored, "v", [f"k{k}" for k in ks], {name: range(len(places))}).collect()}
        out += [(name, k, widths.get(f"k{k}"), float(m.summary.trainingCost)) for k, m in found.items()]
    return sorted(out, key=lambda r: (-r[2] if r[2] is not None else 2.0, r[0], r[1]))


def silhouette(scored: DataFrame, features: str = "features", prediction: str = "cluster") -> float:
    """Spark's squared-Euclidean simplified silhouette."""
    return ClusteringEvaluator(featuresCol=features, predictionCol=prediction,
                               distanceMeasure="squaredEuclidean").evaluate(scored)


def fit_pca(scaled: DataFrame, k: int, features: str = "scaled", keep: float = 0.90):
    """PCA of standardised rows: model, (component, explained, cumulative), components kept."""
    model = PCA(k=k, inputCol=features, outputCol="pcs").fit(scaled)
    cum, out = 0.0, []
    for i, v in enumerate(model.explainedVariance.toArray(), 1):
        cum += v
        out.append((i, float(v), float(cum)))
    kept = next((i for i, _, c in out if c >= keep), len(out))
    return model, out, kept


def candidates(train: DataFrame, label: str, features: str, seed: int = 123) -> dict:
    """Fitted classifiers to compare on one split."""
    kinds = {
        "multinomial": LogisticRegression(family="multinomial", maxIter=100),
        "decision_tree": DecisionTreeClassifier(impurity="entropy", maxDepth=8, seed=seed),
        "random_forest": RandomForestClassifier(numTrees=50, maxDepth=8, seed=seed),
        "naive_bayes": NaiveBayes(modelType="gaussian"),
    }
    return {name: e.setFeaturesCol(features).setLabelCol(label).fit(train) for name, e in kinds.items()}


def mlp_classifier(train: DataFrame, label: str, n_in: int, n_classes: int, hidden: int = 128,
                   seed: int = 123, features: str = "features"):
    """Dense network classifier on flat vectors (M31); sigmoid hidden units."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label,
                                          layers=[n_in, hidden, n_classes], seed=seed,
                                          maxIter=100).fit(train)
