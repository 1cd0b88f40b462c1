"""User interest vectors over a bounded category and clusters of
users — proposed by the reference's documents (no code there)."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.schema import RATING, USER


def _label(v: str) -> str:
    """Column-name-safe form of a category value: ``Brand#13`` → ``13``."""
    tail = v.split("#")[-1]
    return "".join(ch if ch.isalnum() else "_" for ch in tail.lower())


def user_interest_vector(r: DataFrame, category: str, values: list[str], digits: int | None = None,
                         prefix: str = "brand_") -> DataFrame:
    """Mean rating per user and category value, one column per value
    (``groupBy(user).pivot(category, values)``).  The value list is given and
    bounded, so the width is fixed and no discovery job runs."""
    wide = r.groupBy(USER).pivot(category, values).agg(F.avg(RATING))
    cols = []
    for v in values:
        c = F.col(f"`{v}`")
        if digits is not None:
            c = F.round(c, digits)
        cols.append(c.alias(prefix + _label(v)))
    return wide.select(USER, *cols)


def user_interests(r: DataFrame, category: str, digits: int | None = None) -> DataFrame:
    """X3 over an open category list: ``(user_id, <category>, interest,
    n_ratings)``, one row per user and category that the user rated.  No list of
    values is needed and a user without ratings in a category costs nothing;
    a null category is one of its own."""
    mean = F.avg(RATING)
    return r.groupBy(USER, category).agg((F.round(mean, digits) if digits is not None else mean).alias("interest"), F.count(F.lit(1)).alias("n_ratings"))


def choose_clusters(vectors: DataFrame, ks, seed: int = 42, max_iter: int = 20) -> tuple[int, dict[int, float]]:
    """The number of clusters among ``ks`` with the highest mean silhouette
    (squared Euclidean; the smallest on ties), and the silhouettes.  The
    silhouette is one aggregation per k over sums per cluster, not over pairs of
    users.  ``vectors`` is read once per k: pass a written table."""
    feats = [c for c in vectors.columns if c != USER]
    filled = VectorAssembler(inputCols=feats, outputCol="_features").transform(vectors.fillna(0.0, subset=feats))
    score = ClusteringEvaluator(featuresCol="_features", predictionCol="cluster")
    found = {}
    for k in sorted(ks):
        model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(filled)
        found[k] = score.evaluate(model.transform(filled))
    return max(found, key=lambda k: (found[k], -k)), found


def user_clusters(vectors: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 20) -> DataFrame:
    """K-means over the interest vectors (missing categories count as 0).
    Returns ``(user_id, cluster)``."""
    return fit_clusters(vectors, k, seed, max_iter)[0]


def fit_clusters(vectors: DataFrame, k: int = 5, seed: int = 42, max_iter: int = 20) -> tuple[DataFrame, list[list[float]]]:
    """X1 with its k centres."""
    feats = [c for c in vectors.columns if c != USER]
    filled = vectors.fillna(0.0, subset=feats)
    va = VectorAssembler(inputCols=feats, outputCol="_features")
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(
        va.transform(filled))
    return model.transform(va.transform(filled)).select(USER, "cluster"), [[float(x) for x in c] for c in model.clusterCenters()]


def clusters_check(vectors: DataFrame, clusters: DataFrame, centres: list[list[float]]) -> DataFrame:
    """X1 certificate: ``(n_users, n_clusters, n_misplaced)`` — the users with
    a cluster, the centres, and the users that another centre is nearer to."""
    feats = [c for c in vectors.columns if c != USER]
    filled = vectors.fillna(0.0, subset=feats)
    distance = F.array(*[sum((F.pow(F.col(f) - v, 2) for f, v in zip(feats, c)), F.lit(0.0)) for c in centres])
    j = filled.select(USER, distance.alias("_d")).join(clusters, USER)
    away = F.get("_d", F.col("cluster")) > F.array_min("_d") + 1e-9
    return j.agg(F.count(F.lit(1)).alias("n_users"), F.lit(len(centres)).cast("long").alias("n_clusters"),
                 F.count(F.when(away, 1)).alias("n_misplaced"))
