"""Quality by hierarchical empirical Bayes: document, path and host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .linear_model import LinearModel
from .small_tables import small
from .storage import stored
from .text import WordHashes, with_columns

#: Documents less likely than this to be of good quality are rejected.
MIN_PROBABILITY = 0.5
#: Bounds of a prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1000.0


def _log_odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, n: str, mean: Column, prior: Column) -> Column:
    """A beta prior's strength by moments: how little group means spread around
    the prior mean, beyond what their own sizes explain."""
    weight = F.col(n)
    inside = prior * (1 - prior)
    spread = F.sum(weight * (mean - prior) ** 2) / F.sum(weight)
    by_chance = F.sum(inside) / F.sum(weight)
    between = F.greatest(spread - by_chance, F.lit(1e-6))
    inside = F.sum(weight * inside) / F.sum(weight)
    return F.least(F.greatest(inside / between - 1, F.lit(WEAKEST)), F.lit(STRONGEST))


def site_quality(
    documents: DataFrame,
    model: LinearModel | None,
    host: Column,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """Judge documents by their text and by the sites they come from.

    Returns ``(key, host, path, evidence, host_rate, path_rate, quality, kept)``,
    a row per input row. ``evidence`` is the classifier's probability of good
    quality. A host's rate is the mean evidence of its documents, shrunk toward
    the global mean; a path's rate that of its documents, shrunk toward its
    host's rate; both shrink the more the fewer documents there are, with prior
    strengths estimated from how much the rates spread. The rates and the mean
    that a document is judged by are those of all other documents, so its own
    evidence counts once. ``quality`` replaces the mean in the document's odds by its
    path's rate. ``kept`` needs at least ``min_probability``.

    Without a model all evidence is 1/2. A null or empty text has no evidence
    besides the prior of the model. Null hosts and paths are groups of their own.
    Sums are combined in the tasks that read the documents, so neither a large
    host nor a large path meets in one task. Repeated rows count as documents.
    """
    added = T.StructType([T.StructField("evidence", T.DoubleType())])

    def make():
        cache = WordHashes()
        return lambda texts: [[model.probability(x, cache) if model else 0.5 for x in texts]]

    rows = documents.select(
        F.col(key).alias("key"), host.alias("host"), path.alias("path"), F.col(text).alias("text")
    )
    p = F.least(F.greatest(F.col("evidence"), F.lit(0.001)), F.lit(0.999))
    rows = with_columns(rows, "text", make, added).withColumn("evidence", p)
    rows = stored(rows.select("key", "host", "path", "evidence"))

    paths = stored(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    count, total = paths.agg(F.sum("n"), F.sum("s")).first()
    mean = F.lit(float(total / count) if count else 0.5)
    strength = hosts.agg(_strength(hosts, "host_n", F.col("host_s") / F.col("host_n"), mean)).first()[0]
    strength = F.lit(float(strength if strength is not None else WEAKEST))

    def shrunk(s: Column, n: Column, toward: Column, strength: Column) -> Column:
        return (s + strength * toward) / (n + strength)

    hosts = hosts.withColumnRenamed("host", "of_host")
    rate = shrunk(F.col("host_s"), F.col("host_n"), mean, strength)
    paths = stored(
        paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select(
            "host", "path", "n", "s", "host_n", "host_s", rate.alias("rate")
        )
    )
    within = paths.agg(_strength(paths, "n", F.col("s") / F.col("n"), F.col("rate"))).first()[0]
    within = F.lit(float(within if within is not None else WEAKEST))
    named = paths.withColumnsRenamed({"host": "of_host", "path": "of_path"})
    judged = rows.join(
        small(named),
        F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")),
    )
    # Of the other documents: their mean, their host's rate, and their path's.
    own = F.col("evidence")
    if count and count > 1:
        prior = (F.lit(float(total)) - own) / F.lit(float(count - 1))
    else:
        prior = F.lit(0.5)
    judged = judged.withColumn("prior", F.least(F.greatest(prior, F.lit(0.001)), F.lit(0.999)))
    prior = F.col("prior")
    rate = shrunk(F.col("host_s") - own, F.col("host_n") - 1, prior, strength)
    judged = judged.withColumn("host_rate", rate)
    path_rate = shrunk(F.col("s") - own, F.col("n") - 1, F.col("host_rate"), within)
    path_rate = F.least(F.greatest(path_rate, F.lit(0.001)), F.lit(0.999))
    odds = _log_odds(F.col("evidence")) - _log_odds(prior) + _log_odds(F.col("path_rate"))
    return (
        judged.withColumn("path_rate", path_rate)
        .withColumn("quality", 1 / (1 + F.exp(-odds)))
        .select(
            F.col("key").alias(key),
            "host",
            "path",
            "evidence",
            "host_rate",
            "path_rate",
            "quality",
            (F.col("quality") >= min_probability).alias("kept"),
        )
    )
