"""Random forests whose trees depend on the rows alone, not on where the rows lie.

MLlib draws a bootstrap with one random sequence per partition and takes its split candidates from a
sample drawn the same way, so the same rows in other partitions give other trees. Here both come from
hashes of the row's key: a row's weight in a draw is a Poisson number read off a hash of (seed, draw,
key), and the bin edges are exact percentiles of the rows whose hash is small. Each draw is an MLlib
forest over the binned columns with these weights and no bootstrap of its own; the draws vote together.

Counts are whole numbers, so classifiers are equal to the last bit at any partitioning. Regression sums are
equal as long as they are exact in doubles (targets that are multiples of a power of two, as here).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DRAWS = 5  # bootstrap draws of a forest; its trees are shared out among them, one each with draws=numTrees
EDGE_ROWS = 50_000  # rows that the bin edges are read off, on average; all rows of smaller tables
BINS = 32
FITS_AT_ONCE = 5  # draws fitted side by side, so that small stages of one fill the gaps of another
ROWS_OF_TASK = 500_000  # rows that one task reads at most where a number of partitions is chosen

_BINNED = "_binned"


def tasks_for(rows: DataFrame) -> int:
    """How many tasks share out the rows, at least one."""
    return max(1, math.ceil(rows.count() / ROWS_OF_TASK))


def uniform(seed: int, name: str, key: str) -> Column:
    """A number in [0, 1) from a hash of the key; another one for another name or seed."""
    hashed = F.xxhash64(F.lit(seed), F.lit(name), F.col(key))
    return F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))


def poisson_weight(seed: int, draw: int, key: str) -> Column:
    """How often a draw holds the row: a Poisson number of mean 1."""
    chance = uniform(seed, f"draw {draw}", key)
    reached, weight = 0.0, F.lit(0.0)
    for n in range(12):  # the chance of more is below 1e-10
        reached += math.exp(-1) / math.factorial(n)
        weight = weight + (chance >= reached).cast("double")
    return weight


def _edges(train: DataFrame, features: Sequence[str], key: str, seed: int, rows: int) -> list[list[float]]:
    """Inner bin borders of each feature: distinct percentiles of a hashed sample, from one aggregate."""
    sample = train.where(uniform(seed, "edges", key) < min(1.0, EDGE_ROWS / max(rows, 1)))
    steps = F.array(*(F.lit(i / BINS) for i in range(1, BINS)))
    found = sample.agg(*(F.percentile(F.nanvl(F.col(name).cast("double"), F.lit(None)), steps).alias(f"e{i}") for i, name in enumerate(features))).first()
    return [sorted(set(edges or [0.0])) for edges in found]


@dataclass
class BaggedForest:
    """Binning and the forests of the draws; predicts like one forest of all their trees."""

    bins: Bucketizer
    vector: VectorAssembler
    members: list[Model]

    @property
    def algorithm(self) -> str:
        return "RandomForestClassifier" if self.classifies else "RandomForestRegressor"

    @property
    def classifies(self) -> bool:
        return isinstance(self.members[0], RandomForestClassificationModel)

    @property
    def getNumTrees(self) -> int:  # noqa: N802  named as in MLlib
        return sum(member.getNumTrees for member in self.members)

    @property
    def numFeatures(self) -> int:  # noqa: N802
        return self.members[0].numFeatures

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Mean of the draws' importances, summing to 1 unless no tree has a split."""
        total = sum(member.featureImportances.toArray() for member in self.members)
        return Vectors.dense(total / total.sum() if total.sum() else total)

    @property
    def trees(self) -> list[str]:
        """The splits of every tree as text."""
        return [tree.toDebugString.split("\n", 1)[1] for member in self.members for tree in member.trees]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``, and ``rawPrediction`` and ``probability`` of a classifier; needs the feature columns."""
        scored = self.vector.transform(self.bins.transform(df))
        own = [f"_draw_{i}" for i in range(len(self.members))]
        for name, member in zip(own, self.members):
            if self.classifies:
                member = member.copy().setRawPredictionCol(name).setProbabilityCol("").setPredictionCol("")
            else:
                member = member.copy().setPredictionCol(name)
            scored = member.transform(scored)
        if not self.classifies:
            shares = [F.col(name) * member.getNumTrees for name, member in zip(own, self.members)]
            return scored.withColumn("prediction", sum(shares) / self.getNumTrees).select(*df.columns, "prediction")
        votes = [vector_to_array(name) for name in own]
        raw = F.array(*(sum(vote[i] for vote in votes) for i in range(self.members[0].numClasses)))
        out = scored.withColumn("_votes", raw)
        most = F.array_position("_votes", F.array_max("_votes")) - 1
        return out.select(
            *df.columns, array_to_vector("_votes").alias("rawPrediction"),
            array_to_vector(F.transform("_votes", lambda vote: vote / self.getNumTrees)).alias("probability"),
            most.cast("double").alias("prediction"),
        )

    def save(self, path: str) -> None:
        PipelineModel([self.bins, self.vector, *self.members]).write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> BaggedForest:
        bins, vector, *members = PipelineModel.load(path).stages
        return cls(bins, vector, members)


def _fit(
    train: DataFrame, label: str, features: Sequence[str], key: str, seed: int, trees: int, draws: int,
    member: Callable[[int, int], object], classes: bool,
) -> BaggedForest:
    columns = train.select(key, *(F.col(name).cast("double").alias(name) for name in features), label)
    columns = columns.persist(StorageLevel.MEMORY_AND_DISK)  # counted, sampled and binned from one scan
    try:
        rows, largest = columns.agg(F.count(F.lit(1)), F.max(label)).first()
        names = [f"_bin_{i}" for i in range(len(features))]
        bins = Bucketizer(
            inputCols=list(features), outputCols=names, handleInvalid="keep",
            splitsArray=[[-math.inf, *edges, math.inf] for edges in _edges(columns, features, key, seed, rows)],
        )
        vector = VectorAssembler(inputCols=names, outputCol=_BINNED)
        # a draw that lacks the last label still votes on it
        of_label = {"ml_attr": {"type": "nominal", "num_vals": int(largest) + 1}} if classes and largest is not None else None
        target = F.col(label).cast("double").alias(label, metadata=of_label) if of_label else F.col(label).cast("double").alias(label)
        # bins are ordered: as plain numbers they are split by order, with the bins' own metadata as sets of categories
        ordered = bins.transform(columns).withColumns({name: F.col(name) + F.lit(0.0) for name in names})
        binned = vector.transform(ordered).select(key, _BINNED, target)
        binned = binned.persist(StorageLevel.MEMORY_AND_DISK)  # lost blocks are binned again
        draws = min(draws, trees)

        def one(draw: int) -> Model:
            weighted = binned.withColumn("_weight", poisson_weight(seed, draw, key)).where("_weight > 0")
            return member(trees // draws + (draw < trees % draws), seed * 1009 + draw).fit(weighted)

        try:
            binned.count()
            columns.unpersist()  # only the bins stay while the draws are fitted
            with ThreadPoolExecutor(min(FITS_AT_ONCE, draws)) as pool:
                members = list(pool.map(inheritable_thread_target(train.sparkSession)(one), range(draws)))
        finally:
            binned.unpersist()
    finally:
        columns.unpersist()
    return BaggedForest(bins, vector, members)


def fit_classifier(
    train: DataFrame, label: str, features: Sequence[str], key: str = "reading_id", *, numTrees: int, maxDepth: int,  # noqa: N803
    seed: int, draws: int = DRAWS,
) -> BaggedForest:
    """A classifier of 0, 1, ..; ``key`` must be unique. The driver gets 31 edges a feature and the trees.

    NaN has a bin of its own; a NULL feature is refused.
    """

    def member(trees: int, own_seed: int) -> RandomForestClassifier:
        return RandomForestClassifier(
            labelCol=label, featuresCol=_BINNED, weightCol="_weight", bootstrap=False, featureSubsetStrategy="sqrt",
            numTrees=trees, maxDepth=maxDepth, seed=own_seed, maxBins=BINS + 1,
        )

    return _fit(train, label, features, key, seed, numTrees, draws, member, True)


def fit_regressor(
    train: DataFrame, label: str, features: Sequence[str], key: str = "reading_id", *, numTrees: int, maxDepth: int,  # noqa: N803
    seed: int, draws: int = DRAWS,
) -> BaggedForest:
    def member(trees: int, own_seed: int) -> RandomForestRegressor:
        return RandomForestRegressor(
            labelCol=label, featuresCol=_BINNED, weightCol="_weight", bootstrap=False, featureSubsetStrategy="onethird",
            numTrees=trees, maxDepth=maxDepth, seed=own_seed, maxBins=BINS + 1,
        )

    return _fit(train, label, features, key, seed, numTrees, draws, member, False)
