"""Toxicity scores from non-negative positive-unlabelled learning.

The classifier is linear over hashed words that a text holds (each counted once). It learns from
texts confirmed as toxic and from unlabelled ones, without trusted negatives: with prior ``p`` of
the toxic class, the risk is ``p * R+(positive) + max(0, R-(unlabelled) - p * R-(positive))``. Where
the corrected part falls below zero, the step goes against it, which keeps the classifier
from memorising the positives.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm import words as W
from furrow.llm.common import fold, per_batch, with_fields, written

BITS = 20
BEGINNINGS = (4, 5, 6)  # bytes; a shorter word is its own beginning
POSITIVES, UNLABELLED = 3_000, 9_000  # texts that the classifier is fitted on, by order of a hash of the id
FEATURES, MIN_Z, MIN_POSITIVES = 512, 6.0, 5  # words with a weight: the most telling, if clear enough
STEPS, RATE, DECAY = 300, 0.05, 3e-4
THRESHOLD = 0.3


@dataclass(frozen=True)
class Classifier:
    """Weights of the features that have one, and the bias of all texts."""

    slots: np.ndarray
    weights: np.ndarray
    bias: float

    def every(self) -> np.ndarray:
        """A weight for each feature there can be."""
        out = np.zeros(1 << BITS, np.float32)
        out[self.slots] = self.weights
        return out


def _features(column: pa.Array) -> list[np.ndarray]:
    """Distinct hashed words of each text, without punctuation, and the beginnings of longer words."""
    data, offsets = W.text_bytes(column)
    found = W.words(data, offsets, skip=W.MARK)
    lower = W.LOWER[data].astype(np.uint64)
    hashes = [found.hash]
    code = np.zeros(len(found.begin), np.uint64)
    for i in range(max(BEGINNINGS)):
        if i in BEGINNINGS:
            hashes.append(W.mix(code | np.uint64(i << 56)))
        longer = found.begin + i < found.end
        code = np.where(longer, code | lower[np.minimum(found.begin + i, max(0, len(data) - 1))] << np.uint64(8 * i), code) if len(data) else code
    hashes.append(W.mix(code | np.uint64(max(BEGINNINGS) << 56)))
    slots = (np.stack(hashes, axis=1) >> np.uint64(64 - BITS)).astype(np.int32)
    return [np.unique(slots[a:b]) for a, b in zip(found.at, found.at[1:])]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(counts: DataFrame, positives: int, unlabelled: int, prior: float) -> DataFrame:
    """The features (slot) that tell the two sets apart, from how many texts of each hold them.

    Those with the largest z-scores of the difference of shares, among those whose presence alone makes a
    toxic text likelier than not under the prior. Ties go to the smaller slot.
    """
    n, u = F.lit(float(max(positives, 1))), F.lit(float(max(unlabelled, 1)))
    share = (F.col("in_positive") + F.col("in_unlabelled")) / (n + u)
    spread = F.sqrt(F.greatest(share * (1 - share), F.lit(1e-12)) * (1 / n + 1 / u))
    own, other = F.col("in_positive") / n, F.col("in_unlabelled") / u
    clear = (F.col("in_positive") >= MIN_POSITIVES) & (prior * own >= 0.5 * other)
    scored = counts.where(clear).select("slot", ((own - other) / spread).alias("z")).where(F.col("z") >= MIN_Z)
    return scored.orderBy(F.desc("z"), "slot").limit(FEATURES).select("slot")


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], slots: np.ndarray, prior: float) -> Classifier:
    """Non-negative risk with the logistic loss, minimised by Adam over all given texts at once.

    Texts are arrays of places in ``slots``. Only words whose share among the positives differs clearly from that
    among the unlabelled get a weight; the rest would let a few positives be recognised by their rare words.
    """
    if not positive or not unlabelled:
        return Classifier(np.zeros(0, np.int64), np.zeros(0), -30.0)
    n, u, size = len(positive), len(unlabelled), len(slots)
    bias, texts = 0.0, [*positive, *unlabelled]
    weights = np.zeros(size)
    sizes = np.array([len(x) for x in texts])
    slot = np.concatenate(texts) if sizes.sum() else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        margin = np.bincount(text, weights[slot], len(texts)) + bias
        chance = _sigmoid(margin)
        as_negative = np.logaddexp(0, margin)
        corrected = as_negative[n:].mean() - prior * as_negative[:n].mean()
        slope = np.zeros(len(texts))
        if corrected >= 0:
            slope[:n] = -prior * (1 - chance[:n]) / n - prior * chance[:n] / n
            slope[n:] = chance[n:] / u
        else:
            slope[:n] = prior * chance[:n] / n
            slope[n:] = -chance[n:] / u
        gradient = np.append(np.bincount(slot, slope[text], size) + DECAY * weights, slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Classifier(np.asarray(slots, np.int64), weights, float(bias))


def train(documents: DataFrame, labels: DataFrame, learn: Column, prior: float | None = None) -> Classifier:
    """Fit on a bounded sample of the rows for which ``learn`` (over doc_id) holds, each text with all its words.

    Positives are texts with ``labels.toxic = 1``; the unlabelled ones are drawn from all texts, whatever
    their label, so that toxic ones are among them at the rate of the prior. The prior is the share of toxic rows among labelled ones unless given. Ids with
    several labels count as toxic if one of them says so; null ids and labels are ignored; rows of one sampled id
    all count. Without labels or texts on either side every text scores low. Other columns do not matter.

    How many sampled texts hold each feature is counted in Spark; the driver gets the 512 telling features and which
    of them each sampled text holds, 12,000 short lists at most where ids are unique.
    """
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    ).where(F.coalesce(learn, F.lit(False)))
    if prior is None:
        share = marked.agg(F.avg("toxic")).first()[0]
        prior = min(0.5, max(0.001, share or 0.0))
    texts = documents.select("doc_id", "text").where(F.coalesce(learn, F.lit(False)))
    toxic = marked.where("toxic = 1").select("doc_id")
    order = F.xxhash64("doc_id", F.lit("sample"))

    def sample(frame: DataFrame, size: int, side: str) -> DataFrame:
        ids = frame.select("doc_id", order.alias("o")).orderBy("o", "doc_id").limit(size).select("doc_id").distinct()
        return texts.join(ids, "doc_id").select("doc_id", "text", F.lit(side).alias("side"))

    picked = sample(texts.select("doc_id").join(toxic, "doc_id", "left_semi"), POSITIVES, "positive").unionByName(
        sample(texts.select("doc_id"), UNLABELLED, "unlabelled")
    )
    rows = written(per_batch(picked, _rows, "doc_id long, side string, slots array<int>"), "training-texts")
    sizes = {r.side: r["count"] for r in rows.groupBy("side").count().collect()}
    counts = rows.select("side", F.explode("slots").alias("slot")).groupBy("slot").agg(
        F.count_if(F.col("side") == "positive").alias("in_positive"),
        F.count_if(F.col("side") == "unlabelled").alias("in_unlabelled"),
    )
    best = telling(counts, sizes.get("positive", 0), sizes.get("unlabelled", 0), prior)
    slots = np.sort(np.array([r.slot for r in best.collect()], np.int64))
    # only which of the telling features a text holds reaches the driver
    known = F.array_intersect("slots", F.array(*(F.lit(int(slot)) for slot in slots)).cast("array<int>"))
    held = rows.select("side", "doc_id", F.array_sort(known).alias("held")).orderBy("side", "doc_id", "held").collect()
    of = lambda side: [np.searchsorted(slots, np.array(r.held, np.int64)) for r in held if r.side == side]
    return fit(of("positive"), of("unlabelled"), slots, prior)


def _rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    slots = [x.astype(np.int32) for x in _features(batch.column("text"))]
    ids = batch.column("doc_id").cast(pa.int64())
    return pa.RecordBatch.from_arrays(
        [ids, batch.column("side"), pa.array(slots, pa.list_(pa.int32()))], names=["doc_id", "side", "slots"]
    )


def score(documents: DataFrame, classifier: Classifier) -> DataFrame:
    """All columns of ``documents`` and ``toxicity`` (0 to 1); null and empty texts get the bias alone.

    A column of that name in the input is replaced. Repeated rows score alike; an empty table gives an empty result.
    """
    kept = documents.drop("toxicity")
    schema = with_fields(kept, toxicity="double")

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights = classifier.every()
        margin = [float(weights[x].sum()) + classifier.bias for x in _features(batch.column("text"))]
        scores = pa.array(_sigmoid(np.array(margin, float)))
        return pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, "toxicity"])

    return per_batch(kept, convert, schema)


def learnable() -> Column:
    """Ids whose labels may be learned from: crc32 of the id is not 2 modulo 4."""
    return fold() != 2
