"""MinHash near-duplicate groups with tensored banding and exact confirmation.

A set's table keys are formed by combining pairs from two small collections of hashes. With ``m``
hashes in each there are ``m * m`` tables from ``2 * m`` hashes, so about the square root of the
MinHash values that independent tables would need. Two sets meet in a table if they agree in at
least one hash of either collection.

Steps: (1) one pass turns texts into the size, identity and hashes of their shingle sets, and
equal sets become one node; (2) nodes that share a table key are candidates, and only their sets
are fetched; (3) in every bucket all members are compared with one centre, and what is confirmed
is joined into components; (4) the pairs of a bucket that still lie in different components are
compared as well, so no bucket is cut short. A sketch of one-bit MinHash values rules out pairs far
below the threshold inside the join, so that large buckets do not write out their pairs.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm import words as W
from furrow.llm.common import packed, per_batch, unpacked, written
from furrow.llm.components import connected_components

COLLECTION = 8  # m: hashes in each of the two collections
ROWS = 2  # MinHash values in each hash; a table key holds twice as many
SKETCH_WORDS = 16  # 64 one-bit MinHash values in each
SKETCH_SIGMAS = 3.5  # a pair at the threshold is this many deviations away from being ruled out

_seeds = np.random.default_rng(7).integers(1, 2**63, 2 * COLLECTION * ROWS + 64 * SKETCH_WORDS, dtype=np.uint64)
_MULTIPLY = _seeds | np.uint64(1)
_XOR = W.mix(_seeds)
_HASHES = [f"{side}{i}" for side in "uv" for i in range(COLLECTION)]
_SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def _minima(members: np.ndarray, low: int, high: int) -> np.ndarray:
    out = np.empty(high - low, np.uint64)
    for i in range(low, high):
        out[i - low] = ((members ^ _XOR[i]) * _MULTIPLY[i]).min()
    return out


def _identity(members: np.ndarray) -> bytes:
    """128 bits of a sorted set."""
    place = W._power(W._BASE, len(members))
    one = W.mix((members * place).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(members)))
    two = W.mix((W.mix(members) * place).sum(dtype=np.uint64, keepdims=True))
    return one.tobytes() + two.tobytes()


def _sets(column: pa.Array, size: int) -> list[np.ndarray]:
    data, offsets = W.text_bytes(column)
    found = W.words(data, offsets)
    return [W.shingles(found.hash[a:b], size) for a, b in zip(found.at, found.at[1:])]


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def profiles(documents: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, node (identity of the set; null for none) and the two hash collections."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch.column("text"), size)
        count = 2 * COLLECTION * ROWS
        values = np.zeros((len(sets), count), np.uint64)
        for i, members in enumerate(sets):
            if len(members):
                values[i] = _minima(members, 0, count)
        hashes = values[:, ::ROWS].copy()
        for row in range(1, ROWS):
            hashes = W.mix(hashes * np.uint64(0x9E3779B97F4A7C15) + values[:, row::ROWS])
        nodes = [_identity(members) if len(members) else None for members in sets]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array([len(x) for x in sets], pa.int64()), pa.array(nodes, pa.binary())]
            + [pa.array(W.signed(hashes[:, i])) for i in range(2 * COLLECTION)],
            names=["doc_id", "text_key", "n_shingles", "node", *_HASHES],
        )

    schema = "doc_id long, text_key long, n_shingles long, node binary, " + ", ".join(f"{h} long" for h in _HASHES)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), "text")
    return per_batch(rows, convert, schema)


def _candidate_sets(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, n, copies, members (sorted hashes as bytes) and sketch of each wanted node."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets(batch.column("text"), size)
        low = 2 * COLLECTION * ROWS
        sketch = np.zeros((len(sets), SKETCH_WORDS), np.uint64)
        for i, members in enumerate(sets):
            if len(members):
                bits = _minima(members, low, low + 64 * SKETCH_WORDS) >> np.uint64(32) & np.uint64(1)
                sketch[i] = np.packbits(bits.astype(np.uint8)).view(np.uint64)
        nodes = [_identity(members) if len(members) else None for members in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.binary()), pa.array([len(x) for x in sets], pa.int64()), batch.column("copies"),
             pa.array([x.tobytes() for x in sets], pa.binary())]
            + [pa.array(W.signed(sketch[:, i])) for i in range(SKETCH_WORDS)],
            names=["node", "n", "copies", "members", *_SKETCH],
        )

    schema = "node binary, n long, copies long, members binary, " + ", ".join(f"{s} long" for s in _SKETCH)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    fetched = texts.join(wanted.select("doc_id", "copies"), texts.doc_id.eqNullSafe(wanted.doc_id)).select("text", "copies")
    found = per_batch(fetched, convert, schema).dropDuplicates(["node"])
    return found.join(wanted.select("node"), "node", "left_semi")


def _first_meeting(left: str, right: str) -> Column:
    """The join's table is the first one that the pair shares, so that a pair comes out once."""
    def first(side: str) -> Column:
        same = [(F.col(f"{left}.{side}{i}") == F.col(f"{right}.{side}{i}"), i) for i in range(COLLECTION)]
        return F.coalesce(*(F.when(equal, F.lit(i)) for equal, i in same))

    return F.col(f"{left}.place") == first("u") * COLLECTION + first("v")


def _alike(left: str, right: str, percent: int, sketch: list[str], sigmas: float) -> Column:
    """Few enough bits of these sketch words differ."""
    apart = reduce(lambda a, b: a + b, (F.bit_count(F.expr(f"{left}.{s} ^ {right}.{s}")) for s in sketch))
    share, bits = (1 - percent / 100) / 2, 64 * len(sketch)
    return apart <= int(bits * share + sigmas * (bits * share * (1 - share)) ** 0.5)


def _possible(left: str, right: str, percent: int) -> Column:
    """Neither the sizes nor the sketches rule the pair out."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    sizes = (a * 100 >= b * percent) & (b * 100 >= a * percent)
    return sizes & _alike(left, right, percent, _SKETCH[:4], 5.0) & _alike(left, right, percent, _SKETCH, SKETCH_SIGMAS)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are as similar as asked."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column("left"), batch.column("right")
        for i in range(batch.num_rows):
            one, two = np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64)
            if len(one) > len(two):
                one, two = two, one
            place = np.searchsorted(two, one)
            place[place == len(two)] = 0
            both = int((two[place] == one).sum())
            keep[i] = 100 * both >= percent * (len(one) + len(two) - both)
        return batch.select(["a", "b"]).filter(pa.array(keep))

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("right"))
    return per_batch(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right"), convert, "a binary, b binary")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``documents``: doc_id, text_key (hash of the text), n_shingles, node, component_id, kept.

    Two texts are linked if 100 * |intersection| >= percent * |union| of their distinct word
    shingles. A text with fewer words than a shingle is one shingle; null texts and texts without
    words have no set, are linked with nothing and are kept. ``component_id`` is the smallest doc_id
    of the component. Null ids count as larger than all others: a component without
    any id has none, and its rows are kept. Repeated rows get equal results; all rows that carry the smallest id are kept. Further
    columns are ignored. Links are found with a probability of at least 0.999 each at the threshold.
    """
    known = written(profiles(documents, shingle), "profiles")
    classes = written(
        known.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), *(F.first(h).alias(h) for h in _HASHES)
        ),
        "classes",
    )
    keys = F.array(*(
        F.xxhash64(F.lit(i * COLLECTION + j), f"u{i}", f"v{j}") for i in range(COLLECTION) for j in range(COLLECTION)
    ))
    rows = classes.select("node", F.posexplode(keys).alias("place", "key"))
    shared = written(rows.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"), "keys")
    members = written(rows.join(shared, "key"), "members")
    wanted = classes.select("node", "doc_id", "copies").join(members.select("node").distinct(), "node", "left_semi")
    sets = written(_candidate_sets(documents, wanted, shingle), "sets")
    light = sets.select("node", "n", "copies", *_SKETCH)
    members = members.join(light, "node")

    centre = members.groupBy("key").agg(F.max(F.struct("copies", "node", "n", *_SKETCH)).alias("centre")).select(
        F.col("key").alias("centre_key"), "centre.*"
    )
    centre = written(centre, "centres")
    star = members.alias("m").join(
        centre.alias("c"), (F.col("m.key") == F.col("c.centre_key")) & (F.col("m.node") != F.col("c.node")) & _possible("m", "c", percent)
    )
    star = star.select(F.col("c.node").alias("a"), F.col("m.node").alias("b")).distinct()
    edges = written(_confirmed(star, sets, percent), "links")
    labels = written(connected_components(edges), "labels")

    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    spread = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    open_ = labelled.join(written(spread.select("key"), "open-keys"), "key")
    open_ = written(open_.join(classes.select("node", *_HASHES), "node"), "open")
    pairs = open_.alias("m").join(
        open_.alias("c"),
        (F.col("m.key") == F.col("c.key")) & (F.col("m.label") < F.col("c.label"))
        & _possible("m", "c", percent) & _first_meeting("m", "c"),
    )
    pairs = pairs.select(F.col("m.node").alias("a"), F.col("c.node").alias("b"))
    edges = edges.unionByName(_confirmed(pairs, sets, percent))
    labels = written(connected_components(edges), "labels")

    named = classes.select("node", F.col("doc_id").alias("least")).join(labels, "node")
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    grouped = named.select("node", "label").join(least, "label").select("node", "component_id")
    # all classes, so that equal copies outside any link are named as well
    named = classes.select("node", "doc_id").join(grouped, "node", "left").select(
        "node", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    joined = known.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id", "text_key", "n_shingles", "node", component.alias("component_id"),
        F.when(F.col("node").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(component)).alias("kept"),
    )


def one_of_each_group(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` that ``near_duplicates`` keeps, with all their columns.

    Rows with equal id and text count as one document and come out once, whatever their other columns, which may have
    any names. Null and empty texts stay. An empty table gives an empty result.
    """
    found = near_duplicates(documents, shingle, percent).where("kept")
    found = written(found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "kept")
    rows = packed(documents).select(
        "row", F.col("row.doc_id").cast("long").alias("own_id"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("own_key")
    )
    rows = rows.join(found, F.col("own_id").eqNullSafe(F.col("_id")) & (F.col("own_key") == F.col("_key")))
    return unpacked(rows.dropDuplicates(["_id", "_key"]), documents.columns)
