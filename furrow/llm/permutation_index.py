"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. The index is dealt into shards of
a bounded number of vectors; in a shard each pivot has an inverted file of the vectors that hold it
among their nearest, with its place there. A query reads the files of its own nearest pivots and sums
up how far apart the places are (footrule; a pivot that a vector does not hold counts as the place
after its last). The nearest ``SHARE`` of each shard by that distance, ties included, is ranked by the
Euclidean distance of the original vectors in double precision. As the share is one of each shard,
recall does not fall as the table grows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.llm.common import per_batch, with_fields, written

PIVOTS = 256  # the fitted sample: vectors with the smallest hashes of their ids; at most 256, as places in it are bytes
KEPT = 128  # nearest pivots of a vector that the inverted files hold
PROBED = 64  # nearest pivots of a query whose files are read
SHARE = 0.05  # of a shard, ranked by true distance
LEAST = 200  # vectors of a shard ranked by true distance, at least
SHARD = 8192  # vectors of a shard on average
QUERY_BLOCK = 8192  # queries that meet a shard at once, on average

FOUND = "query_id long, rank int, vec_id long, score double"


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector): whole numbers and doubles, one row an id.

    Rows with a null id and vectors that are null, empty, zero or hold null or non-finite parts are left out.
    Of rows with one id the least vector counts. Other columns do not matter, whatever their names.
    """
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = rows.where("vec_id IS NOT NULL AND vector IS NOT NULL").where(finite).where(F.exists("vector", lambda x: x != 0))
    return sound.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Distinct vectors of a bounded sample: those whose ids have the smallest hashes."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(2 * pivots).collect()
    seen = {tuple(row.vector): None for row in sample}
    return np.array(list(seen)[:pivots], float)


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if pa.types.is_binary(column.type):
        flat = np.frombuffer(b"".join(column.to_pylist()), kind)
    else:
        flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, kept: int) -> np.ndarray:
    """The nearest ``kept`` pivots of each vector, nearest first, equal ones by their number."""
    apart = (pivots**2).sum(1)[None] - 2 * vectors @ pivots.T
    return np.argsort(apart, axis=1, kind="stable")[:, :kept].astype(np.uint8)


def with_order(vectors: DataFrame, pivots: np.ndarray, kept: int = KEPT) -> DataFrame:
    """Add ``nearest``: the pivots' numbers as bytes."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        order = nearest_pivots(_matrix(batch.column("vector")), pivots, kept)
        return batch.append_column("nearest", pa.array([row.tobytes() for row in order], pa.binary()))

    return per_batch(vectors, convert, with_fields(vectors, nearest="binary"))


@dataclass
class InvertedFiles:
    """Posts of a shard by pivot: those of pivot p are ``begin[p]:begin[p+1]``."""

    begin: np.ndarray
    row: np.ndarray
    place: np.ndarray
    rows: int
    kept: int

    @classmethod
    def of(cls, nearest: np.ndarray) -> InvertedFiles:
        rows, kept = nearest.shape
        by_pivot = np.argsort(nearest.ravel(), kind="stable")
        begin = np.searchsorted(nearest.ravel()[by_pivot], np.arange(257))
        return cls(begin, by_pivot // kept, (by_pivot % kept).astype(np.int32), rows, kept)

    def footrule(self, probed: np.ndarray) -> np.ndarray:
        """Distance of every row of the shard to a query's nearest pivots."""
        places = np.arange(len(probed), dtype=np.int32)
        apart = np.full(self.rows, int((self.kept - places).sum()), np.int32)
        for place, pivot in zip(places, probed):
            post = slice(self.begin[pivot], self.begin[pivot + 1])
            apart[self.row[post]] += np.abs(self.place[post] - place) - (self.kept - place)
        return apart


def search_shard(
    ids: np.ndarray, vectors: np.ndarray, nearest: np.ndarray,
    query_ids: np.ndarray, queries: np.ndarray, query_nearest: np.ndarray, k: int, share: float = SHARE,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each query (its id repeated, ids found, distances), the best k of the shard."""
    files, out = InvertedFiles.of(nearest), []
    for own, query, order in zip(query_ids, queries, query_nearest):
        apart = files.footrule(order[:PROBED])
        apart[ids == own] = np.iinfo(np.int32).max
        ranked = min(max(LEAST, k, int(np.ceil(share * len(ids)))), len(ids))
        limit = np.partition(apart, ranked - 1)[ranked - 1]
        near = np.flatnonzero((apart <= limit) & (ids != own))
        distance = np.sqrt(((vectors[near] - query) ** 2).sum(axis=1))
        best = np.lexsort((ids[near], distance))[:k]
        out.append((np.full(len(best), own), ids[near[best]], distance[best]))
    return out


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", share: float = SHARE
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row with ``is_query``, itself left out.

    ``is_query`` reads ``vec_id``. Every usable row (``usable``) is indexed and a candidate; fewer than k
    candidates are all returned. Equal distances rank by the smaller id. Vectors of another length than
    the most frequent one (of equally frequent ones the shortest) cannot be compared and are left
    out. An empty table gives an empty result.

    Queries meet the shards in blocks, so a task holds one shard and one block whatever the table's size.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, key, vector), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(
        F.count("*").alias("rows"), F.count_if(is_query).alias("queries")
    ).orderBy(F.desc("rows"), "length").first()
    if lengths is None or lengths.queries == 0:
        return spark.createDataFrame([], FOUND)
    rows = rows.where(F.size("vector") == lengths.length)
    shards, blocks = -(-lengths.rows // SHARD), -(-lengths.queries // QUERY_BLOCK)
    index = written(with_order(rows, choose_pivots(rows)), "index")

    def dealt(frame: DataFrame, own: str, parts: int, other: str, copies: int) -> DataFrame:
        part = F.pmod(F.xxhash64("vec_id", F.lit(own)), F.lit(parts)).cast("int").alias(own)
        return frame.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other))

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not shard.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        found = search_shard(
            shard["vec_id"].to_numpy(), _matrix(shard["vector"]), _matrix(shard["nearest"], np.uint8),
            asked["vec_id"].to_numpy(), _matrix(asked["vector"]), _matrix(asked["nearest"], np.uint8), k, share,
        )
        return pa.table([pa.array(np.concatenate(part)) for part in zip(*found)], names)

    everything = dealt(index, "shard", shards, "block", blocks).groupBy("shard", "block")
    asked = dealt(index.where(is_query), "block", blocks, "shard", shards).groupBy("shard", "block")
    found = everything.cogroup(asked).applyInArrow(search, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
