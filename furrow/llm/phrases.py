"""Phrases whose words occur together, from an FM-index of word numbers per shard.

Texts are cut into pieces at punctuation and line ends and into words at blanks. The words of a shard
(all of one language, a bounded number) are numbered, and two Burrows-Wheeler transforms are built over
them, of the text and of its reverse. As phrases hold three words at most, sorting by three words is
enough (each longer pattern would need more). A pattern is a pair of intervals that stay in step: adding a word on
the left narrows the interval of the first transform by rank and the other by counting smaller
words, adding one on the right the other way round. Enumeration starts from single words, adds the
left and then the right neighbours, and gives every pair of words with its count and its right extensions
with theirs. Counts are summed over shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.llm.common import small_batches, written
from furrow.llm.words import signed, text_bytes, words

SHARD_WORDS = 1 << 22  # words of a shard, unless one text alone has more
BLOCK_ROWS = 1 << 18  # rows of a shard's index that are extended at once; more only for one word alone
SHORT_CODES = 1 << 16  # words that are sent as small numbers; all others as their hashes
SAMPLED_TEXTS = 20_000  # texts that the words with small numbers are chosen from; which they are changes no result
UNKNOWN = "und"  # the language of rows without one

# ---- Fixed values: bytes that end a piece (. , ; : ! ? and 0x0A to 0x0D), bytes between words ----
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BETWEEN = ENDS.copy()
BETWEEN[[0x20, 0x09]] = True

GRAMS = "lang string, w1 long, w2 long, times long, word string, next array<long>, next_times array<int>"


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, .. of size[0] places, then those of begin[1] and so on."""
    shift = begin - (np.cumsum(size) - size)
    return np.repeat(shift, size) + np.arange(size.sum())


@dataclass
class Patterns:
    """Word tuples with their intervals: rows ``low:low+count`` of one transform, ``mirror`` of the other."""

    words: np.ndarray  # one column a word
    low: np.ndarray
    mirror: np.ndarray
    count: np.ndarray


class ShardIndex:
    """A bidirectional FM-index of a sequence of numbers, for patterns of three at most.

    Number 0 separates pieces and is in no pattern. The sequence begins and ends with it.
    """

    def __init__(self, sequence: np.ndarray, size: int) -> None:
        self.size = size
        self.first = np.searchsorted(np.sort(sequence), np.arange(size + 1))  # rows that begin with each number
        self.before = self._transform(sequence)
        self.after = self._transform(sequence[::-1])

    def _transform(self, sequence: np.ndarray) -> np.ndarray:
        """The number before each place, places sorted by the three numbers from there on."""
        ahead = np.concatenate([sequence, sequence[:2]]).astype(np.int64)
        if self.size <= 1 << 21:
            key = ahead[:-2] * self.size
            key += ahead[1:-1]
            key *= self.size
            key += ahead[2:]
            del ahead
            order = np.argsort(key, kind="stable")
            del key
        else:
            order = np.lexsort((ahead[2:], ahead[1:-1], ahead[:-2]))
        return sequence[order - 1]

    def single(self) -> Patterns:
        low = self.first[1:-1]
        return Patterns(np.arange(1, self.size)[:, None], low, low, self.first[2:] - low)

    def _extended(self, patterns: Patterns, transform: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
        """Each pattern's neighbours in its interval: (pattern, number, count, smaller numbers in the interval)."""
        neighbour = transform[_ranges(low, patterns.count)]
        owner = np.repeat(np.arange(len(low)), patterns.count)
        key = np.sort(owner * self.size + neighbour)
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        count = np.diff(np.append(at, len(key)))
        owner, number = np.divmod(key[at], self.size)
        smaller = at - (np.cumsum(patterns.count) - patterns.count)[owner]
        word = number > 0
        return owner[word], number[word], count[word], smaller[word]

    def extend_left(self, patterns: Patterns) -> Patterns:
        """Every pattern with each word that stands before it."""
        owner, number, count, smaller = self._extended(patterns, self.before, patterns.low)
        return Patterns(
            np.column_stack([number, patterns.words[owner]]), self._step(self.before, number, patterns.low[owner]),
            patterns.mirror[owner] + smaller, count,
        )

    def extend_right(self, patterns: Patterns) -> Patterns:
        """Every pattern with each word that stands after it."""
        owner, number, count, smaller = self._extended(patterns, self.after, patterns.mirror)
        return Patterns(
            np.column_stack([patterns.words[owner], number]), patterns.low[owner] + smaller,
            self._step(self.after, number, patterns.mirror[owner]), count,
        )

    def right_extensions(self, patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, word, count) of the words after each pattern, without intervals of their own."""
        return self._extended(patterns, self.after, patterns.mirror)[:3]

    def left_pairs(self, alone: Patterns | None = None) -> Patterns:
        """Each single word with every word before it; only mirror intervals, which is all a step to the right reads."""
        alone = self.single() if alone is None else alone
        owner, number, count, smaller = self._extended(alone, self.before, alone.low)
        words = np.column_stack([number, alone.words[owner, 0]])
        return Patterns(words, np.zeros(0, np.int64), alone.mirror[owner] + smaller, count)

    def blocks(self, rows: int) -> Iterator[Patterns]:
        """The single words in order, a block of them at a time: as many as have ``rows`` rows, one at least."""
        alone, begin = self.single(), 0
        while begin < len(alone.count):
            end = max(begin + 1, int(np.searchsorted(self.first[1:], alone.low[begin] + rows, "right")) - 1)
            part = slice(begin, end)
            yield Patterns(alone.words[part], alone.low[part], alone.mirror[part], alone.count[part])
            begin = end

    def _step(self, transform: np.ndarray, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the rows begin that follow from ``number`` before the rows from ``place`` on (LF mapping)."""
        rows = len(transform)
        by_number = np.sort(transform.astype(np.int64) * rows + np.arange(rows))
        return np.searchsorted(by_number, number * rows + place)


class Shard:
    """Words of texts of one language until there are enough for an index."""

    def __init__(self) -> None:
        self.hashes: list[np.ndarray] = []  # words in order, 0 between pieces
        self.spelled: dict[int, str] = {}
        self.words = 0

    def add(self, hashes: np.ndarray, spelled: dict[int, str], count: int) -> None:
        self.hashes.append(hashes)
        self.spelled.update(spelled)
        self.words += count

    def grams(self, lang: str, short: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of ``GRAMS``: the number of words, each word, each pair with its right extensions.

        Words are told apart by their hashes, or by their place in ``short``, sorted hashes of common words.
        """
        known = np.sort(np.concatenate([np.zeros(1, np.int64), np.fromiter(self.spelled, np.int64)]).view(np.uint64))
        hashes, self.hashes = self.hashes, []  # let go one by one
        sequence, at = np.zeros(2 + sum(map(len, hashes)), np.int32), 1
        while hashes:
            part = hashes.pop(0)
            sequence[at : at + len(part)] = np.searchsorted(known, part)
            at += len(part)
        index = ShardIndex(sequence, len(known))
        del sequence
        spelled, codes = self.spelled, _codes(known, short)
        yield _rows(lang, [None], [None], [self.words], [None])
        for alone in index.blocks(BLOCK_ROWS):
            words_of = [spelled.pop(w) for w in signed(known[alone.words[:, 0]]).tolist()]
            yield _rows(lang, codes[alone.words[:, 0]], [None] * len(alone.count), alone.count, words_of)
        for alone in index.blocks(BLOCK_ROWS):
            pairs = index.left_pairs(alone)
            owner, following, times = index.right_extensions(pairs)
            at = np.searchsorted(owner, np.arange(len(pairs.count) + 1)).astype(np.int32)
            for low in range(0, len(pairs.count), 1 << 16):
                high = min(low + (1 << 16), len(pairs.count))
                inside, offsets = slice(at[low], at[high]), pa.array(at[low : high + 1] - at[low])
                yield _rows(
                    lang, codes[pairs.words[low:high, 0]], codes[pairs.words[low:high, 1]], pairs.count[low:high], None,
                    pa.ListArray.from_arrays(offsets, pa.array(codes[following[inside]])),
                    pa.ListArray.from_arrays(offsets, pa.array(times[inside].astype(np.int32))),
                )


def _codes(hashes: np.ndarray, short: np.ndarray) -> np.ndarray:
    """The place in ``short`` where it holds the hash, else the hash with its highest bit set, which is negative."""
    place = np.searchsorted(short, hashes)
    there = short[np.minimum(place, max(len(short) - 1, 0))] == hashes if len(short) else np.zeros(len(hashes), bool)
    return np.where(there, place, signed(hashes | np.uint64(1 << 63)))


def _rows(lang: str, w1, w2, times, word, following: pa.Array | None = None, counts: pa.Array | None = None) -> pa.RecordBatch:
    size = len(times)
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * size, pa.string()), pa.array(w1, pa.int64()), pa.array(w2, pa.int64()), pa.array(times, pa.int64()),
        pa.nulls(size, pa.string()) if word is None else pa.array(word, pa.string()),
        pa.nulls(size, pa.list_(pa.int64())) if following is None else following,
        pa.nulls(size, pa.list_(pa.int32())) if counts is None else counts,
    ], ["lang", "w1", "w2", "times", "word", "next", "next_times"])


def _separated(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, str], int]:
    """Hashes of the words in order with a 0 after each piece, the words of the hashes, the number of words."""
    found = words(data, offsets, space=BETWEEN)
    if not len(found.hash):
        return np.zeros(0, np.uint64), {}, 0
    hashes = np.maximum(found.hash, np.uint64(1))  # 0 is taken
    ended = np.zeros(len(data) + 1, np.int64)
    np.cumsum(ENDS[data], out=ended[1:])
    last = np.ones(len(hashes), bool)
    last[:-1] = ended[found.begin[1:]] > ended[found.end[:-1]]
    last[found.at[1:][found.at[1:] > 0] - 1] = True  # the last word of a text
    place = np.arange(len(hashes)) + np.cumsum(last) - last
    out = np.zeros(len(hashes) + int(last.sum()), np.uint64)
    out[place] = hashes
    distinct, at = np.unique(hashes, return_index=True)
    raw, begin, end = data.tobytes(), found.begin[at].tolist(), found.end[at].tolist()
    spelled = {w: raw[b:e].lower().decode("utf-8", "replace") for w, b, e in zip(signed(distinct).tolist(), begin, end)}
    return out, spelled, len(hashes)


def common_words(documents: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent words of a bounded sample: the texts whose hashes are smallest, about."""
    share = min(1.0, SAMPLED_TEXTS / max(documents.count(), 1))
    sample = documents.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, times = np.unique(_separated(*text_bytes(batch.column("text")))[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(hashes)), pa.array(times)], ["w", "times"])

    words_of = sample.select("text").mapInArrow(count, "w long, times long").where("w <> 0").groupBy("w").agg(F.sum("times").alias("times"))
    best = words_of.orderBy(F.desc("times"), "w").limit(SHORT_CODES).collect()
    return np.sort(np.array([row.w for row in best], np.int64).view(np.uint64))


def shard_grams(batches: Iterator[pa.RecordBatch], short: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(lang, text) to rows of ``GRAMS``; a shard is flushed when it has enough words."""
    shards: dict[str, Shard] = {}
    for batch in batches:
        langs = np.array([UNKNOWN if x is None else x for x in batch.column("lang").to_pylist()], object)
        for lang in dict.fromkeys(langs.tolist()):
            texts = batch.column("text").filter(pa.array((langs == lang).astype(bool)))
            hashes, spelled, count = _separated(*text_bytes(texts))
            if count:
                shards.setdefault(lang, Shard()).add(hashes, spelled, count)
                if shards[lang].words >= SHARD_WORDS:
                    yield from shards.pop(lang).grams(lang, short)
    for lang in list(shards):
        yield from shards.pop(lang).grams(lang, short)


def _quotient(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)) in whole numbers of 38 digits."""
    wide = "CAST({} AS DECIMAL(18, 0))"
    return F.expr(f"CAST(1000000 AS DECIMAL(7, 0)) * ({wide.format(a)} * {wide.format(a)}) div ({wide.format(left)} * {wide.format(right)})")


def phrases(documents: DataFrame, least: int = 10, inside_percent: int = 50, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of two and three words of each language.

    A phrase occurs ``a >= least`` times. Cutting it gives parts that occur l and r times, and a score of
    floor(1000000 a a / (l r)); the lowest-scoring cut counts, the first of equal ones. A pair of words goes
    if a phrase of three that holds it occurs at least ``inside_percent`` per cent as often. Null and empty
    texts have no words; equal rows all count; a null lang is ``und``; an empty table gives an empty
    result; other columns do not matter.

    One shuffle carries each shard's pairs with their extensions; rows of rare pairs end there, so only the
    extensions of frequent pairs are dealt again. A pair is as many rows as there are shards that hold it.
    Common words travel as small numbers, which halves what is shuffled; the driver gets 65,536 hashes for it.
    """
    small_batches(documents.sparkSession)
    short = common_words(documents)
    counted = documents.select("lang", "text").mapInArrow(lambda batches: shard_grams(batches, short), GRAMS)
    total = F.sum("times").over(Window.partitionBy("w1", "w2", "lang"))
    kept = written(counted.withColumn("total", total).where(f"total >= {least} OR w1 IS NULL"), "grams")

    sizes = kept.where("w1 IS NULL").groupBy("lang").agg(F.sum("times").alias("n"))
    alone = kept.where("w1 IS NOT NULL AND w2 IS NULL").groupBy("lang", "w1").agg(
        F.first("total").alias("f"), F.min("word").alias("word"), F.max("word").alias("other")
    )
    same = F.when(F.col("word") == F.col("other"), F.col("word")).otherwise(F.raise_error(F.lit("two words with one hash")))
    alone = alone.select("lang", "w1", "f", same.alias("word"))
    pairs = kept.where("w2 IS NOT NULL").groupBy("lang", "w1", "w2").agg(F.first("total").alias("a"))
    following = F.explode(F.arrays_zip("next", "next_times"))
    threes = kept.where("w2 IS NOT NULL").select("lang", "w1", "w2", following.alias("x")).groupBy(
        "lang", "w1", "w2", F.col("x.next").alias("w3")
    ).agg(F.sum("x.next_times").alias("a")).where(F.col("a") >= least)
    threes = written(threes, "threes")

    def word(n: int) -> DataFrame:
        return alone.select("lang", F.col("w1").alias(f"w{n}"), F.col("f").alias(f"f{n}"), F.col("word").alias(f"s{n}"))

    def pair(n: int) -> DataFrame:
        return pairs.select("lang", F.col("w1").alias(f"w{n}"), F.col("w2").alias(f"w{n + 1}"), F.col("a").alias(f"p{n}"))

    longer = threes.select("lang", "w1", "w2", "a").unionByName(threes.select("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a"))
    longer = longer.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    twos = pairs.join(longer, ["lang", "w1", "w2"], "left").where(
        f"longer IS NULL OR 100 * longer < {inside_percent} * a"
    ).join(word(1), ["lang", "w1"]).join(word(2), ["lang", "w2"]).select(
        "lang", F.concat_ws(" ", "s1", "s2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        _quotient("a", "f1", "f2").alias("score"),
    )
    cut = threes.join(pair(1), ["lang", "w1", "w2"]).join(pair(2), ["lang", "w2", "w3"])
    for n in (1, 2, 3):
        cut = cut.join(word(n), ["lang", f"w{n}"])
    cut = cut.withColumns({"first": _quotient("a", "f1", "p2"), "second": _quotient("a", "p1", "f3")})
    later = F.col("second") < F.col("first")
    cut = cut.select(
        "lang", F.concat_ws(" ", "s1", "s2", "s3").alias("phrase"), "a",
        F.when(later, F.col("p1")).otherwise(F.col("f1")).alias("l"),
        F.when(later, F.col("f3")).otherwise(F.col("p2")).alias("r"), F.least("first", "second").alias("score"),
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = twos.unionByName(cut).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
