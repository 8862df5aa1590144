"""Brown class-based bigram language model.

Words belong to classes; a text's probability is the product of class transitions and of the
emission of each word by its class. Exchange clustering moves the most frequent words one at a time, on a
table of how often they follow each other in which all other words go by their endings. Then, in rounds over
the whole corpus, every word of the vocabulary of 65,536 is moved to the class that fits its own
counts of classes before and after it best, and so is each group of words beyond it with one ending. With ``every=True``
each word beyond the vocabulary then moves to the class that its own neighbours fit as well, however many such
words there are: they are shuffled by word and never held in one place. Words that the corpus does not hold have the class
of their ending. Word and class counts cover the whole corpus. The logarithms and classes of words outside the
vocabulary come by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count as count_up

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm import words as W
from furrow.llm.common import per_batch, small_batches, written

FREQUENT = 65_536  # words with a class of their own, whose counts every task holds; the counts of all others are joined
UNIT_WORDS = 1_024  # of these, words that are exchanged one at a time
UNIT_ENDINGS = 1_024  # groups of all other words, by a hash of their last three bytes
CLASSES = 40
SWEEPS = 8  # at most; it ends when no word moves
PART = 1_024  # words whose neighbours are counted in one row
ROUNDS = 2  # in which the rest of the vocabulary moves, all words at once
TRANSITION_ADD = 0.5
END = np.int64(-0x45E4D)  # stands for the end of a text, as a word hash
KEPT_WORDS = 1_000_000  # word counts that a training task holds before it sends them
SETTLED = 250_000  # occurrences of words beyond the vocabulary that are settled together, on average
BESIDE = 16_384  # words whose neighbours' classes are counted at once there
RARE = 128  # added to a class where the word is beyond the vocabulary, so that its own class may differ; above CLASSES
PACK = 65_536  # tokens of texts that are scored together, if a text is not longer


@dataclass(frozen=True)
class Tables:
    """What every task needs: counts of frequent words, their units, and the class model."""

    words: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray
    classes: np.ndarray  # class of each of them, then of each ending
    log_emit: np.ndarray  # of each class: log10 of (tokens + types + 1)
    log_step: np.ndarray  # log10 of the transition from class to class


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and ending of each word, and where texts begin."""
    data, offsets = W.text_bytes(column)
    found = W.words(data, offsets)
    lower = W.LOWER[data].astype(np.int64)
    code = np.zeros(len(found.begin), np.int64)
    for back in range(1, 4):
        inside = found.end - back >= found.begin
        code = code * 257 + np.where(inside, lower[np.maximum(found.end - back, 0)] + 1 if len(lower) else 0, 0)
    ending = (W.mix(code.astype(np.uint64)) % np.uint64(UNIT_ENDINGS)).astype(np.int32)
    return W.signed(found.hash), ending, found.at


def word_counts(documents: DataFrame, learn: Column) -> DataFrame:
    """word (hash), ending and n over all training rows; the end of a text is a word of its own."""
    small_batches(documents.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = ends = 0

        def packed() -> pa.RecordBatch:
            word, n, ending = _merged(held)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(ending), pa.array(n)], names=["word", "ending", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            word, ending, _ = _tokens(batch.column("text"))
            ends += batch.num_rows
            held.append(_merged([(word, np.ones(len(word), np.int64), ending)]))
            size += len(held[-1][0])
            if size > 2 * KEPT_WORDS:
                held[:] = [_merged(held)]
                size = len(held[0][0])
                if size > KEPT_WORDS:
                    yield packed()
                    held.clear()
                    size = 0
        held.append((np.array([END]), np.array([ends], np.int64), np.zeros(1, np.int32)))
        yield packed()

    rows = documents.select("text").where(F.coalesce(learn, F.lit(False)))
    parts = rows.mapInArrow(count, "word long, ending int, n long")
    return parts.groupBy("word").agg(F.first("ending").alias("ending"), F.sum("n").alias("n")).where("n > 0")


def _merged(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word, n, ending = (np.concatenate([x[i] for x in held]) for i in range(3))
    found, first, place = np.unique(word, return_index=True, return_inverse=True)
    return found, np.bincount(place, n, len(found)).astype(np.int64), ending[first]


def _units(words: np.ndarray, unit: np.ndarray, word: np.ndarray, ending: np.ndarray, alone: int) -> np.ndarray:
    """Units of words: up to ``alone`` words of their own, then endings; 0 is the end of a text."""
    if len(words):
        place = np.minimum(np.searchsorted(words, word), len(words) - 1)
        own = np.where(words[place] == word, unit[place], -1)
    else:
        own = np.full(len(word), -1)
    return np.where(own >= 0, own, 1 + alone + ending)


def _sequence(unit: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of all texts with an end before the first text and after each, and the place of each end."""
    ends = at[1:] + np.arange(1, len(at))
    full = np.zeros(len(unit) + len(at), np.int64)
    inner = np.ones(len(full), bool)
    inner[0] = False
    inner[ends] = False
    full[inner] = unit
    return full, ends


def unit_bigrams(documents: DataFrame, learn: Column, words: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """How often each unit follows another in the training rows; at most units * units counts."""
    small_batches(documents.sparkSession)
    alone = UNIT_WORDS
    size = 1 + alone + UNIT_ENDINGS
    sent = documents.sparkSession.sparkContext.broadcast((words, unit))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int32)
        for batch in batches:
            if batch.num_rows:
                word, ending, at = _tokens(batch.column("text"))
                full, _ = _sequence(_units(*sent.value, word, ending, alone), at)
                np.add.at(total, full[:-1] * size + full[1:], 1)
        found = np.flatnonzero(total)
        for low in range(0, len(found), 100_000):
            part = found[low : low + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], names=["pair", "n"]
            )

    rows = documents.select("text").where(F.coalesce(learn, F.lit(False)))
    counted = rows.mapInArrow(count, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(size * size)
    pairs[counted.column("pair").to_numpy()] = counted.column("n").to_numpy()
    return pairs.reshape(size, size)


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit: move one unit at a time to the class that raises the bigram likelihood most.

    Unit 0, the end of a text, keeps class 0 to itself. Units begin in turn, by frequency. Equal
    gains go to the smaller class.
    """
    total = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-total, kind="stable")
    order = order[(order != 0) & (total[order] > 0)]
    member = np.ones(len(pairs), np.int64)
    member[0] = 0
    member[order] = 1 + np.arange(len(order)) % (classes - 1)
    table = _class_table(pairs, member, classes)
    left = np.zeros((len(pairs), classes))  # counts of each unit after each class
    right = np.zeros((len(pairs), classes))
    for c in range(classes):
        left[:, c] = pairs[member == c].sum(axis=0)
        right[:, c] = pairs[:, member == c].sum(axis=1)

    def log(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1))

    for _ in range(sweeps):
        moved = 0
        for unit in order:
            old, own = member[unit], pairs[unit, unit]
            before, after = left[unit].copy(), right[unit].copy()
            before[old] -= own
            after[old] -= own
            table[:, old] -= before
            table[old, :] -= after
            table[old, old] -= own
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            # gain of adding the unit to class c, from the cells and sums that change
            gain = (log(table + before[:, None]) - log(table)).sum(axis=0) + (log(table + after[None, :]) - log(table)).sum(axis=1)
            diagonal = np.diagonal(table)
            gain -= log(diagonal + before) - log(diagonal) + log(diagonal + after) - log(diagonal)
            gain += log(diagonal + before + after + own) - log(diagonal)
            out, into = after.sum() + own, before.sum() + own
            rows, columns = rows + before, columns + after  # wherever the unit goes, its neighbours' sums hold it
            gain -= log(rows + out) - log(rows) + log(columns + into) - log(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if new != old and gain[new] <= gain[old] + 1e-9:
                new = old
            table[:, new] += before
            table[new, :] += after
            table[new, new] += own
            if new != old:
                moved += 1
                member[unit] = new
                left[:, old] -= pairs[unit]
                left[:, new] += pairs[unit]
                right[:, old] -= pairs[:, unit]
                right[:, new] += pairs[:, unit]
        if not moved:
            break
    return member


def _class_table(pairs: np.ndarray, member: np.ndarray, classes: int) -> np.ndarray:
    rows = np.zeros((classes, pairs.shape[1]))
    np.add.at(rows, member, pairs)
    table = np.zeros((classes, classes))
    np.add.at(table.T, member, rows.T)
    return table


def _numbers(words: np.ndarray, word: np.ndarray, ending: np.ndarray) -> np.ndarray:
    """Place of each word in the vocabulary; words outside have the number of their ending after it."""
    if not len(words):
        return ending.astype(np.int64)
    place = np.minimum(np.searchsorted(words, word), len(words) - 1)
    return np.where(words[place] == word, place, len(words) + ending)


def _totals(rows: Iterator[pa.RecordBatch], size: int, count) -> np.ndarray:
    """How often ``count(word, ending, at)`` gives each code below ``size``, over the texts of a task."""
    total = np.zeros(size, np.int64)
    for batch in rows:
        if batch.num_rows:
            np.add.at(total, count(*_tokens(batch.column("text"))), 1)
    return total


def class_pairs(documents: DataFrame, learn: Column, words: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """How often each class follows another in the training rows."""

    def count(word: np.ndarray, ending: np.ndarray, at: np.ndarray) -> np.ndarray:
        full, _ = _sequence(classes[_numbers(words, word, ending)], at)
        return full[:-1] * CLASSES + full[1:]

    small_batches(documents.sparkSession)
    size = CLASSES * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _totals(batches, size, count)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], names=["code", "n"])

    table = np.zeros(size)
    rows = documents.select("text").where(F.coalesce(learn, F.lit(False))).mapInArrow(run, "code int, n long")
    for row in rows.groupBy("code").agg(F.sum("n").alias("n")).collect():
        table[row.code] = row.n
    return table.reshape(CLASSES, CLASSES)


def neighbours(documents: DataFrame, learn: Column, words: np.ndarray, classes: np.ndarray) -> DataFrame:
    """part, counts: for PART words or endings in a row, how often each class stands before and after each, packed.

    A task gives one row a part at most, so what is shuffled follows the number of tasks, not of tokens.
    """
    small_batches(documents.sparkSession)
    each = PART * 2 * CLASSES

    def count(word: np.ndarray, ending: np.ndarray, at: np.ndarray) -> np.ndarray:
        number = _numbers(words, word, ending)
        full, _ = _sequence(classes[number], at)
        places, _ = _sequence(number + 1, at)
        here = np.flatnonzero(places)
        own = (places[here] - 1) * (2 * CLASSES)
        return np.concatenate([own + full[here - 1], own + CLASSES + full[here + 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _totals(batches, -(-len(classes) // PART) * each, count).reshape(-1, each)
        used = np.flatnonzero(total.any(axis=1))
        packed = [pa.compress(total[part].tobytes(), codec="zstd", asbytes=True) for part in used]
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], names=["part", "counts"])

    rows = documents.select("text").where(F.coalesce(learn, F.lit(False)))
    return rows.mapInArrow(run, "part int, counts binary")


def best_of(counts: np.ndarray, log_step: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The class under which each row's neighbours are likeliest, given transitions and class sizes.

    A row counts the classes before a word, then those after it. Its occurrences come after the former, go on to the
    latter, and share out the tokens of the class they join. Class 0 is the end of a text. Of equal classes
    the smallest.
    """
    fit = np.vstack([log_step - np.log10(tokens + 1)[None, :], log_step.T])[:, 1:]
    return 1 + (counts @ fit).argmax(axis=1)


def best_classes(found: DataFrame, log_step: np.ndarray, tokens: np.ndarray) -> DataFrame:
    """number, class of every word and ending that occurs, from ``neighbours``; a task holds one part's counts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None

        def best() -> pa.RecordBatch:
            used = np.flatnonzero(total.any(axis=1))
            chosen = best_of(total[used].astype(float), log_step, tokens)
            return pa.RecordBatch.from_arrays(
                [pa.array((held * PART + used).astype(np.int32)), pa.array(chosen.astype(np.int32))], names=["number", "class"]
            )

        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                if part != held:
                    if held is not None:
                        yield best()
                    held, total = part, np.zeros((PART, 2 * CLASSES), np.int64)
                raw = pa.decompress(counts, decompressed_size=total.nbytes, codec="zstd", asbytes=True)
                total += np.frombuffer(raw, np.int64).reshape(total.shape)
        if held is not None:
            yield best()

    small_batches(found.sparkSession)
    return found.repartition("part").sortWithinPartitions("part").mapInArrow(run, "number int, class int")


def rest_pairs(documents: DataFrame, learn: Column, words: np.ndarray, classes: np.ndarray, parts: int) -> DataFrame:
    """Occurrences of all training words beyond the vocabulary with what stands beside them, packed by part of a hash.

    ``word`` and the classes ``before`` and ``after`` it, which have RARE added where the neighbour is beyond the vocabulary
    as well; ``next`` is the word after it in that case. Rows with a negative part, -1 - code, count transitions of
    current classes: code below CLASSES ** 2 all of them, above only those between words of the vocabulary.
    """
    small_batches(documents.sparkSession)
    size = CLASSES * CLASSES
    names = ["part", "n", "word", "before", "after", "next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, kept = np.zeros(2 * size, np.int64), [], 0

        def sent() -> Iterator[pa.RecordBatch]:
            word, before, after, following = (np.concatenate(x) for x in zip(*held))
            part = (word.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            word, before, after, following, part = word[order], before[order], after[order], following[order], part[order]
            used, begin = np.unique(part, return_index=True)
            for p, a, b in zip(used.tolist(), begin, [*begin[1:], len(part)]):
                packed = (word[a:b], before[a:b], after[a:b], following[a:b][after[a:b] >= RARE])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int32()), pa.array([0], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                    names=names,
                )

        for batch in batches:
            if not batch.num_rows:
                continue
            word, ending, at = _tokens(batch.column("text"))
            number = _numbers(words, word, ending)
            cls, _ = _sequence(classes[number], at)
            beyond = _sequence(number >= len(words), at)[0].astype(bool)
            code = cls[:-1] * CLASSES + cls[1:]
            table[:size] += np.bincount(code, minlength=size)
            table[size:] += np.bincount(code[~beyond[:-1] & ~beyond[1:]], minlength=size)
            own, _ = _sequence(word, at)
            marked = (cls + RARE * beyond).astype(np.uint8)
            here = np.flatnonzero(beyond)
            held.append((own[here], marked[here - 1], marked[here + 1], own[here + 1]))
            kept += len(here)
            if kept > KEPT_WORDS:
                yield from sent()
                held.clear()
                kept = 0
        if kept:
            yield from sent()
        used = np.flatnonzero(table)
        none = pa.nulls(len(used), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array((-1 - used).astype(np.int32)), pa.array(table[used]), *[none] * 4], names=names)

    rows = documents.select("text").where(F.coalesce(learn, F.lit(False)))
    return rows.mapInArrow(run, "part int, n long, word binary, before binary, after binary, next binary")


def settled(pairs: DataFrame, log_step: np.ndarray, tokens: np.ndarray) -> DataFrame:
    """Each word of ``rest_pairs`` with n and the class that its neighbours fit best, and the transitions that follow.

    Rows with a word and ``before`` -1 are the words. Rows without a word count n transitions from class ``before`` to
    ``class``; rows with both say that class ``before`` stands n times before the word.
    """

    def settle(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        word, before, after, following = (np.concatenate(x) for x in zip(*held))
        found, place, n = np.unique(word, return_inverse=True, return_counts=True)
        order = np.argsort(place, kind="stable")
        begin = np.append(0, np.cumsum(n))
        chosen = np.zeros(len(found), np.int64)
        for low in range(0, len(found), BESIDE):
            high = min(low + BESIDE, len(found))
            own = order[begin[low] : begin[high]]
            row = (place[own] - low) * (2 * CLASSES)
            code = np.concatenate([row + before[own] % RARE, row + CLASSES + after[own] % RARE])
            beside = np.bincount(code, minlength=(high - low) * 2 * CLASSES).reshape(high - low, 2 * CLASSES)
            chosen[low:high] = best_of(beside.astype(float), log_step, tokens)
        yield rows(found, n, chosen, np.full(len(found), -1))
        own = chosen[place]
        into, out = before < RARE, after < RARE
        codes, times = np.unique(np.concatenate([before[into] * np.int64(CLASSES) + own[into], own[out] * CLASSES + after[out]]), return_counts=True)
        yield rows(None, times, codes % CLASSES, codes // CLASSES)
        links, times = np.unique(np.stack([following, own[~out]]), axis=1, return_counts=True)
        yield rows(links[0], times, np.full(len(times), -1), links[1])

    def rows(word: np.ndarray | None, n: np.ndarray, cls: np.ndarray, before: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.nulls(len(n), pa.int64()) if word is None else pa.array(word), pa.array(n.astype(np.int64)),
             pa.array(cls.astype(np.int32)), pa.array(before.astype(np.int32))],
            names=["word", "n", "class", "before"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, []
        kinds = [np.int64, np.uint8, np.uint8, np.int64]
        for batch in batches:
            for part, *packed in zip(*(batch.column(name).to_pylist() for name in ["part", "word", "before", "after", "next"])):
                if part != current:
                    if held:
                        yield from settle(held)
                    current, held = part, []
                held.append(tuple(np.frombuffer(x, kind) for x, kind in zip(packed, kinds)))
        if held:
            yield from settle(held)

    small_batches(pairs.sparkSession)
    shuffled = pairs.where("part >= 0").drop("n").repartition("part").sortWithinPartitions("part")
    return shuffled.mapInArrow(run, "word long, n long, class int, before int")


def settle_rest(
    documents: DataFrame, learn: Column, words: np.ndarray, classes: np.ndarray, occurrences: int
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """word, n and class of every training word beyond the vocabulary; then the table of transitions, and the types of each class."""
    pairs = written(rest_pairs(documents, learn, words, classes, -(-occurrences // SETTLED)), "lm-rest-pairs")
    size = CLASSES * CLASSES
    tables = np.zeros(2 * size)
    for row in pairs.where("part < 0").groupBy("part").agg(F.sum("n").alias("n")).collect():
        tables[-1 - row.part] = row.n
    current, table = tables.reshape(2, CLASSES, CLASSES)
    found = written(settled(pairs, _log_step(current), current.sum(axis=0)), "lm-rest")
    rest = found.where("word is not null and before = -1").select("word", "n", "class")
    cells = found.where("word is null").select("before", "class", "n")
    links = found.where("word is not null and before >= 0").select("word", "before", F.col("n").alias("times"))
    linked = links.join(rest, "word").select("before", "class", F.col("times").alias("n"))
    for row in cells.unionByName(linked).groupBy("before", "class").agg(F.sum("n").alias("n")).collect():
        table[row["before"], row["class"]] += row["n"]
    kinds = np.zeros(CLASSES)
    for row in rest.groupBy("class").count().collect():
        kinds[row["class"]] = row["count"]
    return rest, table, kinds


def _log_step(table: np.ndarray) -> np.ndarray:
    return np.log10(table + TRANSITION_ADD) - np.log10(table.sum(axis=1, keepdims=True) + TRANSITION_ADD * CLASSES)


def train(documents: DataFrame, learn: Column, every: bool = False) -> tuple[Tables, DataFrame, int, int]:
    """The model, the counts of all training words, and their tokens and types (ends included).

    With ``every``, each word beyond the vocabulary has a class of its own choice, which comes with its count in a column
    ``class``; else such words share the class of their ending. The counts hold then no words of the vocabulary.

    The driver gets the vocabulary with its counts and classes, the table of units, and tables of classes; their
    sizes are fixed. Null texts count as empty, repeated rows count each, and without training rows every
    word is unseen.
    """
    counts = written(word_counts(documents, learn), "word-counts")
    tokens, types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = counts.where(F.col("word") != int(END)).orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    words = np.array([r.word for r in top], np.int64)
    n = np.array([r.n for r in top], np.int64)
    endings = np.array([r.ending for r in top], np.int64)
    unit = np.where(np.arange(len(top)) < UNIT_WORDS, np.arange(len(top)) + 1, -1)
    order = np.argsort(words)
    words, n, endings, unit = words[order], n[order], endings[order], unit[order]
    pairs = unit_bigrams(documents, learn, words, unit)
    member = exchange(pairs)
    classes = np.concatenate([
        member[np.where(unit > 0, unit, 1 + UNIT_WORDS + endings)] if len(words) else np.zeros(0, np.int64), member[1 + UNIT_WORDS :]
    ])
    table, fixed = _class_table(pairs, member, CLASSES), np.flatnonzero(unit > 0)
    beyond = tokens - int(n.sum()) - int(table[0].sum())
    for left in reversed(range(ROUNDS if tokens else 0)):
        moved = best_classes(neighbours(documents, learn, words, classes), _log_step(table), table.sum(axis=0)).collect()
        own = classes[fixed].copy()
        for row in moved:
            classes[row["number"]] = row["class"]
        classes[fixed] = own
        if left or not (every and beyond):
            table = class_pairs(documents, learn, words, classes)
    kinds = np.zeros(CLASSES)
    if every and beyond:
        rest, table, kinds = settle_rest(documents, learn, words, classes, beyond)
        ends = counts.where(F.col("word") == int(END)).select("word", "n", F.lit(0).alias("class"))
        counts = rest.unionByName(ends)
    else:
        of_ending = np.zeros(UNIT_ENDINGS)
        for row in counts.where(F.col("word") != int(END)).groupBy("ending").count().collect():
            of_ending[row.ending] = row["count"]
        np.subtract.at(of_ending, endings, 1)
        np.add.at(kinds, classes[len(words) :], of_ending)
    # tokens and types of each class, over the whole vocabulary
    in_class = table.sum(axis=0)
    np.add.at(kinds, classes[: len(words)], 1)
    log_emit = np.log10(in_class + kinds + 1)
    log_emit[0] = np.log10(in_class[0] + 1) if in_class[0] else 0.0
    return Tables(words, n, classes, log_emit, _log_step(table)), counts, tokens, types


def score(documents: DataFrame, tables: Tables, counts: DataFrame, tokens: int, types: int) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score of each row's whole text; null counts as empty.

    Scores are log10 probabilities: base_score of a unigram model with one added to each count,
    score of the class model. Repeated rows get equal results; equal ids are told apart by the text. An empty table
    gives an empty result; other columns do not matter.
    """
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast(tables)
    base = float(np.log10(tokens + types + 1))
    end_log = float(np.log10(counts.where(F.col("word") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1))

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Tables = sent.value
        task, own = TaskContext.get().partitionId(), count_up()
        for batch in batches:
            if not batch.num_rows:
                continue
            word, ending, at = _tokens(batch.column("text"))
            number = _numbers(model.words, word, ending)
            known = number < len(model.words)
            cls = (model.classes[number] + RARE * ~known).astype(np.uint8)
            log = np.zeros(len(word))
            log[known] = np.log10(model.counts[number[known]] + 1)
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(at, at[low] + PACK, "right")) - 1)
                a, b = at[low], at[high]
                rare, spots = np.unique(word[a:b][~known[a:b]], return_inverse=True)
                owner = np.repeat(np.arange(high - low), np.diff(at[low : high + 1]))
                packed = [
                    np.diff(at[low : high + 1]).astype(np.int64), np.bincount(owner, known[a:b], high - low).astype(np.int64),
                    np.bincount(owner, log[a:b], high - low), cls[a:b], spots.astype(np.int32),
                ]
                ids = batch.column("doc_id").slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(task << 32) + next(own)], pa.int64()), _listed(ids),
                     *(pa.array([x.tobytes()], pa.binary()) for x in packed), _listed(pa.array(rare, pa.int64()))],
                    names=["pack", "ids", "size", "known", "logs", "cls", "spots", "rare"],
                )
                low = high

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Tables = sent.value
        kinds = {"size": np.int64, "known": np.int64, "logs": float, "cls": np.uint8, "spots": np.int32}
        for batch in batches:
            for i in range(batch.num_rows):
                size, known, logs, cls, spots = (np.frombuffer(batch.column(name)[i].as_py(), kind) for name, kind in kinds.items())
                own, times = np.full(int(spots.max(initial=-1)) + 1, -1), np.zeros(int(spots.max(initial=-1)) + 1)
                found = batch.column("found")[i]
                if found.is_valid:
                    place, chosen, n = (found.values.field(k).to_numpy() for k in range(3))
                    own[place], times[place] = chosen, n
                beyond = cls >= RARE
                cls, chosen, times = (cls % RARE).astype(np.int64), own[spots], times[spots]
                cls[beyond] = np.where(chosen >= 0, chosen, cls[beyond])
                full, ends = _sequence(cls, np.append(0, np.cumsum(size)))
                steps = model.log_step[full[:-1], full[1:]] - model.log_emit[full[1:]]
                path = np.add.reduceat(steps, np.append(0, ends[:-1]))
                owner = np.repeat(np.arange(len(size)), size)[beyond]
                known = known + np.bincount(owner, times > 0, len(size)).astype(np.int64) + (end_log > 0)
                logs = logs + np.bincount(owner, np.log10(times + 1), len(size)) + end_log
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, pa.array(size + 1), pa.array(known), pa.array(logs - (size + 1) * base), pa.array(logs + path)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    small_batches(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "pack long, ids array<long>, size binary, known binary, logs binary, cls binary, spots binary, rare array<long>"
    scored = written(rows.mapInArrow(packs, schema), "lm-rows")
    chosen = F.col("class") if "class" in counts.columns else F.lit(-1).alias("class")
    each = scored.select("pack", F.posexplode("rare").alias("place", "word")).join(counts.select("word", "n", chosen), "word")
    found = each.repartition("pack").groupBy("pack").agg(F.collect_list(F.struct("place", "class", "n")).alias("found"))
    return scored.drop("rare").join(found, "pack", "left").mapInArrow(
        finish, "doc_id long, n_tokens long, n_known long, base_score double, score double"
    )


def _listed(values: pa.Array) -> pa.ListArray:
    """All values as the one list of a column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
