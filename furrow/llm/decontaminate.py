"""Benchmark decontamination by template canonicalisation.

Words lose case and punctuation, and numbers, names and units become typed placeholders. Windows
of this template are hashed and joined with those of the benchmark. Where windows of a text and of
an item meet, the values in the slots are compared: within one item, equal values must always be
replaced by equal ones, so a re-parameterised question is caught and a chance meeting is not.

Short questions have too few plain words for that ("What is 12 + 7?"). With other values they are found
where their whole template is a sentence of its own in the text.

Words are read in three ways, each with windows of its own: as they are (verbatim, case apart), with
capitalised words as names, and with the benchmark's names as names in any case.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm import words as W
from furrow.llm.common import packed, per_batch, unpacked, written

WINDOW = 8  # words of a template window; an item with fewer is one window
LITERAL = 4  # words of a window (or all of a shorter item, if fewer) that must not be placeholders
SHORT_LITERAL = 2  # plain words of a whole short item that is looked for as a sentence
SHIFT = 8  # words inserted or dropped between two runs of one copy
SHARE = 0.5  # part of an item's template that a text must hold
BROADCAST_WINDOWS = 2_000_000  # benchmark windows that are sent to all tasks (16 MB); beyond, a shuffled join

# Words that count as units after a number.
UNITS = (
    "mm", "cm", "m", "km", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "inch", "inches", "foot", "feet", "yard", "yards",
    "mile", "miles", "meter", "meters", "kilometer", "kilometers", "gram", "grams", "kilogram", "kilograms", "litre", "litres",
    "liter", "liters", "pound", "pounds", "ounce", "ounces", "second", "seconds", "minute", "minutes", "hour", "hours", "day",
    "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "euro", "euros", "cent", "cents",
)

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0xA11CE5, 0xB0B5, 0xC0FFEE))
_SENTENCE = np.zeros(256, bool)  # bytes that end a sentence, as line ends do
_SENTENCE[[*b".!?:;"]] = True
_WHOLE = np.uint64(0x5E47E4CE)  # tells whole short items from windows
_END = np.zeros(256, bool)  # bytes after which a capital does not make a name
_END[[ord(c) for c in ".!?:;\"'()[]{}<>|*-#>"]] = True


def _hashes(words: list[str]) -> np.ndarray:
    data, offsets = W.text_bytes(pa.array([" ".join(words)]))
    return np.sort(W.words(data, offsets, skip=W.MARK).hash)


_UNIT_HASHES = _hashes(list(UNITS))
_EMPTY = _hashes(["."])[0]


def canonical(
    data: np.ndarray, offsets: np.ndarray, names: np.ndarray | None = None, found: W.Words | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template hash and own hash of each word, whether it is a slot, and where texts begin.

    A word with a digit is a number, a unit right after a number a unit, and a capitalised word
    inside a sentence a name, or, if ``names`` (sorted own hashes) are given, a word among them.
    Words of punctuation only are left out.
    """
    found = W.words(data, offsets, skip=W.MARK) if found is None else found
    begin, end, own = found.begin, found.end, found.hash
    count = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data >= 48) & (data <= 57), out=count[1:])
    number = count[end] > count[begin]
    np.cumsum((data >= 97) & (data <= 122), out=count[1:])
    lower = count[end] > count[begin]
    np.cumsum(data == 10, out=count[1:])
    first = data[begin] if len(begin) else np.zeros(0, np.uint8)
    capital = (first >= 65) & (first <= 90) & lower
    inside = np.zeros(len(begin), bool)
    if len(begin):
        inside[1:] = ~_END[data[end[:-1] - 1]] & (count[begin[1:]] == count[end[:-1]])
        inside[found.at[:-1][found.at[:-1] < len(begin)]] = False
    name = capital & inside if names is None else _among(names, own)
    name &= ~number
    after = np.zeros(len(begin), bool)
    after[1:] = number[:-1]
    after[found.at[:-1][found.at[:-1] < len(begin)]] = False
    unit = after & ~number & _among(_UNIT_HASHES, own)
    template = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, own)))
    kept = own != _EMPTY
    at = np.append(0, np.cumsum(kept))[found.at]
    return template[kept], own[kept], (number | unit | name)[kept], at


def _among(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def sentence_starts(data: np.ndarray, found: W.Words) -> np.ndarray:
    """Whether a sentence begins at each word that counts (see ``canonical``)."""
    begin, end = found.begin, found.end
    lines = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == 10, out=lines[1:])
    starts = np.ones(len(begin), bool)
    if len(begin):
        starts[1:] = _SENTENCE[data[end[:-1] - 1]] | (lines[begin[1:]] > lines[end[:-1]])
        starts[found.at[:-1][found.at[:-1] < len(begin)]] = True
    kept = np.flatnonzero(found.hash != _EMPTY)
    so_far = np.cumsum(starts)[kept]
    return np.diff(so_far, prepend=0) > 0


def readings(
    data: np.ndarray, offsets: np.ndarray, names: np.ndarray
) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray]:
    """Template and slots of each way to read the words, own hashes, where texts begin, and where sentences do.

    The first way is verbatim and has no slots; then come capitals as names, and the given names.
    """
    found = W.words(data, offsets, skip=W.MARK)
    template, own, slot, at = canonical(data, offsets, found=found)
    ways = [(own, np.zeros(len(own), bool)), (template, slot)]
    if len(names):
        template, _, slot, _ = canonical(data, offsets, names, found)
        ways.append((template, slot))
    return ways, own, at, sentence_starts(data, found)


def _names(batch: pa.RecordBatch) -> pa.RecordBatch:
    template, own, _, _ = canonical(*W.text_bytes(batch.column("text")))
    return pa.RecordBatch.from_arrays([pa.array(W.signed(np.unique(own[template == _NAME])))], names=["name"])


def windows(template: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window and whether it holds enough literal words. Empty where there are fewer words.

    Words without any slot, as in the verbatim reading, are all literal, so each window counts.
    """
    if len(template) < size or size == 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    literal = np.append(0, np.cumsum(~slot))
    enough = literal[size:] - literal[:-size] >= min(LITERAL, size)
    return W._chain(template, size, len(template) - size + 1), enough


def whole_sentences(template: np.ndarray, slot: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each stretch of words and whether it is one sentence or more that a short item could be found as.

    It has a slot, as verbatim copies are found anyway, and SHORT_LITERAL plain words.
    """
    if len(template) < size or size == 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    literal = np.append(0, np.cumsum(~slot))
    plain = literal[size:] - literal[:-size]
    alone = starts[: len(starts) - size + 1] & np.append(starts, True)[size:]
    return W.mix(W._chain(template, size, len(template) - size + 1) ^ _WHOLE), alone & (plain >= SHORT_LITERAL) & (plain < size)


def _item_windows(batch: pa.RecordBatch, names: np.ndarray) -> pa.RecordBatch:
    ways, _, at, starts = readings(*W.text_bytes(batch.column("text")), names)
    ids, hashes, sizes, times, words = [], [], [], [], []
    for item, a, b in zip(batch.column("item_id").to_pylist(), at, at[1:]):
        size = min(WINDOW, int(b - a))
        each = [windows(template[a:b], slot[a:b], size) for template, slot in ways]
        if b - a <= WINDOW:
            each += [whole_sentences(template[a:b], slot[a:b], starts[a:b], size) for template, slot in ways]
        found, often = np.unique(np.concatenate([x[enough] for x, enough in each]), return_counts=True)
        ids += [item] * len(found)
        hashes.append(found)
        times.append(often)
        sizes += [size] * len(found)
        words += [int(b - a)] * len(found)
    joined = W.signed(np.concatenate(hashes)) if hashes else np.zeros(0, np.int64)
    often = np.concatenate(times) if times else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(joined), pa.array(sizes, pa.int32()), pa.array(often, pa.int64()), pa.array(words, pa.int64())],
        names=["item_id", "window", "size", "times", "words"],
    )


def _hits(documents: DataFrame, items: DataFrame, sizes: list[int], names: np.ndarray) -> DataFrame:
    """key and the distinct item windows that a text holds; texts without any have no row."""
    distinct = items.select("window").distinct()
    wanted = None
    if distinct.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS:
        values = np.sort(np.array([r.window for r in distinct.collect()], np.int64))
        wanted = documents.sparkSession.sparkContext.broadcast(values)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        ways, _, at, starts = readings(*W.text_bytes(batch.column("text")), names)
        places, found = [], []
        each = [(size, windows(*way, size)) for size, way in itertools.product(sizes, ways)]
        each += [(size, whole_sentences(*way, starts, size)) for size, way in itertools.product(sizes, ways)]
        for size, (hashes, enough) in each:
            if not len(hashes):
                continue
            text = np.searchsorted(at, np.arange(len(hashes)), "right") - 1
            enough &= np.arange(len(hashes)) + size <= at[text + 1]
            hashes = W.signed(hashes)
            if wanted is not None and enough.any():
                enough &= _among(wanted.value, hashes)
            picked = np.flatnonzero(enough)
            places.append(text[picked])
            found.append(hashes[picked])
        text = np.concatenate(places) if places else np.zeros(0, np.int64)
        window = np.concatenate(found) if found else np.zeros(0, np.int64)
        pairs = np.unique(np.stack([text, window]), axis=1) if len(text) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays(
            [batch.column("_key").take(pa.array(pairs[0])), pa.array(pairs[1])], names=["_key", "window"]
        )

    return per_batch(documents.select("_key", "text"), convert, "_key string, window long")


def aligned(text: str, item: str, names: np.ndarray) -> tuple[int, int, int]:
    """Words of the item that the text holds in one chain of runs, the item's words, and slots compared.

    A run is a stretch of windows that text and item share on one diagonal (place in the text minus place in the
    item). Within a run, and along a chain, each value of the item has one value of the text; verbatim runs count
    whatever the other slots hold. A chain goes forward in both, with at most SHIFT words between two diagonals.
    """
    data, offsets = W.text_bytes(pa.array([item, text]))
    ways, own, at, starts = readings(data, offsets, names)
    n = int(at[1])
    held = []  # begin and end in the item, diagonal, values, number of slots up to each place
    for begin, end, shift, way in sorted((a, b, s, i) for i, w in enumerate(ways) for a, b, s in _runs(*w, starts, n)):
        slot = ways[way][1][:n]
        places = begin + np.flatnonzero(slot[begin:end])
        pairs = set(zip(own[places].tolist(), own[n + places + shift].tolist()))
        if len(pairs) == len({x for x, _ in pairs}):
            held.append((begin, end, shift, dict(pairs), np.append(0, np.cumsum(slot))))
    held.sort(key=lambda x: (x[0] + x[2], x[0], x[1]))
    best: list[tuple[int, int, dict[int, int]]] = []  # covered words, slots and values of the best chain to each run
    low = 0
    for k, (begin, end, shift, values, slots) in enumerate(held):
        while held[low][0] + held[low][2] < begin + shift - n - SHIFT:
            low += 1
        top = (end - begin, int(slots[end] - slots[begin]), values)
        for p in range(low, k):
            a, b, s = held[p][:3]
            if not (a < begin and b < end and a + s < begin + shift and abs(s - shift) <= SHIFT):
                continue
            new = max(begin, b)
            sums = (best[p][0] + end - new, best[p][1] + int(slots[end] - slots[new]))
            if sums > top[:2] and all(best[p][2].get(x, y) == y for x, y in values.items()):
                top = (*sums, best[p][2] | values)
        best.append(top)
    covered, found, _ = max(best, key=lambda x: x[:2], default=(0, 0, {}))
    return covered, n, found


def _runs(template: np.ndarray, slot: np.ndarray, starts: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Begin and end in the item and diagonal of each stretch of shared windows; the first n words are the item's."""
    size = min(WINDOW, n)
    ours, enough = windows(template[:n], slot[:n], size)
    theirs, _ = windows(template[n:], slot[n:], size)
    order = np.argsort(theirs, kind="stable")
    sorted_ = theirs[order]
    diagonals: dict[int, list[int]] = {}
    for i in np.flatnonzero(enough).tolist():
        low, high = np.searchsorted(sorted_, ours[i], "left"), np.searchsorted(sorted_, ours[i], "right")
        for j in order[low:high].tolist():
            diagonals.setdefault(j - i, []).append(i)
    runs = []
    for shift, begins in diagonals.items():
        cuts = [k for k in range(1, len(begins)) if begins[k] > begins[k - 1] + size]
        runs += [(begins[a], begins[b - 1] + size, shift) for a, b in zip([0, *cuts], [*cuts, len(begins)])]
    if 0 < n <= WINDOW:  # a whole short item as a sentence
        ours, enough = whole_sentences(template[:n], slot[:n], starts[:n], n)
        theirs, alone = whole_sentences(template[n:], slot[n:], starts[n:], n)
        same = np.flatnonzero(alone & (theirs == ours[0])) if enough[0] else []
        runs += [(0, n, j) for j in map(int, same) if j not in diagonals]
    return runs


def contaminated(documents: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """_key, doc_id, item_id, n_covered, n_words, n_slots of each text and item that meet consistently.

    At least ``share`` of the item's words lie in one chain of runs (see ``aligned``). Null and empty texts and items meet nothing. Items
    with equal ids count apart if their texts differ. Needs ``_key`` (see ``keyed``).
    """
    bench = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    # one number for each distinct name of the benchmark
    known = per_batch(bench.select("text"), _names, "name long").distinct().collect()
    names = np.sort(np.array([r.name for r in known], np.int64).view(np.uint64))
    items = written(per_batch(bench, lambda batch: _item_windows(batch, names), "item_id long, window long, size int, times long, words long"), "item-windows")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most WINDOW values
    hits = written(_hits(documents, items, sizes, names), "window-hits")
    # windows that could not cover the share, each as often as the item holds it, end here: most meetings over a stock phrase do
    pairs = hits.join(items, "window").groupBy("_key", "item_id").agg(
        (F.sum("times") * WINDOW).alias("most"), F.min("words").alias("words")
    ).where(F.col("most") >= share * F.col("words")).select("_key", "item_id")
    texts = documents.select("_key", "doc_id", "text").join(written(hits.select("_key").distinct(), "hit-texts"), "_key")
    named = bench.select(F.col("item_id").alias("_item"), F.col("text").alias("item_text"))
    rows = texts.dropDuplicates(["_key"]).join(pairs, "_key").join(named, F.col("item_id").eqNullSafe(F.col("_item")))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [aligned(t or "", i, names) for t, i in zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist())]
        keep = [n > 0 and covered >= share * n for covered, n, _ in found]
        columns = [pa.array([x[i] for x in found], pa.int64()) for i in range(3)]
        out = pa.RecordBatch.from_arrays(
            [batch.column("_key"), batch.column("doc_id"), batch.column("item_id"), *columns],
            names=["_key", "doc_id", "item_id", "n_covered", "n_words", "n_slots"],
        )
        return out.filter(pa.array(keep, pa.bool_()))

    schema = "_key string, doc_id long, item_id long, n_covered long, n_words long, n_slots long"
    rows = rows.select("_key", F.col("doc_id").cast("long").alias("doc_id"), "text", "item_id", "item_text")
    return per_batch(rows, convert, schema)


def keyed(documents: DataFrame) -> DataFrame:
    """Adds ``_key``, the id and a hash of the text, so that rows with equal or no id are told apart."""
    return documents.withColumn(
        "_key", F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))
    )


def leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_covered, n_words, n_slots: one row for each text and item that meet.

    Rows with equal id and text give one row an item. Null and empty texts, empty tables and other columns: see ``decontaminate``.
    """
    return contaminated(keyed(documents.select("doc_id", "text")), benchmark).drop("_key")


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark item; all columns, whatever their names, and repeated rows stay as they are.

    Null and empty texts hold none. An empty table, or an empty benchmark, takes nothing away.
    """
    key = F.col("row.doc_id"), F.col("row.text")
    rows = keyed(packed(documents).select("row", key[0].alias("doc_id"), key[1].alias("text")))
    found = written(contaminated(rows.drop("row"), benchmark).select("_key").distinct(), "leaks")
    return unpacked(rows.join(found, "_key", "left_anti"), documents.columns)
