"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. The vector of a letter
triple is the product of its letters' vectors, each rotated by its place. A text's vector is the
sum over its triples, a language's prototype the sum over its texts, and a text gets the language
whose prototype has the largest cosine with it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import per_batch, small_batches, with_fields

DIMENSIONS = 1024
SPACE = 32
KEPT_TRIPLES = 40_000  # triple vectors that a task keeps at hand; others are made again
UNKNOWN = "und"

_state: dict[str, object] = {}


def _letters() -> np.ndarray:
    if "letters" not in _state:
        _state["letters"] = np.array([chr(i).isalpha() for i in range(0x110000)])
    return _state["letters"]


def letter_vector(code: int) -> np.ndarray:
    return (np.random.default_rng(code).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)


def triples(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter triples of a text and their counts; every run of other characters is one space.

    A text without letters has none. A space stands before the first and after the last letter.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = np.concatenate([[SPACE], np.where(letter, codes, SPACE), [SPACE]])
    codes = codes[np.append(True, (codes[1:] != SPACE) | (codes[:-1] != SPACE))]
    if len(codes) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique((codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:], return_counts=True)


class Binder:
    """Vectors of triples, made at first use and kept up to a bound."""

    def __init__(self) -> None:
        self.single: dict[int, np.ndarray] = {}
        self.place: dict[int, int] = {}
        self.table = np.zeros((1024, DIMENSIONS), np.int8)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.single:
            self.single[code] = letter_vector(code)
        return self.single[code]

    def bind(self, triple: int) -> np.ndarray:
        a, b, c = triple >> 42, (triple >> 21) & 0x1FFFFF, triple & 0x1FFFFF
        return np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)

    def bundle(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of the vectors, each as often as counted."""
        total = np.zeros(DIMENSIONS)
        for low in range(0, len(found), 4096):
            total += self._bundle(found[low : low + 4096], counts[low : low + 4096])
        return total

    def _bundle(self, found: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if len(self.place) + len(found) > KEPT_TRIPLES:
            self.place.clear()
        at = np.empty(len(found), np.int64)
        for i, triple in enumerate(found.tolist()):
            place = self.place.get(triple)
            if place is None:
                place = self.place[triple] = len(self.place)
                if place >= len(self.table):
                    grown = np.zeros((2 * len(self.table), DIMENSIONS), np.int8)
                    grown[: len(self.table)] = self.table
                    self.table = grown
                self.table[place] = self.bind(triple)
            at[i] = place
        return counts.astype(np.float32) @ self.table[at].astype(np.float32)


def _binder() -> Binder:
    if "binder" not in _state:
        _state["binder"] = Binder()
    return _state["binder"]


@dataclass(frozen=True)
class Prototypes:
    names: tuple[str, ...]
    vectors: np.ndarray  # one unit vector a language


def learn(documents: DataFrame, learn_from: Column) -> Prototypes:
    """Bundle the texts of each language, over all rows for which ``learn_from`` holds.

    Every text weighs the same. Rows without language or text, and texts without letters, teach
    nothing. A task sends one row a language and dimension, whatever the number of its texts.
    """
    small_batches(documents.sparkSession)
    rows = documents.select("text", "lang").where(F.coalesce(learn_from, F.lit(False)) & F.col("lang").isNotNull())

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[int, float]] = {}
        totals: dict[str, np.ndarray] = {}
        binder = _binder()

        def flush(lang: str) -> None:
            found = np.fromiter(sums[lang], np.int64, len(sums[lang]))
            totals[lang] = totals.get(lang, 0) + binder.bundle(found, np.fromiter(sums[lang].values(), float, len(found)))
            sums[lang] = {}

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                found, counts = triples(text)
                if len(found):
                    into, share = sums.setdefault(lang, {}), counts / counts.sum()
                    for triple, weight in zip(found.tolist(), share.tolist()):
                        into[triple] = into.get(triple, 0.0) + weight
                    if len(into) > KEPT_TRIPLES:
                        flush(lang)
        for lang in list(sums):
            flush(lang)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(total)],
                names=["lang", "dimension", "value"],
            )

    parts = rows.mapInArrow(bundle, "lang string, dimension int, value double")
    summed = parts.groupBy("lang", "dimension").agg(F.sum("value").alias("value")).collect()
    names = tuple(sorted({r.lang for r in summed}))
    vectors = np.zeros((len(names), DIMENSIONS))
    for r in summed:
        vectors[names.index(r.lang), r.dimension] = r.value
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return Prototypes(names, np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0))


def predictor(prototypes: Prototypes) -> Callable[[str | None], tuple[str, float]]:
    binder = _binder()

    def predict(text: str | None) -> tuple[str, float]:
        found, counts = triples(text)
        if not len(found) or not prototypes.names:
            return UNKNOWN, 0.0
        vector = binder.bundle(found, counts)
        cosine = prototypes.vectors @ vector / max(float(np.linalg.norm(vector)), 1e-12)
        best = int(cosine.argmax())  # of equal ones the first name
        return prototypes.names[best], float(min(1.0, max(0.0, cosine[best])))

    return predict


def identify(documents: DataFrame, prototypes: Prototypes) -> DataFrame:
    """All columns of ``documents`` with ``lang_pred`` and ``lang_score``, the cosine cut to 0..1.

    Null texts, texts without a letter, and all texts if nothing was learned, get ``und`` and 0.
    Columns of these names in the input are replaced.
    """
    sent = documents.sparkSession.sparkContext.broadcast(prototypes)
    kept = documents.drop("lang_pred", "lang_score")
    schema = with_fields(kept, lang_pred="string", lang_score="double")

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        predict = predictor(sent.value)
        found = [predict(text.as_py()) for text in batch.column("text")]
        names, scores = pa.array([x[0] for x in found]), pa.array([x[1] for x in found])
        return pa.RecordBatch.from_arrays(
            [*batch.columns, names, scores], names=[*batch.schema.names, "lang_pred", "lang_score"]
        )

    return per_batch(kept, convert, schema)
