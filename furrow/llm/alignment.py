"""Alignment of two tokenizers by the byte offsets at which their tokens end.

Both token lists of a text end at ascending byte offsets. The shorter list of ends drives a galloping
search (steps that double, then halving) into the longer one. Ends found in both cut the tokens into
groups, and the ranks of two neighbouring ends in the longer list tell which of its tokens overlap the
token between them. Texts of a batch are searched together, each inside its own stretch.

The first tokenizer is byte-level BPE and reads a space and the text; the second is a sentencepiece
model that adds the space itself. Corpus-wide counts of linked ids are made from blocks: tasks write, for each
block of texts, its distinct pairs of ids once, pairs are summed over blocks, and the sums go back to
the blocks, so a pair that all texts hold is one row a block and not one a text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.bpe import Table
from furrow.llm.common import small_batches, written

BLOCK_PAIRS = 1 << 23  # pairs of texts and linked ids in a block, unless one batch has more
STRIDES = (512, 16, 1)  # every so many ends are searched first, from the place of the last one
IDS = 1 << 16  # ids of either tokenizer are smaller; a pair of ids is a * IDS + b
PLAIN = 0xC8  # no byte above: code points below U+0240, whose classes no Unicode version changes

TEXTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
ENCODED = f"block long, doc_id {{}}, {TEXTS}, links binary, pairs array<long>, held array<int>"


def gallop(longer: np.ndarray, keys: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each key the first place of ``longer`` in start..stop whose value is not smaller, stop if none."""
    low, high, step = start.copy(), stop.copy(), 1
    active = np.flatnonzero(low < stop)
    while len(active):  # exponential steps: all before low is smaller, the answer is at high or before
        at = np.minimum(low[active] + (step - 1), stop[active] - 1)
        smaller = longer[at] < keys[active]
        high[active[~smaller]] = at[~smaller]
        active, at = active[smaller], at[smaller]
        low[active] = at + 1
        active = active[low[active] < stop[active]]
        step *= 2
    active = np.flatnonzero(low < high)
    while len(active):  # halving
        middle = (low[active] + high[active]) >> 1
        smaller = longer[middle] < keys[active]
        low[active[smaller]] = middle[smaller] + 1
        high[active[~smaller]] = middle[~smaller]
        active = active[low[active] < high[active]]
    return low


def ranks(shorter: np.ndarray, longer: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """For each end of ``shorter`` its place in ``longer``; text i has ``at[i]:at[i+1]`` and ``to[i]:to[i+1]``."""
    sizes = np.diff(at)
    inside = np.arange(len(shorter)) - np.repeat(at[:-1], sizes)
    place, stop = np.repeat(to[:-1], sizes), np.repeat(to[1:], sizes)
    for stride, wider in zip(STRIDES, (None, *STRIDES)):
        chosen = np.flatnonzero(inside % stride == 0)
        start = place[chosen] if wider is None else place[chosen - inside[chosen] % wider]
        place[chosen] = gallop(longer, shorter[chosen], start, stop[chosen])
    return place


def _exclusive(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


class Tokens:
    """Token numbers of texts in order with their ends in bytes of all texts joined; text i has ``at[i]:at[i+1]``."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> None:
        self.ids, self.at, self.ends = ids, at, np.cumsum(sizes[ids])

    def of(self, texts: np.ndarray) -> Tokens:
        """Those of some texts, with their ends as they were."""
        out = object.__new__(Tokens)
        size = np.diff(self.at)[texts]
        out.at = np.concatenate([[0], np.cumsum(size)])
        pick = np.repeat(self.at[:-1][texts] - out.at[:-1], size) + np.arange(out.at[-1])
        out.ids, out.ends = self.ids[pick], self.ends[pick]
        return out


def aligned(a: Tokens, b: Tokens) -> tuple[np.ndarray, ...]:
    """Of texts whose first list is not longer: (text, number in a, number in b) of each link, groups of a and of b.

    The last two tell the group of each token, counted over all texts.
    """
    place = ranks(a.ends, b.ends, a.at, b.at)
    common = b.ends[place] == a.ends
    first = np.empty_like(place)  # of the tokens that overlap: how many ends are not after the token's start
    first[1:] = (place + common)[:-1]
    starts = a.at[:-1][np.diff(a.at) > 0]
    first[starts] = b.at[:-1][np.diff(a.at) > 0]
    many = place - first + 1
    link_a = np.repeat(np.arange(len(place)), many)
    link_b = np.repeat(first - _exclusive(many), many) + np.arange(many.sum())
    text = np.repeat(np.arange(len(a.at) - 1), np.diff(a.at))[link_a]
    ends_group = np.zeros(len(b.ids), np.int64)
    ends_group[place[common]] = 1
    return text, link_a, link_b, _exclusive(common.astype(np.int64)), _exclusive(ends_group)


class Aligner:
    """Two loaded tokenizers with the bytes of their tokens."""

    def __init__(self, first_path: str, second_path: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_file(first_path)
        self.first.encode_special_tokens = True
        with open(first_path, encoding="utf-8") as file:
            special = {x["id"] for x in json.load(file)["added_tokens"]}
        byte = _bytes_of_characters()
        vocabulary = {i: piece for piece, i in self.first.get_vocab().items()}
        plain = {i: bytes(byte[c] for c in piece) for i, piece in vocabulary.items() if i not in special}
        self.first_table = Table([plain.get(i, vocabulary.get(i, "").encode()) for i in range(max(vocabulary) + 1)])
        self.fast = tiktoken.Encoding(
            "first", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks={piece: i for i, piece in plain.items()}, special_tokens={},
        )
        self.second = sentencepiece.SentencePieceProcessor(model_file=second_path)
        model = self.second
        self.second_table = Table([
            bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())
        ])
        sizes = len(self.first_table.size), len(self.second_table.size)
        if max(sizes) > IDS:
            raise ValueError(f"a tokenizer has more than {IDS} ids")
        self.written = Table([b"%d%s" % (i, mark) for i in range(max(sizes)) for mark in (b",", b"|", b";", b"")])

    def encode_first(self, text: str, plain: bool) -> np.ndarray:
        """Ids of a space and the text. The quicker library splits alike where ``plain``."""
        if plain:
            return self.fast.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64)
        return np.array(self.first.encode(" " + text, add_special_tokens=False).ids, np.int64)

    def _whole(self, ids: list[np.ndarray], table: Table, expected: list[bytes]) -> np.ndarray:
        """Whether each text's tokens join to what was encoded."""
        joined = table.joined(np.concatenate([np.zeros(0, np.int64), *ids]))
        ends = np.cumsum([int(table.size[x].sum()) for x in ids])
        raw, out, begin = joined.tobytes(), [], 0
        for want, end in zip(expected, ends):
            out.append(raw[begin:end] == want)
            begin = end
        return np.array(out, bool)

    def align(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray]:
        """Rows of ``TEXTS`` for each text, and the distinct links: (text, pair, times), by text and pair."""
        given = [i for i, text in enumerate(texts) if text]
        expected = [b" " + texts[i].encode("utf-8", "surrogatepass") for i in given]
        first = [self.encode_first(texts[i], max(raw) <= PLAIN) for i, raw in zip(given, expected)]
        second = [np.array(x, np.int64) for x in self.second.encode([texts[i] for i in given], num_threads=1)]
        sound = self._whole(first, self.first_table, expected) & self._whole(second, self.second_table, expected)
        given, first, second = ([x for x, ok in zip(xs, sound) if ok] for xs in (given, first, second))
        rows: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        nothing = np.zeros(0, np.int64)
        if not given:
            return rows, nothing, nothing, nothing

        def tokens(ids: list[np.ndarray], table: Table) -> Tokens:
            return Tokens(np.concatenate(ids), np.concatenate([[0], np.cumsum([len(x) for x in ids])]), table.size)

        a, b, whole = tokens(first, self.first_table), tokens(second, self.second_table), np.array(given)
        drives_a = np.diff(a.at) <= np.diff(b.at)
        keys = []
        for chosen, flipped in ((np.flatnonzero(drives_a), False), (np.flatnonzero(~drives_a), True)):
            if not len(chosen):
                continue
            of_a, of_b = a.of(chosen), b.of(chosen)
            if flipped:
                text, link_b, link_a, group_b, group_a = aligned(of_b, of_a)
            else:
                text, link_a, link_b, group_a, group_b = aligned(of_a, of_b)
            keys.append(whole[chosen][text] * (1 << 32) + of_a.ids[link_a] * IDS + of_b.ids[link_b])
            links = np.bincount(text, minlength=len(chosen))
            for i, row in zip(whole[chosen].tolist(), self._rows(of_a, of_b, group_a, group_b, links)):
                rows[i] = row
        distinct, times = np.unique(np.concatenate(keys), return_counts=True)
        return rows, distinct >> 32, distinct & ((1 << 32) - 1), times

    def _rows(self, a: Tokens, b: Tokens, group_a: np.ndarray, group_b: np.ndarray, links: np.ndarray) -> Iterator[tuple]:
        """``TEXTS`` of aligned texts: the tokens of both lists put into one order, group by group."""
        groups = int(group_a[-1]) + 1
        size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        number = np.zeros(len(a.ids) + len(b.ids), np.int64)
        end_a = np.append(group_a[1:] != group_a[:-1], True)
        end_b = np.append(group_b[1:] != group_b[:-1], True)
        mark_b = np.where(end_b, 2, 0)
        mark_b[b.at[1:] - 1] = 3  # nothing after the last token of a text
        number[np.arange(len(a.ids)) + _exclusive(size_b)[group_a]] = a.ids * 4 + end_a
        number[np.arange(len(b.ids)) + np.cumsum(size_a)[group_b]] = b.ids * 4 + mark_b
        spelled = self.written.joined(number).tobytes()
        ends = np.cumsum(self.written.size[number])[(a.at + b.at)[1:] - 1].tolist()
        last = group_a[a.at[1:] - 1]
        n_groups = np.diff(np.concatenate([[-1], last])).tolist()
        begin = 0
        for n_a, n_b, n, n_links, end in zip(np.diff(a.at).tolist(), np.diff(b.at).tolist(), n_groups, links.tolist(), ends):
            yield n_a, n_b, n, n_links, hashlib.sha256(memoryview(spelled)[begin:end]).hexdigest()
            begin = end


def _bytes_of_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, others from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def _aligner(first_path: str, second_path: str) -> Aligner:
    return Aligner(first_path, second_path)


def _packed(code: np.ndarray, times: np.ndarray) -> bytes:
    """Codes of a text, rising, as differences, and how often each; compressed."""
    raw = np.diff(code, prepend=0).astype(np.uint32).tobytes() + times.astype(np.uint32).tobytes()
    return len(code).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(links: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(links[:4], "little")
    raw = np.frombuffer(pa.decompress(links[4:], decompressed_size=8 * size, codec="zstd", asbytes=True), np.uint32)
    return np.cumsum(raw[:size], dtype=np.int64), raw[size:].astype(np.int64)


class _Block:
    """Aligned texts until there are enough; then a row for each and one with the block's distinct pairs."""

    def __init__(self, number: int, kind: pa.DataType) -> None:
        self.number, self.kind, self.size = number, kind, 0
        self.ids: list[pa.Array] = []
        self.rows: list[tuple] = []
        self.text: list[np.ndarray] = []
        self.pair: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: pa.Array, rows: list[tuple], text: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        self.text.append((text + len(self.rows)).astype(np.int32))
        self.pair.append(pair.astype(np.uint32))
        self.times.append(times.astype(np.int32))
        self.ids.append(ids)
        self.rows.extend(rows)
        self.size += len(pair)

    def flushed(self) -> Iterator[pa.RecordBatch]:
        text, pair, times = (np.concatenate(x) for x in (self.text, self.pair, self.times))
        pairs, code, held = np.unique(pair, return_inverse=True, return_counts=True)
        often = np.argsort(-held, kind="stable")  # small codes for frequent pairs
        rank = np.empty(len(pairs), np.int64)
        rank[often] = np.arange(len(pairs))
        code = rank[code]
        at = np.searchsorted(text, np.arange(len(self.rows) + 1))
        links = []
        for low, high in zip(at[:-1].tolist(), at[1:].tolist()):
            order = np.argsort(code[low:high])
            links.append(_packed(code[low:high][order], times[low:high][order]))
        ids = pa.concat_arrays(self.ids)
        for low in range(0, len(ids), 1024):
            part, rows = slice(low, low + 1024), self.rows[low : low + 1024]
            yield self._batch(ids[part], rows, links[part], None, None)
        one = lambda x, kind: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind))
        yield self._batch(
            pa.nulls(1, self.kind), [(None,) * 5], [None], one(pairs[often].astype(np.int64), pa.int64()),
            one(held[often].astype(np.int32), pa.int32()),
        )

    def _batch(self, ids: pa.Array, rows: list[tuple], links: list, pairs: pa.Array | None, held: pa.Array | None) -> pa.RecordBatch:
        n_a, n_b, n_groups, n_links, digest = zip(*rows)
        size = len(rows)
        return pa.RecordBatch.from_arrays([
            pa.array([self.number] * size, pa.int64()), ids,
            *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
            pa.array(links, pa.binary()), pa.nulls(size, pa.list_(pa.int64())) if pairs is None else pairs,
            pa.nulls(size, pa.list_(pa.int32())) if held is None else held,
        ], ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "held"])


def align_tokenizers(documents: DataFrame, first_path: str, second_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row's text.

    ``first_path`` is a byte-level BPE file of the tokenizers library, ``second_path`` a sentencepiece model; both
    are read where the tasks run. Links are the pairs of tokens whose byte ranges overlap; a pair of
    ids counts the rows that hold it linked. ``n_best`` are the links whose pair counts most among those of its first id, ties
    included; ``count_sum`` adds the counts over all links. Null and empty texts, and texts that a tokenizer does
    not give back byte by byte, have zeros and an empty digest. Equal rows each count and each give a row; an empty table gives
    an empty result; other columns do not matter.
    """
    small_batches(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block, part, made = _aligner(first_path, second_path), None, TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column("doc_id")
            if block is None:
                block, made = _Block((part << 32) + made, ids.type), made + 1
            block.add(ids, *aligner.align(batch.column("text").to_pylist()))
            if block.size >= BLOCK_PAIRS:
                yield from block.flushed()
                block = None
        if block is not None and block.rows:
            yield from block.flushed()

    encoded = written(documents.select("doc_id", "text").mapInArrow(encode, ENCODED.format(kind)), "aligned")
    asked = encoded.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "held")).alias("code", "x"))
    asked = asked.select("block", "code", F.col("x.pairs").alias("pair"), F.col("x.held").alias("held"))
    counts = asked.groupBy("pair").agg(F.sum("held").alias("count")).withColumn("a", F.expr(f"pair div {IDS}"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = asked.join(counts, "pair").select(F.col("block").alias("asked_by"), "code", "count", "best")

    def totals(texts: pa.Table, answer: pa.Table) -> pa.Table:
        codes = answer["code"].to_numpy()
        count, best = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        count[codes], best[codes] = answer["count"].to_numpy(), answer["best"].to_numpy(zero_copy_only=False)
        n_best, count_sum = [], []
        for links in texts["links"].to_pylist():
            code, times = _unpacked(links)
            n_best.append(int(best[code] @ times))
            count_sum.append(int(count[code] @ times))
        out = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
        for name, values in (("n_best", n_best), ("count_sum", count_sum)):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out.append_column("groups_sha256", texts["groups_sha256"])

    texts = encoded.where("pairs IS NULL").drop("pairs", "held")
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(answers.groupBy("asked_by")).applyInArrow(totals, schema)
