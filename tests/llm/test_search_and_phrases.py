"""Permutation index, phrases and alignment of tokenizers against brute force."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import oracle
import public_tokenizers
import pytest
from furrow.llm import alignment, permutation_index, phrases, queries
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

FIRST, SECOND = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


# ---- permutation index


def nearest_by_hand(vectors, is_query, k):
    out = {}
    for q, x in vectors.items():
        if is_query(q):
            far = sorted((math.dist(x, y), i) for i, y in vectors.items() if i != q)
            out[q] = far[:k]
    return out


def vector_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, nearest int, shard string, `rank` int")


def test_small_tables_are_searched_whole(spark):
    random.seed(5)
    rows = [(i, [random.gauss(0, 1) for _ in range(6)], 1, "x", 2) for i in range(150)]
    rows += [(200, rows[7][1], 1, "x", 2), (201, rows[7][1], 1, "x", 2), rows[3]]
    bad = [
        (300, None, 1, "x", 2), (301, [], 1, "x", 2), (302, [0.0] * 6, 1, "x", 2), (303, [1.0, None] * 3, 1, "x", 2),
        (305, [float("nan")] + [1.0] * 5, 1, "x", 2), (310, [float("inf")] * 6, 1, "x", 2), (None, [1.0] * 6, 1, "x", 2),
        (320, [1.0, 2.0], 1, "x", 2),
    ]
    frame = vector_frame(spark, rows + bad)
    stored = {r.vec_id: tuple(r.embedding) for r in vector_frame(spark, rows).collect()}
    found = permutation_index.nearest_neighbours(frame, F.col("vec_id") % 5 == 0, k=4).collect()
    expected = nearest_by_hand(stored, lambda i: i % 5 == 0, 4)
    assert {(r.query_id, r.rank): (r.vec_id, pytest.approx(r.score)) for r in found} == {
        (q, n): (i, d) for q, best in expected.items() for n, (d, i) in enumerate(best, 1)
    }
    assert all(r.score == 0 and r.vec_id in (7, 201) for r in found if r.query_id == 200 and r.rank <= 2)


def test_least_vector_of_one_id_counts_and_few_candidates_are_all_given(spark):
    rows = [(0, [1.0, 0.0], 1, "", 1), (1, [3.0, 0.0], 1, "", 1), (1, [2.0, 9.0], 1, "", 1)]
    found = permutation_index.nearest_neighbours(vector_frame(spark, rows), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1)] and found[0].score == math.dist((1, 0), (2, 9))


def test_no_vectors_no_neighbours(spark):
    frame = vector_frame(spark, [])
    found = permutation_index.nearest_neighbours(frame, F.col("vec_id") % 5 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.count() == 0


def test_footrule_of_inverted_files():
    rng = np.random.default_rng(1)
    nearest = np.array([rng.permutation(20)[:8] for _ in range(50)], np.uint8)
    files = permutation_index.InvertedFiles.of(nearest)
    for probed in (rng.permutation(20)[:5].astype(np.uint8) for _ in range(10)):
        places = [{int(p): j for j, p in enumerate(row)} for row in nearest]
        expected = [sum(abs(held.get(int(p), 8) - j) for j, p in enumerate(probed)) for held in places]
        assert files.footrule(probed).tolist() == expected


@pytest.mark.parametrize("blocks", [(8192, 8192), (700, 9)])
def test_recall_over_shards_and_blocks(spark, monkeypatch, blocks):
    monkeypatch.setattr(permutation_index, "SHARD", blocks[0])
    monkeypatch.setattr(permutation_index, "QUERY_BLOCK", blocks[1])
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    stored = {r.vec_id: tuple(r.embedding) for r in frame.collect()}
    found = permutation_index.nearest_neighbours(frame, F.col("vec_id") % 100 == 0).collect()
    expected = nearest_by_hand(stored, lambda i: i % 100 == 0, 10)
    got = defaultdict(set)
    for r in found:
        got[r.query_id].add(r.vec_id)
        assert r.score == pytest.approx(math.dist(stored[r.query_id], stored[r.vec_id]), abs=1e-12)
    hits = [len(got[q] & {i for _, i in best}) for q, best in expected.items()]
    assert sum(hits) / (10 * len(hits)) >= 0.95 and len(found) == 10 * len(hits)


# ---- phrases


def phrases_by_hand(rows, least, top):
    import re

    counts = defaultdict(Counter)
    for lang, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = tuple(re.findall("[^\x20\x09]+", piece))
            for k in (1, 2, 3):
                counts[lang or "und"].update(words[i : i + k] for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        n, ranked = sum(a for p, a in f.items() if len(p) == 1), []
        for p, a in candidates.items():
            if any(len(q) > len(p) and p in (q[:2], q[1:]) and 100 * b >= 50 * a for q, b in candidates.items()):
                continue
            cuts = [(math.floor(Fraction(1000000 * a * a, f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrase_rows(found):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in found.collect())


def invented(seed, size, lang):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "x", "Ölfeld", "näh", "a b", "q1", "İx", "zz"]
    marks = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r", "! ", "\x0b", "\x0c", ";x:"]
    return [(lang, "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randint(0, 40)))) for _ in range(size)]


@pytest.mark.parametrize("shard_words", [1 << 21, 40])
def test_phrases_equal_brute_force(spark, monkeypatch, shard_words):
    monkeypatch.setattr(phrases, "SHARD_WORDS", shard_words)
    rows = [*invented(1, 60, "en"), *invented(2, 40, None), *invented(3, 9, "und"), ("de", None), ("de", ""), ("de", " \t,."), ("fr", "a b a b")]
    rows += rows[:5]
    frame = spark.createDataFrame([(i, *row, 1, "z") for i, row in enumerate(rows)], "doc_id long, lang string, text string, w1 int, times string")
    assert phrase_rows(phrases.phrases(frame.repartition(3), least=4, top=30)) == phrases_by_hand(rows, 4, 30)


@pytest.mark.parametrize("block_rows", [1 << 18, 7, 1])
def test_a_shard_is_extended_in_blocks(monkeypatch, block_rows):
    """Blocks hold their rows and no more unless one word has more; together they give each pair once, in order."""
    monkeypatch.setattr(phrases, "BLOCK_ROWS", block_rows)
    rng = np.random.default_rng(4)
    sequence = np.concatenate([[0], rng.integers(0, 12, 300), [0]]).astype(np.int32)
    index = phrases.ShardIndex(sequence, 12)
    parts = list(index.blocks(phrases.BLOCK_ROWS))
    assert [w for part in parts for w in part.words[:, 0].tolist()] == list(range(1, 12))
    assert all(len(part.count) == 1 or part.count.sum() <= block_rows for part in parts)
    text, found = sequence.tolist(), Counter()
    for part in parts:
        pairs = index.left_pairs(part)
        owner, following, times = index.right_extensions(pairs)
        found.update({tuple(w): n for w, n in zip(pairs.words.tolist(), pairs.count.tolist())})
        found.update({(*pairs.words[o].tolist(), w): n for o, w, n in zip(owner.tolist(), following.tolist(), times.tolist())})
    expected = Counter(tuple(text[i : i + k]) for k in (2, 3) for i in range(len(text) - k + 1) if 0 not in text[i : i + k])
    assert found == expected


def test_one_very_long_text_and_no_text(spark):
    row = ("en", ", ".join("to be or not to be" for _ in range(60000)))
    frame = spark.createDataFrame([row], "lang string, text string")
    assert phrase_rows(phrases.phrases(frame)) == phrases_by_hand([row], 10, 2000)
    assert phrases.phrases(frame.limit(0)).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    a = 3_000_000_007
    row = spark.createDataFrame([(a, a + 11, a + 2)], "a long, l long, r long").select(phrases._quotient("a", "l", "r").alias("s")).first()
    assert row.s == 1000000 * a * a // ((a + 11) * (a + 2))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=60))
def test_intervals_stay_in_step(numbers):
    sequence = np.array([0, *numbers, 0], np.int32)
    index = phrases.ShardIndex(sequence, 5)
    text = sequence.tolist()
    counted = lambda k: Counter(
        tuple(text[i : i + k]) for i in range(len(text) - k + 1) if 0 not in text[i : i + k]
    )
    shown = lambda p: {tuple(w): n for w, n in zip(p.words.tolist(), p.count.tolist()) if n}
    pairs = index.extend_left(index.single())
    assert shown(index.single()) == counted(1) and shown(pairs) == counted(2) == shown(index.extend_right(index.single()))
    assert shown(index.extend_right(pairs)) == counted(3) == shown(index.extend_left(pairs))
    assert shown(index.extend_left(index.extend_right(index.single()))) == counted(3)
    quick = index.left_pairs()
    assert (quick.words == pairs.words).all() and (quick.mirror == pairs.mirror).all()


def test_phrases_match_sql(spark):
    sf = "/root/testdata/sf0.01"
    assert oracle.difference(oracle.connect(sf), queries.SQL["op12_phrases"], queries.op12_phrases(spark, sf)) is None


# ---- alignment


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(FIRST, SECOND)


def token_bytes():
    import json

    import sentencepiece

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown}
    for b in range(256):
        if b not in shown:
            byte[chr(256 + len(byte) - len(shown))] = b
    with open(FIRST, encoding="utf-8") as file:
        first = {i: bytes(byte[c] for c in piece) for piece, i in json.load(file)["model"]["vocab"].items() if not piece.startswith("<|end")}
    model = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    second = [
        bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces
    ]
    return first, second


def align_by_hand(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(FIRST)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=SECOND)
    bytes_a, bytes_b = token_bytes()
    docs = []
    for text in texts:
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        want = (" " + (text or "")).encode()
        if not text or b"".join(bytes_a[i] for i in a) != want or b"".join(bytes_b[i] for i in b) != want:
            docs.append(([], [], [], ""))
            continue
        spans = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(out)
        links, low = [], 0
        for s, e, i in spans[0]:
            while low < len(b) and spans[1][low][1] <= s:
                low += 1
            j = low
            while j < len(b) and spans[1][j][0] < e:
                links.append((i, spans[1][j][2]))
                j += 1
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, begin = [], 0
        for end in both:
            groups.append("|".join(",".join(str(i) for s, _, i in side if begin <= s < end) for side in spans))
            begin = end
        docs.append((a, b, links, ";".join(groups)))
    held = Counter(pair for doc in docs for pair in set(doc[2]))
    most = Counter()
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return [
        (len(a), len(b), groups.count(";") + bool(groups), len(links), sum(held[x] == most[x[0]] for x in links),
         sum(held[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "")
        for a, b, links, groups in docs
    ]


HARD = [
    "Hello, world!", "", None, "  two  spaces\n\n\nand lines\t", "<|endoftext|> and <s> </s> <unk>", "naïve Übergrößenträger œuvre",
    "日本語のテキスト and 한국어", "emoji 👩‍👩‍👧‍👦 flags 🇩🇪", "a▁b", "\x00nul", "12345678901234567890", "x", " ", "don't we'll I'M",
    "ﬁ ligature ½ ①", "é combining", "​zero width", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\r\n\r\n", "<0x41>",
    "same text", "same text", "word " * 3000, "unbrokenwordwithoutblanks" * 400,
]


@pytest.mark.parametrize("block_pairs", [1 << 23, 1])
def test_alignment_equals_brute_force(spark, monkeypatch, block_pairs):
    monkeypatch.setattr(alignment, "BLOCK_PAIRS", block_pairs)
    expected = align_by_hand(HARD)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(HARD)], "doc_id long, text string, pair string, block int")
    found = {r.doc_id: r for r in alignment.align_tokenizers(frame.repartition(3, "doc_id"), FIRST, SECOND).collect()}
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert [tuple(found[i][name] for name in names) for i in range(len(HARD))] == expected


def test_alignment_of_the_corpus(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    expected = align_by_hand([r.text for r in rows])
    found = {r.doc_id: r for r in queries.op13_alignment(spark, "/root/testdata/sf0.001").collect()}
    names = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert [tuple(found[r.doc_id][name] for name in names) for r in rows] == expected


def test_alignment_of_nothing_and_of_rows_without_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align_tokenizers(empty, FIRST, SECOND).count() == 0
    found = alignment.align_tokenizers(spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string"), FIRST, SECOND).collect()
    assert [(r.doc_id, r.n_a, r.count_sum) for r in found] == [(None, 2, 4)] * 2


def test_both_ways_to_encode_agree(aligner):
    random.seed(3)
    signs = [chr(c) for c in range(1, 0x240)] + list("   ''''tsremvd\n0129") * 12
    for _ in range(1500):
        text = "".join(random.choices(signs, k=random.randint(1, 60)))
        assert aligner.encode_first(text, True).tolist() == aligner.encode_first(text, False).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3000), max_size=80), st.lists(st.integers(0, 3000), max_size=400)), min_size=1, max_size=5))
def test_galloping_ranks(texts):
    shorter, longer, at, to = [], [], [0], [0]
    for i, (keys, values) in enumerate(texts):
        shorter += [x + 4000 * i for x in sorted(set(keys))]
        longer += [x + 4000 * i for x in sorted(set(values))]
        at.append(len(shorter))
        to.append(len(longer))
    at, to = np.array(at), np.array(to)
    found = alignment.ranks(np.array(shorter, np.int64), np.array(longer, np.int64), at, to)
    expected = [
        int(np.searchsorted(longer[to[i] : to[i + 1]], x)) + to[i] for i in range(len(texts)) for x in shorter[at[i] : at[i + 1]]
    ]
    assert found.tolist() == expected


def test_vocabulary_is_the_rank_file(aligner):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    assert aligner.fast._mergeable_ranks == ranks
