"""Near-duplicate groups against all pairs, and connected components."""

import random
import re

import pytest
from furrow.llm import near_dedup
from furrow.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text, size):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_force(rows, size, percent):
    """doc_id -> (set size, smallest reachable id), for rows with ids."""
    sets = [shingle_set(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def result(spark, rows, size=4, percent=80):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r for r in near_dedup.near_duplicates(frame, size, percent).collect()}


def test_groups_equal_all_pairs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 20, 60, 120]))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(text)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    rng.shuffle(rows)
    expected = brute_force(rows, 4, 80)
    found = result(spark, rows)
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == expected
    assert all(r.kept == (k == r.component_id) for k, r in found.items())


def test_one_large_group_of_near_copies(spark):
    """Members that are not alike pairwise hang together through others."""
    rng = random.Random(5)
    text = [f"v{i}" for i in range(90)]
    rows = []
    for i in range(150):
        copy = list(text)
        for _ in range(rng.randrange(0, 7)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(copy)))
    expected = brute_force(rows, 4, 80)
    found = result(spark, rows)
    assert {k: (r.n_shingles, r.component_id) for k, r in found.items()} == expected


def test_edges(spark):
    same = "one two three four five six"
    rows = [(5, same), (2, same.upper()), (9, None), (8, ""), (7, " \n\t"), (3, "one two"), (4, "ONE  two"), (None, same), (5, same)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS node", "2 AS kept", "3 AS n_shingles")
    found = near_dedup.near_duplicates(frame, 4, 80).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == 9
    assert by_id[2].component_id == 2 and by_id[2].kept and by_id[5].component_id == 2 and not by_id[5].kept
    assert by_id[None].component_id == 2 and not by_id[None].kept
    assert by_id[3].component_id == 3 and by_id[4].component_id == 3 and by_id[3].n_shingles == 1
    for alone in (7, 8, 9):
        assert by_id[alone].component_id == alone and by_id[alone].kept and by_id[alone].n_shingles == 0
    assert result(spark, []) == {}


def test_one_of_each_group_keeps_columns(spark):
    rows = [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (2, "a b c d e f g", "y"), (3, None, "z"), (4, "q r s t u v", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = near_dedup.one_of_each_group(frame)
    assert kept.columns == ["doc_id", "text", "node"]
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 4]


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51), (51, 52), (7, 7)]])
def test_components(spark, links):
    frame = spark.createDataFrame(links, "a long, b long")
    label = {}
    for a, b in links:
        if a != b:
            label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    assert {r.node: r.label for r in connected_components(frame).collect()} == label


def test_helper_names_and_very_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(60000))
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, None), (4, ""), (5, long), (6, long + " end")]
    names = ["_id", "_key", "row", "own_id", "own_key", "node", "kept", "doc", "key"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"doc_id AS `{n}`" for n in names))
    found = near_dedup.one_of_each_group(frame)
    assert found.columns == frame.columns
    assert sorted(set(tuple(r[2:]) for r in found.collect())) == [(i,) * len(names) for i in (1, 3, 4, 5)]
