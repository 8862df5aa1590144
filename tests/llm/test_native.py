"""Operators in SQL functions only: line windows, syncmers, quotes; each against plain Python."""

import hashlib
import random
import struct

import xxhash
from furrow.llm import line_dedup, quotes, syncmers


def lines_by_hand(rows, window=3):
    """Texts after removing later windows, for rows in (doc_id) order with distinct ids."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        if text is None:
            out[doc_id] = None
            continue
        lines, gone = text.split("\n"), set()
        for i in range(len(lines) - window + 1):
            key = tuple(line.strip(" ") for line in lines[i : i + window])
            if not any(key):
                continue
            if key in seen:
                gone |= set(range(i, i + window))
            seen.add(key)
        out[doc_id] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    return out


def test_line_windows(spark):
    rng = random.Random(2)
    rows = [(i * 2, "\n".join(rng.choice("abcd") * 2 for _ in range(rng.randrange(0, 12)))) for i in range(40)]
    rows += [(1001, None), (1002, ""), (1003, "x\ny"), (1004, "p\n p\np \np\np")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "7 AS n_lines", "doc_id AS c")
    found = line_dedup.deduplicate_lines(frame).collect()
    assert {r.doc_id: r.text for r in found} == lines_by_hand(rows)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1001].n_lines == 0 and by_id[1002].n_lines == 0 and by_id[1003].n_removed == 0
    assert by_id[1004].n_removed > 0


def test_blank_lines_and_helper_names_stay(spark):
    rows = [(1, "a\n\n\n\nb"), (2, "c\n\n\n \nd"), (3, "\n\n\n\n"), (4, "x\ny\nz\n\n\n\nx\ny\nz")]
    names = ["_id", "_key", "_lines", "_starts", "_gone", "_kept", "id", "key", "row", "lines", "starts", "h", "at", "cuts", "gone", "window", "left"]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"doc_id AS `{n}`" for n in names))
    found = line_dedup.deduplicate_lines(frame)
    assert found.columns == ["doc_id", "text", *names, "n_lines", "n_removed"]
    assert all(set(r[2:-2]) == {r.doc_id} for r in found.collect())
    assert {r.doc_id: r.text for r in found.collect()} == lines_by_hand(rows)


def test_lines_of_very_long_texts(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(30000))) for i in range(2)]
    rows.append((9, "k" * 2_000_000 + "\nq\nq\nq\nq"))
    found = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in found.collect()} == lines_by_hand(rows)


def test_line_windows_with_repeated_and_null_ids(spark):
    text = "a\nb\nc\nd"
    rows = [(None, text), (None, None), (3, text), (3, text), (9, text)]
    found = line_dedup.deduplicate_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in found) == [("3", text), ("3", text), ("9", ""), ("None", ""), ("None", "None")]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert line_dedup.deduplicate_lines(empty).count() == 0


def _hash(data, seed=42):
    return xxhash.xxh64_intdigest(data, seed=seed)


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def anchors_by_hand(text):
    """Smallest distinct (hash, place) of the closed syncmers, as the operator packs them."""
    if not text:
        return []
    s, inner = syncmers.S, syncmers.INNER
    h = [_signed(_hash(text[i : i + s].encode("utf-32-be"))) for i in range(len(text) - s + 1)]
    best = {}
    for i in range(len(h) - inner + 1):
        part = h[i : i + inner]
        if min(part) == part[0] or (min(part) == part[-1]):
            first = _hash(struct.pack("<q", part[0]))
            value = _hash(struct.pack("<q", part[-1]), seed=first) & 0x7FFFFFFF
            best.setdefault(value, i)
    if not best:
        return [(_hash(text.encode()) & 0x7FFFFFFF) << 32]
    return [value << 32 | place for value, place in sorted(best.items())]


def alike_by_hand(one, two):
    a, b = {x >> 32: x & 0xFFFFFFFF for x in one}, {x >> 32: x & 0xFFFFFFFF for x in two}
    both = sorted(set(a) | set(b))
    if not both:
        return 1.0
    apart = [a[x] - b[x] for x in both if x in a and x in b]
    return max((apart.count(x) for x in apart), default=0) / len(both)


def test_syncmers(spark):
    rng = random.Random(8)
    letters = "abcdefgh éßü\n"
    texts = ["".join(rng.choice(letters) for _ in range(n)) for n in (0, 1, 5, 19, 20, 31, 79, 80, 81, 200, 900, 3000, 3001)]
    texts += [texts[-1][:2000] + "tail", "ab" * 400, "a" * 500, texts[9], None]
    rows = [(i * 7, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _id", "2 AS fingerprint")
    found = {r.doc_id: r for r in syncmers.fingerprints(frame.repartition(3)).collect()}
    plain = [t or "" for t in texts]
    for i, text in enumerate(plain):
        row, after = found[i * 7], plain[(i + 1) % len(plain)]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        own, changed = anchors_by_hand(text), anchors_by_hand(edited)
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert [int(x, 16) for x in row.fingerprint.split()] == own
        assert [int(x, 16) for x in row.edited_fingerprint.split()] == changed
        assert row.near_edited == alike_by_hand(own, changed) and row.near_next == alike_by_hand(own, anchors_by_hand(after))


def test_short_texts_have_fingerprints_of_their_own(spark):
    """Around the length of a k-mer, where a text may have no anchor; unlike texts are not alike."""
    rng = random.Random(21)
    texts = ["".join(rng.choice("abcdefghij klmn") for _ in range(n)) for n in [*range(1, 30)] * 4]
    found = syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r in found:
        text, after = texts[r.doc_id], texts[(r.doc_id + 1) % len(texts)]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        own, changed = anchors_by_hand(text), anchors_by_hand(edited)
        assert r.fingerprint and [int(x, 16) for x in r.fingerprint.split()] == own
        assert [int(x, 16) for x in r.edited_fingerprint.split()] == changed
        assert r.near_next == alike_by_hand(own, anchors_by_hand(after)) and (r.near_next < 1 or text == after)


def test_helper_names_of_syncmers_do_not_clash(spark):
    names = ["_id", "_key", "_text", "_bucket", "_a", "_f", "_n", "_place", "_b", "_e", "row"]
    frame = spark.createDataFrame([(1, "some words here " * 5), (2, "other")], "doc_id long, text string")
    plain = syncmers.fingerprints(frame).collect()
    assert sorted(syncmers.fingerprints(frame.selectExpr("*", *(f"'x' AS `{n}`" for n in names))).collect()) == sorted(plain)


def test_syncmers_beyond_the_basic_plane_and_odd_ids(spark):
    text = "\U0001f600 some words \U00010348 and more of them " * 12
    rows = [(None, text), (None, "b" * 50), (4, text), (4, text), (2, "")]
    found = syncmers.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    row = next(r for r in found if r.doc_id == 4)
    assert [int(x, 16) for x in row.fingerprint.split()] == anchors_by_hand(text)
    assert len(found) == 5 and len({r.fingerprint for r in found if r.n_chars == len(text)}) == 1
    single = syncmers.fingerprints(spark.createDataFrame([(1, "x y z " * 30)], "doc_id long, text string")).first()
    assert single.near_next == 1.0
    assert syncmers.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_anchor_of_a_long_text_is_left_out(spark):
    """One passage changed in the middle of long texts, and one passage shared with a long next text."""
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    words = [word() for _ in range(2000)]
    other = [*words[:1000], *(word() for _ in range(12)), *words[1012:]]
    unlike = [word() for _ in range(2000)] + words[100:150]
    texts = [" ".join(x) for x in (words, other, unlike, words)]
    found = syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    one, two, three, four = sorted(found, key=lambda r: r.doc_id)
    assert one.fingerprint == four.fingerprint != two.fingerprint and 0.9 < one.near_next < 1
    assert 0 < three.near_next < 0.1 and len(three.fingerprint.split()) > 2000


def test_buckets_join_up_across_borders(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "ROWS_PER_BUCKET", 7)
    rows = [(i * i, f"text number {i} " * 9) for i in range(60)]
    found = syncmers.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r._bucket for r in found}) > 5
    texts = dict(zip([i * i for i in range(60)], [rows[(i + 1) % 60][1] for i in range(60)]))
    assert {r._id: r._next for r in found} == texts


def test_quotes(spark):
    rows = [
        (1, 0, "a", "Where is the key?\nI lost it."), (1, 1, "b", "And the map, where is it?"),
        (1, 2, "a", "> where is the KEY\n> I lost it\nIn the drawer."), (1, 3, "b", "> > Where is the key?\n> > I lost it.\n> In the drawer.\nThanks!"),
        (1, 4, "c", "> nobody wrote this\nHm."), (2, 0, "a", "> Where is the key? I lost it.\nno link across"), (2, 1, "b", None),
        (None, 0, "a", "> x"), (3, None, "a", "y"), (1, 0, "a", "Where is the key?\nI lost it."), (4, 5, "a", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS depth", "2 AS parent")
    found = quotes.link_quotes(frame).collect()
    assert len(found) == len(rows)
    by = {(r.conv_id, r.turn): r for r in found}
    assert [by[1, t].parent for t in range(5)] == [None, 0, 0, 2, 3]
    assert [by[1, t].depth for t in range(5)] == [0, 1, 1, 2, 3]
    assert by[1, 2].text == "In the drawer." and by[1, 3].text == "Thanks!" and by[1, 3].n_quotes == 2 and by[1, 3].n_linked == 2
    assert by[1, 4].n_linked == 0 and by[2, 0].parent is None and by[2, 0].n_linked == 0
    assert by[2, 1].text is None and by[2, 1].parent == 0 and by[4, 5].text == ""
    assert by[None, 0].parent is None and by[3, None].depth == 0
    places = sorted((r.place, r.turn) for r in found if r.conv_id == 1)
    assert [p for p, _ in places] == list(range(6)) and places[-1][1] == 4
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert quotes.link_quotes(empty).count() == 0


def quotes_by_hand(rows):
    """(n_quotes, n_linked, parent, linked) of each message, by comparing every quote with every earlier message."""
    import re
    import string

    def normal(text):
        return re.sub(r"[\s%s]+" % re.escape(string.punctuation), " ", text.lower()).strip()

    def units_of(words):
        return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}

    def split(text):
        own, parts, before = [], [], (0, True)
        for line in text.split("\n"):
            marks = re.match(r"[ \t]*((?:>[ \t]?)*)", line)
            level, rest = marks[1].count(">"), line[marks.end():]
            if not re.match(r"[ \t]*>", line):
                own.append(line)
            blank = not rest.strip(" ")
            if not blank and level and (level == before[0] and not before[1]):
                parts[-1][1].append(rest)
            elif not blank and level:
                parts.append((level, [rest]))
            before = (level, blank)
        return "\n".join(own).strip("\n"), parts

    out, messages = {}, {}
    for conv, turn, text in sorted(rows):
        own, parts = split(text)
        near, any_, n, linked = [], [], 0, 0
        for level, lines in parts:
            n += 1
            quote = normal("\n".join(lines))
            if not quote:
                continue
            words, source = quote.split(" "), None
            for earlier in sorted(messages.get(conv, {}), reverse=True):
                wrote = messages[conv][earlier]
                if len(words) >= 4:
                    there = units_of(words) <= units_of(normal(wrote).split(" "))
                else:
                    pieces = wrote.split("\n") + re.split(r"[.!?\n]+", wrote) + re.split(r"\n[ \t]*\n", wrote) + [wrote]
                    there = quote in {normal(x) for x in pieces}
                if there:
                    source = earlier
                    break
            if source is not None:
                linked += 1
                any_.append(source)
                if level == 1:
                    near.append(source)
        before = max(messages.get(conv, {}), default=None)
        found = max(near, default=max(any_, default=None))
        out[conv, turn] = (n, linked, before if found is None else found, found is not None)
        messages.setdefault(conv, {})[turn] = own
    return out


def threads(seed, conversations=12, turns=14):
    """Generated threads whose messages quote whole, trimmed, joined and nested parts of earlier ones; and their true parents."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    sentence = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 12))).capitalize() + rng.choice(".?!")
    rows, truth = [], {}
    for conv in range(conversations):
        own = []
        for turn in range(turns):
            blocks = [[sentence() for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 3))]
            head = []
            if turn and rng.random() < 0.8:
                target = rng.randrange(turn)
                parts = own[target]
                kind = rng.choice(["whole", "line", "trimmed", "joined", "nested"])
                lines = [line for block in parts for line in block]
                if kind == "line":
                    lines = [rng.choice(lines)]
                elif kind == "trimmed":
                    words = " ".join(lines).split(" ")
                    start = rng.randrange(max(1, len(words) - 6))
                    lines = [" ".join(words[start : start + 9])]
                elif kind == "whole":
                    lines = rng.choice(parts)
                if len(" ".join(lines).split(" ")) >= 4 or kind in ("whole", "line"):
                    truth[conv, turn] = target
                mark = rng.choice(["> ", ">", "  > ", "\t> "])
                head = [mark + line.upper() for line in lines]
                if kind == "nested" and target:
                    head = ["> > " + own[rng.randrange(target)][0][0], *head]
            own.append(blocks)
            rows.append((conv, turn, "\n".join([*head, "", "\n\n".join("\n".join(b) for b in blocks)])))
    return rows, truth


def test_partial_quotes_equal_brute_force_and_find_the_parents(spark):
    rows, truth = threads(3)
    frame = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): r for r in quotes.link_quotes(frame.repartition(4)).collect()}
    expected = quotes_by_hand(rows)
    assert {k: (r.n_quotes, r.n_linked, r.parent, r.linked) for k, r in found.items()} == expected
    right = [found[k].linked and found[k].parent == target for k, target in truth.items()]
    assert len(right) > 80 and sum(right) / len(right) >= 0.9
    assert not any(">" in r.text for r in found.values())


def test_one_line_of_a_message_and_many_quoters_of_one(spark):
    rows = [(1, 0, "a", "First line here.\nSecond line there now."), (1, 1, "b", "hm"), (1, 2, "a", "> Second line there now.\nyes"),
            (1, 3, "b", "> yes\nshort quote"), (1, 4, "a", "> line here second line\nacross lines"), (1, 5, "b", "> line there first\nno")]
    rows += [(2, t, "a", "the same words again and again" if t % 2 else "> the same words again and again\nok") for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): r for r in quotes.link_quotes(frame).collect()}
    assert [(found[1, t].parent, found[1, t].linked) for t in range(6)] == [
        (None, False), (0, False), (0, True), (2, True), (0, True), (4, False)]
    assert all(found[2, t].parent == (t - 1 if t else None) and found[2, t].linked == (t % 2 == 0 and t > 0) for t in range(300))
