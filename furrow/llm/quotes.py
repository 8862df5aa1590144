"""Conversations in reply order, from quoted passages, with SQL functions only.

Lines that begin with ``>`` are quotes; the number of marks is their level. Consecutive lines of one
level are a passage. A quoted passage is cut into units: windows of four normalised words, or the whole of a
shorter one. Units are hashed and joined with those that messages of the same conversation wrote
themselves (windows, and whole lines, sentences and passages), and a passage comes from a message that wrote all
its units, so a reply may quote a part of a message or join its paragraphs. A message replies to the latest
earlier message that one of its first-level quotes comes from. Deeper levels link the quoted messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.llm.common import written
from furrow.operators import ordinal
from furrow.sources.shared import fresh_path

# one level of ">" marks with blanks between them, at the start of a line
_MARKS = r"^[ \t]*((?:>[ \t]?)*)"


WORDS = 4  # of a window


def _normal(text: Column) -> Column:
    """Lower case, all white space and punctuation as one blank."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\p{Punct}]+", " "))


def _windows(text: str) -> Column:
    """Hashes of all windows of words of a normalised text; none where it has fewer words."""
    window = ", ".join(f"w[i + {k}]" for k in range(WORDS))
    return F.expr(
        f"transform(array(split({text}, ' ')), w -> CASE WHEN size(w) >= {WORDS} THEN "
        f"transform(sequence(0, size(w) - {WORDS}), i -> xxhash64({window})) ELSE array() END)[0]"
    )


def _whole(normal: Column) -> Column:
    """The hash of a text as a whole, another one than that of the same words as a window."""
    return F.xxhash64(F.lit("whole"), normal)


def _own_text(text: str) -> Column:
    """The lines without quote marks."""
    return F.expr(
        rf"trim(BOTH '\n' FROM array_join(filter(split({text}, '\n'), x -> NOT regexp_like(x, '^[ \\t]*>')), '\n'))"
    )


def passages(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, _key, level, at (place of the first line), text and normalised text of each passage.

    A passage is a maximal run of lines of one quote level without empty lines between them. Null
    texts have none. A passage that is empty after normalising links nothing.
    """
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 1), r"[ \t]", "")).alias("level"),
        F.regexp_replace(line, _MARKS, "").alias("line"),
    ))
    rows = conversations.select("conv_id", "turn", "_key", lines.alias("l")).where("l is not null")
    # a passage begins where the level changes or an empty line lies before
    begins = F.expr(
        "filter(transform(l, (x, i) -> if(trim(x.line) = '', -1, if(i = 0, i, "
        "if(l[i - 1].level <> x.level OR trim(l[i - 1].line) = '', i, -1)))), i -> i >= 0)"
    )
    rows = rows.withColumn("b", begins).where("size(b) > 0")
    each = rows.select("conv_id", "turn", "_key", F.posexplode(F.expr(
        "transform(b, (s, i) -> struct(s AS at, l[s].level AS level, "
        "filter(slice(l, s + 1, coalesce(get(b, i + 1), size(l)) - s), x -> trim(x.line) <> '') AS part))"
    )).alias("n", "p")).select(
        "conv_id", "turn", "_key", "p.at", "p.level", F.expr("array_join(transform(p.part, x -> x.line), '\\n')").alias("text")
    )
    return each.withColumn("normal", _normal(F.col("text")))


def _sources(quoted: DataFrame, rows: DataFrame) -> DataFrame:
    """``quoted`` (conv_id, turn, _key, at, level, normal) with ``from_turn``, the latest earlier turn that wrote all its units.

    Equal quotes of a conversation are looked up once. Of a quote's units the one that the fewest messages wrote
    names the candidates, which are then checked for all the others. Who wrote a quote and who quotes it meet in
    one order by turn, so many writers and many quoters of one passage are not paired.
    """
    units = F.array_distinct(F.when(F.size("windows") > 0, F.col("windows")).otherwise(F.array(_whole(F.col("normal")))))
    quoted = quoted.where("normal <> ''").withColumn("windows", _windows("normal")).withColumn("units", F.array_sort(units))
    quoted = written(quoted.withColumn("content", F.xxhash64("units")).drop("windows", "normal"), "quotes")
    asked = quoted.select("conv_id", "content", "units").dropDuplicates(["conv_id", "content"])
    asked = written(asked.select("conv_id", "content", F.size("units").alias("n"), F.explode("units").alias("unit")), "quoted-units")

    own = rows.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi").withColumn("own", _own_text("text"))
    own = own.withColumn("normal", _normal(F.col("own"))).withColumn("windows", _windows("normal"))
    pieces = F.concat(F.split("own", r"\n"), F.split("own", r"[.!?\n]+"), F.split("own", r"\n[ \t]*\n"), F.array("own"))
    own = own.withColumn("wholes", F.transform(F.array_distinct(F.transform(pieces, _normal)), _whole))
    wrote = own.select("conv_id", "turn", "_key", F.explode(F.array_distinct(F.concat("windows", "wholes"))).alias("unit"))
    wrote = written(wrote.join(asked.select("conv_id", "unit").distinct(), ["conv_id", "unit"], "left_semi"), "written-units")

    writers = wrote.groupBy("conv_id", "unit").agg(F.count("*").alias("writers"))
    rare = asked.join(writers, ["conv_id", "unit"], "left").groupBy("conv_id", "content", "n").agg(
        F.min(F.struct(F.coalesce("writers", F.lit(0)).alias("writers"), "unit")).alias("rare")
    ).where("rare.writers > 0").select("conv_id", "content", "n", F.col("rare.unit").alias("unit"))
    candidates = wrote.join(rare, ["conv_id", "unit"]).select("conv_id", "content", "turn", "_key")
    whole = candidates.join(asked, ["conv_id", "content"]).join(wrote, ["conv_id", "turn", "_key", "unit"]).groupBy(
        "conv_id", "content", "turn", "_key", "n"
    ).agg(F.count("*").alias("found")).where("found = n")
    events = quoted.drop("units").withColumn("wrote", F.lit(None).cast("long")).unionByName(
        whole.select("conv_id", "content", "turn", F.col("turn").alias("wrote")).distinct(), allowMissingColumns=True
    )
    earlier = Window.partitionBy("conv_id", "content").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    return events.withColumn("from_turn", F.max("wrote").over(earlier)).where("wrote IS NULL").drop("wrote", "content")


def link_quotes(conversations: DataFrame) -> DataFrame:
    """One row per row of ``conversations`` (conv_id, turn, role, text), with its own words and its place.

    conv_id, turn, role, text (without quotes, null stays null), n_quotes (quoted passages), n_linked
    (those found in an earlier message), parent (turn replied to; the message before if no
    quote is found, null for the first), linked (whether the parent comes from a quote), depth (replies above it) and place (from 0, in reply
    order: by depth, then turn, so a message comes before all replies to it).

    Turns order a conversation; equal turns of one conversation are told apart by role and text, and
    rows that repeat in full get equal results. Null conv_ids or turns make no links: such rows have
    no parent, depth 0 and their place by turn, nulls first. Further columns are ignored. An empty table gives an
    empty result.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text",
        F.xxhash64(F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))).alias("_key"),
    )
    messages = rows.where("conv_id is not null and turn is not null").dropDuplicates(["conv_id", "turn", "_key"])
    parts = written(passages(messages), "passages")
    quoted = parts.where("level > 0").select("conv_id", "turn", "_key", "at", "level", "normal")
    empty = quoted.where("normal = ''").drop("normal").withColumn("from_turn", F.lit(None).cast("long"))
    found = _sources(quoted, messages).unionByName(empty)
    links = found.groupBy("conv_id", "turn", "_key").agg(
        F.count("*").alias("n_quotes"), F.count("from_turn").alias("n_linked"),
        F.max(F.when(F.col("level") == 1, F.col("from_turn"))).alias("near"), F.max("from_turn").alias("any"),
    )
    text = F.when(F.col("text").isNotNull(), _own_text("text"))
    joined = rows.join(links, ["conv_id", "turn", "_key"], "left")
    turns = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    # the turn before, from one order of all turns: no conversation has to fit in a task
    turns = ordinal.with_ordinal(written(turns, "turns"), ["conv_id", "turn"], fresh_path(conversations.sparkSession, "llm-turn-order"))
    last = turns.select("conv_id", (F.col("ordinal") + 1).alias("ordinal"), F.col("turn").alias("before"))
    before = turns.join(last, ["conv_id", "ordinal"], "left").select("conv_id", "turn", "before")
    before = joined.join(before, ["conv_id", "turn"], "left").withColumns({
        "parent": F.coalesce("near", "any", "before"), "linked": F.coalesce("near", "any").isNotNull(),
    })
    known = written(before.select(
        "conv_id", "turn", "role", text.alias("text"), "_key", F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "parent", "linked",
    ), "replies")
    deep = known.join(_depths(known), ["conv_id", "turn"], "left").withColumn("depth", F.coalesce("depth", F.lit(0)).cast("long"))
    order = ["conv_id", "depth", "turn", "_key", "_twin"]
    # rows that repeat in full need numbers for a unique order
    deep = deep.withColumn("_twin", F.monotonically_increasing_id())
    numbered = ordinal.with_ordinal(written(deep, "depths"), order, fresh_path(conversations.sparkSession, "llm-reply-order"))
    first = numbered.groupBy("conv_id").agg(F.min("ordinal").alias("_first"))
    placed = numbered.alias("n").join(first.alias("f"), F.col("n.conv_id").eqNullSafe(F.col("f.conv_id")))
    return placed.select(
        "n.conv_id", "n.turn", "n.role", "n.text", "n.n_quotes", "n.n_linked", "n.parent", "n.linked", "n.depth",
        (F.col("n.ordinal") - F.col("f._first")).alias("place"),
    )


def _depths(known: DataFrame) -> DataFrame:
    """conv_id, turn and the number of replies above a turn, by doubling: each round jumps twice as far.

    A turn that has reached the top is set aside and only looked up from then on.
    """
    jumps = known.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.max("parent").alias("up"))
    jumps = written(jumps.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "jumps")
    done, going = jumps.where("up is null"), jumps.where("up is not null")
    while going.limit(1).count():
        above = done.unionByName(going).select(
            "conv_id", F.col("turn").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth")
        )
        jumps = written(going.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "turn", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth")
        ), "jumps")
        done, going = done.unionByName(jumps.where("up is null")), jumps.where("up is not null")
    return done.select("conv_id", "turn", "depth")
