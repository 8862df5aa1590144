"""Line deduplication by overlapping windows of three lines, with SQL functions only.

Every three consecutive lines of a text are hashed. Of each window that occurs more than once in all
texts, the first occurrence (smallest doc_id, then smallest place) stays; the later ones are
removed. Windows overlap, so the removed lines of a text are the union of what its later windows cover.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import packed, unpacked, written

WINDOW = 3


def deduplicate_lines(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``documents`` (doc_id, text, ...) with the new ``text``, and n_lines and n_removed.

    Lines end at a line feed; their case and inner white space count, white space at their ends does
    not. A window of blank lines only is no repetition. A text of fewer lines than a window is left as it is, and so are null and empty texts. Equal ids (or null ones, which come
    last) are told apart by a hash of the text; rows that repeat in full count as one occurrence,
    so they stay or lose lines together. Columns named n_lines or n_removed are replaced; others may have any name.
    An empty table gives an empty result.
    """
    names = [name for name in documents.columns if name not in ("n_lines", "n_removed")]
    rows = packed(documents).select(
        "row", F.split("row.text", "\n").alias("lines"), F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("key"),
        F.col("row.doc_id").cast("long").alias("id"),
    )
    hashed = rows.where(F.size("lines") >= window).select(
        "id", "key", F.transform(F.transform("lines", lambda line: F.trim(line)), lambda line: F.xxhash64(line)).alias("h")
    )
    blank = " AND ".join(f"h[i + {k}] = xxhash64('')" for k in range(window))
    spans = hashed.select("id", "key", F.posexplode(F.expr(
        f"transform(slice(h, 1, size(h) - {window - 1}), (x, i) -> CASE WHEN NOT ({blank}) THEN xxhash64("
        + ", ".join(["x", *(f"h[i + {k}]" for k in range(1, window))]) + ") END)"
    )).alias("at", "window")).where("window IS NOT NULL")
    spans = written(spans, "line-windows")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "at")
    repeated = spans.groupBy("window").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    repeated = written(repeated.select("window", "first"), "line-repeats")
    later = spans.join(repeated, "window").where(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")) & (F.col("at") == F.col("first.at")))
    )
    covered = written(later.groupBy("id", "key").agg(F.sort_array(F.collect_set("at")).alias("starts")), "line-covered")
    # the texts are always dealt out by id, whatever the size of the other side
    covered = covered.select(F.col("id").alias("of_id"), F.col("key").alias("of_key"), "starts")
    joined = rows.join(covered.hint("merge"), F.col("id").eqNullSafe(F.col("of_id")) & (F.col("key") == F.col("of_key")), "left")
    # the removed lines as stretches: one begins where a window does not reach the next one, and ends before the next begins
    joined = joined.withColumn("cuts", F.expr(
        f"filter(transform(starts, (s, i) -> if(i = 0 OR s > starts[i - 1] + {window}, i, -1)), i -> i >= 0)"
    ))
    joined = joined.withColumn("gone", F.expr(
        f"transform(cuts, (c, k) -> struct(starts[c] AS low, starts[coalesce(get(cuts, k + 1), size(starts)) - 1] + {window} AS high))"
    ))
    # what lies between the stretches stays
    stay = F.expr(
        "flatten(transform(sequence(0, size(gone)), k -> slice(lines, if(k = 0, 0, gone[k - 1].high) + 1, "
        "if(k = size(gone), size(lines), gone[k].low) - if(k = 0, 0, gone[k - 1].high))))"
    )
    kept = F.col("starts").isNull()
    return unpacked(
        joined.withColumns({
            "left": F.when(~kept, F.array_join(stay, "\n")),
            "removed": F.when(kept, 0).otherwise(F.expr("aggregate(gone, 0, (n, g) -> n + g.high - g.low)")).cast("long"),
        }),
        names,
        text=F.when(kept, F.col("row.text")).otherwise(F.col("left")),
        n_lines=F.when(F.col("row.text").isNull() | (F.col("row.text") == ""), 0).otherwise(F.size("lines")).cast("long"),
        n_removed=F.col("removed"),
    )
