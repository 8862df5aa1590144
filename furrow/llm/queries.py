"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm import alignment, bpe, class_lm, decontaminate, language, line_dedup, near_dedup
from furrow.llm import permutation_index, phrases, pii, quotes, syncmers, toxicity
from furrow.llm.common import fold, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def vocabulary() -> tuple[str, str]:
    """Where the public rank file lies, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def held_out(parts: int = 4):
    """Rows that nothing is learned from; a null id has no remainder and is not one of them."""
    return F.coalesce(fold(parts=parts) == 2, F.lit(False))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    classifier = toxicity.train(documents, table(spark, sf_dir, "labels"), toxicity.learnable())
    scored = toxicity.score(documents, classifier)
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.deduplicate_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    prototypes = language.learn(documents, fold() != 2)
    found = language.identify(documents.select("doc_id", "text"), prototypes)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    tables, counts, tokens, types = class_lm.train(documents, F.coalesce(fold(parts=7) != 2, F.lit(True)), every=True)
    scored = class_lm.score(documents, tables, counts, tokens, types)
    return scored.select(
        "doc_id", held_out(7).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), *vocabulary())


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"), pii.train())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    first, second = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align_tokenizers(table(spark, sf_dir, "documents"), first, second)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_syncmers": op3_syncmers,
    "op4_line_dedup": op4_line_dedup,
    "op5_language": op5_language,
    "op6_quotes": op6_quotes,
    "op7_class_lm": op7_class_lm,
    "op8_bpe": op8_bpe,
    "op9_personal_data": op9_personal_data,
    "op10_decontamination": op10_decontamination,
    "op11_neighbours": op11_neighbours,
    "op12_phrases": op12_phrases,
    "op13_alignment": op13_alignment,
}

SQL: dict[str, str] = {
    "op12_phrases": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, doc_id,
                unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\n\x0b\f\r]')) AS piece
            FROM documents),
        cut AS (
            SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS words FROM pieces),
        starts AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM cut WHERE len(words) > 0),
        grams AS (
            SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase,
                array_to_string(words[i:i + k - 2], ' ') AS front, array_to_string(words[i + 1:i + k - 1], ' ') AS back,
                words[i] AS head, words[i + k - 1] AS tail
            FROM starts, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(words)),
        f AS (
            SELECT lang, k, phrase, any_value(front) AS front, any_value(back) AS back, any_value(head) AS head,
                any_value(tail) AS tail, CAST(count(*) AS HUGEINT) AS f
            FROM grams GROUP BY lang, k, phrase),
        sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        cuts AS (
            SELECT p.lang, p.k, p.phrase, p.f AS a, 1 AS part, x.f AS l, y.f AS r FROM f p
            JOIN f x ON x.lang = p.lang AND x.k = 1 AND x.phrase = p.head
            JOIN f y ON y.lang = p.lang AND y.k = p.k - 1 AND y.phrase = p.back WHERE p.k > 1 AND p.f >= 10
            UNION ALL
            SELECT p.lang, p.k, p.phrase, p.f, 2, x.f, y.f FROM f p
            JOIN f x ON x.lang = p.lang AND x.k = 2 AND x.phrase = p.front
            JOIN f y ON y.lang = p.lang AND y.k = 1 AND y.phrase = p.tail WHERE p.k = 3 AND p.f >= 10),
        scored AS (SELECT *, (1000000 * a * a) // (l * r) AS score FROM cuts),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, k, phrase ORDER BY score, part) = 1),
        longer AS (
            SELECT lang, part, max(f) AS f FROM (
                SELECT lang, front AS part, f FROM f WHERE k = 3 AND f >= 10
                UNION ALL SELECT lang, back, f FROM f WHERE k = 3 AND f >= 10) GROUP BY lang, part),
        left_over AS (
            SELECT lowest.* FROM lowest LEFT JOIN longer ON longer.lang = lowest.lang AND longer.part = lowest.phrase AND k = 2
            WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
        SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
            phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
        FROM left_over JOIN sizes USING (lang)
        QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
}
