"""Registered queries of this folder over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, counts, decontaminate, exact, html, lines, near, negatives, quality, spelling, syncmers, toxicity, warc

LEAST_QUALITY = 0.3
RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> tuple[str, str]:
    """Path of the rank file, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.PATTERN


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of 10 consecutive benchmark words."""
    hits = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.col("items").cast("array<string>"))
    return hits.select(
        "doc_id", "n_words", decontaminate.hit_words("spans").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"),
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines deleted from every document because a run of 50 words or more with them occurs earlier."""
    docs = table(spark, sf_dir, "documents")
    out = lines.deduplicate(docs)
    removed = F.aggregate(lines.runs_column(docs), F.lit(0).cast("bigint"), lambda total, run: total + run["b"] - run["a"])
    return out.select("doc_id", removed.alias("n_removed"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_chars_left"))


OP3_SQL = """
WITH rows AS (
    SELECT doc_id, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
words AS (SELECT doc_id, pos, line, trim(line, ' ' || chr(9) || chr(13)) AS bare, len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS w FROM rows),
texts AS (SELECT doc_id, list(bare ORDER BY pos) AS bares FROM words GROUP BY doc_id),
sums AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) - w AS before FROM words),
runs AS (
    SELECT DISTINCT doc_id, start, bares[start + 1 : last + 1] AS run FROM (
        SELECT doc_id, pos AS start, max(pos) OVER ahead AS last, sum(w) OVER ahead AS total FROM sums
        WINDOW ahead AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
        UNION ALL
        SELECT doc_id, min(pos) OVER back, pos, sum(w) OVER back FROM sums
        WINDOW back AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)
    ) JOIN texts USING (doc_id) WHERE total >= 50
),
later AS (SELECT doc_id, start, len(run) AS n FROM runs QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, start) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(start, start + n - 1)) AS pos FROM later),
left_over AS (
    SELECT s.doc_id, count(g.pos) AS n_removed, coalesce(string_agg(s.line, chr(10) ORDER BY s.pos) FILTER (WHERE g.pos IS NULL), '') AS text
    FROM sums s LEFT JOIN gone g USING (doc_id, pos) GROUP BY s.doc_id
)
SELECT doc_id, n_removed, sha256(text) AS text_sha256, length(text) AS n_chars_left FROM left_over
"""


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rank file, decoded again."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), *vocabulary())
    return bpe.decode(encoded, *vocabulary()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after personal data and secrets are masked, the latter from the trees of the former."""
    edits = counts.masking(table(spark, sf_dir, "documents"))
    trees = counts.build(edits, *vocabulary(), keep=("doc_id", "edits"))
    return counts.apply(trees, *vocabulary()).select(
        "doc_id", "n_edits", "n_tokens_before", "n_tokens", "n_chars_encoded", F.sha2("text", 256).alias("text_sha256")
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal text, and the row of each that stays."""
    return exact.mark(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as an ARC record, converted to WARC and read back."""
    archives = warc.convert(spark, warc.to_arc(table(spark, sf_dir, "pages"), version=2))
    return warc.read(spark, archives).select(
        F.col("key").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to_key").cast("bigint").alias("refers_to")
    )


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance of the label toxic for every document, learnt from labels that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85% of their 3-word shingles."""
    return near.mark(table(spark, sf_dir, "documents"), size=3, num=85, den=100)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chance of the label quality for every document, learnt from labels that are not held out."""
    scored = quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        F.col("id").alias("doc_id"), quality.held_out("id").alias("held_out"), "score", (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted")
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, by inner products of whole numbers."""
    rows = table(spark, sf_dir, "embeddings")
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = rows.where(whole).select("vec_id", label.alias("label"), vector.alias("vector"))
    return negatives.mine(rows, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
),
positives AS (SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.other_id AS positive_id, CAST(row_number() OVER ranked AS INTEGER) AS rank, n.other_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW ranked AS (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id)
QUALIFY row_number() OVER ranked <= 10
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard forms of all words of six letters and five occurrences or more."""
    return spelling.variants(table(spark, sf_dir, "documents"), noise=199)


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return syncmers.edited(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_extraction, op2_decontamination, op3_line_dedup, op4_byte_bpe, op5_token_counts, op6_exact_dedup, op7_toxicity, op8_near_dedup, op9_quality, op10_warc, op11_hard_negatives, op12_spelling_variants, op13_fingerprints)
}
SQL: dict[str, str] = {"op3_line_dedup": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op11_hard_negatives": OP11_SQL}
