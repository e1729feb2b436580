"""Registered queries of the package on the given tables, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    best_fit,
    fingerprints,
    licenses,
    pii,
    quality,
    resampling,
    secret_scan,
    simhash_pivots,
    site_trees,
    tiling,
    token_trees,
    warc,
)
from tidemark.session import new_path
from tidemark.sources.tables import table

PACKING_TOKENIZER = "byte_bpe_50k.json"
PACKING_RANKS = "byte_bpe_50k.tiktoken"  # the same vocabulary
PIECE_TOKENIZER = "piece_bpe_32k.model"


def tokenizer_path(name: str = PACKING_TOKENIZER) -> str:
    """Place of a public vocabulary file, which is the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    archive = warc.archived(table(spark, folder, "pages"))
    return archive.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_simhash_pivots(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash_pivots.near_duplicates(table(spark, folder, "documents"))
    fingerprint = simhash_pivots.hex16(F.col("fp")).alias("fingerprint")
    return groups.select("doc_id", fingerprint, "component_id")


def op3_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    ranks = tokenizer_path(PACKING_RANKS)
    return best_fit.pack(best_fit.token_pieces(docs, tokenizer_path(), ranks=ranks))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    rows = fingerprints.edited_fingerprints(table(spark, folder, "documents"))
    rows = fingerprints.with_near(rows)
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash_pivots.hex16(F.col("fp")).alias("fingerprint"),
        simhash_pivots.hex16(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        "n_near",
    )


def op4_near_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs that ``n_near`` of ``op4_fingerprints`` counts; its rows name the documents of ``found``."""
    docs = table(spark, folder, "documents")
    path = new_path(spark, "near")
    fingerprints.write_near(fingerprints.edited_fingerprints(docs), path)
    return spark.read.parquet(f"{path}/pairs").select(
        simhash_pivots.hex16(F.col("fp")).alias("fingerprint"),
        simhash_pivots.hex16(F.col("found")).alias("found"),
        "bits",
        "n",
    )


def op5_string_tiling(spark: SparkSession, folder: str) -> DataFrame:
    return tiling.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents"))


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classified(table(spark, folder, "documents"), table(spark, folder, "labels"))


def three_edits() -> Column:
    """Edits made from a row itself: a repeat inside, an insertion in the middle, a cut at the end.

    Places count in the text as the edits before have left it.
    """
    text = F.coalesce("text", F.lit(""))
    n = F.length(text).cast("bigint")
    quarter, half = F.floor(n / 4), F.floor(n / 2)

    def edit(start: Column, end: Column, replacement: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), replacement.alias("replacement"))

    return F.array(
        edit(quarter, quarter + F.least(n, F.lit(20)), F.substring(text, 1, 24)),
        edit(half, half, F.concat(F.lit(" "), F.coalesce("source", F.lit("")), F.lit(" "))),
        edit(n - F.floor(n / 16), n + 64, F.lit("")),
    )


def op8_token_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Counts after three edits of every document, applied to stored trees.

    The trees are written first; the edits are made from and applied to what is
    read back. NULL text is empty, every row has a row, repeated ones too; edits
    out of place are treated as ``token_trees.apply_edits`` says.
    """
    docs = table(spark, folder, "documents")
    state = token_trees.stored_trees(docs, tokenizer_path(), "source")
    edited = state.withColumn("edits", three_edits())
    return token_trees.apply_edits(edited, tokenizer_path(), with_state=False)


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secrets(table(spark, folder, "documents"))


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Documents drawn towards the benchmark's words; odd rows as ``resampling.resampled`` says."""
    docs, target = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return resampling.resampled(docs, target).drop("n_words")


def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Alignment of a byte-level and a piece vocabulary; odd rows as ``alignment.aligned`` says."""
    paths = map(tokenizer_path, (PACKING_TOKENIZER, PIECE_TOKENIZER, PACKING_RANKS))
    return alignment.aligned(table(spark, folder, "documents"), *paths)


def op13_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page; odd rows as ``site_trees.main_texts`` says."""
    return site_trees.main_texts(table(spark, folder, "pages"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_simhash_pivots": op2_simhash_pivots,
    "op3_best_fit": op3_best_fit,
    "op4_fingerprints": op4_fingerprints,
    "op4_near_pairs": op4_near_pairs,
    "op5_string_tiling": op5_string_tiling,
    "op6_licenses": op6_licenses,
    "op7_quality": op7_quality,
    "op8_token_trees": op8_token_trees,
    "op9_pii": op9_pii,
    "op10_secrets": op10_secrets,
    "op11_resampling": op11_resampling,
    "op12_alignment": op12_alignment,
    "op13_html": op13_html,
    "pipeline": pipeline,
}

#: SHA-1 in base 32: five hexadecimal digits give four digits of five bits.
_BASE32 = """(
    SELECT string_agg(
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((five >> (15 - 5 * k)) & 31)::INT + 1, 1), ''
        ORDER BY g, k)
    FROM (SELECT g, k, (
            (strpos('0123456789abcdef', substr(h, 5 * g + 1, 1)) - 1) * 65536
          + (strpos('0123456789abcdef', substr(h, 5 * g + 2, 1)) - 1) * 4096
          + (strpos('0123456789abcdef', substr(h, 5 * g + 3, 1)) - 1) * 256
          + (strpos('0123456789abcdef', substr(h, 5 * g + 4, 1)) - 1) * 16
          + (strpos('0123456789abcdef', substr(h, 5 * g + 5, 1)) - 1))::BIGINT AS five
        FROM range(8) a(g), range(4) b(k)))"""

SQL: dict[str, str] = {
    "op1_warc": f"""
        WITH hashed AS (
            SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
        grouped AS (
            SELECT *, max(page_id) OVER (PARTITION BY body) AS greatest FROM hashed)
        SELECT page_id,
               strlen(body) AS payload_bytes,
               {_BASE32} AS payload_digest,
               CASE WHEN page_id = greatest OR greatest IS NULL THEN 'response' ELSE 'revisit' END
                   AS record_type,
               CASE WHEN page_id IS DISTINCT FROM greatest THEN greatest END AS refers_to
        FROM grouped""",
}
