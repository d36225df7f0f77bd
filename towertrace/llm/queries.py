"""The registered queries of the subpackage and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, bpe, decontaminate, exact, extraction, lines, neighbours, quality, simhash, spelling, suffix, toxicity, urls
from .labelled import held_out
from .shared import read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages"), min_pages=2)


#: (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge(read_table(spark, sf_dir, "pages"), rules)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.decisions(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.with_digests(bpe.bpe_round_trip(read_table(spark, sf_dir, "documents"), vocabulary_path()))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.decisions(read_table(spark, sf_dir, "documents"), edits=lines.EDITS, min_chars=1)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_groups(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.with_digests(suffix.remove_repeats(read_table(spark, sf_dir, "documents")))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item found in it."""
    return decontaminate.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), short_gaps=True)


def _scores(frame: DataFrame, threshold: float) -> DataFrame:
    return frame.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
                        (F.col("__score") >= threshold).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return _scores(toxicity.scored(docs.select("doc_id", "text"), model), toxicity.THRESHOLD)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return _scores(quality.scored(docs.select("doc_id", "text"), model), quality.THRESHOLD)


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.aligned(read_table(spark, sf_dir, "documents"), vocabulary_path(),
                             public_tokenizers.path("piece_bpe_32k.model"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), min_chars=6, min_count=5, ratio=5, every=199)


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_url_filters": op2_url_filters,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe": op4_bpe,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_neighbours": op11_neighbours,
    "op12_alignment": op12_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op2_url_filters": urls.oracle(URL_RULES),
    "op13_spelling_variants": spelling.ORACLE_SQL,
    "op3_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       h AS text_sha256
FROM d
WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
}
