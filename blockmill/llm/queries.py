"""The registered queries of the operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from blockmill.llm import (
    bpe, classifier, fim, html_extract, imatch, mixing as M, pieces, quality_rules as Q, sharding, simhash as S,
    substring_dedup as R, warc, whitening,
)
from blockmill.llm.mixing_sql import mix_sql
from blockmill.session import scratch_path

# The tree of the test tables: four domains by source number, then language, then source.
DOMAINS = {"web": 4, "news": 3, "books": 2, "forums": 1}
LANGS = {"en": 4, "de": 2, "fr": 2, "es": 1}
SOURCES = {f"src{n}": 1 + n % 3 for n in range(20)}
SOURCE_DOMAINS = {f"src{n}": list(DOMAINS)[n % len(DOMAINS)] for n in range(20)}
MIX_PERCENT, MIX_EPOCHS, MIX_SEED = 80, 2, 1234


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix_plan(percent: int = MIX_PERCENT) -> M.MixPlan:
    pairs = [F.lit(x) for pair in SOURCE_DOMAINS.items() for x in pair]
    known = F.element_at(F.create_map(*pairs), F.coalesce("source", F.lit("")))
    return M.MixPlan(
        F.coalesce(known, F.lit("web")), DOMAINS, LANGS, SOURCES,
        budget_percent=percent, max_epochs=MIX_EPOCHS, seed=MIX_SEED,
    )


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.select_mix(table(spark, sf_dir, "documents"), mix_plan()).select(
        "doc_id", F.col("__domain").alias("domain"), "lang", "source", F.col("__epoch").alias("epoch"),
        F.col("__tokens").alias("n_tokens"), F.col("__taken").alias("taken"),
    )


_DOMAIN_SQL = "CASE source " + " ".join(f"WHEN '{s}' THEN '{d}'" for s, d in SOURCE_DOMAINS.items()) + " ELSE 'web' END"


def op2_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints_with_next(table(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = S.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", S.hex_fingerprint(groups["fp"]).alias("fingerprint"), "component_id")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.removal_digests(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archives into the shared folder and reads them back."""
    folder = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_articles(table(spark, sf_dir, "pages"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.quality_rules(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of nearly equal bytes."""
    return sharding.assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, sf_dir, "embeddings"))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_decode(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    text = fim.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(text, 256).alias("restored_sha256"),
    )


# The same cuts by the tokens themselves.
FIM_SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents
), drawn AS (
  SELECT doc_id, text, t, len(t) AS n, ('0x' || h[1:8])::BIGINT % (len(t) + 1) AS a,
    ('0x' || h[9:16])::BIGINT % (len(t) + 1) AS b, ('0x' || h[17:24])::BIGINT % 100 AS c,
    ('0x' || h[25:32])::BIGINT % 100 AS d
  FROM cut
), parts AS (
  SELECT doc_id, n, text,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 50
      THEN 'plain' WHEN d < 80 THEN 'spm' ELSE 'psm' END AS form,
    array_to_string(t[1:least(a, b)], '') AS prefix,
    array_to_string(t[least(a, b) + 1:greatest(a, b)], '') AS middle,
    array_to_string(t[greatest(a, b) + 1:], '') AS suffix
  FROM drawn
)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text
    WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_classifier": op2_classifier,
    "op3_imatch": op3_imatch,
    "op4_simhash": op4_simhash,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_bpe": op6_bpe,
    "op7_warc": op7_warc,
    "op8_html_extraction": op8_html_extraction,
    "op9_quality_rules": op9_quality_rules,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_pieces": op12_pieces,
    "op13_fill_in_middle": op13_fill_in_middle,
}
ORACLE: dict[str, str] = {
    "op1_mixing": mix_sql(_DOMAIN_SQL, DOMAINS, LANGS, SOURCES, MIX_PERCENT, MIX_EPOCHS, MIX_SEED),
    "op13_fill_in_middle": FIM_SQL,
}
