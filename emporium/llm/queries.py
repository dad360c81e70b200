"""The opN_* queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import decontam, html_model, jaccard_join, kn_lm, licences, merkle, oracle, packing, quality, secrets, spelling, token_counts, token_store, toxicity
from emporium.llm.common import scratch, table


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, tokenizer_file(), end_id=2)
    return token_store.read_store(spark, path, tokenizer_file()).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), end_id=1, max_len=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_model.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.prefix_table(table(spark, sf_dir, "documents"), tokenizer_file(), limit=2048, keep_steps=False)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "limit_bytes")


def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.verdicts(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    held_out = F.coalesce(remainder == 2, F.lit(False))
    model = kn_lm.train(docs.where(~held_out), scratch(spark, "kn-model"))
    scored = kn_lm.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_licence_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licensed(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"), shortest=6, misspell=199)
    return spelling.variants(words.where("n >= 5"), ratio=5)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and whether a tampered copy of it still verifies."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lower = F.translate("text", UPPER, UPPER.lower())
    changed = F.when(tampered, F.unhex(merkle.leaf_of("doc_id", "source", "lang", "n_chars", lower)))
    manifest = merkle.build(table(spark, sf_dir, "documents").withColumn("changed", changed), carried=["changed"])
    leaf = F.coalesce(F.lower(F.hex("changed")), F.col("digest"))
    rows = merkle.proofs(manifest).select(
        "doc_id",
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(manifest.root).cast("string").alias("root"),
        merkle.proof_digest().alias("proof_sha256"),
        merkle.folded(leaf).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.scores(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_html_extraction": op4_html_extraction,
    "op5_token_counts": op5_token_counts,
    "op6_secret_scans": op6_secret_scans,
    "op7_quality_rules": op7_quality_rules,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_decontamination": op9_decontamination,
    "op10_licence_scans": op10_licence_scans,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_toxicity": op13_toxicity,
}

ORACLE: dict[str, str] = oracle.ORACLE
