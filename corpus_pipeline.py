"""The training-data pipeline over ``documents``.

``STAGES`` are applied in order; each stage's rows are written as Parquet to
the shared folder and read again as the next one's documents.  All but the last
return the columns of their input.

Rows of a null id are kept by the stages that find documents by id (they can be
linked to nothing); a null or empty text is rejected by the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from emporium.llm import decontam, jaccard_join, packing, quality, secrets
from emporium.llm.common import IdFilter, stored, table
from emporium.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood-ratio verdict.  The
    raw multinomial is that of the stage's own documents."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, model).where("__verdict.kept").drop("__verdict")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, 0.8): the one
    of the smallest id, once.  A node is an id with one of its texts (a 64-bit
    hash of both), so unrelated texts of one id stay.  Only documents that may
    go, or that a copy is of, are shuffled; all others stay where they are read."""
    words = F.when(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.col("text"))  # texts without words are equal
    nodes = docs.withColumn("__node", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", words)))
    found = jaccard_join.classes(nodes, k=5, num=80, den=100, id_col="__node", rounds=2, longs=16).where("doc_id is not null")
    rows = found.groupBy(F.col("doc_id").alias("__node")).agg(F.count(F.lit(1)).alias("__rows"), F.min("component_id").alias("__component"))
    copies = stored(rows.where("__rows > 1 or __node <> __component").select("__node", "__component"), "pipeline-copies")
    group = copies.unionByName(copies.select(F.col("__component").alias("__node"), "__component")).distinct()
    may = IdFilter(group, "__node")
    marked = nodes.withColumn("__odd", F.col("__node").isNotNull() & may.may_hold("__node"))
    named = marked.where("__odd").select("__node", "doc_id").distinct().join(group, "__node")
    first = named.groupBy("__component").agg(F.min(F.struct("doc_id", "__node")).alias("x")).select(F.col("x.__node").alias("__first"))
    odd = group.join(first, F.col("__node") == F.col("__first"), "left").select(F.col("__node").alias("__id"), F.col("__first").isNotNull().alias("__stays"))
    odd = stored(odd, "pipeline-odd")
    plain = marked.where("not __odd").select(docs.columns)
    looked_at = marked.where("__odd").join(odd, F.col("__node") == F.col("__id"), "left").where("coalesce(__stays, true)")
    once = looked_at.withColumn("__nth", F.row_number().over(W.partitionBy("__node").orderBy("__node"))).where("__nth = 1").select(docs.columns)
    return plain.unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.  Each row is judged by its own text
    (a 64-bit hash of id and text names it), so a clean text stays next to one of
    the same id that goes, and a text without an id can go as well."""
    rows = docs.withColumn("__row", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(0), F.coalesce("text", F.lit(""))))
    leaks = decontam.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col="__row")
    found = stored(leaks.select(F.col("doc_id").alias("__leak")).distinct(), "pipeline-leaks")
    return rows.join(found, F.col("__row") == F.col("__leak"), "left_anti").select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with its secrets replaced by a mark."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left, and the digest of their ids."""
    pieces = packing.pack(docs, tokenizer_file(), end_id=1, max_len=2048)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", hide_secrets),
    ("packing", pack),
]

# Token ids come from a tokenizer library and the quality verdict from hashed
# features, which SQL cannot express; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
