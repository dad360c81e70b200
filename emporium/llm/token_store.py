"""Token-id files: one zstandard frame per document, a shared dictionary.

Layout under ``path``:

* ``dictionary``: one row, the dictionary and its hash;
* ``blocks``: rows in ascending id order.  A block holds up to 4096 documents
  or 4 MiB of frames: the dictionary's hash, the frames end to end, and an
  index of (id, frame offset, frame length, tokens) per document.  ``part`` and
  ``seq`` give the order, ``part_start`` the ids of the part before the block.

Parquet statistics on ``first_id``/``last_id`` lead a reader to the one block
that holds a document, the index to its frame; only that frame is decompressed.
Spark's commit protocol makes the write safe against retries and lost executors.

Defined results: a null or empty text holds the end id alone; rows of a null id
come first; rows of one id keep a stable order (by a hash of the text).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm.common import batch_rows, id_and_text, slices
from emporium.llm.wordbpe import encoder

BLOCKS = "part int, seq long, part_start long, first_id long, last_id long, n_docs long, n_tokens long, dict_hash long, index binary, frames binary"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"
INDEX = np.dtype([("id", "<i8"), ("null", "u1"), ("offset", "<u4"), ("length", "<u4"), ("tokens", "<u4")])
BLOCK_DOCS, BLOCK_BYTES = 4096, 4 << 20
DICT_DOCS, DICT_CHARS, DICT_BYTES = 2000, 20_000, 64 << 10


def train_dictionary(docs: DataFrame, tokenizer_path: str, n_docs: int = DICT_DOCS) -> bytes:
    """A dictionary from the serialized ids of at most ``n_docs`` documents,
    picked by a hash (of each, the first 20,000 characters).  It only decides
    how small the files get.  Too little data gives no dictionary."""
    share = int(1e6 * min(1.0, 2 * n_docs / max(1, docs.count()))) + 1
    picked = docs.where((F.length("text") > 0) & (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share))
    rows = picked.select(F.substring("text", 1, DICT_CHARS).alias("text")).limit(n_docs).collect()
    enc = encoder(tokenizer_path)
    samples = [ids.tobytes() for ids in enc.ids([r["text"].encode() for r in rows])]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_hash(dictionary: bytes) -> int:
    return xxhash.xxh3_64_intdigest(dictionary) >> 1


def _zdict(dictionary: bytes):
    return {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    level: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every document, append ``end_id`` and write the files.

    The texts are dealt into id ranges once (a hash of the text parts rows of
    one id), so no task holds more than its range."""
    docs = id_and_text(docs, id_col, text_col)
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer_path)
    mark = dictionary_hash(dictionary)
    spark.createDataFrame([(mark, bytearray(dictionary))], "dict_hash long, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        pack = zstandard.ZstdCompressor(level=level, write_content_size=True, **_zdict(dictionary)).compress
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        index, frames, size = [], [], 0

        def block() -> pa.RecordBatch:
            table = np.array(index, INDEX)
            given = [i for i, null, *_ in index if not null]
            n_tokens = int(table["tokens"].sum(dtype=np.int64))
            row = {"part": part, "seq": seq, "part_start": before, "first_id": min(given, default=None), "last_id": max(given, default=None), "n_docs": len(index), "n_tokens": n_tokens, "dict_hash": mark, "index": table.tobytes(), "frames": b"".join(frames)}
            return pa.RecordBatch.from_pylist([row], schema=ARROW_BLOCKS)

        for batch in slices(batches, 1000):
            own, texts = batch_rows(batch, "doc_id", "text")
            for doc, found in zip(own, enc.ids(texts), strict=True):
                ids = np.append(found, enc.dtype.type(end_id))
                frame = pack(ids.tobytes())
                index.append((doc or 0, doc is None, size, len(frame), len(ids)))
                frames.append(frame)
                size += len(frame)
                if len(index) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                    made = block()
                    yield made
                    seq, before = seq + 1, before + made.column("n_tokens")[0].as_py()
                    index, frames, size = [], [], 0
        if index:
            yield block()

    order = [F.col("doc_id"), F.xxhash64("text")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks")


ARROW_BLOCKS = pa.schema(
    [("part", pa.int32())]
    + [(c, pa.int64()) for c in ("seq", "part_start", "first_id", "last_id", "n_docs", "n_tokens", "dict_hash")]
    + [("index", pa.binary()), ("frames", pa.binary())]
)


def _open(spark: SparkSession, path: str, tokenizer_path: str) -> tuple[bytes, np.dtype, DataFrame]:
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])
    return dictionary, encoder(tokenizer_path).dtype, spark.read.schema(BLOCKS).parquet(f"{path}/blocks")


def _unpack(frame: bytes, unpack, dtype: np.dtype) -> np.ndarray:
    return np.frombuffer(unpack(frame), dtype).astype("<u4")


def read_store(spark: SparkSession, path: str, tokenizer_path: str) -> DataFrame:
    """All documents: id, ids of all documents before it, token count, ids as
    little-endian 32-bit integers.  The starts need one number per part, which
    the driver sums up (parts, not documents)."""
    dictionary, dtype, blocks = _open(spark, path, tokenizer_path)
    mark = dictionary_hash(dictionary)
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    starts, total = {}, 0
    for row in sorted(sums, key=lambda r: r["part"]):
        starts[row["part"]] = total
        total += row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor(**_zdict(dictionary)).decompress
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            if row["dict_hash"] != mark:
                raise ValueError("block written with another dictionary")
            index, frames = np.frombuffer(row["index"], INDEX), row["frames"]
            ids = [_unpack(frames[x["offset"] : int(x["offset"]) + int(x["length"])], unpack, dtype) for x in index]
            counts = index["tokens"].astype(np.int64)
            if [len(x) for x in ids] != counts.tolist():
                raise ValueError("block and index differ")
            begin = np.cumsum(counts) - counts + starts[row["part"]] + row["part_start"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(index["id"], mask=index["null"].astype(bool)), pa.array(begin), pa.array(counts), pa.array([x.tobytes() for x in ids], pa.binary())],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

    return blocks.select("part", "part_start", "dict_hash", "index", "frames").mapInArrow(run, DOCUMENTS)


def read_document(spark: SparkSession, path: str, tokenizer_path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of one document (of each row with that id), from its block alone."""
    dictionary, dtype, blocks = _open(spark, path, tokenizer_path)
    unpack = zstandard.ZstdDecompressor(**_zdict(dictionary)).decompress
    found = []
    for row in blocks.where((F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id)).orderBy("part", "seq").select("index", "frames").collect():
        index = np.frombuffer(row["index"], INDEX)
        for x in index[(index["id"] == doc_id) & (index["null"] == 0)]:
            found.append(_unpack(bytes(row["frames"][x["offset"] : int(x["offset"]) + int(x["length"])]), unpack, dtype))
    return found
