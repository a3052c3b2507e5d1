"""Token ids as compressed binary segments with short access to single documents.

File format: a Parquet table of segments, in ascending order of (part, segment). A segment holds the
ids of some documents that follow each other in doc_id order, every document compressed on its own
with one zstandard dictionary that all documents share, so a document is read by decompressing
nothing but itself. Columns:

* part, segment: place of the segment; n_tokens: ids in it.
* dictionary_hash: SHA-256 of the dictionary; the dictionary itself is in the table beside it.
* doc_ids: the segment's documents. token_counts, offsets: per document its number of ids and where
  its frame begins in payload (one more offset closes the last).
* payload: the frames. A frame holds the ids as little-endian unsigned integers of id_bytes bytes.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.texts import text_of
from ledgermill.llm.tokenizing import encoder, shared_tokenizer
from ledgermill.operators.joins import attach

SEGMENT_BYTES = 4 << 20
# The dictionary is fitted on at most so many documents of at most so many characters each.
SAMPLE_DOCUMENTS, SAMPLE_CHARACTERS = 2_000, 4_000
DICTIONARY_BYTES = 110 << 10
LEVEL = 3

_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("n_tokens", pa.int64()),
        ("dictionary_hash", pa.string()),
        ("id_bytes", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("token_counts", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
SEGMENT_SCHEMA = (
    "part int, segment int, n_tokens bigint, dictionary_hash string, id_bytes int, doc_ids array<bigint>, "
    "token_counts array<bigint>, offsets array<bigint>, payload binary"
)


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary for serialized id arrays.

    Too few or too uniform samples give no trained dictionary; the samples' own bytes then serve as
    one, which zstandard takes as raw content.
    """
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


@functools.lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared, write_content_size=True)


@functools.lru_cache(maxsize=4)
def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _sample(docs: DataFrame, content: str, version: str, dtype: np.dtype, end_id: int) -> list[bytes]:
    """Serialized ids of about SAMPLE_DOCUMENTS short documents, chosen by hash: no more ever reach the driver."""
    short = docs.filter(F.length("text") <= SAMPLE_CHARACTERS)
    share = int(min(1.0, SAMPLE_DOCUMENTS / max(1, docs.count())) * (1 << 30))
    chosen = short.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < share)
    texts = [row.text for row in chosen.select("text").limit(SAMPLE_DOCUMENTS).collect()]
    return [np.append(ids, end_id).astype(dtype).tobytes() for ids in encoder(content, version).ids(sorted(texts))]


def write_token_ids(docs: DataFrame, tokenizer_path: str, out_dir: str, end_id: int) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``), each document followed by ``end_id``.

    Texts move once, to their range of doc_ids; ids never move. Null texts are empty and give the end
    id alone; null doc_ids come first; rows that share a doc_id follow each other in the order of their
    texts; texts of any length are written whole. An empty table gives a table without segments. Other columns are not looked at.
    """
    spark = docs.sparkSession
    content, version = shared_tokenizer(spark, tokenizer_path)
    rows = docs.select("doc_id", text_of().alias("text"))
    wide = encoder(content.value, version).vocabulary_size > 1 << 16 or end_id >= 1 << 16
    dtype = np.dtype("<u4" if wide else "<u2")
    dictionary = train_dictionary(_sample(rows, content.value, version, dtype, end_id))
    dictionary_hash = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(dictionary_hash, bytearray(dictionary))], "dictionary_hash string, dictionary binary").coalesce(
        1
    ).write.parquet(f"{out_dir}/dictionary")
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICTIONARY_BYTES

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, compress = encoder(content.value, version), _compressor(shared.value).compress
        part, segment = TaskContext.get().partitionId(), 0
        doc_ids, counts, offsets, frames = [], [], [0], []

        def cut() -> pa.RecordBatch:
            row = {
                "part": part,
                "segment": segment,
                "n_tokens": sum(counts),
                "dictionary_hash": dictionary_hash,
                "id_bytes": dtype.itemsize,
                "doc_ids": doc_ids,
                "token_counts": counts,
                "offsets": offsets,
                "payload": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], _SEGMENTS)

        for batch in batches:
            arrays = known.ids(batch.column("text").to_pylist())
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), arrays, strict=True):
                frames.append(compress(np.append(ids, end_id).astype(dtype).tobytes()))
                doc_ids.append(doc_id)
                counts.append(len(ids) + 1)
                offsets.append(offsets[-1] + len(frames[-1]))
                if offsets[-1] >= SEGMENT_BYTES:
                    yield cut()
                    segment += 1
                    doc_ids, counts, offsets, frames = [], [], [0], []
        if doc_ids:
            yield cut()

    (
        rows.withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie", "text")
        .select("doc_id", "text")
        .mapInArrow(encode, SEGMENT_SCHEMA)
        .write.parquet(f"{out_dir}/segments")
    )


def read_token_ids(spark: SparkSession, out_dir: str) -> DataFrame:
    """What ``write_token_ids`` wrote: doc_id, start, n_tokens, ids (as unsigned 32-bit little-endian bytes).

    ``start`` counts the ids of all documents before it.
    """
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{out_dir}/segments")
    # Bounded by its writer: one dictionary of at most DICTIONARY_BYTES.
    dictionary = bytes(spark.read.parquet(f"{out_dir}/dictionary").first().dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    # One row per part, then one per segment of a part: sizes, never ids.
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before_part = parts.select(
        "part",
        F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "_before_part"
        ),
    )
    before_segment = F.coalesce(
        F.sum("n_tokens").over(
            Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    starts = (
        segments.select("part", "segment", "n_tokens")
        .withColumn("_before", before_segment)
        .join(before_part, "part")
        .select("part", "segment", (F.col("_before") + F.col("_before_part")).alias("start"))
    )
    placed = attach(segments, starts, {"part": "part", "segment": "segment"}, "inner")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompress = _decompressor(shared.value).decompress
        names = ("doc_ids", "token_counts", "offsets", "payload", "id_bytes", "start")
        for batch in batches:
            for n in range(batch.num_rows):
                doc_ids, counts, offsets, payload, width, start = (batch.column(c)[n].as_py() for c in names)
                frames = memoryview(payload)
                ids = [
                    np.frombuffer(decompress(frames[a:b]), f"<u{width}").astype("<u4").tobytes()
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                begin = start + np.cumsum([0, *counts[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(begin, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    columns = placed.select("doc_ids", "token_counts", "offsets", "payload", "id_bytes", "start")
    return columns.mapInArrow(decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def read_document(spark: SparkSession, out_dir: str, doc_id: int) -> list[list[int]]:
    """Ids of one document (of each row that has this doc_id), decompressing only its own frames."""
    dictionary = bytes(spark.read.parquet(f"{out_dir}/dictionary").first().dictionary)
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(f"{out_dir}/segments")
    place = F.explode(F.arrays_zip("doc_ids", F.slice("offsets", 1, F.size("doc_ids")).alias("a"), F.slice("offsets", 2, F.size("doc_ids")).alias("b")))
    frames = (
        segments.filter(F.array_contains("doc_ids", F.lit(doc_id).cast("bigint")))
        .select("part", "segment", "id_bytes", "payload", place.alias("p"))
        .filter(F.col("p.doc_ids") == doc_id)
        .selectExpr("part", "segment", "id_bytes", "p.a AS a", "substring(payload, int(p.a) + 1, int(p.b - p.a)) AS frame")
        .orderBy("part", "segment", "a")
    )
    decompress = _decompressor(dictionary).decompress
    return [np.frombuffer(decompress(bytes(r.frame)), f"<u{r.id_bytes}").tolist() for r in frames.toLocalIterator()]


def with_checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what ``read_token_ids`` gives."""
    return tokens.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


