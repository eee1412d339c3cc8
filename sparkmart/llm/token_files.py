"""Token-id output: documents in ascending id order as patched frame-of-reference segments.

``write_ids`` sorts the texts by id over range partitions, encodes each text in the
task that writes it and stores segments of about a million ids as binary values of a
Parquet folder, so Spark's own commit protocol decides what counts when a task runs
twice. ``read_ids`` gives the documents back with their place among all ids.

A segment is ``PFR1 | documents u4 | ids u8 | blocks u4 | has id u1[] | id i8[] |
length u4[] | block start u4[blocks + 1] | blocks``, little-endian; the blocks are
those of :mod:`frames_of_reference`.

* A null or empty text has the end id alone; a null id sorts before all others.
* Rows of the same id keep the order of (length, hash) of their texts; equal rows are
  told apart by nothing but their place.
* An empty table gives no segment. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import frames_of_reference as frames
from sparkmart.llm.tokens import default_path, encoder

SEGMENT_IDS = 1 << 20
_MAGIC, _HEAD = b"PFR1", struct.Struct("<4sIQI")
_SEGMENTS = "shard int, part int, shard_start long, n_docs long, n_ids long, segment binary"


def pack_segment(doc_ids: list[int | None], lengths: list[int], ids: bytes) -> bytes:
    starts, blocks = frames.encode(np.frombuffer(ids, "<u4"))
    return b"".join(
        (
            _HEAD.pack(_MAGIC, len(doc_ids), len(ids) // 4, len(starts) - 1),
            np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
            np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
            np.array(lengths, "<u4").tobytes(),
            starts.tobytes(),
            blocks,
        )
    )


class Segment:
    """A segment's tables; ids are decoded on demand, by way of the block index."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, blocks = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a segment of token ids")
        at, parts = _HEAD.size, []
        for kind, n in (("u1", docs), ("<i8", docs), ("<u4", docs), ("<u4", blocks + 1)):
            parts.append(np.frombuffer(data, kind, n, at))
            at += parts[-1].nbytes
        known, ids, self.lengths, self._starts = parts
        self.doc_ids = [int(i) if k else None for k, i in zip(known, ids)]
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths, dtype=np.int64)])
        self._blocks = data[at:]

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``start`` to before ``end`` of the segment, decoding only the blocks that hold them."""
        end = self.n_ids if end is None else end
        first = start // frames.BLOCK
        found = frames.decode(self._starts, self._blocks, first, -(-end // frames.BLOCK))
        return found[start - first * frames.BLOCK : end - first * frames.BLOCK]


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1) -> None:
    """Writes the ids of ``docs`` (doc_id, text), each document followed by ``end_id``."""
    tokenizer = tokenizer or default_path()
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer).each, None
        doc_ids, lengths, ids, held, part, start = [], [], [], 0, 0, 0

        def segment() -> pa.RecordBatch:
            row = (shard, part, start, len(doc_ids), held, pack_segment(doc_ids, lengths, b"".join(ids)))
            names = [f.split()[0] for f in _SEGMENTS.split(", ")]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            batch_ids, texts, shards = (c.to_pylist() for c in batch.columns)
            for doc_id, own, shard in zip(batch_ids, encode(texts), shards):
                own += end
                doc_ids.append(doc_id)
                lengths.append(len(own) // 4)
                ids.append(own)
                held += len(own) // 4
                if held >= SEGMENT_IDS:
                    yield segment()
                    part, start = part + 1, start + held
                    doc_ids, lengths, ids, held = [], [], [], 0
        if doc_ids:
            yield segment()

    order = (F.col("doc_id").asc_nulls_first(), F.length("text"), F.xxhash64("text"))
    ordered = (
        docs.select("doc_id", "text")
        # The row number splits ids and texts that fill more than a partition.
        .repartitionByRange(*order, F.monotonically_increasing_id())
        .sortWithinPartitions(*order)
        .withColumn("shard", F.spark_partition_id())
    )
    # The blocks are dense already.
    ordered.mapInArrow(segments, _SEGMENTS).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start: ids of all documents before it, ids: little-endian unsigned 32-bit integers)."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    # One row for each range partition of the write, 16 bytes each, whatever the number of documents.
    totals = segments.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_ids")).alias("total"))
    before = totals.select(
        "shard", F.expr("coalesce(sum(total) over (order by shard rows between unbounded preceding and 1 preceding), 0)").alias("before")
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "ids"]
        for batch in batches:
            for first, data in zip(*(c.to_pylist() for c in batch.columns)):
                segment = Segment(data)
                at, ids = segment.offsets, segment.ids().tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(at[:-1] + first, pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    names=names,
                )

    return (
        segments.join(F.broadcast(before), "shard")
        .select((F.col("before") + F.col("shard_start")).alias("first"), "segment")
        .mapInArrow(documents, "doc_id long, start long, ids binary")
    )
