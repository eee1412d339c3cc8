"""How filters interact: what each removes, alone, in every order and by its Shapley value.

Five filters judge whole texts. Four look at the text alone and become bits of a mask in the
one pass that reads the words. The fifth, an equal text under a smaller id, needs all texts; a
counting Bloom sketch spares most of them the shuffle:

* Every text has a 64-bit hash, a segment of the sketch and ``PROBES`` cells in it. Tasks count
  their cells in chunks; the partial sketches of a segment are added (they saturate, as only
  "two or more" matters). The sketch has ``CELLS`` cells per text, so it grows with the table.
* A text with a cell that was counted once is guaranteed unique. Only the others, all repeats
  and about one in a hundred unique texts, are shuffled whole: grouped by the full text, copies
  of a task already collapsed, for the least id of each text.
* A hash with one text among these hands its least id to all rows of the hash. Hashes that
  several different texts share are settled text by text.

Masks, joined with labels, become counts by part and mask: at most 32 rows a part, and all
numbers of all orders are sums of them.

The sketch is broadcast up to ``BROADCAST_BYTES``, some 170 million texts; a larger one is joined
by segment, where texts are shuffled once more.

* A null text counts as empty, a null part as the empty string.
* A null id counts as larger than all others. Equal rows are two documents; neither removes
  the other, as their ids are equal.
* A document has a label if any of its label rows says so. An empty table gives no row.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import record_batches, written

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT, SYMBOLS = 100, 80, 10, b"#$%&*|"

CELLS, PROBES, SEGMENT_BITS = 12, 3, 14
BROADCAST_BYTES = 256 << 20
_SEGMENT = 1 << SEGMENT_BITS
_CHUNK = 1 << 18

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that go on with a character of UTF-8.
_INSIDE = bytes(range(0x80, 0xC0))


def text_mask(data: bytes) -> int:
    """Bits of the filters that a text fails by itself: A is bit 0, B bit 1, C bit 2, D bit 3."""
    words = data.split()  # of bytes: at ASCII white space only
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    characters = len(data.translate(None, _INSIDE))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > CAPITALS_PERCENT * characters) << 2
        | (len(data.translate(None, SYMBOLS)) < len(data)) << 3
    )


def _whole_text() -> Column:
    return F.coalesce("text", F.lit(""))


def text_hash(text: Column) -> Column:
    return F.xxhash64(text)


def _other_hash(text: Column) -> Column:
    """Tells the documents of different texts with one hash apart."""
    return F.xxhash64(F.lit(1), text)


def _masks(docs: DataFrame, part: str) -> DataFrame:
    """(part, doc_id, hash, other_hash, mask) of every document, the text's own bits only."""
    schema = pa.schema(
        [("part", pa.string()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("other_hash", pa.int64()), ("mask", pa.int32())]
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = pa.array([text_mask(t) for t in batch.column(4).to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], masks], schema=schema)

    text = _whole_text()
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
        text_hash(text).alias("hash"), _other_hash(text).alias("other_hash"), text.cast("binary").alias("data"),
    )
    return written(rows.mapInArrow(judge, "part string, doc_id long, hash long, other_hash long, mask int"))


# the sketch ------------------------------------------------------------------------


def _segment(segments: int) -> Column:
    return F.pmod(F.xxhash64("hash"), F.lit(segments)).alias("segment")


def sketch(hashes: DataFrame, segments: int) -> DataFrame:
    """(segment, repeated): for every segment 64 cells a number, set where a cell was counted twice or more."""
    partial = pa.schema([("segment", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts(held: list[pa.RecordBatch]) -> Iterator[tuple]:
            whole = pa.Table.from_batches(held)
            segment, bits = whole["segment"].to_numpy(), whole["hash"].to_numpy().view(np.uint64)
            cells = [(bits >> np.uint64(SEGMENT_BITS * k)) & np.uint64(_SEGMENT - 1) for k in range(PROBES)]
            every, n = np.unique(np.concatenate([segment << SEGMENT_BITS | c.astype(np.int64) for c in cells]), return_counts=True)
            numbers, starts = np.unique(every >> SEGMENT_BITS, return_index=True)
            within, n = (every & (_SEGMENT - 1)).astype("<u2"), np.minimum(n, 255).astype(np.uint8)
            for number, a, b in zip(numbers.tolist(), starts, [*starts[1:], len(every)]):
                yield number, within[a:b].tobytes(), n[a:b].tobytes()

        def chunks() -> Iterator[tuple]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                held.append(batch)
                if sum(b.num_rows for b in held) >= _CHUNK:
                    yield from parts(held)
                    held.clear()
            if held:
                yield from parts(held)

        return record_batches(chunks(), partial, 1024)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def repeated(counts: np.ndarray) -> list[int]:
            return np.packbits(counts >= 2, bitorder="little").view("<i8").tolist()

        def merged() -> Iterator[tuple]:
            current, counts = None, np.zeros(_SEGMENT, np.uint16)
            for batch in batches:
                for segment, cells, n in zip(*(c.to_pylist() for c in batch.columns)):
                    if segment != current:
                        if current is not None:
                            yield current, repeated(counts)
                        current = segment
                        counts[:] = 0
                    at = np.frombuffer(cells, "<u2")
                    counts[at] = np.minimum(counts[at] + np.frombuffer(n, np.uint8), 255)
            if current is not None:
                yield current, repeated(counts)

        return record_batches(merged(), pa.schema([("segment", pa.int64()), ("repeated", pa.list_(pa.int64()))]), 256)

    partials = hashes.select(_segment(segments), "hash").mapInArrow(count, "segment long, cells binary, counts binary")
    return partials.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment long, repeated array<bigint>")


def _possible_repeats(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(hash, doc_id, text) of the documents whose cells were all counted twice or more."""
    segments = max(1, -(-hashes.count() * CELLS // _SEGMENT))
    cells = written(sketch(hashes, segments))
    if segments * _SEGMENT // 8 <= BROADCAST_BYTES:
        cells = F.broadcast(cells)
    text = _whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), text_hash(text).alias("hash"))
    rows = rows.withColumn("segment", _segment(segments)).join(cells, "segment")
    for k in range(PROBES):
        cell = F.shiftrightunsigned("hash", SEGMENT_BITS * k).bitwiseAND(F.lit(_SEGMENT - 1)).cast("int")
        word = F.get("repeated", F.shiftright(cell, 6))
        rows = rows.where(F.call_function("shiftrightunsigned", word, cell.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1)
    return rows.select("hash", "doc_id", "text")


def _with_repeats(masks: DataFrame, docs: DataFrame) -> DataFrame:
    """``masks`` with bit 4 set where a smaller id has the same text."""
    possible = _possible_repeats(docs, masks.select("hash"))
    # Least ids by full text; copies collapse before the shuffle, so a hot text is a row a task.
    texts = possible.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    firsts = written(
        texts.select("hash", "first", "copies").groupBy("hash").agg(
            F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.sum("copies").alias("copies")
        ).where("copies > 1")
    )
    later = F.coalesce(F.col("first") < F.col("doc_id"), F.col("doc_id").isNull() & F.col("first").isNotNull())
    single = firsts.where("texts = 1").select("hash", "first")
    marked = masks.join(single, "hash", "left").withColumn("repeat", later).drop("first")
    shared = firsts.where("texts > 1").select("hash")
    if not shared.isEmpty():
        # Different texts of one hash: their documents are compared by the texts themselves.
        theirs = possible.join(shared, "hash", "left_semi").withColumn("other_hash", _other_hash(F.col("text")))
        least = theirs.groupBy("hash", "other_hash", "text").agg(F.min("doc_id").alias("least")).drop("text")
        marked = marked.join(least, ["hash", "other_hash"], "left").withColumn(
            "repeat", F.when(F.col("least").isNull(), F.col("repeat")).otherwise(F.coalesce(F.col("least") < F.col("doc_id"), F.lit(True)))
        ).drop("least")
    return marked.withColumn("mask", F.col("mask").bitwiseOR(F.when(F.coalesce("repeat", F.lit(False)), 16).otherwise(0))).drop("repeat", "hash", "other_hash")


# counts ----------------------------------------------------------------------------


def mask_counts(docs: DataFrame, labels: DataFrame, part: str) -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and the set of filters that they fail."""
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    rows = _with_repeats(_masks(docs, part), docs).join(known, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")],
    )


def _steps() -> list[tuple[str, int, int, int]]:
    """Every step of every order: the order, the step's number, its filter's bit and the bits before."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[k] for k in order)
        for step, k in enumerate(order):
            steps.append((name, step + 1, 1 << k, sum(1 << j for j in order[:step])))
    return steps


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, filter order and step, zeros included.

    ``docs`` has doc_id, text and ``part``; ``labels`` doc_id, quality and toxic.
    """
    counts = written(mask_counts(docs, labels, part))
    steps = ", ".join(f"named_struct('filter_order', '{o}', 'step', {s}, 'bit', {b}, 'before', {e})" for o, s, b, e in _steps())
    # At most 32 rows a part meet the 600 steps of the 120 orders, held as one literal.
    rows = counts.withColumn("at", F.explode(F.expr(f"array({steps})"))).select("*", "at.*").drop("at")
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")

    def total(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(F.lit(0))).cast("long")

    orders = 120  # of which 120 / (number of failed filters) meet the filter before all others
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.expr("mask = bit")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * F.expr(f"{orders} div bit_count(mask)")).otherwise(F.lit(0))).cast("long").alias("shapley"),
    )
