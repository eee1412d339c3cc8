"""Removal of runs of lines that occurred before, found by winnowing over line hashes.

Only lines with a word count. A gram is the shortest run of lines from some line on with
``GRAM_WORDS`` words or more; a window the shortest run from some line on, or up to some line, with
``RUN_WORDS`` or more. Of each window the gram with the smallest hash is its fingerprint, so
two runs of equal lines with that many words share one, wherever they begin.

A place of a fingerprint goes by two keys: the gram alone, and the gram within the window that chose
it. Each is joined to the first place of its key, by (doc_id, row, line). The second key matters
where the gram is frequent: the first place of all may have other neighbours, the first one within the same
window has none. From the earlier place the match is extended line by line both ways, and the
later of the two runs is deleted. Extension reads the ``BLOCK`` lines around the two places, and
``MARGIN`` more, not whole documents; a run over several blocks is found in each.

So of a run of ``RUN_WORDS`` words that occurred before all lines go, as each lies in a window of the run;
nothing shorter than ``GRAM_WORDS`` is deleted, and every deleted line has an equal line before it, so
one that stays.

* A null or empty text has no lines and stays as it is; null ids come last in the order.
* Of equal rows the first keeps its lines. An empty table gives no row.
* ``deduplicate`` keeps every other column, whatever its name.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import WORD, fresh, numbered, record_batches, written

GRAM_WORDS, RUN_WORDS = 40, 50
#: A window has no more lines than words, so the margin holds any window around a place.
BLOCK, MARGIN = 512, 64
_WORD = re.compile(WORD)


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def lines_of(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """(number, hash, words) of the lines with a word."""
    numbers, hashes, words = [], [], []
    for n, line in enumerate((text or "").split("\n")):
        if count := len(_WORD.findall(line)):
            numbers.append(n)
            hashes.append(_hash(line.encode()))
            words.append(count)
    return numbers, hashes, words


def _run_ends(words: list[int], least: int) -> list[int]:
    """For each line the last line of the shortest run from it with so many words; no entry where there is none."""
    ends, end, total = [], 0, 0
    for start in range(len(words)):
        while total < least and end < len(words):
            total += words[end]
            end += 1
        if total < least:
            break
        ends.append(end - 1)
        total -= words[start]
    return ends


def fingerprints(hashes: list[int], words: list[int]) -> list[tuple[int, int]]:
    """(key, line) of the places: the smallest gram of each window, by itself and together with the window."""
    data, top = np.array(hashes, "<i8").tobytes(), len(words) - 1
    ends = _run_ends(words, GRAM_WORDS)
    grams = [(_hash(data[8 * a : 8 * b + 8]), a) for a, b in enumerate(ends)]
    up_to = ((top - b, top - a) for a, b in enumerate(_run_ends(words[::-1], RUN_WORDS)))
    found = set()
    for start, end in {*enumerate(_run_ends(words, RUN_WORDS)), *up_to}:
        least = min(grams[start : bisect.bisect_right(ends, end)])
        found.add(least)
        found.add((_hash(b"window" + data[8 * start : 8 * end + 8]), least[1]))
    return sorted(found, key=lambda g: (g[1], g[0]))


_BLOCKS = "row long, block int, doc_id long, start int, lines binary, hashes binary, marks array<struct<key: bigint, line: int>>"


def _line_table(rows: DataFrame, row: str) -> DataFrame:
    """Blocks of lines of the documents with a place: line numbers and hashes from ``start`` on, and the block's places."""
    mark = pa.struct([("key", pa.int64()), ("line", pa.int32())])
    schema = pa.schema(
        [("row", pa.int64()), ("block", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int32()), ("lines", pa.binary()), ("hashes", pa.binary()), ("marks", pa.list_(mark))]
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table():
            for batch in batches:
                for number, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    lines, hashes, words = lines_of(text)
                    of_block: dict[int, list[dict]] = {}
                    for key, line in fingerprints(hashes, words):
                        of_block.setdefault(line // BLOCK, []).append({"key": key, "line": line})
                    for block, marks in of_block.items():
                        start, end = max(0, block * BLOCK - MARGIN), (block + 1) * BLOCK + MARGIN
                        packed = (np.array(lines[start:end], "<i4"), np.array(hashes[start:end], "<i8"))
                        yield number, block, doc_id, start, *(p.tobytes() for p in packed), marks

        return record_batches(table(), schema)

    return written(rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long"), "text").mapInArrow(hashed, _BLOCKS))


def _extended(own: np.ndarray, other: np.ndarray, at: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs (first, last) of ``own`` around the places (line, line of the other) that agree with ``other``."""
    runs, done = [], set()
    for line, there in sorted(at):
        shift = there - line
        if (line, shift) in done:
            continue
        first, last = line, line
        while first > 0 and first + shift > 0 and own[first - 1] == other[first - 1 + shift]:
            first -= 1
        while last + 1 < len(own) and last + 1 + shift < len(other) and own[last + 1] == other[last + 1 + shift]:
            last += 1
        done.update((k, shift) for k in range(first, last + 1))
        runs.append((first, last))
    return runs


def _later(places: DataFrame) -> DataFrame:
    """``places`` (row, doc_id, key, line) that are not the first of their key, which is added as ``first``."""
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "line")
    # Partial minima come before the shuffle, so a key of a third of all texts is a row of each task.
    first = places.groupBy("key").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("places")).where("places > 1")
    return places.join(first.select("key", "first"), "key").where(
        (F.col("first.row") != F.col("row")) | (F.col("first.line") != F.col("line"))
    )


def _merged(runs: list[tuple]) -> list[tuple]:
    """Runs (first, last, first_doc_id) with those that overlap, of one document, as one."""
    merged: list[tuple] = []
    open_: dict[int | None, int] = {}
    for first, last, doc in sorted(runs, key=lambda r: r[:2]):
        k = open_.get(doc)
        if k is not None and first <= merged[k][1]:
            merged[k] = (merged[k][0], max(last, merged[k][1]), doc)
        else:
            open_[doc] = len(merged)
            merged.append((first, last, doc))
    return merged


def repeated_runs(rows: DataFrame, row: str) -> DataFrame:
    """(row, runs: array of (first, last, first_doc_id)) of the rows with lines that occurred before.

    ``rows`` is a written table with ``doc_id``, ``text`` and the unique number ``row``;
    first and last are line numbers from 0, both deleted.
    """
    table = _line_table(rows, row)
    marks = table.select("row", "doc_id", F.explode("marks").alias("mark")).select("row", "doc_id", "mark.*")

    def block(line: str) -> Column:
        return F.floor(F.col(line) / BLOCK).cast("int")

    # A block has at most two places for each of its lines and windows, so the lists are no longer than it.
    pairs = (
        _later(marks)
        .select("row", block("line").alias("block"), F.col("first.row").alias("there"), block("first.line").alias("there_block"), "line", F.col("first.line").alias("there_line"))
        .groupBy("row", "block", "there", "there_block")
        .agg(F.collect_set(F.struct("line", "there_line")).alias("at"))
    )
    there = table.select(
        F.col("row").alias("there"), F.col("block").alias("there_block"), F.col("doc_id").alias("first_doc_id"),
        F.col("start").alias("there_start"), F.col("hashes").alias("there_hashes"),
    )
    both = pairs.join(there, ["there", "there_block"]).join(table.select("row", "block", "start", "lines", "hashes"), ["row", "block"])
    schema = pa.schema([("row", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("first_doc_id", pa.int64())])

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs():
            for batch in batches:
                for number, doc, at, start, there_start, lines, own, other in zip(*(c.to_pylist() for c in batch.columns)):
                    lines = np.frombuffer(lines, "<i4")
                    places = [(p["line"] - start, p["there_line"] - there_start) for p in at]
                    for a, b in _extended(np.frombuffer(own, "<i8"), np.frombuffer(other, "<i8"), places):
                        yield number, int(lines[a]), int(lines[b]), doc

        return record_batches(runs(), schema)

    found = both.select("row", "first_doc_id", "at", "start", "there_start", "lines", "hashes", "there_hashes").mapInArrow(
        extend, "row long, first int, last int, first_doc_id long"
    )
    lists = found.groupBy("row").agg(F.collect_set(F.struct("first", "last", "first_doc_id")).alias("runs"))
    runs_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("first_doc_id", pa.int64())]))
    merged_schema = pa.schema([("row", pa.int64()), ("runs", runs_type)])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def merged():
            for batch in batches:
                for number, runs in zip(*(c.to_pylist() for c in batch.columns)):
                    runs = [(r["first"], r["last"], r["first_doc_id"]) for r in runs]
                    yield number, [dict(zip(("first", "last", "first_doc_id"), r)) for r in _merged(runs)]

        return record_batches(merged(), merged_schema)

    return lists.mapInArrow(merge, "row long, runs array<struct<first: int, last: int, first_doc_id: bigint>>")


def deduplicate(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """All columns of ``docs`` (doc_id, text and others), the text without the runs that occurred before.

    Two columns are added, and their names returned, as they avoid those that are there:
    the runs (empty where nothing was deleted) and the text as it was.
    """
    row, runs, before, found_row = (fresh(docs, n) for n in ("row_number", "removed_runs", "whole_text", "found_row"))
    rows = written(numbered(docs, row))
    found = repeated_runs(rows, row).select(F.col("row").alias(found_row), F.col("runs").alias(runs))
    joined = rows.join(found, F.col(row) == F.col(found_row), "left")
    none = F.expr("cast(array() as array<struct<first: int, last: int, first_doc_id: bigint>>)")
    kept = F.filter(
        F.split("text", "\n", -1), lambda line, n: ~F.exists(runs, lambda r: (n >= r["first"]) & (n <= r["last"]))
    )
    text = F.when(F.col(runs).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    columns = [text.alias("text") if c == "text" else F.col(c) for c in docs.columns]
    return joined.select(*columns, F.coalesce(runs, none).alias(runs), F.col("text").alias(before)), runs, before
