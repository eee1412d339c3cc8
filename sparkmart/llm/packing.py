"""Best-fit packing of token pieces into sequences by swap-based local search.

``pieces`` cuts documents into pieces of at most ``capacity`` ids. ``pack`` deals the
pieces over groups of bounded size; in each, best-fit decreasing makes the first bins
and a local search then takes the emptiest bin and moves its pieces, swaps one of them
for a smaller one or two of them for one, always so that the fuller bin gains (the sum
of squared fills grows) and until the bin is empty or nothing fits. What is left in
bins that stayed underfull is packed once more over new groups.

* A null or empty text is a document of its end id alone.
* Equal rows and repeated ids are packed one by one; a null id stays null.
* An empty table gives no piece. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import group_count, numbered, record_batches, written
from sparkmart.llm.tokens import default_path, encoder

CAPACITY = 2048
#: Pieces a group holds on average; a task keeps only their lengths.
GROUP = 4096
#: Bins with more free ids than this share of the capacity go to the second round.
UNDERFULL = 0.02


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Written table (doc_id, piece, start, length, ids, key) of the token pieces of ``docs`` (doc_id, text).

    ``ids`` are little-endian unsigned 32-bit integers, ``key`` numbers the pieces.
    """
    tokenizer = tokenizer or default_path()
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).each

        def rows():
            for batch in batches:
                doc_ids, texts = (c.to_pylist() for c in batch.columns)
                for doc_id, ids in zip(doc_ids, encode(texts)):
                    ids += end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        yield doc_id, n, at // 4, len(part) // 4, part

        return record_batches(rows(), schema, 1024)

    rows = docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")
    return written(numbered(rows, "key"))


def pack(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(key, sequence_id, offset) for the rows of a written table (key: unique, length: 1 to ``capacity``)."""
    first = written(_packed(lengths.select("key", "length"), capacity, 0), "snappy")
    done = first.filter(~F.col("underfull"))
    again = _packed(first.filter("underfull").select("key", "length"), capacity, 1)
    return done.unionByName(again).select("key", "sequence_id", "offset")


def _packed(lengths: DataFrame, capacity: int, turn: int) -> DataFrame:
    groups = group_count(lengths.count(), GROUP)

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "key"], ascending=[False, True], ignore_index=True)
        bins = pack_bins(group["length"].to_numpy(np.int64), capacity)
        order = np.concatenate([np.array(b, np.int64) for b in bins])
        sizes = np.array([len(b) for b in bins])
        bin_of = np.repeat(np.arange(len(bins)), sizes)
        size = group["length"].to_numpy(np.int64)[order]
        before = np.cumsum(size) - size
        fill = np.bincount(bin_of, size)
        base = (int(group["group_no"].iloc[0]) * 2 + turn) << 32
        return pd.DataFrame(
            {
                "key": group["key"].to_numpy()[order],
                "length": size,
                "sequence_id": base + bin_of,
                "offset": before - before[np.cumsum(sizes) - sizes][bin_of],
                "underfull": (capacity - fill > UNDERFULL * capacity)[bin_of],
            }
        )

    return (
        lengths.withColumn("group_no", F.pmod(F.xxhash64("key"), F.lit(groups)))
        .groupBy("group_no")
        .applyInPandas(place, "key long, length long, sequence_id long, offset long, underfull boolean")
    )


def pack_bins(size: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions in ``size``, which descends: best-fit decreasing, then the local search."""
    bins = _best_fit(size.tolist(), capacity)
    least = -(-int(size.sum()) // capacity)
    search = _Search(size, bins, capacity)
    while search.count > least and search.empty_one():
        pass
    return search.bins()


def _best_fit(size: list[int], capacity: int) -> list[list[int]]:
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for i, s in enumerate(size):
        at = bisect.bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(i)
        else:
            free, b = capacity, len(bins)
            bins.append([i])
        if free > s:
            bisect.insort(room, (free - s, b))
    return bins


class _Search:
    """Empties the emptiest bins by moves and swaps into bins that are fuller."""

    def __init__(self, size: np.ndarray, bins: list[list[int]], capacity: int):
        self._size, self._capacity = size, capacity
        self._bin = np.zeros(len(size), np.int64)
        for b, items in enumerate(bins):
            self._bin[items] = b
        self._fill = np.bincount(self._bin, size, minlength=len(bins)).astype(np.int64)
        self._stuck = np.zeros(len(bins), bool)

    @property
    def count(self) -> int:
        return int((self._fill > 0).sum())

    def bins(self) -> list[list[int]]:
        order = np.argsort(self._bin, kind="stable")
        ends = np.cumsum(np.bincount(self._bin))
        return [p.tolist() for p in np.split(order, ends[:-1]) if len(p)]

    def empty_one(self) -> bool:
        """Works on the emptiest bin that is not stuck; False if there is none."""
        open_ = np.flatnonzero((self._fill > 0) & ~self._stuck)
        if not len(open_):
            return False
        source = int(open_[np.argmin(self._fill[open_])])
        while self._fill[source] and self._improve(source):
            pass
        self._stuck[source] = self._fill[source] > 0
        return True

    def _improve(self, source: int) -> bool:
        """The step out of ``source`` that fills another bin best; squared fill grows, as that bin is fuller."""
        own = np.flatnonzero(self._bin == source)
        free = self._capacity - self._fill
        free[(self._fill < self._fill[source]) | (self._fill == 0)] = 0
        free[source] = 0
        open_ = free > 0
        if not open_.any():
            return False
        # A move needs no partner: the largest piece that fits anywhere, where it leaves the least room.
        widest = int(free.max())
        fits = own[self._size[own] <= widest]
        if len(fits):
            item = fits[np.argmax(self._size[fits])]
            room = np.where(free >= self._size[item], free, self._capacity + 1)
            self._shift([item], source, int(np.argmin(room)))
            return True
        partners = np.flatnonzero(open_[self._bin] & (self._bin != source))
        gives = self._gives(own)
        sums = np.array(sorted(gives))
        # The most that each partner's bin can take for it.
        most = np.searchsorted(sums, self._size[partners] + free[self._bin[partners]], "right") - 1
        gain = np.where(most >= 0, sums[most] - self._size[partners], 0)
        if not len(gain) or gain.max() <= 0:
            return False
        k = int(np.argmax(gain))
        other = int(partners[k])
        target = int(self._bin[other])
        self._shift([other], target, source)
        self._shift(list(gives[int(sums[most[k]])]), source, target)
        return True

    def _gives(self, own: np.ndarray) -> dict[int, tuple[int, ...]]:
        """All sums of one or two of a bin's pieces, with such pieces; as lengths add up to a bin, few of them differ."""
        by_length: dict[int, list[int]] = {}
        for i in own.tolist():
            by_length.setdefault(int(self._size[i]), []).append(i)
        lengths = sorted(by_length)
        pairs = {
            a + b: (by_length[a][0], by_length[b][-1])
            for k, a in enumerate(lengths) for b in lengths[k:] if a != b or len(by_length[a]) > 1
        }
        return pairs | {a: (by_length[a][0],) for a in lengths}

    def _shift(self, items: list[int], source: int, target: int) -> None:
        moved = int(self._size[items].sum())
        self._bin[items] = target
        self._fill[source] -= moved
        self._fill[target] += moved
