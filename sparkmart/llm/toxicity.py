"""Toxicity scores from subword-bag embeddings averaged into a linear softmax.

A word stands for itself and its character n-grams, hashed to rows of one embedding
table. A text is the average of the rows of all its words' subwords; a softmax layer
over that average gives the score. Table and layer are learnt together by mini-batch
gradient steps (Adagrad) in numpy, on a sample of labelled texts with a fixed bound.
Misspelt or inflected forms share most n-grams with the forms that were seen.

Since the layer is linear, ``average(rows) . weights`` is ``average(rows . weights)``:
for scoring the model shrinks to one number for each row, and a word to their sum.

* A null or empty text has the score of the bias alone.
* Equal rows get equal scores; a null id stays null and is never held out or learnt
  from; an empty table gives no row; without labelled rows every score is that of a bias of -30, about 1e-13.
* Of different texts with one id the one with the smallest hash is learnt from.
* Labels that are null are left out; a document labelled twice counts as toxic if any
  of its labels is. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import batched, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.3
#: Words a worker remembers, about 200 bytes each; beyond it the memo starts anew.
MEMO_WORDS = 900_000
_EDGES = ".,;:!?\"'()[]{}«»“”‘’…-–—"


@dataclass(frozen=True)
class Settings:
    #: Labelled texts to learn from, by class; the only bound on what is learnt from.
    toxic_rows: int = 1000
    clean_rows: int = 2000
    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    epochs: int = 8
    #: A small sample is gone over more often, up to so many steps.
    steps: int = 300
    batch: int = 128
    rate: float = 0.5
    seed: int = 7


def subwords(word: str, settings: Settings) -> list[int]:
    """Rows of the word and of its character n-grams, word ends marked."""
    word = f"<{word.strip(_EDGES).lower()}>"
    grams = [word]
    for n in range(settings.shortest, min(settings.longest, len(word) - 1) + 1):
        grams += [word[i : i + n] for i in range(len(word) - n + 1)]
    return [zlib.crc32(g.encode()) % settings.buckets for g in grams]


@dataclass(frozen=True)
class Model:
    settings: Settings
    #: Each row's share of the log-odds, and the bias.
    weights: np.ndarray
    bias: float

    def scorer(self):
        """``score(text)`` with a memo of words: complex(sum of weights, number of subwords)."""
        weights, settings = self.weights, self.settings

        class Memo(dict):
            def __missing__(self, word: str) -> complex:
                if len(self) >= MEMO_WORDS:
                    self.clear()
                rows = subwords(word, settings)
                self[word] = value = complex(float(weights[rows].sum()), len(rows))
                return value

        memo, bias = Memo(), self.bias

        def score(text: str | None) -> float:
            total = sum(map(memo.__getitem__, (text or "").split()))
            odds = bias + (total.real / total.imag if total else 0.0)
            return float(1.0 / (1.0 + np.exp(-np.clip(odds, -30.0, 30.0))))

        return score


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the ids whose labels are never learnt from; null has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic), held-out ids left out."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg((F.max("toxic") == 1).alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    sample = (
        known.where("toxic").orderBy(order, "doc_id").limit(settings.toxic_rows)
        .unionByName(known.where("not toxic").orderBy(order, "doc_id").limit(settings.clean_rows))
    )
    schema = pa.schema([("toxic", pa.bool_()), ("bag", pa.binary())])

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                counts = np.zeros(settings.buckets, np.float64)
                # Words by their number, some at a time: a long text never lies there as subwords.
                for some in batched(Counter((text or "").split()).items(), 10_000):
                    for word, _ in some:
                        if word not in memo:
                            memo[word] = subwords(word, settings)
                    rows = [memo[word] for word, _ in some]
                    often = np.repeat([n for _, n in some], [len(r) for r in rows])
                    counts += np.bincount(list(chain.from_iterable(rows)), often, settings.buckets)
                    if len(memo) > MEMO_WORDS // 10:
                        memo.clear()
                found = np.flatnonzero(counts).astype(np.uint32)
                out.append((toxic, _packed(found, counts[found].astype(np.float32))))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    # The sample has at most ``toxic_rows + clean_rows`` rows; a text of a repeated id counts once.
    least = F.min(F.struct(F.xxhash64("text"), "text")).alias("least")
    sampled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(least)
    sampled = sampled.select("doc_id", "toxic", "least.text")
    found = sampled.orderBy(F.xxhash64("doc_id", "text")).select("toxic", "text").mapInArrow(
        bags, "toxic boolean, bag binary"
    ).collect()
    toxic, size = sum(r["toxic"] for r in found), len(found)
    model = _fit([(r["toxic"], r["bag"]) for r in found], settings)
    # The sample holds more toxic texts than the labels do; the bias goes back to their share.
    share = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(share) < 2 or toxic in (0, size):
        return model
    return replace(model, bias=model.bias + float(np.log(share[True] / share[False] * (size - toxic) / toxic)))


def _packed(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Rows and counts of a bag, about a fifth of their size."""
    return zlib.compress(np.diff(rows.astype(np.uint32), prepend=np.uint32(0)).tobytes() + counts.astype(np.float32).tobytes(), 1)


def _unpacked(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, counts = np.frombuffer(zlib.decompress(bag), np.uint32).reshape(2, -1)
    return np.cumsum(steps, dtype=np.uint32), counts.view(np.float32)


class _Batch:
    """Some bags as one sparse matrix, its entries ordered by text and by row (``order``, where it is known)."""

    def __init__(self, bags: list[tuple[bool, np.ndarray, np.ndarray]], order: np.ndarray | None = None):
        self.toxic = np.array([b[0] for b in bags], np.float32)
        self._rows = np.concatenate([b[1] for b in bags]).astype(np.int32)
        self._share = np.concatenate([b[2] / b[2].sum() for b in bags])[:, None]
        sizes = np.array([len(b[1]) for b in bags])
        self._starts = np.cumsum(sizes) - sizes
        self.order = np.argsort(self._rows, kind="stable").astype(np.int32) if order is None else order
        self._text = np.repeat(np.arange(len(bags), dtype=np.int32), sizes)[self.order]
        ordered = self._rows[self.order]
        self._firsts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        self.rows = ordered[self._firsts]

    def average(self, table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[self._rows] * self._share, self._starts)

    def gradient(self, of_average: np.ndarray) -> np.ndarray:
        """For each of ``rows``."""
        return np.add.reduceat(of_average[self._text] * self._share[self.order], self._firsts)


class _Held:
    """A batch as it is held between its steps: its bags packed, and their order by row."""

    def __init__(self, bags: list[tuple[bool, bytes]]):
        self._bags, self._order = bags, None
        self._order = self.opened().order

    def opened(self) -> _Batch:
        return _Batch([(toxic, *_unpacked(bag)) for toxic, bag in self._bags], self._order)


def fit(bags: list[tuple[bool, np.ndarray, np.ndarray]], settings: Settings) -> Model:
    """Embedding table and softmax layer together, from (toxic, rows, counts)."""
    return _fit([(toxic, _packed(rows, counts)) for toxic, rows, counts in bags], settings)


def _fit(bags: list[tuple[bool, bytes]], settings: Settings) -> Model:
    """The same from packed bags; they are opened a batch at a time, so the driver never holds them all."""
    empty = _packed(np.zeros(0, np.uint32), np.zeros(0, np.float32))
    bags = [b for b in bags if b[1] != empty]
    if not bags:
        return Model(settings, np.zeros(settings.buckets, np.float32), -30.0)
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(bags))
    batches = [_Held([bags[k] for k in order[i : i + settings.batch]]) for i in range(0, len(bags), settings.batch)]
    table = rng.normal(0, 0.1, (settings.buckets, settings.dim)).astype(np.float32)
    layer = rng.normal(0, 0.1, (settings.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen, seen_layer, seen_bias = np.full(settings.buckets, 1e-8, np.float32), np.full(layer.shape, 1e-8), np.full(2, 1e-8)
    for _ in range(max(settings.epochs, settings.steps // len(batches))):
        for i in rng.permutation(len(batches)):
            batch = batches[i].opened()
            average = batch.average(table)
            logits = average @ layer + bias
            share = np.exp(logits - logits.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            share -= np.stack([1 - batch.toxic, batch.toxic], axis=1)
            share /= len(share)
            of_rows = batch.gradient((share @ layer.T).astype(np.float32))
            of_layer, of_bias = average.T @ share, share.sum(axis=0)
            seen[batch.rows] += (of_rows**2).mean(axis=1)
            table[batch.rows] -= settings.rate * of_rows / np.sqrt(seen[batch.rows])[:, None]
            seen_layer += of_layer**2
            layer -= (settings.rate * of_layer / np.sqrt(seen_layer)).astype(np.float32)
            seen_bias += of_bias**2
            bias -= (settings.rate * of_bias / np.sqrt(seen_bias)).astype(np.float32)
    return Model(settings, table @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text)."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            scores = pa.array([of(t) for t in batch.column(1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), scores], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(scored, "doc_id long, score double")


def score_column(text: Column, model: Model) -> Column:
    """The score as a column, for filters that keep the rows as they are."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = model.scorer()
        for texts in batches:
            yield texts.map(of, na_action=None).astype("float64")

    return scored(text)
