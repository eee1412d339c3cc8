"""Near-duplicate documents by an LSH forest of MinHash signatures, confirmed on full sets.

A text's set holds its distinct five-word shingles as 64-bit hashes. Equal sets are one
class and represented once. A class has a signature of minima; each of ``TREES`` sorted
orders takes its values from another place on, so that classes with a long common prefix
become neighbours. Classes that share ``ROOT`` values of an order are a region. In regions
of up to ``REGION`` classes all pairs are candidates; larger ones are divided at the next
value, and so on, down to parts of ``PART`` classes, while each class also meets its next
neighbour and the hub of its region, the class at its most frequent values, which makes the region one
component. At similarity 0.75 two classes miss each
other in all orders with probability below 3e-6 (undivided regions; what a divided one misses
is looked up, as follows).

Candidates form components. Within one, pairs are confirmed on the full sets unless they
are linked already; where regions were divided, the sets outside the largest group are then
compared with all others of the component, so no link inside it is lost. Components of more
than ``TASK_SHINGLES`` do both by joins: every candidate pair is confirmed, then the sets
outside the largest group meet all others that share a shingle among the rarest of each, as
any two linked sets do (``_looked_up``). So no group is gathered that grows without bound.

* A null or empty text, or one without words, has the empty set and is linked with nothing.
* Rows with equal texts, also equal rows, are one class. A null id counts as larger than all.
* An empty table gives no row. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import fresh, numbered, record_batches, written
from sparkmart.llm.components import Union, components

SHINGLE, PERCENT = 5, 75
TREES, ROOT, DEPTH, REGION, PART, NEIGHBOURS = 24, 3, 6, 12, 2, 1
#: Large regions are divided in one of so many orders; the others add only the pairs with their hubs.
SPARSE = 6
#: Shingles of a component that a task confirms by itself, 8 bytes each.
TASK_SHINGLES = 6_000_000
_CHUNK = 1 << 18
#: Sets that share a frequent shingle are dealt over parts of so many.
_DEALT = 1000

_rng = np.random.default_rng(20240229)
_FACTORS = _rng.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_MULTIPLY = _rng.integers(1, 1 << 63, TREES * ROOT, dtype=np.uint64) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, TREES * ROOT, dtype=np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the five-word shingles, or of the whole sequence if it is shorter."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(SHINGLE, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        mixed += hashes[k : len(hashes) - size + 1 + k] * _FACTORS[k]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def signature(values: np.ndarray) -> np.ndarray:
    low = np.full(TREES * ROOT, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(values), 1024):
        hashed = ((values[a : a + 1024, None] * _MULTIPLY + _ADD) >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, hashed.min(axis=0), out=low)
    return low


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * intersection size >= PERCENT * union size, exactly."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= PERCENT * (len(both) - shared)


def _signed(docs: DataFrame, row: str) -> DataFrame:
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("signature", pa.binary())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for number, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    values = shingles(text)
                    if not len(values):
                        yield number, doc_id, 0, None, None
                        continue
                    key = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                    yield number, doc_id, len(values), key, signature(values).tobytes()

        return record_batches(rows(), schema)

    return docs.select(F.col(row).alias("row"), F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "row long, doc_id long, n_shingles long, set_key binary, signature binary"
    )


def _orders(classes: DataFrame) -> DataFrame:
    """(tree, label, rep, n) of every class in every order; labels sort as their values do."""
    schema = pa.schema([("tree", pa.int32()), ("label", pa.binary()), ("rep", pa.int64()), ("n", pa.int64())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, n, signatures = batch.columns
            values = np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(-1, TREES * ROOT)
            for tree in range(TREES):
                own = np.roll(values, -ROOT * tree, axis=1)[:, :DEPTH].astype(">u4").tobytes()
                labels = pa.array([own[a : a + 4 * DEPTH] for a in range(0, len(own), 4 * DEPTH)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rep), tree), pa.int32()), labels, rep, n], schema=schema)

    return classes.select("rep", F.col("n_shingles").alias("n"), "signature").mapInArrow(spread, "tree int, label binary, rep long, n long")


def _starts(label: np.ndarray, tree: np.ndarray, depth: int) -> np.ndarray:
    new = np.ones(len(tree), bool)
    new[1:] = (tree[1:] != tree[:-1]) | (label[1:, :depth] != label[:-1, :depth]).any(axis=1)
    return new


def candidates(tree: np.ndarray, label: np.ndarray, rep: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes (smaller first) from rows in the order of (tree, label, rep)."""
    region = np.cumsum(_starts(label, tree, ROOT)) - 1
    size = np.bincount(region)[region]
    left, right = [], []

    def pair(a: np.ndarray, b: np.ndarray, any_size: bool = False) -> None:
        fits = (any_size | (100 * np.minimum(n[a], n[b]) >= PERCENT * np.maximum(n[a], n[b]))) & (rep[a] != rep[b])
        left.append(np.minimum(rep[a], rep[b])[fits])
        right.append(np.maximum(rep[a], rep[b])[fits])

    divided = tree % SPARSE == 0
    open_ = (size > 1) & (divided | (size <= REGION))
    for depth in range(ROOT, DEPTH + 1):
        part = np.cumsum(_starts(label, tree, depth)) - 1
        # Parts of a divided region only have to connect it; what they miss is looked up later.
        small = open_ & (np.bincount(part)[part] <= (REGION if depth == ROOT else PART))
        for step in range(1, REGION):
            near = np.flatnonzero(small[:-step] & (part[:-step] == part[step:]))
            if not len(near):
                break
            pair(near, near + step)
        open_ &= ~small
    large = size > REGION
    if large.any():
        for step in range(1, NEIGHBOURS + 1):
            near = np.flatnonzero((large & divided)[:-step] & (region[:-step] == region[step:]))
            pair(near, near + step)
        # The hub: the first row of the most frequent full label of its region.
        full = np.cumsum(_starts(label, tree, DEPTH)) - 1
        count = np.bincount(full)[full]
        rows = np.flatnonzero(large)
        best = rows[np.lexsort((rows, -count[rows], region[rows]))]
        hubs = best[np.unique(region[best], return_index=True)[1]]
        # Whatever its size, it makes the region one component, within which every link is found.
        pair(hubs[np.searchsorted(region[hubs], region[rows])], rows, True)
    return np.concatenate(left or [np.zeros(0, np.int64)]), np.concatenate(right or [np.zeros(0, np.int64)])


def _candidate_pairs(orders: DataFrame) -> DataFrame:
    """Distinct (u, v); ranges of the orders are searched each by itself, also those of one hot region."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            label = np.frombuffer(b"".join(table["label"].to_pylist()), ">u4").reshape(-1, DEPTH)
            u, v = candidates(table["tree"].to_numpy(), label, table["rep"].to_numpy(), table["n"].to_numpy())
            pairs = np.unique(np.stack([u, v]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= _CHUNK:
                yield found()
                held.clear()
        if held:
            yield found()

    order = ("tree", "label", "rep")
    return orders.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(search, "u long, v long").distinct()


def complete(sets: dict[int, np.ndarray], union: Union) -> None:
    """Finds every link that is still missing, by the rarest shingles of each set.

    With shingles in one order, rarest first, the first one that two linked sets share is near the
    start of both (see ``_looked_up``). One end of a missing link lies outside the largest group.
    """
    nodes = list(sets)
    roots = [union.find(node) for node in nodes]
    largest = Counter(roots).most_common(1)[0][0]
    rest = np.array([root != largest for root in roots])
    if not rest.any():
        return
    sizes = np.array([len(sets[node]) for node in nodes])
    owner = np.repeat(np.arange(len(nodes)), sizes)
    _, number, often = np.unique(np.concatenate([sets[node] for node in nodes]), return_inverse=True, return_counts=True)
    order = np.lexsort((number, often[number], owner))
    owner, number = owner[order], number[order]
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # Shingles of a single set link nothing, but keep their place in the order.
    shared = often[number] > 1
    short = shared & (rank < (sizes - -(-sizes * 2 * PERCENT // (100 + PERCENT)) + 1)[owner])
    long = shared & (rank < (sizes - -(-sizes * PERCENT // 100) + 1)[owner])

    def index(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        by = np.argsort(number[chosen], kind="stable")
        return number[chosen][by], owner[chosen][by]

    every, others = index(long), index(long & rest[owner])
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner[short], minlength=len(nodes)))])
    looked = number[short]
    for k in range(len(nodes)):
        # A set of the largest group only has to meet those outside.
        values, owners = every if rest[k] else others
        own = looked[starts[k] : starts[k + 1]]
        low, high = (np.searchsorted(values, own, side) for side in ("left", "right"))
        count = high - low
        if not count.any():
            continue
        found = owners[np.repeat(high - np.cumsum(count), count) + np.arange(count.sum())]
        found = found[(sizes[found] >= sizes[k]) & (100 * sizes[k] >= PERCENT * sizes[found])]
        for other in np.unique(found).tolist():
            a, b = nodes[k], nodes[other]
            if union.find(a) != union.find(b) and linked(sets[a], sets[b]):
                union.join(a, b)


def _confirmed_within(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, component) by the pairs that hold, for components that fit a task.

    ``sets`` has (component, node, shingles), ``pairs`` (component, u, v).
    """
    rows = sets.select("component", F.lit(0).alias("kind"), F.col("node").alias("u"), F.lit(0).cast("long").alias("v"), "shingles").unionByName(
        pairs.select("component", F.lit(1).alias("kind"), "u", "v", F.lit(None).cast("binary").alias("shingles"))
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(held: dict[int, np.ndarray], union: Union):
            if len(held) > REGION:
                complete(held, union)
            return ((node, union.find(node)) for node in held)

        def result():
            current, held, union = None, {}, Union()
            for batch in batches:
                for component, kind, u, v, data in zip(*(c.to_pylist() for c in batch.columns)):
                    if component != current:
                        yield from closed(held, union)
                        current, held, union = component, {}, Union()
                    if kind == 0:
                        held[u] = np.frombuffer(data, np.uint64)
                    elif union.find(u) != union.find(v) and linked(held[u], held[v]):
                        union.join(u, v)
            yield from closed(held, union)

        return record_batches(result(), pa.schema([("node", pa.int64()), ("component", pa.int64())]))

    return rows.repartition("component").sortWithinPartitions("component", "kind", "u", "v").mapInArrow(confirm, "node long, component long")


def _confirmed_pairs(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (u, v) that hold, each confirmed by itself."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(k).to_pylist() for k in (2, 3))
            holds = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)]
            yield batch.select([0, 1]).filter(pa.array(holds, pa.bool_()))

    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("right"))
    return pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "left", "right").mapInArrow(confirm, "u long, v long")


def _tokens(sets: DataFrame) -> DataFrame:
    """(node, shingle) of every shingle, one row each."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(data, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node), pa.int64()), pa.array(values)], names=["node", "shingle"])

    return sets.select("node", "shingles").mapInArrow(spread, "node long, shingle long")


def _looked_up(sets: DataFrame, confirmed: DataFrame) -> DataFrame:
    """The (u, v) that may hold between the groups of ``confirmed`` in a component of ``sets``: a superset of those that do.

    Two linked sets share at least PERCENT of the larger one, and 2 * PERCENT / (100 + PERCENT)
    of the smaller one. So with shingles in one order, rarest first, the first that they share
    is near the start of both. One end lies outside the largest group of the component.
    """
    grouped = components(confirmed).select("node", F.col("component").alias("group"))
    nodes = sets.select("component", "node", (F.octet_length("shingles") / 8).cast("long").alias("n"))
    nodes = nodes.join(grouped, "node", "left").withColumn("group", F.coalesce("group", "node"))
    counts = nodes.groupBy("component", "group").agg(F.count(F.lit(1)).alias("members"))
    largest = counts.groupBy("component").agg(
        F.max(F.struct("members", "group")).getField("group").alias("largest"), F.count(F.lit(1)).alias("groups")
    )
    # A component of one group has no link to find.
    open_ = largest.where("groups > 1").select("component", "largest")
    nodes = written(nodes.join(open_, "component").withColumn("rest", F.col("group") != F.col("largest")).drop("largest"))
    if nodes.isEmpty():
        return confirmed.limit(0)
    tokens = written(_tokens(sets.join(nodes.select("node"), "node", "left_semi")).join(nodes.select("node", "component"), "node"))
    often = tokens.groupBy("component", "shingle").agg(F.count(F.lit(1)).alias("often"))
    # What a single set has joins nothing, but takes its place in the order.
    ranked = (
        tokens.join(often, ["component", "shingle"])
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("often", "shingle"))).alias("ordered"))
        .join(nodes, "node")
    )
    lower = f"n - ceil(n * {2 * PERCENT} / {100 + PERCENT}) + 1"
    upper = f"n - ceil(n * {PERCENT} / 100) + 1"
    kept = [F.col(c) for c in ("component", "node", "n", "group", "rest")]
    place = ranked.select(*kept, F.expr(lower).cast("int").alias("short"), F.posexplode(F.expr(f"slice(ordered, 1, int({upper}))")).alias("at", "t"))
    place = written(place.where("t.often > 1").select(*kept, "short", "at", F.col("t.shingle").alias("shingle"), "t.often"))
    # A frequent shingle is dealt over parts; the smaller set meets them all.
    parts = F.expr(f"int(ceil(often / {_DEALT}))")
    small = place.where("at < short").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    large = place.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    a, b = small.alias("a"), large.alias("b")
    key = (
        (F.col("a.component") == F.col("b.component")) & (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.part") == F.col("b.part"))
        & (F.struct("a.n", "a.node") < F.struct("b.n", "b.node"))
        & (100 * F.col("a.n") >= PERCENT * F.col("b.n"))
        & (F.col("a.group") != F.col("b.group"))
    )
    found = [
        a.where("rest").join(b, key),
        a.where("not rest").join(b.where("rest"), key),
    ]
    ends = (F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v"))
    return found[0].select(*ends).unionByName(found[1].select(*ends)).distinct()


def group(docs: DataFrame, row: str) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, first_row) of every row of ``docs``.

    ``docs`` is a written table with ``doc_id``, ``text`` and the unique number ``row``.
    ``component_id`` is the smallest doc_id reachable, ``first_row`` the row that has it.
    """
    signed = written(_signed(docs, row))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    classes = written(
        signed.where("n_shingles > 0")
        .groupBy("set_key")
        .agg(F.min(F.struct("row", "n_shingles", "signature")).alias("rep"), F.min(place).alias("first"))
        .select("set_key", F.col("rep.row").alias("rep"), "rep.n_shingles", "rep.signature", "first")
    )
    pairs = written(_candidate_pairs(_orders(classes)))
    around = written(components(pairs).join(classes.select(F.col("rep").alias("node"), "n_shingles"), "node"))
    sizes = around.groupBy("component").agg((F.sum("n_shingles") > TASK_SHINGLES).alias("large"))
    around = around.join(sizes, "component").select("component", "node", "large")
    texts = docs.select(F.col(row).alias("node"), "text")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.binary())], names=["component", "node", "large", "shingles"])

    sets = written(
        around.join(texts, "node").select("component", "node", "large", "text").mapInArrow(
            hashed, "component long, node long, large boolean, shingles binary"
        ),
        "snappy",
    )
    labelled = pairs.join(around.withColumnRenamed("node", "u"), "u")
    small = _confirmed_within(sets.where("not large"), labelled.where("not large"))
    huge = sets.where("large")
    if huge.isEmpty():
        labels = small
    else:
        confirmed = written(_confirmed_pairs(huge, labelled.where("large")))
        more = _confirmed_pairs(huge, _looked_up(huge, confirmed))
        labels = small.unionByName(components(confirmed.unionByName(more)))
    labels = labels.withColumnRenamed("node", "rep")
    whole = written(
        classes.select("set_key", "rep", "first")
        .join(labels, "rep", "left")
        .select("set_key", "first", F.coalesce("component", "rep").alias("component"))
    )
    firsts = whole.groupBy("component").agg(F.min("first").alias("of_all"))
    found = whole.join(firsts, "component").select("set_key", "of_all")
    return signed.join(found, "set_key", "left").select(
        "row",
        "doc_id",
        "n_shingles",
        F.when(F.col("of_all").isNull(), F.col("doc_id")).otherwise(F.col("of_all.doc_id")).alias("component_id"),
        F.coalesce("of_all.row", "row").alias("first_row"),
    )


def numbered_rows(docs: DataFrame, row: str) -> DataFrame:
    """``docs`` written with a row number, as ``group`` needs it."""
    return written(numbered(docs, row))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their component."""
    row, first = fresh(docs, "row_number"), fresh(docs, "first_row")
    rows = numbered_rows(docs, row)
    firsts = group(rows, row).where("row = first_row").select(F.col("row").alias(first))
    return rows.join(firsts, F.col(row) == F.col(first), "left_semi").select(*docs.columns)
