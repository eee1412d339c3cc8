"""Spelling variants: words one edit apart, found by walking a trie level by level with joins.

Runs of letters are counted over all texts; the frequent ones of some length are the words.
Two words are near if they differ by exactly one inserted, deleted or replaced code point.

The words make two tries, one of the words as they are and one of the words reversed, stored as
a table of edges: from each prefix where words part or end to the next one, with the code points
between. Words that are near agree before and behind the edit, so one of the two tries has the
edit in its second half, where it hardly branches; only there an edit is tried.

A state is (word, position, node, edit). A word without an edit is at the nodes of its own
path. Level by level the states at a level's nodes are joined with its edges: one without an
edit may spend it on a branch that is not its own, by replacing a code point or by an inserted
one; one with an edit must match the whole edge. An edge knows which lengths and which next code
points its words go on with, so most states end before they are written. A state that ends
with its word and at the end of a word gives a pair. Deletions are insertions seen from the
other word, so every pair is found from one side and written for both.

Nodes are 64-bit hashes of prefixes. Two prefixes with one hash would share a node, which adds
states but loses none; the pair is spelt out from its state and looked up among the words.

* A null text has no words; a null id is read as no digits. Equal rows count twice.
* An empty table, or one without a frequent word, gives no row.
* Rounds are as many as the most parting prefixes on a word's path, however long words are.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import numbered, record_batches, written

MIN_LENGTH, MIN_COUNT = 5, 3
#: Of the runs whose hash this divides, one code point is dropped.
DROP = 97
#: Words that a task counts before it hands them on.
MEMO = 400_000

#: Letters of runs as bytes of Latin-1, A-Z lower-cased; everything else is a blank.
_LETTERS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0xC0 else 0x20 for c in range(256)
)


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[bytes, int]]:
    """(word as Latin-1, occurrences) of a text's runs of ``MIN_LENGTH`` code points or more, once dropped what is to be dropped."""
    prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    # Whatever is no Latin-1 becomes a question mark, which is no letter.
    for word, n in Counter(text.encode("latin-1", "replace").translate(_LETTERS).split()).items():
        if len(word) < MIN_LENGTH:
            continue
        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), prefix)
        if h % DROP == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < MIN_LENGTH:
                continue
        yield word, n


def counted(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text) with at least ``MIN_COUNT`` occurrences."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def partial() -> Iterator[tuple[str, int]]:
            total: Counter[bytes] = Counter()
            for batch in batches:
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                    for word, n in words_of(doc_id, text):
                        total[word] += n
                    if len(total) > MEMO:
                        yield from ((w.decode("latin-1"), n) for w, n in total.items())
                        total.clear()
            yield from ((w.decode("latin-1"), n) for w, n in total.items())

        return record_batches(partial(), schema)

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# the tries -------------------------------------------------------------------------

#: Lengths from here on share a bit, and so do code points with one remainder.
_LONGEST, _POINTS = 62, 63
_END = -1


def _prefixes(words: DataFrame) -> DataFrame:
    """(id, back, depth, node, next) of every prefix of two code points or more of both spellings; ``next`` is -1 at the end."""
    schema = pa.schema(
        [("id", pa.int64()), ("back", pa.bool_()), ("depth", pa.int32()), ("node", pa.int64()), ("next", pa.int32()), ("left", pa.int32())]
    )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for number, word in zip(*(c.to_pylist() for c in batch.columns)):
                    for back in (False, True):
                        s = word[::-1] if back else word
                        hashed, size = xxhash.xxh64(s[:1].encode(), seed=back), len(s)
                        for depth in range(2, size + 1):
                            hashed.update(s[depth - 1].encode())
                            node = hashed.intdigest() - (1 << 63)
                            yield number, back, depth, node, ord(s[depth]) if depth < size else _END, size - depth

        return record_batches(rows(), schema, 1 << 15)

    return words.select("id", "word").mapInArrow(spread, "id long, back boolean, depth int, node long, next int, left int")


def _bit(number: Column, below: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), number % below)


def _paths(words: DataFrame) -> DataFrame:
    """(id, spelt, back, path) of both spellings of every word, with the nodes on its way where words part or end, in order."""
    prefixes = written(_prefixes(words))
    nodes = (
        prefixes.groupBy("node")
        .agg(
            F.min("next").alias("low"), F.max("next").alias("high"), F.min(F.when(F.col("next") >= 0, F.col("next"))).alias("least"),
            F.bit_or(_bit(F.least("left", F.lit(_LONGEST)), _LONGEST + 1)).alias("lengths"),
            F.bit_or(F.when(F.col("next") >= 0, _bit(F.col("next"), _POINTS)).otherwise(F.lit(0).cast("long"))).alias("nexts"),
        )
        .where("low < high or low = -1")
        .select("node", (F.col("low") == _END).alias("ends"), (F.col("least") < F.col("high")).alias("parts"), "lengths", "nexts")
    )
    stops = prefixes.select("id", "back", "depth", "node").join(nodes, "node")
    # No more nodes than code points of the word.
    paths = stops.groupBy("id", "back").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "ends", "parts", "lengths", "nexts"))).alias("path"))
    spelt = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    return written(paths.join(words.select("id", "word"), "id").select("id", spelt.alias("spelt"), "back", "path"))


def _edges(paths: DataFrame) -> DataFrame:
    """(level, node, label, child, ends, lengths, nexts), in the order of the levels."""
    both = "zip_with(slice(path, 1, size(path) - 1), slice(path, 2, size(path) - 1), (low, high) -> struct(low, high))"
    steps = paths.select("spelt", F.posexplode(F.expr(both)).alias("level", "step"))
    rows = steps.select(
        "level", F.col("step.low.node").alias("node"),
        F.expr("substring(spelt, step.low.depth + 1, step.high.depth - step.low.depth)").alias("label"),
        F.col("step.high.node").alias("child"), F.col("step.high.ends").alias("ends"),
        F.col("step.high.lengths").alias("lengths"), F.col("step.high.nexts").alias("nexts"),
    ).distinct()
    # In this order a level is in few files, and the others' are skipped by their footers.
    return written(rows.repartitionByRange("level", "node").sortWithinPartitions("level", "node"))


_STATE = ("spelt", "back", "at", "point", "inserted", "position", "node")


def _unedited(paths: DataFrame) -> DataFrame:
    """(level, state) of every word at the nodes of its own path from its middle on, no edit made: ``at`` is null."""
    half = F.expr("if(back, length(spelt) - length(spelt) div 2, length(spelt) div 2)")
    rows = paths.select("spelt", "back", half.alias("half"), F.posexplode("path").alias("level", "stop"))
    # Where words only end, there is no other branch, but for a word that ends itself.
    rows = rows.where("stop.depth >= half and (stop.parts or (stop.nexts <> 0 and stop.depth = length(spelt)))")
    state = {
        "at": F.lit(None).cast("int"), "point": F.lit(None).cast("string"), "inserted": F.lit(False),
        "position": F.col("stop.depth"), "node": F.col("stop.node"),
    }
    rows = rows.select("level", "spelt", "back", *[c.alias(n) for n, c in state.items()])
    return written(rows.repartitionByRange("level", "node").sortWithinPartitions("level", "node"))


def _advanced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one edge, all with their edit, and ``over`` where word and edge end with a word."""
    joined = states.join(edges.withColumnRenamed("node", "edge_node"), F.col("node") == F.col("edge_node"))
    rest, size = F.expr("substring(spelt, position + 1)"), F.length("label")
    tail, unedited = F.expr("substring(label, 2)"), F.col("at").isNull()
    first, branch = F.substring(rest, 1, 1), F.substring("label", 1, 1)

    def goes_on(position: Column) -> Column:
        left = F.length("spelt") - position
        length = F.col("lengths").bitwiseAND(_bit(F.least(left, F.lit(_LONGEST)), _LONGEST + 1)) != 0
        point = F.ascii(F.substring(F.col("spelt"), position + 1, F.lit(1)))
        return F.when(left == 0, F.col("ends")).otherwise(length & (F.col("nexts").bitwiseAND(_bit(point, _POINTS)) != 0))

    # A replaced code point uses up one of the word, an inserted one none. One way suffices for replacing.
    matched = ~unedited & F.startswith(rest, F.col("label"))
    replaced = unedited & (rest != "") & (first < branch) & F.startswith(F.expr("substring(spelt, position + 2)"), tail)
    inserted = unedited & (first != branch) & F.startswith(rest, tail)
    whole = (matched | replaced) & goes_on(F.col("position") + size)
    less = inserted & goes_on(F.col("position") + size - 1)
    # Most rows end here, before anything is made of them.
    rows = joined.select("*", whole.alias("whole"), less.alias("less")).where("whole or less")
    kinds = F.when(F.expr("whole and less"), F.array(F.lit(0), F.lit(1))).when(F.col("whole"), F.array(F.lit(0))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("short", F.explode(kinds))
    position = (F.col("position") + size - F.col("short")).alias("position")
    return rows.select(
        "spelt", "back", F.when(unedited, F.col("position")).otherwise(F.col("at")).alias("at"),
        F.when(unedited, branch).otherwise(F.col("point")).alias("point"),
        F.when(unedited, F.col("short") == 1).otherwise(F.col("inserted")).alias("inserted"),
        position, F.col("child").alias("node"), (F.length("spelt") == F.col("position") + size - F.col("short")).alias("over"),
    )


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near): both ways, every pair of ``words`` (id, word, n) that are one edit apart."""
    paths = _paths(words)
    edges, own = _edges(paths), _unedited(paths)
    last = edges.agg(F.max("level")).first()[0]
    found, moving = [], None
    for level in range((last or 0) + 1):
        states = own.where(F.col("level") == level).select(*_STATE)
        if moving is not None:
            states = states.unionByName(moving)
        after = written(_advanced(states, edges.where(F.col("level") == level).drop("level")))
        found.append(after.where("over"))
        moving = after.where("not over").drop("over")
    reached = found[0]
    for more in found[1:]:
        reached = reached.unionByName(more)
    other = F.expr("concat(substring(spelt, 1, at), point, substring(spelt, at + if(inserted, 1, 2)))")
    ends = reached.select(*[F.when(F.col("back"), F.reverse(c)).otherwise(c).alias(n) for c, n in ((F.col("spelt"), "word"), (other, "near"))])
    ends = ends.distinct()
    return ends.unionByName(ends.select(F.col("near").alias("word"), F.col("word").alias("near")))


# forms -----------------------------------------------------------------------------


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms of ``forms`` (word, form) end; every round doubles the way, which halves as n doubles."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        after = now.select(F.col("word").alias("middle"), F.col("root").alias("further"))
        ahead = now.join(after, now["root"] == F.col("middle"), "left")
        now = written(ahead.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the frequent words of ``docs`` (doc_id, text)."""
    words = written(numbered(counted(docs), "id"))
    pairs = near_pairs(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    around = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.select("word", "n").join(around, "word", "left").select("word", "n", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    wins = F.col("near_n") >= 2 * F.col("n")
    rows = written(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(wins, F.col("near")).alias("form"), F.when(wins, F.col("near_n")).alias("form_n"),
        )
    )
    roots = _rooted(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
