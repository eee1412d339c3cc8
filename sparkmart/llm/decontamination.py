"""Benchmark decontamination by template windows, with DataFrame functions alone.

Texts become templates: numbers, units behind them and names (capitalised words inside a
sentence) turn into typed placeholders, the rest into lower-case words. Windows of five
template words are hash-joined with those of the benchmark, so a question is found with
other numbers or names too. Slots must be consistent: along one alignment, within the windows
that matched there, each value of the item stands for one value of the document and the other
way round. Windows of other alignments do not count.

Capitals mark names, so a text in upper or title case has hardly a template word that is
none. So windows are searched a second way too, case-free: names stay lower-cased words, only
numbers and units are placeholders. A text without names has the same windows either way.

A document leaks an item if, either way, it holds at least ``CONTAINMENT`` of the item's windows, or
``LONG_RUN`` of them, in consistent alignments, or if the windows of one consistent alignment
cover ``COVERED`` of the words that the item's windows cover, or if along one of them ``AGREED`` of
the item's words agree (those that are no placeholders, ``AGREEING`` or more). The last two count
words, as each replaced word breaks five windows, which are many of a short item.

A stem that many items share, as "which of the following best", may occur in as many documents,
and the two must not meet. So texts first meet the distinct windows only. Each item has key
windows: those that the fewest items have, without which it cannot leak by windows. Documents and
items with a common key are candidates, and only for them the other windows are counted and the
words compared. So a stem costs pairs only where it is three quarters of its items.

* Windows with fewer than ``LITERALS`` words that are no placeholders are searched with their
  lower-cased words and numbers as they are, case-free only. An item of fewer than five words is
  one such window, so each text that holds it leaks it, even where it is a single word.
* A null or empty text leaks nothing.
* Equal rows get equal verdicts; null ids are kept apart by their texts. Empty tables of
  documents or items are fine. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import fresh, written

WIDTH, LITERALS = 5, 3
CONTAINMENT, LONG_RUN, COVERED = 0.75, 20, 0.75
AGREED, AGREEING = 0.75, 10
#: A benchmark with more windows is joined by shuffle; below, it takes 24 bytes a window in every executor.
BROADCAST_WINDOWS = 1_000_000
#: As many documents' keys, 24 bytes each, are broadcast at most.
BROADCAST_DOCUMENTS = 1_000_000

NUMBER, NAME, UNIT = "0", "1", "2"
TEMPLATE, CASE_FREE = 0, 1
_UNITS = "km|cm|mm|m|kg|mg|g|t|ml|l|s|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|ft|inch(?:es)?|pounds?|lbs?|ounces?|oz|dollars?|euros?|usd|eur|cents?|percent"
_RAW = r"\p{N}+(?:[.,]\p{N}+)*|\p{L}+"


def template(text: Column) -> Column:
    """The template words of a text: placeholders are digits, as no other digit is left."""
    return _words(F.regexp_replace(_without_numbers(text), r"(?<=[\p{L}\p{N},;:]\x20)\p{Lu}\p{L}+", NAME))


def case_free(text: Column) -> Column:
    """The template words, one for one, but with names as lower-cased words."""
    return _words(_without_numbers(text))


def _without_numbers(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\p{N}+(?:[.,]\p{N}+)*", NUMBER)


def _words(text: Column) -> Column:
    text = F.regexp_replace(text, rf"(?<=0|0\x20)(?i:{_UNITS})(?!\p{{L}})", UNIT)
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+|[012]"), F.lit(0))


def raw_words(text: Column) -> Column:
    """The words that the template's words stand for, one for one."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_RAW), F.lit(0))


def _windows(words: str, raw: str = "") -> Column:
    """Hashes of all windows; with ``raw``, which may be empty, those of few literals have the hash of their raw words."""
    literal = f"xxhash64(slice({words}, i, {WIDTH}))"
    few = f"size(filter(slice({words}, i, {WIDTH}), w -> w in ('0', '1', '2'))) > {WIDTH - LITERALS}"
    either = f"if(size({raw}) > 0 and {few}, xxhash64(1, slice({raw}, i, {WIDTH})), {literal})" if raw else literal
    return F.expr(
        f"if(size({words}) < {WIDTH}, cast(array() as array<bigint>), "
        f"transform(sequence(1, size({words}) - {WIDTH - 1}), i -> {either}))"
    )


def _lower_raw(text: Column) -> Column:
    return raw_words(F.lower(text))


def _item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, way, at, hash, template, raw) of each window that is searched, ``way`` being ``TEMPLATE`` or ``CASE_FREE``."""
    text = F.col("text")
    ways = F.array(
        F.struct(F.lit(TEMPLATE).alias("way"), template(text).alias("words")),
        F.struct(F.lit(CASE_FREE).alias("way"), case_free(text).alias("words")),
    )
    items = benchmark.select("item_id", _lower_raw(text).alias("raw"), F.explode(ways).alias("as")).select("item_id", "raw", "as.*")
    exact = F.when(F.size("raw").between(1, WIDTH - 1), F.array(F.expr("xxhash64(1, raw)"))).otherwise(_windows("words", "raw"))
    hashes = F.when(F.col("way") == CASE_FREE, exact).otherwise(_windows("words"))
    every = items.select("item_id", "way", "words", "raw", F.posexplode(hashes).alias("at", "hash"))
    cut = every.select(
        "item_id", "way", "at", "hash",
        F.expr(f"slice(words, at + 1, {WIDTH})").alias("template"),
        F.expr(f"slice(raw, at + 1, {WIDTH})").alias("raw"),
    )
    enough = F.expr(f"size(filter(template, w -> w not in ('0', '1', '2'))) >= {LITERALS}")
    return cut.where((F.col("way") == CASE_FREE) | enough)


def _doc_windows(docs: DataFrame, short: list[int]) -> DataFrame:
    """(doc_id, text_hash, at, hash) of the windows of both ways, once where they are the same, and of all of ``short`` words."""
    text, none = F.col("text"), F.expr("cast(array() as array<string>)")
    words = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), template(text).alias("words"))
    plain = words.withColumn("named", F.array_contains("words", NAME)).withColumn(
        "plain", F.when(F.col("named"), case_free(text)).otherwise(F.col("words"))
    )
    many = F.expr(f"size(filter(plain, w -> w in ('0', '2'))) > {WIDTH - LITERALS}")
    raw = plain.withColumn("raw", F.when(many, _lower_raw(text)).otherwise(none))
    two = F.when(F.col("named") | (F.size("raw") > 0), _windows("plain", "raw")).otherwise(F.expr("cast(array() as array<bigint>)"))
    hashed = raw.select("doc_id", "text_hash", _windows("words").alias("one"), two.alias("two"))
    both = F.expr("concat(one, transform(two, (h, i) -> if(h = get(one, i), null, h)))")
    found = hashed.select("doc_id", "text_hash", F.size("one").alias("n"), F.posexplode(both).alias("place", "hash"))
    at = F.when(F.col("place") < F.col("n"), F.col("place")).otherwise(F.col("place") - F.col("n"))
    found = found.where("hash is not null").select("doc_id", "text_hash", at.alias("at"), "hash")
    for width in short:
        runs = F.expr(
            f"if(size(raw) < {width}, cast(array() as array<bigint>), "
            f"transform(sequence(1, size(raw) - {width - 1}), i -> xxhash64(1, slice(raw, i, {width}))))"
        )
        raw = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lower_raw(text).alias("raw"))
        found = found.unionByName(raw.select("doc_id", "text_hash", F.posexplode(runs).alias("at", "hash")))
    return found


def _keys(item_windows: DataFrame, sizes: DataFrame) -> DataFrame:
    """(hash, item_id, way): of each item the windows of which a leak holds at least one, those of the fewest items.

    Windows that more items have than a bound are left out, the bound being the least one for which
    those left out are no leak by themselves, whatever their alignment: they are fewer than
    ``CONTAINMENT`` and ``LONG_RUN`` ask for, and cover fewer words than ``COVERED``.
    """
    often = item_windows.groupBy("hash").agg(F.count_distinct("item_id").alias("often"))
    every = item_windows.select("item_id", "way", "at", "hash").join(often, "hash")
    # The words that windows above a bound cover are those of which some window is above it.
    words = every.select("item_id", "way", F.explode(F.sequence("at", F.col("at") + WIDTH - 1)).alias("word"), "often")
    words = words.groupBy("item_id", "way", "word").agg(F.max("often").alias("often"))

    def ordered(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("item_id", "way").agg(F.sort_array(F.collect_list("often"), False).alias(name))

    bounds = ordered(words, "by_word").join(ordered(every.select("item_id", "way", "hash", "often").distinct(), "by_window"), ["item_id", "way"])
    least_words = F.expr(f"greatest(1, int(ceil({COVERED} * item_words)))")
    least_windows = F.expr(f"greatest(1, least({LONG_RUN}, int(ceil({CONTAINMENT} * item_windows))))")
    bound = F.greatest(F.get("by_word", least_words - 1), F.get("by_window", least_windows - 1)).alias("bound")
    bounds = bounds.join(sizes, ["item_id", "way"]).select("item_id", "way", bound)
    return every.join(bounds, ["item_id", "way"]).where("often <= bound").select("hash", "item_id", "way").distinct()


def _known_size(rows: DataFrame, bound: int) -> DataFrame:
    """``rows`` of a written table, broadcast if they are no more than ``bound``."""
    return F.broadcast(rows) if rows.limit(bound + 1).count() <= bound else rows


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, containment, reparameterised) for each item that a document leaks.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; ``text_hash`` is ``xxhash64(text)``.
    """
    item_windows = written(_item_windows(benchmark))
    sizes = item_windows.groupBy("item_id", "way").agg(
        F.count_distinct("hash").alias("item_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + WIDTH - 1))))).alias("item_words"),
    )
    # Each window of a text meets one row at most, however many items have it.
    search = _known_size(written(item_windows.select("hash").distinct()), BROADCAST_WINDOWS)
    # At most four rows: the widths of the items that are shorter than a window.
    widths = benchmark.select(F.size(_lower_raw(F.col("text"))).alias("n")).where(F.col("n").between(1, WIDTH - 1)).distinct()
    found = _doc_windows(docs, [r.n for r in widths.collect()]).join(search, "hash")
    hits = written(found.select("doc_id", "text_hash", "at", "hash").distinct())
    keys = _known_size(written(_keys(item_windows, sizes)), BROADCAST_WINDOWS)
    candidates = written(hits.join(keys, "hash").select("doc_id", "text_hash", "item_id", "way").distinct())
    theirs = hits.select(F.col("doc_id").alias("their_id"), F.col("text_hash").alias("their_hash"), F.col("hash").alias("their_window"), "at")
    expected = candidates.join(item_windows.select("item_id", "way", "hash", F.col("at").alias("item_at")).distinct(), ["item_id", "way"])
    both = expected.join(theirs, _same_document() & (F.col("hash") == F.col("their_window")))
    # Per alignment first, then per document and item; both sums start before the shuffle.
    aligned = both.groupBy("doc_id", "text_hash", "item_id", "way", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.collect_set("item_at").alias("places"), F.collect_set("hash").alias("hashes")
    )
    alignments = aligned.groupBy("doc_id", "text_hash", "item_id", "way").agg(
        F.collect_list(F.struct("shift", "places", "hashes")).alias("alignments")
    )
    # Only documents with a candidate are read word by word again; their texts alone are shuffled.
    ids = candidates.select(F.col("doc_id").alias("near_id"), F.col("text_hash").alias("near_hash")).distinct()
    near = _known_size(written(ids), BROADCAST_DOCUMENTS)
    hashed = docs.select(F.col("doc_id").alias("their_id"), F.xxhash64("text").alias("their_hash"), "text")
    read = hashed.join(near, F.col("their_id").eqNullSafe(F.col("near_id")) & (F.col("their_hash") == F.col("near_hash")), "left_semi")
    # Words once per document, below the join: above it they would be made anew for each word looked up.
    text = F.col("text")
    texts = read.dropDuplicates(["their_id", "their_hash"]).select(
        "their_id", "their_hash", template(text).alias("as_template"), case_free(text).alias("as_words"), raw_words(text).alias("raw")
    )
    judged = _judged(alignments.join(texts, _same_document()), benchmark, item_windows, sizes)
    best = F.max(F.struct("containment", "n_windows"))
    return (
        judged.groupBy("doc_id", "text_hash", "item_id")
        .agg(best.alias("best"), F.min("reparameterised").alias("reparameterised"))
        .select("doc_id", "text_hash", "item_id", "best.n_windows", "best.containment", "reparameterised")
    )


def _same_document() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("their_id")) & (F.col("text_hash") == F.col("their_hash"))


def _judged(found: DataFrame, benchmark: DataFrame, item_windows: DataFrame, sizes: DataFrame) -> DataFrame:
    """The leaks among ``found`` (a document's alignments with an item, and its words), judged by its consistent alignments."""
    slots = F.expr(
        "filter(transform(template, (w, i) -> named_struct('kind', w, 'place', at + i, 'value', lower(raw[i]))), s -> s.kind in ('0', '1', '2'))"
    )
    values = item_windows.groupBy("item_id", "way").agg(F.array_distinct(F.flatten(F.collect_list(slots))).alias("slots"))
    text = F.col("text")
    ways = F.array(
        F.struct(F.lit(TEMPLATE).alias("way"), template(text).alias("item")), F.struct(F.lit(CASE_FREE).alias("way"), case_free(text).alias("item"))
    )
    items = benchmark.select("item_id", F.explode(ways).alias("as")).select("item_id", "as.*").dropDuplicates(["item_id", "way"])
    literal = F.expr("filter(transform(item, (w, i) -> struct(i as place, w as word)), l -> l.word not in ('0', '1', '2'))")
    about = items.select("item_id", "way", literal.alias("literals")).join(values, ["item_id", "way"]).join(sizes, ["item_id", "way"])
    read = found.join(about, ["item_id", "way"]).withColumn("words", F.when(F.col("way") == TEMPLATE, F.col("as_template")).otherwise(F.col("as_words")))
    kept = ("doc_id", "text_hash", "item_id", "way", "item_windows", "item_words", "literals")
    # Values as hashes: of the item's, of the document's, and of the two together.
    pairs = F.expr(
        f"""transform(alignments, a -> struct(a.shift, a.places, a.hashes, transform(
            filter(slots, s -> exists(a.places, p -> s.place between p and p + {WIDTH - 1})),
            s -> struct(xxhash64(s.kind, s.value) as item, xxhash64(s.kind, lower(get(raw, s.place + a.shift))) as doc)) as pairs,
            size(filter(literals, l -> get(words, l.place + a.shift) = l.word)) as agreeing))"""
    )
    one_to_one = F.expr(
        """filter(judged, a -> size(array_distinct(transform(a.pairs, p -> xxhash64(p.item, p.doc)))) = size(array_distinct(a.pairs.item))
            and size(array_distinct(a.pairs.item)) = size(array_distinct(a.pairs.doc)))"""
    )
    consistent = read.select(*kept, pairs.alias("judged")).select(*kept, one_to_one.alias("alignments"))
    n_windows = F.size(F.array_distinct(F.flatten("alignments.hashes")))
    covered = F.expr(
        f"array_max(transform(alignments, a -> size(array_distinct(flatten(transform(a.places, p -> sequence(p, p + {WIDTH - 1})))))))"
    )
    enough = (
        (F.col("containment") >= CONTAINMENT) | (F.col("n_windows") >= LONG_RUN) | (covered >= COVERED * F.col("item_words"))
        | ((F.size("literals") >= AGREEING) & (F.array_max("alignments.agreeing") >= AGREED * F.size("literals")))
    )
    other = F.expr(
        """exists(alignments, a -> size(a.hashes) = array_max(transform(alignments, b -> size(b.hashes)))
            and exists(a.pairs, p -> p.item <> p.doc))"""
    )
    rows = consistent.where("size(alignments) > 0").withColumn("n_windows", n_windows)
    rows = rows.withColumn("containment", F.col("n_windows") / F.col("item_windows")).where(enough)
    return rows.select("doc_id", "text_hash", "item_id", "way", "n_windows", "containment", other.alias("reparameterised"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_ids) of the distinct documents that leak an item."""
    return leaks(docs, benchmark).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def joined(docs: DataFrame, benchmark: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``contaminated``, of whose columns ``item_ids`` may stay; null ids meet null ids."""
    leaky_id, leaky_hash, items = (fresh(docs, n) for n in ("leaky_id", "leaky_hash", "item_ids"))
    found = written(contaminated(docs, benchmark).toDF(leaky_id, leaky_hash, items))
    # Few documents leak, so the texts need not move; items count, as a row lists all of a document's.
    size = found.agg(F.sum(F.size(items) + 2)).first()[0] or 0
    if size <= BROADCAST_DOCUMENTS:
        found = F.broadcast(found)
    same = F.col("doc_id").eqNullSafe(F.col(leaky_id)) & (F.xxhash64("text") == F.col(leaky_hash))
    return docs.join(found, same, how).drop(leaky_id, leaky_hash)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that leak no item."""
    return joined(docs, benchmark, "left_anti")
