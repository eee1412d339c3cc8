"""Document fingerprints that add up: a multiset hash of paragraphs, as a wide vector of lanes.

A text is the multiset of its paragraphs (lines). Each paragraph hashes to a vector, and a
fingerprint is the sum of the vectors, lane by lane modulo a power of two. So the order of
paragraphs does not matter, a paragraph is inserted or deleted by adding or subtracting its
vector (``plus``, ``minus``), and fingerprints of parts add up to that of the whole.

Of a paragraph's lanes ``EXACT`` come from hashes of the whole paragraph, modulo 2**32: they
tell whether two multisets are equal. ``LANES`` more come from its pairs of neighbouring words,
modulo 2**16: each pair adds 1 or -1 to each of them, as the bits of its hash say. Of two sums
of such vectors the cosine estimates that of the pair counts, with an error of about
1 / sqrt(LANES), so these tell how alike two texts are (``likeness``).

Everything is DataFrame functions: paragraphs and pairs are exploded and summed, two lanes in
one 64-bit sum, without a shuffle where rows lie together by their key already.

* A null text counts as empty; the empty text is one empty paragraph, and has no pair.
* Equal fingerprints are alike by 1; a text without words is unlike (0) any other.
* ``edited`` counts rows of equal id and text as one document in the order, and returns each.
  Different texts of one id follow by their hash. Null ids come last. The only document is its
  own next one. An empty table gives no row.
* Other columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import written
from sparkmart.operators.keys import assign_keys

EXACT, LANES = 8, 64
_LOW = 0xFFFFFFFF
#: Bit 0 and bit 32: two counters in one long.
_TWO = 0x100000001


# vectors ---------------------------------------------------------------------------


def summed(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, vector) of all paragraphs of the texts of a key; a null text has none."""
    lines = rows.select(*keys, F.explode(F.split(text, "\n", -1)).alias("paragraph"))
    hashed = lines.select(
        *keys, *[F.xxhash64(F.lit(k), "paragraph").alias(f"e{k}") for k in range(EXACT // 2)], F.split("paragraph", " ", -1).alias("words")
    )
    # The word before and the word; nothing behind the last word, which adds nothing.
    pair = F.zip_with(
        F.concat(F.array(F.lit("")), "words"), "words", lambda a, b: F.when(b != "", F.xxhash64(a, b))
    )
    units = hashed.select(*keys, *[f"e{k}" for k in range(EXACT // 2)], F.posexplode(pair).alias("place", "pair"))
    once = F.col("place") == 0
    halves = [h for k in range(EXACT // 2) for h in (F.col(f"e{k}").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(f"e{k}", 32))]
    sums = units.groupBy(*keys).agg(
        F.count("pair").alias("pairs"),
        *[F.sum(F.when(once, h).otherwise(F.lit(0).cast("long"))).alias(f"x{k}") for k, h in enumerate(halves)],
        *[F.sum(F.shiftright("pair", k).bitwiseAND(F.lit(_TWO))).alias(f"s{k}") for k in range(LANES // 2)],
    )
    bits = [F.coalesce(F.col(f"s{k}"), F.lit(0).cast("long")) for k in range(LANES // 2)]
    counts = [b.bitwiseAND(F.lit(_LOW)) for b in bits] + [F.shiftrightunsigned(b, 32) for b in bits]
    return sums.select(
        *keys,
        F.struct(
            F.array(*[F.col(f"x{k}").bitwiseAND(F.lit(_LOW)) for k in range(EXACT)]).alias("exact"),
            F.array(*[(2 * c - F.col("pairs")).bitwiseAND(F.lit(0xFFFF)) for c in counts]).alias("lanes"),
        ).alias("vector"),
    )


def _lane_by_lane(a: Column, b: Column, sign: int) -> Column:
    def of(name: str, mask: int) -> Column:
        return F.zip_with(a[name], b[name], lambda x, y: (x + sign * y).bitwiseAND(F.lit(mask))).alias(name)

    return F.struct(of("exact", _LOW), of("lanes", 0xFFFF))


def plus(a: Column, b: Column) -> Column:
    """The vector with the paragraphs of both."""
    return _lane_by_lane(a, b, 1)


def minus(a: Column, b: Column) -> Column:
    """The vector of ``a`` without the paragraphs of ``b``."""
    return _lane_by_lane(a, b, -1)


def as_text(vector: Column) -> Column:
    """The vector in hexadecimal digits."""
    exact = F.transform(vector["exact"], lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    lanes = F.transform(vector["lanes"], lambda x: F.lpad(F.lower(F.hex(x)), 4, "0"))
    return F.array_join(F.concat(exact, lanes), "")


def likeness(a: Column, b: Column) -> Column:
    """How alike the texts of two vectors are, from 0 to 1."""

    def signed(vector: Column) -> Column:
        return F.transform(vector["lanes"], lambda x: F.when(x < 0x8000, x).otherwise(x - 0x10000))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(signed(x), signed(y), lambda p, q: p * q), F.lit(0).cast("long"), lambda s, p: s + p)

    both = F.sqrt(dot(a, a).cast("double") * dot(b, b).cast("double"))
    cosine = F.when(both > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot(a, b) / both))).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, vector) of every distinct pair of id and text of ``docs``."""
    rows = _keyed(docs).dropDuplicates(KEYS)
    return summed(rows, KEYS, "text").select(F.when(~F.col("unknown"), F.col("id")).alias("doc_id"), as_text(F.col("vector")).alias("fingerprint"), "vector")


# edited texts ----------------------------------------------------------------------

KEYS = ["unknown", "id", "hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    """(unknown, id, hash, text): what tells documents apart, without nulls."""
    text = F.coalesce("text", F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.isNull().alias("unknown"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")
    )


def _links(docs: DataFrame) -> DataFrame:
    """(keys, n_chars, next_keys) of every document; the next one by descending id, of the last the first."""
    sized = _keyed(docs).select(*KEYS, F.length("text").cast("long").alias("n_chars")).distinct()
    place = F.struct("unknown", F.bitwise_not("id"), "hash")  # not(id) descends, and never overflows
    rows = written(assign_keys(sized.withColumn("place", place), "place", "number", -1).drop("place"))
    total = rows.count()
    after = rows.select(F.col("number").alias("next_number"), *[F.col(k).alias(f"next_{k}") for k in KEYS])
    here = rows.withColumn("next_number", F.pmod(F.col("number") + 1, F.lit(max(total, 1))))
    return written(here.join(after, "next_number").drop("number", "next_number"))


def _same(left: dict[str, Column], right: dict[str, Column]) -> Column:
    return (left["unknown"] == right["unknown"]) & (left["id"] == right["id"]) & (left["hash"] == right["hash"])


def edited(docs: DataFrame) -> DataFrame:
    """Every document, and the text that has the start of the next one in place of its second half.

    (doc_id, n_chars, edited_sha256, vector, edited_vector, next_vector). The parts before the
    paragraph with the cut are hashed once for both texts, as vectors add up.
    """
    links = _links(docs)
    # Both uses read the same shuffle of the texts by their keys.
    texts = _keyed(docs).dropDuplicates(KEYS)
    owners = links.select(*[F.col(k).alias(f"own_{k}") for k in KEYS], F.expr("n_chars div 2").alias("cut"), *[f"next_{k}" for k in KEYS])
    heads = texts.join(owners, [F.col(k) == F.col(f"next_{k}") for k in KEYS]).select(
        *[f"own_{k}" for k in KEYS], F.expr("substring(text, 1, cut)").alias("head")
    )
    pairs = texts.join(heads, [F.col(k) == F.col(f"own_{k}") for k in KEYS])
    pairs = pairs.select(*KEYS, "text", F.expr("concat(substring(text, 1, length(text) - length(text) div 2), head)").alias("edited"))
    # The paragraphs before that with the cut are the same in both.
    kept = "substring(text, 1, length(text) - length(text) div 2)"
    pairs = pairs.withColumn("common", F.expr(f"length({kept}) - length(substring_index({kept}, '\\n', -1))"))
    parts = F.array(
        F.struct(F.lit(True).alias("own"), F.lit(True).alias("new"), F.expr("if(common > 0, substring(text, 1, common - 1), null)").alias("part")),
        F.struct(F.lit(True).alias("own"), F.lit(False).alias("new"), F.expr("substring(text, common + 1)").alias("part")),
        F.struct(F.lit(False).alias("own"), F.lit(True).alias("new"), F.expr("substring(edited, common + 1)").alias("part")),
    )
    digest = F.sha2("edited", 256).alias("edited_sha256")
    rows = pairs.select(*KEYS, F.length("text").cast("long").alias("n_chars"), digest, F.explode(parts).alias("of")).select(
        *KEYS, "n_chars", "edited_sha256", "of.*"
    )
    keys = [*KEYS, "n_chars", "edited_sha256"]
    vectors = summed(rows, [*keys, "own", "new"], "part")
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), EXACT).alias("exact"), F.array_repeat(F.lit(0).cast("long"), LANES).alias("lanes"))

    def of(condition: str, name: str) -> Column:
        # At most three parts, each without more than a vector.
        return F.coalesce(F.max(F.when(F.expr(condition), F.col("vector"))), zero).alias(name)

    three = vectors.groupBy(*keys).agg(of("own and new", "both"), of("not new", "old"), of("not own", "fresh"))
    found = written(
        three.select(*keys, plus(F.col("both"), F.col("old")).alias("vector"), plus(F.col("both"), F.col("fresh")).alias("edited_vector"))
    )
    after = found.select(*[F.col(k).alias(f"next_{k}") for k in KEYS], F.col("vector").alias("next_vector"))
    whole = found.join(links.drop("n_chars"), KEYS).join(after, [f"next_{k}" for k in KEYS])
    result = whole.select(*KEYS, "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector")
    # One row again for each row of the table.
    each = _keyed(docs).select(*KEYS)
    return each.join(result, KEYS).select(
        F.when(~F.col("unknown"), F.col("id")).alias("doc_id"), "n_chars", "edited_sha256", "vector", "edited_vector", "next_vector"
    )
