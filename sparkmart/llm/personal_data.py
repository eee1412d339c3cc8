"""Personal data in whole texts, with DataFrame functions alone.

Patterns propose spans, checks confirm them (parts of an address, Luhn for cards,
mod 97 for account numbers, digit counts), and words near a span raise or lower its
score. The base kinds email, ip, card and phone stay whatever their score; the added
kinds iban, national_id, local_phone, secret and access_key need a score of ``LEAST_SCORE``. A
secret is what is assigned to a name such as token or password and looks random, an access
key what has the form of a known kind of key.

The patterns find what their plain forms find, leftmost and without overlap, but start
a run of characters only at its begin and never go back into it, so that no text, however
odd, takes deep recursion. Matches are placed block by block, and context is read from chunks of the
text, so the work grows with the 3/2 power of the matches of a text at most, and not with their square.

* A null or empty text has no spans. Equal rows get equal results; a null id stays null;
  an empty table gives no row. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT = 40
LEAST_SCORE = 0.6


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: Spark SQL on ``hit``, true if the text matched is one.
    check: str
    #: What the text as a whole must hold for the pattern to be tried.
    needs: str
    score: float
    context: str
    base: bool = True


_DIGITS = "regexp_replace(hit, '[^0-9]', '')"
_LUHN = f"""
    length({_DIGITS}) between 12 and 19 and
    aggregate(sequence(1, length({_DIGITS})), 0, (sum, i) -> sum +
        if(i % 2 = 1, int(substr({_DIGITS}, -i, 1)),
           int(substr({_DIGITS}, -i, 1)) * 2 - if(int(substr({_DIGITS}, -i, 1)) > 4, 9, 0))) % 10 = 0"""
#: Letters count as 10 to 35, the first four characters come last.
_MOD_97 = """
    length(replace(hit, ' ', '')) between 15 and 34 and
    aggregate(split(concat(substr(replace(hit, ' ', ''), 5), substr(replace(hit, ' ', ''), 1, 4)), ''), 0,
        (rest, c) -> if(c = '', rest, if(c between '0' and '9', rest * 10 + int(c), rest * 100 + ascii(c) - 55) % 97)) = 1"""

#: In the order in which spans of one place are listed.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "true", "contains(text, '@')", 0.9, "e-?mail|contact|kontakt|correo|courriel",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"hit rlike '^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})([.]0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$'",
        r"text rlike '[0-9][.][0-9]'", 0.7, "\\bip\\b|address|adresse|server|host|login",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _LUHN, r"text rlike '[0-9][0-9 -]{10}'", 0.8, "card|karte|tarjeta|carte|visa|credit|pay"),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15",
        r"text rlike '[+][0-9]'", 0.8, "phone|call|tel|mobile|fax|whatsapp",
    ),
    Kind(
        "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _MOD_97,
        r"text rlike '[A-Z]{2}[0-9]{2}'", 0.9, "iban|konto|account|cuenta|compte|bank", base=False,
    ),
    Kind(
        "national_id", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "true",
        r"text rlike '[0-9]-[0-9]{2}-[0-9]'", 0.4, "ssn|social security|national id|tax id|identity", base=False,
    ),
    Kind(
        "local_phone", r"(?<![0-9+)(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])", "true",
        r"text rlike '[0-9][.-][0-9]{4}'", 0.5, "phone|call|tel|mobile|fax|whatsapp|number", base=False,
    ),
    Kind(
        "secret",
        r"(?<=(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|private[_-]?key)[\x22\x27]?\s{0,2}[:=]{1,2}\s{0,2}[\x22\x27]?)[A-Za-z0-9_+/=.-]{12,}+",
        "hit rlike '[0-9]' and hit rlike '[A-Za-z]' and size(array_distinct(split(hit, ''))) >= 8",
        r"text rlike r'(?i)(?:token|secret|passw(?:or)?d|key)[\x22\x27]?\s{0,2}[:=]'", 0.7, "token|secret|passw|key", base=False,
    ),
    Kind(
        "access_key",
        r"(?<![A-Za-z0-9_-])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35}"
        r"|eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{5,}+)(?![A-Za-z0-9_])",
        "true", r"text rlike 'AKIA|gh[pousr]_|xox[abprs]-|AIza|eyJ'", 0.9, "key|token|secret", base=False,
    ),
)


_NO_SPANS = "cast(array() as array<struct<start: bigint, end: bigint>>)"
_START = f"named_struct('at', 0L, 'spans', {_NO_SPANS})"
#: Code points of a chunk of the text, from which context is read.
CHUNK = 1024


def _proposed(kind: Kind) -> Column:
    """Array of (hit, gap) of the pattern's matches; what lies between them gives their places."""
    pattern = f"r'{kind.pattern}'"
    found = f"zip_with(regexp_extract_all(text, {pattern}, 0), split(text, {pattern}, -1), (hit, gap) -> named_struct('hit', hit, 'gap', gap))"
    none = "cast(array() as array<struct<hit: string, gap: string>>)"
    return F.expr(f"if({kind.needs}, filter({found}, m -> m.hit is not null), {none})")


def _confirmed(kind: Kind) -> Column:
    """Array of (start, end) of the confirmed matches; positions in code points, end exclusive."""
    found = f"{kind.name}_found"
    size = f"int(ceil(sqrt(size({found}))))"
    # A fold that adds to an array copies it, so it goes over blocks, and another one joins their results.
    block = f"""
        aggregate(slice({found}, i + 1, {size}), {_START}, (acc, m) -> named_struct(
            'at', acc.at + length(m.gap) + length(m.hit),
            'spans', if({kind.check.replace("hit", "m.hit")},
                concat(acc.spans, array(named_struct('start', acc.at + length(m.gap), 'end', acc.at + length(m.gap) + length(m.hit)))),
                acc.spans)))"""
    whole = f"""
        aggregate(transform(sequence(0, size({found}) - 1, {size}), i -> {block}), {_START}, (acc, part) -> named_struct(
            'at', acc.at + part.at,
            'spans', concat(acc.spans, transform(part.spans, s -> named_struct('start', s.start + acc.at, 'end', s.end + acc.at)))),
            acc -> acc.spans)"""
    return F.expr(f"if(size({found}) = 0, {_NO_SPANS}, {whole})")


def _scored(order: int, kind: Kind) -> Column:
    """The kind's spans as (start, order, end, kind, score), low scores of added kinds left out."""
    first = f"int(greatest(s.start - {CONTEXT}, 0L))"
    near = f"""lower(substr(
        array_join(slice(chunks, {first} div {CHUNK} + 1, int((s.end + {CONTEXT}) div {CHUNK} - {first} div {CHUNK}) + 1), ''),
        int({first} % {CHUNK}) + 1, int(s.end - s.start) + {2 * CONTEXT}))"""
    score = f"least(1.0D, {kind.score}D + if({near} rlike r'{kind.context}', 0.3D, 0D) - if({near} rlike 'example|sample|version', 0.1D, 0D))"
    spans = F.expr(
        f"transform({kind.name}_spans, s -> named_struct('start', s.start, 'order', {order}, 'end', s.end, "
        f"'kind', '{kind.name}', 'score', {score}))"
    )
    return spans if kind.base else F.filter(spans, lambda s: s["score"] >= LEAST_SCORE)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with ``spans``: array of (start, order, end, kind, score), by start, then kind."""
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chunks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    found = found.select("*", chunks.alias("chunks"), *[_proposed(k).alias(f"{k.name}_found") for k in KINDS])
    found = found.select("doc_id", "text", "chunks", *[_confirmed(k).alias(f"{k.name}_spans") for k in KINDS])
    spans = F.concat(*[_scored(n, k) for n, k in enumerate(KINDS)])
    return found.select("doc_id", "text", F.array_sort(spans).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kinds(spans: Column, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(kinds))


def redact(text: Column, spans: Column) -> Column:
    """The text with every span, of overlapping ones the first, replaced by its kind in angle brackets."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    return F.aggregate(
        spans,
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    acc["out"],
                    text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    F.concat(F.lit("<"), s["kind"], F.lit(">")),
                ).alias("out"),
            ),
        ).otherwise(acc),
        lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text))),
    )
