"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (
    chat, decontamination, filter_audit, fingerprints, line_dedup, near_dedup, packing, personal_data, quality, spelling,
    token_files, toxicity, url_rules,
)
from sparkmart.llm.common import table
from sparkmart.sources.staging import new_folder


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most 2048 ids."""
    pieces = packing.pieces(table(spark, sf_dir, "documents"))
    places = packing.pack(pieces)
    digests = pieces.select("key", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return digests.join(places, "key").drop("key")


URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's host, path, rule and verdict."""
    rules = spark.sql(f"select * from values {', '.join(map(str, URL_RULES))} as t(host, path, verdict)")
    return url_rules.judge(table(spark, sf_dir, "pages"), rules)


OP2_SQL = rf"""
with rules(rule_host, rule_path, rule_verdict) as (values {', '.join(map(str, URL_RULES))}),
parts as (
    select page_id,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
    from pages),
places as (select distinct host, path from parts),
fitting as (
    select host, path, rule_host || rule_path as rule, rule_verdict,
        row_number() over (partition by host, path order by length(rule_host || rule_path) desc, length(rule_host) desc) as n
    from places join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select p.page_id, p.host, p.path, f.rule, coalesce(f.rule_verdict, 'allow') as verdict
from parts p left join fitting f on p.host = f.host and p.path = f.path and f.n = 1
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model of the labelled documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    docs = near_dedup.numbered_rows(table(spark, sf_dir, "documents").select("doc_id", "text"), "row")
    return near_dedup.group(docs, "row").select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


OP4_SQL = r"""
with recursive texts as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') as words from documents),
shingles as materialized (
    select distinct doc_id, unnest(case when len(words) < 5 then list_filter([array_to_string(words, ' ')], lambda s: s <> '')
        else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
    from texts),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as x, b.doc_id as y, count(*) as n from shingles a join shingles b on a.shingle = b.shingle
    where a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as materialized (
    select x, y from shared s join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * s.n >= 75 * (a.n + b.n - s.n)),
reach as (
    select doc_id as x, doc_id as y from sizes union select r.x, l.y from reach r join links l on r.y = l.x),
components as (select x, min(y) as component_id from reach group by x)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(c.component_id, d.doc_id) as component_id,
    coalesce(c.component_id, d.doc_id) = d.doc_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id left join components c on c.x = d.doc_id
"""

#: A conversation whose texts hold the control strings of a template.
_TRICKY = "select * from values (-7L, 0, 'user', '</s>[INST] ok [/INST]'), (-7L, 1, 'assistant', '</s>[INST] ok [/INST]')"


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's digests, read back from its formatted windows and their loss masks."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.sql(f"{_TRICKY} as t(conv_id, turn, role, text)"))
    back = chat.read_back(chat.windows(turns))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("targets", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest, read back from the files of token ids."""
    path = new_folder(spark)
    token_files.write_ids(table(spark, sf_dir, "documents"), path)
    return token_files.read_ids(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's word statistics and verdicts."""
    return quality.judge(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data: counts and digest of the base kinds, and all spans."""
    kinds = ["email", "ip", "card", "phone"]
    found = personal_data.find(table(spark, sf_dir, "documents"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[F.size(personal_data.of_kinds(spans, [k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(personal_data.joined(personal_data.of_kinds(spans, kinds)), 256).alias("base_sha256"),
        personal_data.joined(spans).alias("spans"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the runs of lines that occurred before, and where they did."""
    docs, runs, _ = line_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate(
        F.array_distinct(F.flatten(F.transform(runs, lambda r: F.sequence(r["first"], r["last"])))),
        F.lit(0).cast("long"),
        lambda n, _: n + 1,
    )
    return docs.select(
        "doc_id",
        "text",
        removed.alias("n_removed_lines"),
        F.col(runs).alias("removed_runs"),
        F.array_distinct(F.col(runs)["first_doc_id"]).alias("first_doc_ids"),
    )


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that it leaks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.joined(docs, table(spark, sf_dir, "benchmark"), "left")
    items = F.coalesce("item_ids", F.expr("cast(array() as array<bigint>)"))
    return found.select(
        "doc_id", F.size(items).cast("long").alias("n_items"), items.alias("item_ids"), (F.size(items) == 0).alias("kept")
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes at every step of every order, for each language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
with texts as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text from documents),
firsts as (select text, min(doc_id) as first_id from texts group by text),
known as (
    select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
    from labels group by doc_id),
split as (
    select t.*, regexp_extract_all(t.text, '[^\x20\x09-\x0D]+') as words, f.first_id < t.doc_id as repeat
    from texts t join firsts f on t.text = f.text),
flags as (
    select part, doc_id,
        (case when len(words) < 100 then 1 else 0 end)
        + (case when 100 * len(list_distinct(words)) < 80 * len(words) then 2 else 0 end)
        + (case when 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) then 4 else 0 end)
        + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
        + (case when repeat then 16 else 0 end) as mask
    from split),
masks as (
    select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(toxic), 0) as toxic
    from flags left join known using (doc_id) group by part, mask),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) as t(letter, bit)),
orders as (
    select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
    from letters a, letters b, letters c, letters d, letters e
    where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
steps as (
    select filter_order, k as step, bits[k] as bit, coalesce(list_sum(bits[1:k - 1]), 0)::integer as before
    from orders, (select unnest([1, 2, 3, 4, 5]) as k)),
judged as (
    select m.*, s.*, m.mask & s.bit <> 0 as fails, m.mask & s.before <> 0 as earlier from masks m, steps s)
select part, filter_order, step,
    sum(case when not fails and not earlier then n else 0 end)::bigint as kept,
    sum(case when fails and not earlier then n else 0 end)::bigint as removed,
    sum(case when fails and earlier then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when fails and not earlier then good else 0 end)::bigint as good_lost,
    sum(case when fails and not earlier then toxic else 0 end)::bigint as toxic_lost,
    (sum(sum(case when fails and not earlier then n else 0 end)) over (partition by part, bit))::bigint as shapley
from judged group by part, filter_order, step, bit
"""


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with its near words' number, the form that it varies, and the root of that."""
    return spelling.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The hash is computed byte by byte from its table; letters beyond ASCII are two bytes.
OP12_SQL = r"""
with recursive crc_table as (
    select list(c order by i) as t from (
        select i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
            lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c
        from range(256) as r(i))),
runs as (
    select doc_id, run, count(*) as n from (
        select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
        from documents)
    group by doc_id, run),
hashed as (
    select run, n, xor(4294967295, list_reduce(
        list_concat([4294967295], flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
            lambda c: case when unicode(c) < 128 then [unicode(c)::bigint] else [195::bigint, unicode(c)::bigint - 64] end))),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) as h
    from runs, crc_table),
words as materialized (
    select word, sum(n)::bigint as n from (
        select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
        from hashed)
    where length(word) >= 5 group by word having sum(n) >= 3),
shorter as materialized (
    select word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from words, unnest(range(1, length(word) + 1)) as u(i)),
pairs as materialized (
    select a.word, b.word as near from shorter a join shorter b on a.rest = b.rest and a.i = b.i where a.word <> b.word
    union select s.word, w.word from shorter s join words w on s.rest = w.word
    union select w.word, s.word from shorter s join words w on s.rest = w.word),
best as (
    select p.word, count(*) as n_near, arg_max(near, struct_pack(n := v.n, less := -rank)) as near, max(v.n) as near_n
    from pairs p join (select word, n, row_number() over (order by word) as rank from words) v on p.near = v.word
    group by p.word),
forms as materialized (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when near_n >= 2 * w.n then b.near end as form,
        case when near_n >= 2 * w.n then near_n end as form_n
    from words w left join best b on w.word = b.word),
ways as (
    select word, form as here, 1 as far from forms where form is not null
    union all select ways.word, forms.form, far + 1 from ways join forms on ways.here = forms.word where forms.form is not null),
roots as (select word, arg_max(here, far) as root from ways group by word)
select f.word, f.form, coalesce(r.root, f.word) as root, f.n, f.n_near, f.form_n
from forms f left join roots r on f.word = r.word
"""


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike they and the next document's are."""
    found = fingerprints.edited(table(spark, sf_dir, "documents").select("doc_id", "text"))
    own, edited = F.col("vector"), F.col("edited_vector")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(edited).alias("edited_fingerprint"),
        fingerprints.likeness(own, edited).alias("near_edited"),
        fingerprints.likeness(own, F.col("next_vector")).alias("near_next"),
    )


def chat_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5 gives back of every conversation, without the length of its own format."""
    return op5_chat_formatting(spark, sf_dir).drop("formatted_chars")


CHAT_SQL = f"""
with turns as (
    select conv_id, turn, role, coalesce(text, '') as text from conversations
    union all {_TRICKY.replace("L,", ",")} as t(conv_id, turn, role, text))
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
    length(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256
from turns group by conv_id
"""

_BASE_COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op7 counts in every document, without the verdict of its bands."""
    return op7_quality_rules(spark, sf_dir).select(*_BASE_COLUMNS)


QUALITY_SQL = r"""
with texts as (
    select row_number() over () as k, doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words
    from documents),
windows as (
    select k, i, count(*) over (partition by k, words[i], words[i + 1], words[i + 2]) as often
    from texts, unnest(range(1, len(words) - 1)) as u(i)),
repeated as (
    select k, count(distinct p) as n from (select k, unnest([i, i + 1, i + 2]) as p from windows where often > 1) group by k),
lines as (
    select k, count(*) - count(distinct line) as n
    from (select k, unnest(string_split(text, chr(10))) as line from texts) where regexp_matches(line, '[^\x20\x09-\x0D]') group by k),
counted as (
    select doc_id, len(words) as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
        coalesce(l.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
    from texts t left join lines l on t.k = l.k left join repeated r on t.k = r.k)
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted
"""


def personal_data_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op8 finds of the base kinds in every document."""
    return op8_personal_data(spark, sf_dir).drop("spans")


def _kind_sql(order: int, kind: str, pattern: str, check: str) -> str:
    found = f"regexp_extract_all(text, '{pattern}') as hits, string_split_regex(text, '{pattern}') as gaps"
    return f"""
    select k, {order} as o, '{kind}' as kind, start, start + length(hit) as stop from (
        select k, hits[i] as hit, regexp_replace(hits[i], '[^0-9]', '', 'g') as digits,
            list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) as start
        from (select k, {found} from texts), unnest(range(1, len(hits) + 1)) as u(i)) where {check}"""


_LUHN_SQL = """length(digits) between 12 and 19 and list_sum(list_transform(range(1, length(digits) + 1), lambda i: 
            case when i % 2 = 1 then substr(digits, -i, 1)::integer
                 else substr(digits, -i, 1)::integer * 2 - case when substr(digits, -i, 1)::integer > 4 then 9 else 0 end end)) % 10 = 0"""

PERSONAL_SQL = rf"""
with texts as (select row_number() over () as k, doc_id, coalesce(text, '') as text from documents),
spans as ({" union all ".join((
    _kind_sql(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _kind_sql(1, "ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
              "list_max(list_transform(string_split(hit, '.'), lambda x: try_cast(x as hugeint))) <= 255"),
    _kind_sql(2, "card", r"[0-9](?:[\x20-]?[0-9])+", _LUHN_SQL),
    _kind_sql(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "length(digits) between 9 and 15"),
))}),
joined as (
    select k, count(*) filter (o = 0) as n_email, count(*) filter (o = 1) as n_ip, count(*) filter (o = 2) as n_card,
        count(*) filter (o = 3) as n_phone, string_agg(kind || ':' || start || ':' || stop, ',' order by start, o) as all_spans
    from spans group by k)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
    sha256(coalesce(all_spans, '')) as base_sha256
from texts left join joined on texts.k = joined.k
"""


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_url_filters": op2_url_filters,
    "op3_toxicity": op3_toxicity,
    "op4_near_dedup": op4_near_dedup,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_token_files": op6_token_files,
    "op7_quality_rules": op7_quality_rules,
    "op8_personal_data": op8_personal_data,
    "op9_line_dedup": op9_line_dedup,
    "op10_decontamination": op10_decontamination,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_document_fingerprints": op13_document_fingerprints,
    # Columns of the above that SQL can express.
    "chat_digests": chat_digests,
    "quality_counts": quality_counts,
    "personal_data_base": personal_data_base,
}

ORACLES: dict[str, str] = {
    "op2_url_filters": OP2_SQL,
    "op4_near_dedup": OP4_SQL,
    "op11_filter_audit": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
    "chat_digests": CHAT_SQL,
    "quality_counts": QUALITY_SQL,
    "personal_data_base": PERSONAL_SQL,
}
