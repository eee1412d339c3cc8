import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from sparkmart.llm import decontamination, line_dedup, near_dedup, queries
from sparkmart.llm.common import written
from sparkmart.llm.components import Union, components


def brute_components(rows):
    """doc_id -> smallest reachable, by all pairs of full sets."""

    def shingles(text):
        words = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()

    sets = [(i, shingles(t)) for i, t in rows]
    union = Union()
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                union.join(i, j)
    return {i: union.find(i) for i, _ in rows}


def copies(rng, text, n, rate):
    words = text.split()
    return [" ".join(f"new{rng.random()}" if rng.random() < rate else w for w in words) for _ in range(n)]


@pytest.mark.parametrize("region, shingles", [(32, 6_000_000), (4, 6_000_000), (4, 500)])
def test_near_copies(spark, monkeypatch, region, shingles):
    monkeypatch.setattr(near_dedup, "REGION", region)
    monkeypatch.setattr(near_dedup, "TASK_SHINGLES", shingles)
    rng = random.Random(5)
    texts = []
    for _ in range(12):
        text = " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 200)))
        texts += [text, text.upper(), *copies(rng, text, rng.randint(0, 12), 0.012)]
    texts += ["", " \n", "one two", "One  two", "one two three four five", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dedup.group(near_dedup.numbered_rows(docs, "row"), "row").collect()}
    want = brute_components(rows)
    if shingles > 1000:
        assert got == want
    else:
        assert all(want[got[i]] == want[i] for i in got)
        assert np.mean([got[i] == want[i] for i in got]) > 0.97


@pytest.mark.parametrize("dealt", [1000, 7])
def test_large_components_by_joins(spark, monkeypatch, dealt):
    """Texts with a shared template, 0.667 alike, and pairs of 0.754 among them: equal to brute force."""
    monkeypatch.setattr(near_dedup, "TASK_SHINGLES", 500)
    monkeypatch.setattr(near_dedup, "_DEALT", dealt)
    rng = random.Random(6)
    template = [f"t{k}" for k in range(84)]
    texts = []
    for n in range(180):
        own = [f"o{n}x{k}" for k in range(20)]
        texts.append(" ".join(template + own))
        if n % 2 == 0:
            texts.append(" ".join(template + own[:6] + [f"p{n}x{k}" for k in range(14)]))
    texts += [" ".join(template + ["last"] * 2 + [f"g{k}x{j}" for j in range(3)]) for k in range(12)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in near_dedup.group(near_dedup.numbered_rows(docs, "row"), "row").collect()}
    want = brute_components(rows)
    assert len(set(want.values())) < len(rows) and got == want


def test_op4_on_the_table(spark, sf_dir):
    got = {r.doc_id: r.component_id for r in queries.op4_near_dedup(spark, sf_dir).collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got == brute_components(rows)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (300, 200), (200, 300)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(5)).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 130)}, 200: 200, 300: 200}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("file_edges, files", [(1000, 1), (20, 3)])
def test_rounds_of_few_edges_write_few_files(spark, monkeypatch, file_edges, files):
    monkeypatch.setattr("sparkmart.llm.components.FILE_EDGES", file_edges)
    tables = []
    monkeypatch.setattr("sparkmart.llm.components.written", lambda df: tables.append(written(df)) or tables[-1])
    edges = [(i, i + 1) for i in range(0, 90, 3)] + [(i + 1, i + 2) for i in range(0, 60, 3)] + [(5, 5), (200, 190)]
    random.Random(2).shuffle(edges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = Union()
    for u, v in edges:
        if u != v:
            want.join(u, v)
    assert got == {n: want.find(n) for n in want.parent}
    rounds = [len(t.inputFiles()) for t in tables[2:]]
    assert rounds and rounds == [files] * len(rounds)


def test_exact_share(spark):
    a = np.arange(100, dtype=np.uint64)
    assert near_dedup.linked(a[:75], a) and not near_dedup.linked(a[:74], a)


def test_first_of_each_keeps_columns(odd_docs):
    kept = near_dedup.first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # Of the three equal rows and the near copy without id one stays.
    assert Counter(r.doc_id for r in kept.collect()) == Counter([1, None, None, 3, 4, 5, 6, 7, 8, 9])
    assert near_dedup.first_of_each(odd_docs.limit(0)).count() == 0


def test_line_runs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rng = random.Random(2)
    passage = ["\n".join(" ".join(f"p{n}x{k}" for k in range(s * 9, s * 9 + 9)) for s in range(7)) for n in range(3)]
    extra = [(10_000 + i, f"start {i}\n{passage[i % 3]}\n\nend {rng.random()}") for i in range(12)]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    cut, runs, before = line_dedup.deduplicate(docs)
    rows = sorted(cut.collect(), key=lambda r: r.doc_id)
    seen, kept = set(), set()
    for r in rows:
        numbers, hashes, words = line_dedup.lines_of(r[before])
        gone = {k for run in r[runs] for k in range(run.first, run.last + 1)}
        assert r.text == ("\n".join(x for k, x in enumerate(r[before].split("\n")) if k not in gone) if gone else r[before])
        for a, b in enumerate(line_dedup._run_ends(words, line_dedup.RUN_WORDS)):
            run = tuple(hashes[a : b + 1])
            assert run not in seen or any(numbers[k] in gone for k in range(a, b + 1))
            seen.add(run)
        for n, h in zip(numbers, hashes):
            assert n not in gone or h in kept
            kept |= {h} if n not in gone else set()
    planted = [r for r in rows if r.doc_id >= 10_000]
    assert [bool(r[runs]) for r in planted] == [False] * 3 + [True] * 9
    assert all(r.text.startswith("start") and "end" in r.text and "p0x0 " not in r.text for r in planted[3:])


def test_all_lines_of_repeated_windows_go(spark):
    """A common line amid longer passages is first met elsewhere, so extension from its first place stops at once."""
    rng = random.Random(4)

    def line(n):
        return " ".join(f"q{rng.randrange(10**9)}" for _ in range(n))

    common = line(42)
    rows = [(0, f"{line(6)}\n{common}\n{line(6)}")]
    for n in range(40):
        passage = "\n".join([line(21), line(22), common, line(21), line(22)])
        rows += [(1 + 3 * n + k, f"{line(3)}\n{passage}\n{line(3)}") for k in range(3)]
    rng.shuffle(rows)
    cut, runs, before = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    seen, kept = set(), set()
    for r in sorted(cut.collect(), key=lambda r: r.doc_id):
        numbers, hashes, words = line_dedup.lines_of(r[before])
        gone = {k for run in r[runs] for k in range(run.first, run.last + 1)}
        for a, b in enumerate(line_dedup._run_ends(words, line_dedup.RUN_WORDS)):
            run = tuple(hashes[a : b + 1])
            assert run not in seen or gone >= set(numbers[a : b + 1])
            seen.add(run)
        for n, h in zip(numbers, hashes):
            assert n not in gone or h in kept
            kept |= {h} if n not in gone else set()
        assert len(r.text.split("\n")) == (3 if r.doc_id == 0 else 2 if (r.doc_id - 1) % 3 else 6)


def test_runs_over_many_blocks(spark):
    """Long copies go whole, wherever they begin, though places are compared block by block."""
    rng = random.Random(6)
    long = [" ".join(f"l{rng.randrange(10**9)}" for _ in range(rng.choice((1, 3, 30)))) for _ in range(1800)]
    rows = [
        (1, "\n".join(long)), (2, "\n".join(["other words here", "", *long[300:1500], "", "the end"])),
        (3, "\n".join(long[700:705])), (4, "\n".join(["x"] * 700 + ["y z"])),
        (5, "\n".join([*long[1790:], "new line", *long[:600]])),
    ]
    cut, runs, _ = line_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {r.doc_id: r.text.split("\n") for r in cut.collect()}
    assert left[1] == long and left[2] == ["other words here", "", "", "the end"]
    assert left[5] == ["new line"] and left[4][-1] == "y z" and len(left[4]) < 60
    words = sum(len(x.split()) for x in long[700:705])
    assert left[3] == ([""] if words >= line_dedup.RUN_WORDS else rows[2][1].split("\n"))


def test_odd_lines(odd_docs):
    cut, runs, _ = line_dedup.deduplicate(odd_docs)
    rows = cut.collect()
    assert cut.columns[: len(odd_docs.columns)] == odd_docs.columns and len(rows) == odd_docs.count()
    # Equal rows: the first with the smallest id keeps its line.
    assert sorted(r.doc_id for r in rows if r[runs]) == [2, 2]
    assert line_dedup.deduplicate(odd_docs.limit(0))[0].count() == 0


ITEM = "If Tom buys 3 apples at 2 dollars and Ann buys 3 pears, how much does Tom pay in total for apples?"


def test_templates(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None)], "item_id long, text string")
    docs = [
        (1, "x y. If Bob buys 7 apples at 4 dollars and Sue buys 7 pears, how much does Bob pay in total for apples? zz"),
        (2, "If Bob buys 7 apples at 4 dollars and Sue buys 9 pears, how much does Jim pay in total for apples?"),
        (3, None), (None, ITEM), (None, "no"), (4, ITEM.lower()), (4, "other text"),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.reparameterised) for r in decontamination.leaks(docs, items).collect()}
    assert (1, True) in found and (None, False) in found and not any(i in (2, 3) for i, _ in found)
    kept = decontamination.without_leaks(docs, items).collect()
    assert Counter(r.doc_id for r in kept) >= Counter([2, 3, None])
    assert decontamination.without_leaks(docs, items.limit(0)).count() == docs.count()
    assert decontamination.without_leaks(docs.limit(0), items).count() == 0


def test_op10_against_whole_items(spark, sf_dir):
    import re

    def plain(text):
        return " " + " ".join(re.findall(r"[^\W_]+", (text or "").lower())) + " "

    items = {r.item_id: plain(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    docs = {r.doc_id: plain(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: set(r.item_ids) for r in queries.op10_decontamination(spark, sf_dir).collect()}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        assert {i for i, t in items.items() if t in text} <= got[doc_id]
    assert sum(bool(v) for v in got.values()) <= 1.2 * sum(any(t in x for t in items.values()) for x in docs.values()) + 1


def test_upper_and_title_case(spark):
    items = spark.createDataFrame([(1, ITEM), (2, "the quick brown fox jumps over a lazy dog near our old stone bridge")], "item_id long, text string")
    texts = [ITEM, items.collect()[1].text]
    docs = [(10 * k + n, f"so it was. {f(t)} and then") for n, t in enumerate(texts) for k, f in enumerate((str, str.lower, str.upper, str.title))]
    wrong = ITEM.upper().replace("ANN BUYS 3", "ANN BUYS 9")
    docs = spark.createDataFrame([*docs, (99, wrong)], "doc_id long, text string")
    got = {(r.doc_id, i) for r in decontamination.contaminated(docs, items).collect() for i in r.item_ids}
    assert got == {(10 * k + n, n + 1) for n in range(2) for k in range(4)}


def test_slots_of_what_matched(spark):
    words = (
        "If Tom buys 3 apples at 2 dollars and our neighbour Ann buys 3 pears on a warm day in spring"
        " then how much money does our friend Tom pay in total for apples"
    ).split()
    whole = " ".join(words)
    longer = whole + " and what would he pay, if Ann and Tom gave 2 of all 3 apples, 3 pears and 2 plums back to Ann before the market closed?"
    items = spark.createDataFrame([(1, whole), (2, longer)], "item_id long, text string")
    docs = [
        (1, " ".join([*words[:13], "really", *words[13:]])),
        (2, whole + ". This has 7 other ends, and John says 9 things on 4 days here, 5 there, as Mary saw Jim with Sue in town."),
        (3, whole.replace("friend Tom", "friend Jim").replace("buys 3 pears", "buys 9 pears")),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: set(r.item_ids) for r in decontamination.contaminated(docs, items).collect()}
    assert 1 in got[1] and got[2] == {1, 2} and 3 not in got


def test_numbers_and_short_items(spark):
    sums = "Compute 3 + 4 * 5 - 6 / 7 + 8 and 9 * 10 - 11 = 12 then 13 + 14"
    german = "der alte Mann las in seiner Zeitung vom Sonntag, Herr Meier, Frau Schmidt, Bruder Hans und Onkel Karl kamen zu Besuch"
    items = spark.createDataFrame([(1, sums), (2, german), (3, "Name 3 Primes"), (4, "Why?"), (5, ""), (6, "...")], "item_id long, text string")
    docs = [
        (1, f"see this: {sums} and more"), (2, sums.upper()), (3, sums.replace("3", "9")), (4, f"x {german}."), (5, german.lower()),
        (6, "so, name 3 primes"), (7, "name 4 primes"), (8, "Why"), (9, "whys"), (10, ""),
    ]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontamination.contaminated(docs, items).collect()}
    assert got == {1: [1], 2: [1], 4: [2], 5: [2], 6: [3], 8: [4]}
    leaks = decontamination.leaks(docs, items).where("doc_id in (1, 4)").collect()
    assert [r.containment for r in leaks] == [1.0, 1.0]


def test_edited_items(spark, sf_dir):
    """Copies of whole items with words replaced or cut; the least shares are below those measured."""
    rng = random.Random(8)
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    kinds, docs = ("one", "two", "three", "cut"), []
    for i, text in items.items():
        words = text.split()
        for k, kind in enumerate(kinds):
            some = rng.sample(range(len(words)), min(k + 1, len(words)))
            edited = words[: len(words) * 4 // 5] if kind == "cut" else ["xqzo" if n in some else w for n, w in enumerate(words)]
            docs.append((i * len(kinds) + k, " ".join(edited)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    found = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()
    share = Counter(kinds[r.doc_id % len(kinds)] for r in found if r.doc_id // len(kinds) in r.item_ids)
    least = {"one": 0.95, "two": 0.85, "three": 0.6, "cut": 0.85}
    assert {k: share[k] / len(items) for k in kinds if share[k] < least[k] * len(items)} == {}


def test_op10_against_whole_items_sf001(spark):
    test_op10_against_whole_items(spark, "/root/testdata/sf0.01")


def test_odd_leaks(spark, odd_docs):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontamination.without_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("*", "'x' as row_number")
    columns, size = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        assert docs.columns == columns, name
        assert docs.count() <= size
        size = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "near_dedup"


def test_pairs_of_a_large_group_of_near_copies():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 32, near_dedup.TREES * near_dedup.ROOT, dtype=np.uint32)
    own = rng.integers(0, 1 << 32, (600, len(common)), dtype=np.uint32)
    values = np.where(rng.random(own.shape) < 0.9, common, own)
    pairs, joined = set(), Union()
    for tree in range(near_dedup.TREES):
        label = np.roll(values, -near_dedup.ROOT * tree, axis=1)[:, : near_dedup.DEPTH]
        order = np.lexsort(label.T[::-1])
        u, v = near_dedup.candidates(np.full(600, tree), label[order], order, np.full(600, 100))
        pairs.update(zip(u.tolist(), v.tolist()))
    for u, v in pairs:
        joined.join(u, v)
    assert {joined.find(k) for k in range(600)} == {0}
    # Few of them each, however large the group is.
    assert len(pairs) < 9 * 600


def test_edges_of_many_partitions_are_contracted_together(spark, monkeypatch):
    sizes = []

    def counted(df):
        sizes.append((out := written(df)).count())
        return out

    monkeypatch.setattr("sparkmart.llm.components.written", counted)
    # No partition alone holds a tree of all nodes.
    edges = spark.range(3000).selectExpr("(id * 7919) % 499 u", "(id * 104729) % 503 v").where("u <> v").repartition(40)
    assert components(edges).select("component").distinct().count() == 1
    # The edges as they came, one star of all nodes, and two rounds that change nothing.
    assert len(sizes) == 4 and sizes[1:] == [502] * 3
