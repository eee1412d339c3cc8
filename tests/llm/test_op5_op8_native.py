import hashlib
import random
import re

from sparkmart.llm import chat, personal_data, queries
from pyspark.sql import functions as F


def test_chat_digests(spark, sf_dir):
    got = {r.conv_id: r for r in queries.op5_chat_formatting(spark, sf_dir).collect()}
    talks = {-7: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]}
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect():
        talks.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    assert set(got) == set(talks)
    for key, turns in talks.items():
        whole = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        r = got[key]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r.formatted_chars > len(whole)


ODD_TURNS = [
    (1, 0, "system", "S " * 20), (1, 1, "user", "a " * 30), (1, 2, "assistant", "b<|im_end|>\n" * 10),
    (1, 3, "us\n\\er\r\\n", "c " * 80), (1, 4, "assistant", r"x [\INST] <\\s> </s> [[INST] <"),
    (1, 4, "assistant", r"x [\INST] <\\s> </s> [[INST] <"), (1, 5, None, None),
    (None, 1, "user", "q"), (None, 1, "user", "q"), (2, None, "assistant", "<"), (2, None, "\\n\\\n", "<"),
]


def test_windows_keep_turns_and_budget(spark):
    turns = spark.createDataFrame(ODD_TURNS, "conv_id long, turn int, role string, text string").withColumn("window", F.lit(1))
    windows = chat.windows(turns, budget=100, history_tokens=60)
    rows = windows.orderBy("conv_id", "window").collect()
    assert all(r.n_tokens <= 100 or r.over_budget for r in rows)
    first = [r for r in rows if r.conv_id == 1]
    assert len(first) > 2 and all(r.text.startswith("<|im_start|>system\nS") for r in first)
    assert all(r.n_context >= 1 for r in first[1:])
    back = {r.conv_id: r for r in chat.read_back(windows).collect() if r.conv_id}
    want = [(a or "", b or "") for _, _, a, b in ODD_TURNS[:7]]
    assert [tuple(t) for t in back[1].turns] == want
    assert back[1].targets == [b for a, b in want if a == "assistant"]
    assert sum(r.conv_id is None for r in rows) == 2
    assert chat.windows(turns.limit(0)).count() == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def holds(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), n, m.end(), k) for n, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text) if holds(k, m[0])]
    return sorted(found)


def test_personal_data(spark, sf_dir, odd_docs):
    rng = random.Random(3)
    bits = [
        "a@b.c_d@e.f.", "x.y@z", "1.2.3.4", ".", "256.1.1.1", "001.02.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "-", " ", "+1 (988) 555-2485", "+", "+49 30 1234567", "9", "@", "é😀", "1.2.3x4", "a..b@c..d", "%+-_@q.w", "0000000000000",
    ]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    texts += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in personal_data.find(docs).collect():
        got = [(s.start, s.order, s.end, s.kind) for s in r.spans if s.kind in PATTERNS]
        assert got == base_spans(texts[r.doc_id])
    assert personal_data.find(odd_docs).count() == odd_docs.count()
    long = spark.createDataFrame([(1, "9" * 60_000), (2, "1 2" * 20_000), (3, "a" * 200_000 + "@"), (4, "1." * 50_000)], "doc_id long, text string")
    assert personal_data.find(long).count() == 4


def test_checks_and_context(spark):
    texts = ["iban DE89 3704 0044 0532 0130 00.", "iban DE89 3704 0044 0532 0130 01.", "ssn 123-45-6789", "no 123-45-6789", "call 555-123-4567"]
    rows = personal_data.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[s.kind for s in r.spans] for r in rows] == [["iban"], [], ["national_id"], [], ["local_phone"]]
    docs = spark.createDataFrame([(1, "é a@b.cd, +1 (988) 555-2485 x")], "doc_id long, text string")
    assert personal_data.find(docs).select(personal_data.redact(F.col("text"), F.col("spans"))).first()[0] == "é <email>, <phone> x"


def test_native_plans(spark, sf_dir):
    for name in ("op2_url_filters", "op5_chat_formatting", "op8_personal_data", "op10_decontamination", "op13_document_fingerprints"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", plan), name


def test_many_matches_in_one_text(spark):
    """Places and context stay right, and the work near-linear, with matches in the ten thousands."""
    n = 30_000
    text = " ".join(f"é contact user{i}@host{i % 7}.org" for i in range(n))
    docs = spark.createDataFrame([(1, text), (2, "a@b.c " * 3)], "doc_id long, text string")
    found = {r.doc_id: r.spans for r in personal_data.find(docs).collect()}
    mails = [s for s in found[1] if s.kind == "email"]
    assert len(mails) == n and all(text[s.start : s.end] == f"user{i}@host{i % 7}.org" for i, s in enumerate(mails))
    assert {s.score for s in mails} == {1.0} and [(s.start, s.end) for s in found[2]] == [(0, 5), (6, 11), (12, 17)]


def test_secrets(spark):
    secret, github = "04dbebab91ab85687d33eeaaf9ac699e1188f962", "ghp_" + "a1B2" * 9
    texts = {
        1: f'token = "{secret}" and so on', 2: f"API_KEY:{secret}.", 3: f"password = '{secret}'", 4: f"see {github}!", 5: "AKIA" + "Q7X2" * 4,
        6: f"hash {secret}", 7: "token = aaaaaaaaaaaaaaaaaaaaaaaa1", 8: "the secret: understanding everything", 9: "a key = value pair", 10: "token=",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind in ("secret", "access_key")] for r in personal_data.find(docs).collect()}
    assert found == {1: [secret], 2: [secret + "."], 3: [secret], 4: [github], 5: [texts[5]], **{k: [] for k in range(6, 11)}}
