import base64
import pathlib
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from sparkmart.llm import quality, queries, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_counts(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op7_quality_rules(spark, sf_dir).collect()}
    for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        words = WORD.findall(d.text or "")
        windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
        seen, covered, lines, duplicates = Counter(windows), set(), set(), 0
        for k, w in enumerate(windows):
            covered |= {k, k + 1, k + 2} if seen[w] > 1 else set()
        for line in (d.text or "").split("\n"):
            duplicates += bool(WORD.search(line)) and line in lines
            lines.add(line)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        row = got.pop(d.doc_id)
        assert (row.n_words, row.word_chars, row.n_symbols) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in d.text or "")
        )
        assert (row.n_dup_lines, row.n_repeat_words, row.base_failed) == (duplicates, len(covered), failed)
        assert not (failed and row.kept)
    assert not got


def test_compression_bands():
    judge = quality.Compression(quality.Bands())
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(900)]
    prose = " ".join(rng.choice(vocabulary, 2500)).encode()
    assert judge(prose)[2]
    assert not judge(b"spam and eggs " * 200)[2]
    assert not judge(rng.integers(0, 256, 5000, np.uint8).tobytes())[2]
    # Most of the text is fine as a whole, but too many chunks repeat.
    assert not judge(prose[:5000] + b"ab" * 3000)[2]
    assert judge(b"short short short short")[2] and judge(b"") == (None, None, True)


def test_bands_tell_prose_from_junk():
    """Windows of legal prose are kept; base64 and random words of the same lengths are not."""
    judge = quality.Compression(quality.Bands())
    prose = (pathlib.Path(public_tokenizers.__file__).parent / "LICENSES.txt").read_bytes()
    rng = np.random.default_rng(4)
    signs = list("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    for size in (256, 399, 400, 512, 600, 700, 1000, 1024, 2000, 3000, 4096, 9000):
        windows = [prose[a : a + size] for a in range(0, len(prose) - size, max(200, size // 2))]
        assert all(judge(w)[2] for w in windows), size
        for _ in range(10):
            words = " ".join("".join(rng.choice(signs, rng.integers(3, 10))) for _ in range(size // 4))[:size]
            junk = base64.b64encode(rng.bytes(size))[:size], base64.encodebytes(rng.bytes(size))[:size], words.encode()
            assert not any(judge(j)[2] for j in junk), size
    # Of wide scripts a kilobyte holds fewer characters.
    assert judge("".join(rng.choice([chr(0x4E00 + k) for k in range(1500)], 1400)).encode())[2]


def test_odd_documents(spark, odd_docs):
    assert quality.judge(odd_docs).count() == odd_docs.count()
    assert quality.judge(odd_docs.limit(0)).count() == 0
    labels = spark.createDataFrame([(1, 0), (1, 1), (8, 0), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    small = toxicity.Settings(buckets=1 << 10, steps=5)
    model = toxicity.train(odd_docs, labels, small)
    rows = toxicity.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.train(odd_docs, labels.limit(0), small).bias == -30
    assert toxicity.score(odd_docs.limit(0), model).count() == 0


def test_unseen_forms_share_subwords(spark):
    rng = np.random.default_rng(3)
    clean = ["".join(rng.choice(list("bdgklmnprstaeio"), 6)) for _ in range(400)]
    bad = ["zuckworm", "zuckwormy", "quaxling", "quaxlings"]

    def text(toxic):
        words = list(rng.choice(clean, 60))
        return " ".join(words + list(rng.choice(bad, 3)) if toxic else words)

    rows = [(i, text(i % 3 == 0), int(i % 3 == 0)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.drop("text"), toxicity.Settings(buckets=1 << 14))
    score = model.scorer()
    held = [(score(t), y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(s >= toxicity.THRESHOLD) == y for s, y in held]) > 0.95
    unseen = " ".join(clean[:60])
    assert score(unseen + " zuckworms zuckwormed quaxlingo") > 10 * score(unseen)


def test_held_out_is_the_contract(spark, sf_dir):
    rows = queries.op3_toxicity(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)


def plain_fit(bags, settings):
    """The same learning with dense matrices, text by text and row by row."""
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(bags))
    dense = np.zeros((len(bags), settings.buckets))
    for k, (_, rows, counts) in enumerate(bags):
        dense[k, rows] = counts / counts.sum()
    truth = np.array([[not b[0], b[0]] for b in bags], float)
    parts = [order[i : i + settings.batch] for i in range(0, len(bags), settings.batch)]
    table, layer = rng.normal(0, 0.1, (settings.buckets, settings.dim)), rng.normal(0, 0.1, (settings.dim, 2))
    table, layer, bias = table.astype(np.float32).astype(float), layer.astype(np.float32).astype(float), np.zeros(2)
    seen, seen_layer, seen_bias = np.full(settings.buckets, 1e-8), np.full(layer.shape, 1e-8), np.full(2, 1e-8)
    for _ in range(max(settings.epochs, settings.steps // len(parts))):
        for i in rng.permutation(len(parts)):
            x, y = dense[parts[i]], truth[parts[i]]
            logits = x @ table @ layer + bias
            odds = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
            error = (odds - y) / len(x)
            of_table, of_layer, of_bias = x.T @ (error @ layer.T), (x @ table).T @ error, error.sum(axis=0)
            used = (x > 0).any(axis=0)
            seen[used] += (of_table[used] ** 2).mean(axis=1)
            table[used] -= settings.rate * of_table[used] / np.sqrt(seen[used])[:, None]
            seen_layer += of_layer**2
            layer -= settings.rate * of_layer / np.sqrt(seen_layer)
            seen_bias += of_bias**2
            bias -= settings.rate * of_bias / np.sqrt(seen_bias)
    return table @ (layer[:, 1] - layer[:, 0]), bias[1] - bias[0]


def test_fit_equals_plain_loops():
    rng = np.random.default_rng(5)
    settings = toxicity.Settings(buckets=60, dim=3, batch=7, epochs=4, steps=30)
    bags = []
    for k in range(40):
        rows = np.unique(rng.integers(0, 30 if k % 3 else 60, 12)).astype(np.uint32)
        bags.append((k % 3 == 0, rows, rng.integers(1, 5, len(rows)).astype(np.float32)))
    weights, bias = plain_fit(bags, settings)
    model = toxicity.fit(list(bags), settings)
    assert np.allclose(model.weights, weights, rtol=0.02, atol=0.02) and abs(model.bias - bias) < 0.02


def test_sample_of_repeated_ids_and_long_texts(spark):
    long = " ".join(f"word{i % 20_011}" for i in range(60_000))
    rows = [(1, "bad words here"), (1, "other words"), (2, "fine text"), (3, long), (4, long + " bad")]
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, 1)], "doc_id long, toxic int")
    small = toxicity.Settings(buckets=1 << 10, steps=5)
    models = [
        toxicity.train(spark.createDataFrame(some, "doc_id long, text string").repartition(3), labels, small)
        for some in (rows, rows[::-1])
    ]
    assert (models[0].weights == models[1].weights).all() and models[0].bias == models[1].bias


def test_fit_holds_bags_packed():
    rng = np.random.default_rng(6)
    settings = toxicity.Settings(epochs=1, steps=1)
    bags = []
    for k in range(1000):
        rows = np.unique(rng.integers(0, settings.buckets, 1500)).astype(np.uint32)
        bags.append((k % 3 == 0, rows, np.ones(len(rows), np.float32)))
    entries = sum(len(rows) for _, rows, _ in bags)
    tracemalloc.start()
    try:
        toxicity.fit(bags, settings)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    # Besides the table of rows and a batch at work, under 8 bytes an entry; open batches took 24.
    assert peak < 4 * settings.buckets * settings.dim * 6 + 8 * entries
