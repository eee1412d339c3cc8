import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmart.llm import frames_of_reference as frames
from sparkmart.llm import packing, queries, token_files
from sparkmart.llm.common import written
from sparkmart.llm.tokens import default_path, encoder


def whole_ids(text, end):
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(default_path()).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, end], "<u4").tobytes()


@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2**32 - 1)), max_size=700))
@settings(max_examples=40, deadline=None)
def test_frames_round_trip(values):
    values = np.array(values, "<u4")
    starts, data = frames.encode(values)
    assert (frames.decode(starts, data)[: len(values)] == values).all()
    if len(values) > frames.BLOCK:
        assert (frames.decode(starts, data, 1, 2)[: len(values) - 256] == values[256:512]).all()


@given(st.text(alphabet="aB'sSté ß.,!1²\n\x1c\x85İΣ<|>", max_size=40))
@settings(max_examples=80, deadline=None)
def test_words_alone_give_the_ids_of_the_whole(text):
    assert encoder(default_path()).ids(text) == whole_ids(text, 0)[:-4]


def test_segment_reads_a_range():
    ids = np.arange(5000, dtype="<u4") * 7
    segment = token_files.Segment(token_files.pack_segment([4, None], [1000, 4000], ids.tobytes()))
    assert segment.doc_ids == [4, None]
    assert (segment.ids(300, 900) == ids[300:900]).all() and (segment.ids() == ids).all()


def test_op6_equals_the_library(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in queries.op6_token_files(spark, sf_dir).collect()}
    start = 0
    for d in docs:
        ids, row = whole_ids(d.text, 1), got.pop(d.doc_id)
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert not got


def test_odd_documents_in_files(spark, odd_docs, tmp_path):
    token_files.write_ids(odd_docs, f"{tmp_path}/ids")
    rows = token_files.read_ids(spark, f"{tmp_path}/ids").orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in odd_docs.collect()], key=lambda i: (i is not None, i or 0))
    sizes = [len(r.ids) // 4 for r in rows]
    assert [r.start for r in rows] == (np.cumsum(sizes) - sizes).tolist()


def test_empty_tables(spark, odd_docs, tmp_path):
    none = odd_docs.limit(0)
    token_files.write_ids(none, f"{tmp_path}/ids")
    assert token_files.read_ids(spark, f"{tmp_path}/ids").count() == 0
    pieces = packing.pieces(none)
    assert packing.pack(pieces).count() == 0


def test_op1_places_every_piece(spark, sf_dir):
    rows = queries.op1_best_fit_packing(spark, sf_dir).orderBy("sequence_id", "offset").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    by_doc, end = {}, {}
    for r in rows:
        assert r.offset == end.get(r.sequence_id, 0)
        end[r.sequence_id] = r.offset + r.length
        by_doc.setdefault(r.doc_id, []).append(r)
    assert max(end.values()) <= 2048
    total = sum(r.length for r in rows)
    assert len(end) <= 1.02 * -(-total // 2048) + 1
    for doc_id, text in texts.items():
        ids = whole_ids(text, 0)
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.start for r in own] == list(range(0, len(ids) // 4, 2048))
        assert [r.ids_crc32 for r in own] == [zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in own]


def test_odd_documents_in_sequences(odd_docs):
    pieces = packing.pieces(odd_docs)
    assert pieces.select("doc_id").distinct().count() == 10
    assert packing.pack(pieces).count() == pieces.count()


@pytest.mark.parametrize("seed", range(4))
def test_search_beats_best_fit(seed):
    rng = np.random.default_rng(seed)
    size = np.sort(rng.integers(1, 700, 400))[::-1].astype(np.int64)
    bins = packing.pack_bins(size, 1000)
    assert sorted(i for b in bins for i in b) == list(range(400))
    assert all(size[b].sum() <= 1000 for b in bins)
    assert len(bins) <= len(packing._best_fit(size.tolist(), 1000))


def test_swaps_empty_a_bin():
    # Best fit leaves three bins; exchanging pieces makes two full ones.
    size = np.array([6, 5, 4, 3, 2], np.int64)
    assert len(packing.pack_bins(size, 10)) == 2


def test_second_round_repacks_across_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 5)
    pieces = written(spark.range(60).selectExpr("id as key", "30 + id % 7 as length"))
    rows = packing.pack(pieces, 100).join(pieces, "key").collect()
    fill = {}
    for r in rows:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert len(rows) == 60 and max(fill.values()) <= 100
