import hashlib
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from strata.llm import arrays, piece_chunks
from strata.llm.piece_chunks import chunks_stand_alone, decode_pieces, encode_pieces, processor
from tests.llm.fixtures import HAVE_DATA, SF, awkward_docs, no_docs

public = pytest.importorskip("public_tokenizers")
MODEL = public.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  ", "  a  b ", "a\x00b", "a▁b", "▁", "▁ ▁", "a ▁", "\n\n", "<s> </s> <unk> x</s>", " é ﬁ﻿", "😀😀 \U0010ffff",
         " " * 40 + "x" + " " * 33, "　a b\tc", "x" * 500, "İI ẞ é", "2024 1234567890", "日本語 テキスト"]


def plain(text):
    ids = processor(MODEL).encode(text or "") + [2]
    return ids, processor(MODEL).decode(ids)


def coded(spark, docs):
    rows = decode_pieces(encode_pieces(docs, MODEL).selectExpr("doc_id", "ids as kept", "ids"), MODEL)
    assert rows.columns == ["doc_id", "kept", "decoded"]
    return sorted(((r.doc_id, r.kept, r.decoded) for r in rows.collect()), key=repr)


def test_the_model_has_chunks():
    assert chunks_stand_alone(MODEL)


@pytest.mark.parametrize("block", [piece_chunks.BLOCK_BYTES, 40])
def test_ids_and_texts_are_those_of_the_library(spark, monkeypatch, block):
    monkeypatch.setattr(piece_chunks, "BLOCK_BYTES", block)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (7, None), (1, "a"), (1, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert coded(spark, docs) == sorted(((i, *plain(t)) for i, t in rows), key=repr)


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    want = sorted(((r.doc_id, *plain(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert coded(spark, docs) == want
    assert coded(spark, no_docs(spark)) == []
    nothing = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert coded(spark, nothing) == [(1, [2], ""), (2, [2], "")]
    assert [r.ids for r in encode_pieces(nothing, MODEL, end_id=None).collect()] == [[], []]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" ▁ab\n\t0é"), st.characters(codec="utf-8")), max_size=30), max_size=8))
def test_any_texts_are_spelt_out_of_their_chunks(texts):
    import numpy as np
    import pyarrow as pa

    chunks, counts = piece_chunks._chunks(pa.array(texts, pa.string()), True)
    told = chunks.dictionary_encode()
    n = len(told.dictionary)
    data, offsets = arrays.text_bytes(told.dictionary)
    half = n // 2
    rows = [(0, 0, 0, piece_chunks._packed(data[offsets[i]:offsets[j]], np.diff(np.arange(i, j), prepend=0), np.diff(offsets[i:j + 1])))
            for i, j in ((0, half), (half, n))]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["bucket", "block", "digest", "packed"])
    packed = [x for b in piece_chunks._segment(MODEL)(iter([batch[:1], batch[1:]])) for x in b.column(2).to_pylist()]
    made = [flat[a:b].tolist() for _, _, flat, o in piece_chunks._texts(counts, told.indices.to_numpy(), *piece_chunks._by_place(packed), None)
            for a, b in zip(o[:-1], o[1:], strict=True)]
    assert made == [processor(MODEL).encode(t) for t in texts]


def test_rows_that_change_between_two_reads_are_noticed(spark):
    import pyarrow as pa

    def other(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([os.urandom(4).hex() for _ in range(b.num_rows)])], ["doc_id", "text"])

    docs = spark.range(300).mapInArrow(other, "doc_id long, text string")
    with pytest.raises(Exception, match="write them to a table first"):
        encode_pieces(docs, MODEL).collect()


def test_whole_texts_where_chunks_do_not_stand_alone(spark, monkeypatch):
    monkeypatch.setattr(piece_chunks, "chunks_stand_alone", lambda path: False)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert coded(spark, docs) == sorted(((i, *plain(t)) for i, t in enumerate(TEXTS)), key=repr)


@pytest.mark.skipif(not HAVE_DATA, reason="driver test data not present")
def test_query_is_exact(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(SF, "documents.parquet")).collect()}
    rows = entry.queries()["op11_sentencepiece"](spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids, text = plain(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
