import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from strata.llm.token_files import Encoder, read_tokens, token_index, tokens_round_trip, words_stand_alone, write_tokens
from strata.llm import arrays
from tests.llm.fixtures import as_dicts, awkward_docs, no_docs

public = pytest.importorskip("public_tokenizers")
WORD, BYTE = (public.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["Hello, World's  end\n", "", "don't <|endoftext|>x", "e\u0301 \u0301a ΑΣ ΟΔΟΣ\u00a0x\u3000y", "a\x00b\x1cc", "😀 1234 ###", "İI ẞ"]


def plain(path, texts):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    return [[*made.encode(t, add_special_tokens=False).ids, 2] for t in texts]


@pytest.mark.parametrize("path,alone", [(WORD, True), (BYTE, False)])
def test_ids_are_those_of_the_library(path, alone):
    import pyarrow as pa

    assert words_stand_alone(path) is alone
    encoder = Encoder(path)
    for _ in range(2):  # the second time from what is kept
        ids, at = encoder.encode(*arrays.text_bytes(pa.array(TEXTS)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain(path, TEXTS)


def test_words_of_one_hash_keep_their_own_ids():
    import pyarrow as pa

    parity = [bin(i).count("1") & 1 for i in range(1024)]
    one, two = ("".join("ab"[p ^ flip] for p in parity) for flip in (0, 1))
    data, offsets = arrays.text_bytes(pa.array([one, two]))
    assert len(set(arrays.words_of(data, offsets).hashes.tolist())) == 1  # else this tests nothing
    texts = [f"{one} and {two}", two, one.upper(), f"x {two.upper()} {one}"]
    encoder = Encoder(WORD)
    for some in (texts[:1], texts[1:], texts[::-1], texts):
        ids, at = encoder.encode(*arrays.text_bytes(pa.array(some)))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == plain(WORD, some)


def test_round_trip_of_awkward_rows(spark):
    docs = awkward_docs(spark)
    nulls = spark.createDataFrame([(None, "no id"), (None, None)], "doc_id long, text string")
    assert [(r.start, r.n_tokens) for r in sorted(tokens_round_trip(nulls, WORD).collect(), key=lambda r: r.start)] == [(0, 1), (1, 3)]
    rows = sorted(((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()))
    want, start = [], 0
    for (i, _), ids in zip(rows, plain(WORD, [t for _, t in rows]), strict=True):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokens_round_trip(docs, WORD).collect())) == want
    assert tokens_round_trip(no_docs(spark), WORD).collect() == []


def test_files_are_ordered_and_laid_out(spark, tmp_path):
    docs = spark.range(3000).selectExpr("2999 - id as doc_id", "concat('word', id, ' and more ', id % 7) as text").repartition(5)
    folder = f"file://{tmp_path}/tokens"
    write_tokens(docs, folder, WORD)
    files = sorted(glob.glob(f"{tmp_path}/tokens/*.parquet"))
    ids = [i for f in files for i in pq.read_table(f, columns=["id"])["id"].to_pylist()]
    assert ids == list(range(3000))
    meta = pq.ParquetFile(next(f for f in files if pq.ParquetFile(f).metadata.num_rows)).metadata
    kinds = {meta.row_group(0).column(c).path_in_schema.split(".")[0]: meta.row_group(0).column(c) for c in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in str(kinds["ids"].encodings) and kinds["id"].has_offset_index and kinds["id"].has_column_index
    part = read_tokens(spark, folder).select("id", "n_tokens").where("id < 10")
    assert "ids" not in part._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1] and part.count() == 10
    assert token_index(spark, folder).agg({"start": "max"}).first()[0] > 0
    assert as_dicts(token_index(spark, folder).where("doc_id = 0"))[0]["start"] == 0
