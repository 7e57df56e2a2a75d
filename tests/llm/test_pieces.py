"""SentencePiece ids and texts against the library itself."""

import hashlib
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.llm.pieces import coder_of, encode_decode, public_pieces
from tidelog.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=public_pieces())


@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text("ab thein▁ \n\t1é漢ゼ\0😀<s>", max_size=60)))
def test_ids_and_text_are_the_librarys(library, text):
    coder = coder_of(public_pieces())
    ids = np.frombuffer(coder.encode(text), "<u4").tolist()
    assert ids == library.encode(text) and coder.decode(np.array(ids, "<u4")) == library.decode(ids)


@settings(max_examples=400, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31_999)), max_size=12))
def test_any_ids_decode_as_in_the_library(library, ids):
    assert coder_of(public_pieces()).decode(np.array(ids, dtype="<u4")) == library.decode(ids)


def test_control_ids_among_others(library):
    for ids in ([197, 1, 131], [1, 306, 2, 306], [1, 1, 306], [2, 29871, 1, 29871, 306], [1, 197, 131, 306, 0, 306], [1], []):
        assert coder_of(public_pieces()).decode(np.array(ids, dtype="<u4")) == library.decode(ids)


def test_each_last_piece_is_the_prefix_encoding(library):
    coder = coder_of(public_pieces())
    for word in ("▁unbelievable", "▁▁▁▁▁tokens", "▁aaaaaaaaaaaaaaaaaaaaaaa", "▁Überraschung漢字ゼx"):
        last = coder.last_pieces(word)
        for k in range(1, len(word) + 1):
            assert last[k] == coder.merged(word[:k])[-1]


def test_rows_of_all_kinds(docs, library):
    r = random.Random(4)
    texts = [None, "", " ", "  two  blanks ", "tab\tand\nline", "▁sign ▁", "literal <s> </s> <0x41>", "é" * 70_000, "word " * 60_000,
             " " * 30_000, "x" * 50_000, "".join(chr(r.randrange(33, 0x3000)) for _ in range(20_000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (3, "  two  blanks "), (3, "other text of that id")]
    table = docs(rows).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit("x"))
    got = sorted((str(x.doc_id), bytes(x.ids), x.decoded) for x in encode_decode(table, public_pieces()).collect())
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((str(i), np.array(ids, "<u4").tobytes(), library.decode(ids)))
    assert got == sorted(want)
    assert encode_decode(docs([]), public_pieces()).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not mounted")
def test_query_over_the_given_documents(spark, library):
    want = []
    for doc in spark.read.parquet(f"{SF}/documents.parquet").collect():
        ids = library.encode(doc.text or "", add_bos=True, add_eos=True)
        digest = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), library.decode(ids).encode())]
        want.append((doc.doc_id, len(ids), *digest))
    out = QUERIES["op11_prefix_pieces"](spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect())) == sorted(want)
