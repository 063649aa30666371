from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridloom.llm import token_counts as op
from gridloom.llm.text import buffers


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TABLES = op.compile_tokenizer(PATH)
MACHINE = op.Transducer(TABLES, 1 << 16)
EDGES = ["", " ", "a", "don't 's ''s  's\n's'sound I'lls we've'", "  a  \n\n b  c 　x ", "<|endoftext|> a<|endoftext|>  ", "<|endoftext", "|>",
         "x" * 3000, " " * 700 + "y", "àé日本語１２３", " \n", "'s's't're'rex'", " \u0085'll", "'" * 600, "😀" * 300, "ſ's ẞ½²"]


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def ours(texts, machine=MACHINE):
    return op.count_tokens(machine, *buffers(pa.array(texts, pa.string()))).tolist()


def test_edges():
    assert ours(EDGES) == library(EDGES)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aestvrlmd' \n\t "), st.characters(exclude_categories=["Cs"])), max_size=60), max_size=8))
def test_random_texts_equal_library(texts):
    assert ours(texts) == library(texts)


def test_every_code_point_has_the_library_class():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 64 == 0)]
    for lo in range(0, len(points), 4096):
        texts = [f"a{chr(c)}.1{chr(c)}. {chr(c)}" for c in points[lo:lo + 4096]]
        pre = [len(LIBRARY.pre_tokenizer.pre_tokenize_str(t)) for t in texts]
        data, offsets = buffers(pa.array(texts))
        starts = op.piece_starts(data, offsets[:-1], TABLES["classes"])
        assert np.add.reduceat(starts.astype(int), offsets[:-1]).tolist() == pre


@pytest.mark.parametrize("chunk", [1, 3, 16])
def test_chunks_compose(chunk, monkeypatch):
    monkeypatch.setattr(op.emitted, "__defaults__", (chunk,))
    assert ours(EDGES) == library(EDGES)


def test_full_table_is_emptied():
    tiny = op.Transducer(TABLES, 1 << 9)
    for t in EDGES:
        if len(t) < 200:
            assert ours([t], tiny) == library([t])


def test_documents(spark, small):
    got = op.token_counts(small, PATH).collect()
    texts = {r.doc_id: r.text for r in small.collect()}
    assert [r.n_tokens for r in got] == library([texts[r.doc_id] for r in got])
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) for r in got) and len(got) == len(texts)


def test_nulls_repeats_empty_and_extra_columns(spark):
    rows = [(1, None, 9), (None, "a b", 9), (1, "", 9), (None, "a b", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    assert Counter(map(tuple, op.token_counts(df, PATH).collect())) == Counter([(1, 0, 0), (None, 3, 2), (1, 0, 0), (None, 3, 2)])
    assert op.token_counts(df.limit(0), PATH).collect() == []
