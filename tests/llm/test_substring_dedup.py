import re
from collections import Counter

import pytest

from gridloom.llm.substring_dedup import cut_repeated, remove_repeated


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, window):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (key, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        spans = [[j, None] for j in sorted(gone) if j - 1 not in gone]
        for s in spans:
            s[1] = next(j for j in range(s[0], len(w) + 1) if j not in gone)
        out.append((key, len(w), len(gone), tuple(map(tuple, spans)), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return Counter(out)


def run(spark, rows, window):
    df = remove_repeated(spark.createDataFrame(rows, "doc_id long, text string"), window=window)
    return Counter((r.row.doc_id, r.n_words, r.n_removed, tuple((s.start, s.end) for s in r.spans), r.kept_text) for r in df.collect())


EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "a b c d e f g"), (5, "x a b c\td  e y"), (5, "x a b c\td  e y"), (None, "q r s t u"),
         (7, "z z z z z z"), (8, "é ü a b c d"), (9, "only"), (10, "w " * 5000 + "end"), (None, None)]


@pytest.mark.parametrize("window", [1, 3, 4])
def test_edges_equal_brute_force(spark, window):
    assert run(spark, EDGES, window) == brute(EDGES, window)


def test_documents_equal_brute_force(spark, small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert run(spark, rows, 35) == brute(rows, 35)


def test_many_blocks_equal_brute_force(spark, small, monkeypatch):
    import gridloom.llm.substring_dedup as op
    monkeypatch.setattr(op, "plan", lambda total: (7, 3))
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert run(spark, rows, 35) == brute(rows, 35)


def test_empty_table_and_clashing_columns(spark):
    assert run(spark, [], 3) == Counter()
    df = spark.createDataFrame([(1, "a b c a b c", "n", 5)], "doc_id long, text string, spans string, n_words int")
    row = remove_repeated(df, window=3).first()
    assert (row.n_words, row.n_removed, row.row.spans, row.row.n_words) == (6, 6, "n", 5)


def test_cut_leaves_the_rest_as_it_was(spark):
    rows = [(1, " x  a b\nc d\ty ", 15, "en"), (2, "a b c d\n\nélan", 13, "m"), (3, None, 0, "n"), (4, "clean\n  text", 12, "k"), (5, "a b c d", 7, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, kept_text string")
    got = sorted(map(tuple, cut_repeated(df, window=4).collect()))
    assert got == [(1, " x  \ty ", 7, "en"), (2, "\n\nélan", 6, "m"), (3, "", 0, "n"), (4, "clean\n  text", 12, "k"), (5, "", 0, "z")]


def test_columns_that_cannot_be_hashed_pass_through(spark):
    df = spark.createDataFrame([(1, "a b c a b c", {"k": 1}, [1])], "doc_id long, text string, m map<string,int>, l array<int>")
    row = remove_repeated(df, window=3).first()
    assert (row.n_removed, row.row.m, row.row.l) == (6, {"k": 1}, [1])
