import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import fingerprint as op
from gridloom.llm.text import buffers, split_words, word_values


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_pieces(text):
    out = []
    for line in re.split("[\n\r]", text or ""):
        piece = []
        for w in WORD.findall(line):
            piece.append(w)
            data, at = buffers(pa.array([w]))
            if int(word_values(data, *split_words(data, at)[:2])[0, 0]) % op.CUT == 0:
                out.append(tuple(piece))
                piece = []
        if piece:
            out.append(tuple(piece))
    return out


def vec(*texts):
    return op.of_texts(pa.array(texts, pa.string()))


def test_pieces_equal_brute_force():
    texts = ["a b c d e f g h i j k l m n o p q r s t u v w x y z", "", " \n ", "one\r\ntwo three\n\nfour", None, "é ü\tß\n" * 4]
    _, first = op.pieces(*buffers(pa.array(texts)))
    assert np.diff(first).tolist() == [len(brute_pieces(t)) for t in texts]
    assert op.counts(vec(*texts)).tolist() == [len(brute_pieces(t)) for t in texts]


def test_order_does_not_matter_and_updates_need_no_text():
    lines = [f"line {i} of {i * 7}" for i in range(40)]
    random.Random(1).shuffle(lines)
    a, b, both = vec("\n".join(lines[:15])), vec("\n".join(lines[15:])), vec("\n".join(sorted(lines)))
    assert (op.insert(a, b) == both).all() and (op.delete(both, b) == a).all()
    assert not (vec("x y\nx y") == vec("x y")).all() and (vec("x  y \n") == vec("x y")).all()
    many = op.insert(np.repeat(a, 1, 0), vec("q\n" * 70000))
    assert op.counts(many)[0] == op.counts(a)[0] + 70000


def test_likeness_follows_the_shared_pieces():
    lines = [f"piece number {i}" for i in range(400)]
    whole = vec("\n".join(lines))
    for share in (0.25, 0.5, 0.9):
        k = int(400 * share)
        other = vec("\n".join(lines[:k] + [f"other {i} thing" for i in range(400 - k)]))
        a, b = (Counter(brute_pieces("\n".join(x))) for x in (lines, lines[:k] + [f"other {i} thing" for i in range(400 - k)]))
        truth = 2 * sum(n * b[p] for p, n in a.items()) / (sum(n * n for n in a.values()) + sum(n * n for n in b.values()))
        assert abs(op.likeness(whole, other)[0] - truth) < 0.25
    assert op.likeness(whole, whole)[0] == 1 and op.likeness(vec(""), vec(None))[0] == 1 and op.likeness(vec(""), whole)[0] == 0


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (d, t), (_, u) in zip(order, order[1:] + order[:1], strict=True):
        t, u = t or "", u or ""
        e = t[:len(t) - len(t) // 2] + u[:len(t) // 2]
        a, b, c = vec(t), vec(e), vec(u)
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), op.spelled(a)[0].as_py(), op.spelled(b)[0].as_py(), round(float(op.likeness(a, b)[0]), 9), round(float(op.likeness(a, c)[0]), 9)))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, near_next double")
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9)) for r in op.edited_fingerprints(df, **options).collect()), key=str)


EDGES = [(5, "abc déf"), (-3, None), (9, ""), (7, "日本語 x"), (7, "other"), (7, "other"), (None, "null id"), (1, "w " * 20000), (2, "x")]


@pytest.mark.parametrize("parts", [None, 3, 40])
def test_edges_equal_brute_force(spark, parts):
    assert run(spark, EDGES, parts=parts) == brute(EDGES)


def test_small_tables(spark):
    for rows in ([], [(1, "alone in here")], [(None, "a"), (None, "b")]):
        assert run(spark, rows, parts=5) == brute(rows)


def test_documents_equal_brute_force(spark, small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    assert run(spark, rows, parts=9) == brute(rows)
    plain = {r.doc_id: r.fingerprint for r in op.fingerprints(small).collect()}
    assert plain == {d: op.spelled(vec(t))[0].as_py() for d, t in rows}
