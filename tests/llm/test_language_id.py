import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from gridloom.llm import language_id as op
from gridloom.llm.text import blank_cuts, buffers

CODES = op.letter_codes()


def grams(text):
    """Counts of the n-grams of a text's words, each with a blank on either side."""
    codes = [int(CODES[ord(c)]) for c in text or ""]
    words, out = [], Counter()
    for before, c in zip([0, *codes], codes):
        if c and not before:
            words.append([])
        if c:
            words[-1].append(c)
    for w in words:
        out.update(w)
        out.update((1 << 36) | (a << 12) | b for a, b in zip([0, *w], [*w, 0]))
        out.update((2 << 36) | (a << 24) | (b << 12) | c for a, b, c in zip([0, *w], w, [*w[1:], 0]))
    return out


def profile(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]]


TEXTS = ["Ab, c-d éÉ", "", "日本 語x a", "1 2 !", "a" * 500, None, "zz yy zz"]


def test_counts_and_distances_equal_brute_force():
    data, offsets = buffers(pa.array(TEXTS))
    rows, own, counts = op.gram_counts(data, offsets, CODES)
    assert Counter({(r, g): n for r, g, n in zip(rows.tolist(), own.tolist(), counts.tolist())}) == Counter({(i, g): n for i, t in enumerate(TEXTS) for g, n in grams(t).items()})
    size = 6
    theirs = [profile(grams("ab ab ac c d"), size), profile(grams("zz z yy"), size)]
    every = np.unique(np.array(sum(theirs, [])))
    ranks = np.array([[p.index(g) if g in p else size for g in every.tolist()] for p in theirs])
    far, filled = op.distances(data, offsets, CODES, every, ranks, size)
    for t, f, n in zip(TEXTS, far, filled, strict=True):
        mine = profile(grams(t), size)
        assert n == len(mine)
        assert f.tolist() == [sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(mine)) for p in theirs]


def test_profiles_equal_brute_force_and_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.collect()
    held = {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    codes = spark.sparkContext.broadcast(CODES)
    known = op.language_profiles(docs.where(~docs.doc_id.isin(list(held))), codes, size=50).collect()
    for lang in ("de", "es"):
        total = Counter()
        for r in rows:
            if r.lang == lang and r.doc_id not in held:
                total.update(grams(r.text))
        assert [r.gram for r in sorted((r for r in known if r.lang == lang), key=lambda r: r["rank"])] == profile(total, 50)
    found = {r.doc_id: r for r in op.identify(docs).collect()}
    assert len(found) == len(rows) and all(found[d].held_out == (d in held) for d in found)
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in rows if r.doc_id in held]) > 0.95


def test_nulls_repeats_ties_and_empty_tables(spark):
    rows = [(0, "abc abc", "xx", 1), (0, "abc abc", "xx", 1), (None, "def def", None, 1), (2, None, "yy", 1), (3, "", None, 1), (4, "12 !?", "xx", 1), (5, "abc " * 9000, None, 1), (6, "def", "yy", 1), (7, "q", "zz", 1), (8, "q", "ww", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = op.identify(docs, folds=1, held_out=9).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[0].lang_pred == "xx" and by[0].score == 1.0 and by[None].lang_pred == "yy"
    assert [(by[i].lang_pred, by[i].score) for i in (2, 3, 4)] == [("und", 0.0)] * 3 and by[5].lang_pred == "xx" and by[7].lang_pred == "ww"
    assert all(r.lang_pred == "und" for r in op.identify(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect())
    assert op.identify(docs.limit(0)).collect() == []


def test_texts_of_marks_only_have_no_letter(spark):
    texts = ["\u0301\u0302", "e\u0301", "\u0301 日", "12 \u0300", "", "é", "ʰ", "ª"]
    assert op.with_letters(*buffers(pa.array(texts))).tolist() == [False, True, True, False, False, True, True, True]
    rows = [(i, t, "xx" if i == 1 else None) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.lang_pred, r.score) for r in op.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), folds=1, held_out=9).collect()}
    assert got[0] == got[3] == got[4] == ("und", 0.0) and got[1] == ("xx", 1.0) and got[5][0] == "xx"


def test_a_long_text_is_counted_in_pieces():
    rng = np.random.default_rng(4)
    text = " ".join(rng.choice(["ab", "c-d", "éÉx", "日本", "12", "\n", "z" * 70], 900))
    data, at = buffers(pa.array([text]))
    for limit in (16, 50, 333):
        cuts = list(blank_cuts(data, limit))
        assert cuts[0][0] == 0 and cuts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:])) and len(cuts) > 3
        for got, want in zip(op.slice_counts(data, at, CODES, limit), op.gram_counts(data, at, CODES)):
            assert np.array_equal(got, want)
    lone = buffers(pa.array(["w" * 400]))
    assert list(blank_cuts(lone[0], 50)) == [(0, 400)]
    assert [x.tolist() for x in op.slice_counts(*lone, CODES, 50)] == [x.tolist() for x in op.gram_counts(*lone, CODES)]


def test_a_text_of_several_megabytes(spark):
    docs = spark.createDataFrame([(1, "abc def " * 700_000, "xx"), (2, "abc def", None), (3, "uvw zyx", "yy")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in op.identify(docs, folds=1, held_out=9).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "xx" and got[1].score == got[2].score == 1.0 and got[3].lang_pred == "yy"
