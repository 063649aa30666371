import functools
from collections import Counter

import test_decontamination
import test_ngram_join
import test_substring_dedup
from test_packing import check

import corpus_pipeline
from gridloom.llm import packing
from gridloom.llm.toxicity import toxicity

SF = "/root/testdata/sf0.01"


def words(text):
    return test_substring_dedup.WORD.findall(text)


def test_every_stage_equals_brute_force(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    names = docs.columns
    rows = [tuple(r) for r in docs.collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "packing"]

    def stage(k, rows):
        out = corpus_pipeline.STAGES[k][1](spark, spark.createDataFrame(rows, docs.schema), SF)
        if k < 4:
            assert out.columns == names
        return out.collect()

    toxic = {r.doc_id for r in toxicity(docs, labels).collect() if r.predicted}
    kept = [tuple(r) for r in stage(0, rows)]
    assert toxic and Counter(kept) == Counter(r for r in rows if r[0] not in toxic)

    monkeypatch.setattr(test_ngram_join, "shingles", functools.partial(test_ngram_join.shingles, size=corpus_pipeline.SHINGLE))
    least = {d: c for d, _, c in test_ngram_join.brute([r[:2] for r in kept], corpus_pipeline.PER_CENT)}
    rows, kept = kept, [tuple(r) for r in stage(1, kept)]
    assert len(kept) < len(rows) and Counter(kept) == Counter(r for r in rows if least[r[0]] == r[0])

    want = {d: (n, text) for d, _, n, _, text in test_substring_dedup.brute([r[:2] for r in kept], 35)}
    rows, kept = {r[0]: r for r in kept}, [tuple(r) for r in stage(2, kept)]
    assert len(kept) == len(rows) and any(n for n, _ in want.values())
    for doc_id, text, lang, source, n_chars in kept:
        n, left = want[doc_id]
        assert words(text) == left.split(" ") * bool(left) and n_chars == len(text) and (lang, source) == rows[doc_id][2:4]
        assert n or text == rows[doc_id][1]

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_ in test_decontamination.brute([r[:2] for r in kept], items)}
    rows, kept = kept, [tuple(r) for r in stage(3, kept)]
    assert bad and Counter(kept) == Counter(r for r in rows if r[0] not in bad)

    packed = stage(4, kept)
    check(packed, [r[:2] for r in kept], packing.BUCKETS, packing.BUDGET)
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, packed))


def test_nulls_repeats_and_empty_tables_go_through(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(test_ngram_join, "shingles", functools.partial(test_ngram_join.shingles, size=corpus_pipeline.SHINGLE))
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = [tuple(r) for r in docs.limit(60).collect()]
    odd = [(None, None, None, None, None), (9001, None, "en", "s", 0), (9002, "", None, None, 0), (None, "a null id here", "en", None, 14)]

    def run(name, rows, labels, items):
        folder = tmp_path / name
        spark.createDataFrame(rows, docs.schema).write.parquet(str(folder / "documents.parquet"))
        for table, kept in (("labels", labels), ("benchmark", items)):
            df = spark.read.parquet(f"{small}/{table}.parquet")
            (df if kept else df.limit(0)).write.parquet(str(folder / f"{table}.parquet"))
        return corpus_pipeline.run(spark, str(folder)).collect()

    got = Counter(r.doc_id for r in run("odd", rows + odd + rows[:3] + odd[:2], True, True))
    assert got[None] == 3 and got[9001] == 2 and got[9002] == 1  # blank rows stay, repeated ones too
    assert set(got) <= {r[0] for r in rows + odd} and all(n == 1 for d, n in got.items() if d is not None and d < 9000)
    assert run("none", [], True, True) == []
    assert Counter(r.doc_id for r in run("bare", rows, False, False)) == Counter(
        d for d, _, c in test_ngram_join.brute([r[:2] for r in rows], corpus_pipeline.PER_CENT) if c == d)
