import random

import numpy as np
import pyarrow as pa
import pytest

from gridloom.llm import fingerprint, hash_blocks, substring_dedup, text
from gridloom.llm.ngram_join import near_duplicates

P = text.PRIME


def thue_morse(a, b, n=2048):
    """A word and its complement: any polynomial modulo 2**64 with an odd base gives both one value."""
    signs = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[s] for s in signs), "".join((b, a)[s] for s in signs)


X, Y = thue_morse("a", "b")


def values_of(*texts):
    data, at = text.buffers(pa.array(texts, pa.string()))
    starts, ends, first = text.split_words(data, at)
    return text.word_values(data, starts, ends), first


def test_field_arithmetic_equals_whole_numbers():
    rng = random.Random(0)
    edge = [0, 1, 2, P - 1, P, (1 << 32) - 1, 1 << 32, (1 << 61) - 2, 1 << 60]
    a = edge + [rng.randrange(1 << 61) for _ in range(500)]
    b = [rng.randrange(1 << 61) for _ in range(250)] + edge * 3 + [rng.randrange(1 << 61) for _ in range(len(a) - 250 - 27)]
    got = text._times(np.array(a, np.uint64), np.array(b, np.uint64))
    assert [int(x) % P for x in got] == [x * y % P for x, y in zip(a, b)] and max(map(int, got)) < P
    assert [int(x) for x in text._field_sums(np.array(a, np.uint64))] == [sum(a[:i]) % P for i in range(len(a) + 1)]
    assert [int(x) for x in text._field_powers(12345, 40)] == [pow(12345, i, P) for i in range(40)]


@pytest.mark.parametrize("chunk", [3, 8, 1 << 18])
def test_windows_are_the_polynomials_of_their_words(monkeypatch, chunk):
    monkeypatch.setattr(text, "CHUNK", chunk)
    rng = random.Random(chunk)
    rows = [" ".join(rng.choice("ab") for _ in range(n)) for n in (0, 3, 40, 1, 4, 17)]
    values, first = values_of(*rows)
    got, at, row_first = text.window_values(values, first, 4)
    want = [[sum(int(v[i + j]) * pow(base, j, P) for j in range(4)) % P for r in range(len(rows)) for i in range(first[r], first[r + 1] - 3)] for v, base in zip(values, text.BASES)]
    assert got.tolist() == want and np.diff(row_first).tolist() == [max(0, n - 3) for n in np.diff(first)]
    words = [rows[r].split()[i:i + 4] for r in range(len(rows)) for i in range(len(rows[r].split()) - 3)]
    assert len({tuple(w) for w in words}) == len(set(zip(*text.wide(got))))
    assert at.tolist() == [i for r in range(len(rows)) for i in range(first[r], first[r + 1] - 3)]


def test_words_that_collide_modulo_a_power_of_two_do_not_here():
    data, at = text.buffers(pa.array([X, Y]))
    starts, ends, _ = text.split_words(data, at)
    old = text.word_hashes(data, starts, ends)
    new = text.word_values(data, starts, ends)
    assert old[0] == old[1] and (new[:, 0] != new[:, 1]).all()
    assert (values_of("a  b\ta", "a")[0][:, [0, 0]] == values_of("a  b\ta", "a")[0][:, [2, 3]]).all()
    # runs of words in the same pattern
    runs = [" ".join(t) for t in (X, Y)]
    v, first = values_of(*runs)
    pair = text.run_values(v, first[:-1], first[1:])
    assert (pair[:, 0] != pair[:, 1]).all()


def test_shingles_are_equal_where_their_words_are():
    rng = random.Random(3)
    rows = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 3, 40, 1, 4, 17, 2, 2)] + ["a a", "a", f"{X} {Y}", f"{Y} {X}"]
    data, at = text.buffers(pa.array(rows))
    hashes, of = text.shingles(data, at, 4)
    want = [(r, tuple(w[i:i + 4])) for r, w in enumerate(map(str.split, rows)) if w for i in range(max(1, len(w) - 3))]
    assert of.tolist() == [r for r, _ in want]
    names = dict(zip(hashes.tolist(), [w for _, w in want]))
    assert len(names) == len({w for _, w in want}) and all(names[h] == w for h, (_, w) in zip(hashes.tolist(), want))


def test_fingerprints_of_such_texts_differ():
    a, b, c, d = fingerprint.of_texts(pa.array([X, Y, " ".join(X), " ".join(Y)]))
    assert (a != b).any() and (c != d).any()


def test_many_equal_lines_do_not_wrap():
    a, b = (fingerprint.of_texts(pa.array(["same line\n" * n])) for n in (40_000, 20_000))
    assert fingerprint.likeness(a, b)[0] == pytest.approx(0.8)


def test_join_and_dedup_tell_such_texts_apart(spark):
    rows = [(1, f"x y {X} z"), (2, f"x y {Y} z"), (3, f"x y {X} z")]
    got = {r._id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    around = [" ".join(f"{side}{i}" for i in range(25)) for side in "pq"]
    rows = [(1, f"{around[0]} {X} {around[1]}"), (2, f"{around[0]} {Y} {around[1]}"), (3, "none")]
    kept = substring_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.row.doc_id: r.n_removed for r in kept} == {1: 0, 2: 0, 3: 0}


def test_wide_hashes_sort_by_both_parts_and_pack():
    rng = np.random.default_rng(1)
    for high, low in ((rng.integers(0, 50, 400), rng.integers(0, 4, 400)), (rng.integers(0, 1 << 62, 400), rng.integers(0, 1 << 32, 400)), (np.zeros(0), np.zeros(0)), (np.full(5, 7), np.full(5, 9))):
        high, low = high.astype(np.uint64), low.astype(np.uint32)
        order, new = hash_blocks.ascending(high, low)
        pairs = list(zip(high[order].tolist(), low[order].tolist()))
        assert pairs == sorted(zip(high.tolist(), low.tolist())) and [p for p, n in zip(pairs, new) if n] == sorted(set(pairs))
        own = high[order[new]], low[order[new]]
        back = hash_blocks.unpack_wide(hash_blocks.pack_wide(*own))
        assert all(np.array_equal(x, y) for x, y in zip(own, back))


def test_equal_high_parts_with_different_low_ones_are_not_repeats(spark, monkeypatch):
    rows = [(i, " ".join(random.Random(i % 3).choices("abc", k=30))) for i in range(7)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((r.row.doc_id, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeated(df, window=5).collect())
    real = text.wide
    monkeypatch.setattr(substring_dedup, "wide", lambda v: ((real(v)[0] >> np.uint64(60)) << np.uint64(60), real(v)[1]))
    assert sorted((r.row.doc_id, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeated(df, window=5).collect()) == want
