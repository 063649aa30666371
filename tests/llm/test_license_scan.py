import random
from itertools import combinations

import pytest

from gridloom.llm import license_scan as op


@pytest.mark.parametrize("seed", range(20))
def test_longest_increasing_subsequence(seed):
    rng = random.Random(seed)
    places = rng.sample(range(20), rng.randrange(0, 9))
    got = [places[i] for i in op.increasing(places)]
    assert got == sorted(got)
    assert len(got) == max(k for k in range(len(places) + 1) for c in combinations(places, k) if list(c) == sorted(c))


@pytest.mark.parametrize("seed", range(20))
def test_alignment_is_increasing_and_equal(seed):
    rng = random.Random(seed)
    a = [rng.randrange(12) for _ in range(15)]
    b = [x for x in a if rng.random() < 0.8] + [rng.randrange(30) for _ in range(3)]
    pairs = op.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert op.patience(a, a) == [(i, i) for i in range(len(a))]


def test_notices_in_documents(spark):
    mit, apache, notice = (op.TEMPLATES[k] for k in ("MIT", "Apache-2.0", "MIT-notice"))
    worn = notice.replace("hereby ", "").replace("Software", "Program", 1).upper()
    rows = [(1, f"the license of the day\n{mit}\nunder the tree"), (2, f"{apache} x {mit} y {mit}"), (3, "the MIT under License released"), (4, None), (5, " "),
            (None, "Released under the the MIT License"), (7, "word " * 20000 + worn), (8, "***"), (8, "***"), (9, "licensed under " * 40)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, license int")
    got = {r.doc_id: r for r in op.scan_licenses(df).collect()}
    assert (got[1].license, got[1].coverage) == ("MIT", 1.0) and [(n.start, n.end) for n in got[1].notices] == [(5, 10)]
    assert got[2].license == "Apache-2.0" and sorted(n.license for n in got[2].notices) == ["Apache-2.0", "MIT", "MIT"]
    assert got[None].license == "MIT" and got[7].license == "MIT-notice" and got[7].coverage > 0.95
    assert all(got[i].license is None and got[i].coverage == 0 and got[i].notices == [] for i in (3, 4, 5, 8, 9))
    assert op.scan_licenses(df).count() == len(rows) and op.scan_licenses(df.limit(0)).collect() == []


def test_license_lines_of_the_corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: {n.license for n in r.notices} for r in op.scan_licenses(docs).collect()}
    for r in docs.collect():
        lines = {k for k in ("Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0") if op.TEMPLATES[k] in r.text}
        assert got[r.doc_id] == lines


NEIGHBOURS = {
    "Released under the BSD License": "BSD", "Released under the 3-Clause BSD License": "BSD-3-Clause-line", "Released under the ISC License": "ISC",
    "Licensed under CC BY 4.0": "CC-BY-4.0-short", "Licensed under CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0-short", "Licensed under CC BY-NC 5.0": None, "Licensed under CC0 1.0": "CC0-1.0",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "CC-BY-NC-4.0-long",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "CC-BY-4.0",
    "Licensed under the Apache License, Version 1.1": "Apache-1.1", "Licensed under the Apache License, Version 2.1": None, "Released under the Zope License": None,
    "This work is licensed under the GNU General Public License, version 2": "GPL-2.0", "This work is licensed under the GNU General Public License, version 4": None,
    "This work is licensed under the GNU Lesser General Public License, version 3": "LGPL-3.0", "This work is licensed under the GNU Affero General Public License v3.0": "AGPL-3.0-v-dotted",
    op.TEMPLATES["GPL-3.0-header"].replace("version 3", "version 2"): "GPL-2.0-header",
    op.TEMPLATES["GPL-3.0-header"].replace("General", "Lesser General").replace("program", "library"): "LGPL-3.0-header",
    op.TEMPLATES["GPL-3.0-header"].replace("version 3", "version 4"): None,
    "Licensed under the Apache License 2.0": "Apache-2.0", "Licensed under the Apache Software License, Version 2.0": "Apache-2.0", "Licensed under the Apache License, Version 2": "Apache-2.0-short",
    "This work is licensed under the GNU Public License, version 3": "GPL-3.0", "This work is licensed under the GNU General Public License v3": "GPL-3.0-v",
    "This work is licensed under the GNU General Public License, version 4, section 3": None, "Released under the MIT/X11 License": "MIT-X11",
}


def test_neighbours_of_a_license_are_told_apart(spark):
    texts = [f"some words before it {t}. And some behind it" for t in NEIGHBOURS]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {n.license for n in r.notices} for r in op.scan_licenses(rows).collect()}
    assert got == {i: {n} - {None} for i, n in enumerate(NEIGHBOURS.values())}


def test_every_template_is_found_as_itself(spark):
    rows = spark.createDataFrame(list(enumerate(op.TEMPLATES.values())), "doc_id long, text string")
    got = {r.doc_id: (r.license, r.coverage) for r in op.scan_licenses(rows).collect()}
    assert got == {i: (n, 1.0) for i, n in enumerate(op.TEMPLATES)}


def test_worn_notice_is_not_taken_for_a_part_of_it(spark):
    worn = op.TEMPLATES["BSD-3-Clause-notice"].replace("specific prior", "our").replace("copyright holder", "author")
    assert [n.license for n in op.scan_licenses(spark.createDataFrame([(1, worn)], "doc_id long, text string")).first().notices] == ["BSD-3-Clause-notice"]
