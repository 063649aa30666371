import re
from collections import Counter

import pytest

from gridloom.llm.decontamination import contained_items, drop_contaminated


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sets(text, size=5):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, items):
    out = Counter()
    for d, t in docs:
        own = sets(t)
        for i, q in items:
            need = sets(q)
            if need and len(need & own) >= 0.8 * len(need) - 1e-9:
                out[(d, i, len(need), len(need & own))] += 1
    return out


def run(spark, docs, items, **options):
    docs, items = (spark.createDataFrame(x, f"{n} long, text string, n_item string") for x, n in (([(*r, "x") for r in docs], "doc_id"), ([(*r, "x") for r in items], "item_id")))
    return Counter((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contained_items(docs, items, **options).collect())


BASE = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, BASE), (2, "one two three"), (3, None), (4, " \n"), (5, "A b C d e"), (None, "k l m n o p"), (7, " ".join(["same"] * 9)), (1, BASE)]
DOCS = [(1, "x y " + BASE.upper() + " z"), (2, "One two THREE"), (3, "zero one two three"), (4, None), (5, ""), (6, "q a B c D e f"), (None, "k l m n o p"),
        (8, "same " * 4), (9, "same " * 5000), (10, " ".join(f"w{i}" if i not in (3, 20) else "no" for i in range(30))),
        (11, " ".join(f"w{i}" if i != 3 else "no" for i in range(30))), (11, " ".join(f"w{i}" if i != 3 else "no" for i in range(30))), (12, "v " * 9000 + BASE)]


@pytest.mark.parametrize("item_bytes", [1 << 20, 60])
def test_edges_equal_brute_force(spark, item_bytes):
    assert run(spark, DOCS, ITEMS, item_bytes=item_bytes) == brute(DOCS, ITEMS)


def test_documents_equal_brute_force(spark, small):
    rows = [tuple(r) for r in small.select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    found = run(spark, rows, items)
    assert found == brute(rows, items) and found


def test_drop_keeps_columns_and_clean_documents(spark):
    docs = spark.createDataFrame([(d, t, "en", "m") for d, t in DOCS], "doc_id long, text string, lang string, matches string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    bad = {d for d, *_ in brute(DOCS, ITEMS)}
    left = drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert Counter(map(tuple, left.collect())) == Counter((d, t, "en", "m") for d, t in DOCS if d not in bad)
    assert drop_contaminated(docs.limit(0), items).collect() == [] and drop_contaminated(docs, items.limit(0)).count() == len(DOCS)
