import hashlib
import re
from collections import defaultdict

import pytest

from innlake.llm import queries
from innlake.llm.decontaminate import contaminated, find_benchmark

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        for k in range(len(w) - n + 1):
            windows[tuple(w[k : k + n])].add(str(item))
    sizes = sorted({len(k) for k in windows})
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[k : k + n]))):
                    hit.update(range(k, k + n))
                    found |= names
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r.hit_items)) for r in frame.collect()), key=str)


CASES = [
    (1, None), (2, ""), (3, "one two THREE four five six seven eight nine ten eleven"), (3, "x one two three four five six seven eight nine ten"),
    (4, "short item"), (5, "a short-ITEM b short item short"), (6, "ärger ÄRGER 12\x00ab"), (7, "solo solo solo"), (8, " ".join(["rep"] * 300)),
    (None, "short item"), (9, "...,,,"), (5, "a short-ITEM b short item short"),
]
ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (1, "short item"), (2, "solo"), (3, None), (4, ""), (None, "nine ten"), (5, " ".join(["rep"] * 14)), (6, "Ärger"), (12, "SHORT item!")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 20])
def test_cases_against_brute_force(spark, block_bytes):
    docs = spark.createDataFrame([(d, t, "kept", 1.5) for d, t in CASES], "doc_id long, text string, n_words string, other double")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = contaminated(docs, items, block_bytes=block_bytes)
    assert result(got) == brute(CASES, ITEMS)
    assert {"other", "n_words"} <= set(got.columns) and dict(got.dtypes)["n_words"] == "bigint"


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert result(contaminated(docs, none)) == [(1, 2, 0, [])]
    assert find_benchmark(docs.limit(0), none).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)]
    got = queries.op10_decontaminate(spark, sf_dir)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert any(r[-1] for r in want)
