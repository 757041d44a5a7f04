import random
import re

import numpy as np
import pytest

from innlake.llm import jaccard_join, queries
from innlake.llm.jaccard_join import jaccard_components, prefixes

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(docs, size=5):
    sets = []
    for _, text in docs:
        w = WORD.findall((text or "").encode().lower())
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    parent = list(range(len(docs)))

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    holders = {}
    for k, s in enumerate(sets):
        for t in s:
            holders.setdefault(t, []).append(k)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            parent[top(a)] = top(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(k)] = min(doc, least.get(top(k), doc))
    return sorted(((d, len(s), least.get(top(k)) if s else d) for k, ((d, _), s) in enumerate(zip(docs, sets))), key=str)


def made(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["the", "The", "ä"]
    docs = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 9, 40, 120]))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy) if rng.random() < 0.8 else "\n".join(copy).upper())
    docs += [None, "", "  \t", "one", "ONE", "one two", "one two", "x" * 5000]
    rng.shuffle(docs)
    rows = [(k, t) for k, t in enumerate(docs)]
    return rows + rows[:3] + [(None, docs[5]), (None, "alone here"), (rows[7][0], rows[9][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = made(seed)
    docs = spark.createDataFrame([(d, t, 7) for d, t in rows], "doc_id long, text string, n int")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("bits", [6, 9])
def test_order_does_not_depend_on_tasks(spark, bits):
    rows = [(k, t) for k, (_, t) in enumerate(made(3, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = np.empty(0, np.uint64), np.empty(0, np.int64)
    one, many = (sorted(map(repr, prefixes(docs.repartition(n), *none, 5, 75, bits).collect())) for n in (1, 16))
    assert one == many and one


def test_frequent_tokens_change_no_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "OFTEN", 2)
    monkeypatch.setattr(jaccard_join, "TALLY", 50)
    monkeypatch.setattr(jaccard_join, "PACKED", 200)
    rows = made(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == brute(rows)


def test_very_long_texts(spark):
    rng = random.Random(9)
    long = [f"w{rng.randrange(50_000)}" for _ in range(60_000)]
    other = [*long[:54_000], *(f"v{k}" for k in range(6_000))]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(long[:40_000])), (4, " ".join(long[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in jaccard_components(docs).collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in queries.op6_jaccard_join(spark, sf_dir).collect()), key=str)
    assert got == brute(docs)
    assert any(c < d for d, _, c in got)


def test_near_copies_do_not_all_meet_pairwise(spark, monkeypatch):
    """The least set of a group is far from most copies, which must be joined by stars around other ones."""
    rng = random.Random(3)
    base = [f"b{k}" for k in range(120)]
    docs = []
    for k in range(160):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3])):
            copy[rng.randrange(20, 120)] = f"c{rng.randrange(10**9)}"
        docs.append((k, " ".join(copy)))
    docs += [(1000 + k, " ".join(base[:88] + [f"x{k}-{j}" for j in range(k)])) for k in range(4)]
    made_pairs = []

    def counted(*given, real=jaccard_join._possible):
        near = real(*given).cache()
        made_pairs.append(near.count())
        return near

    monkeypatch.setattr(jaccard_join, "_possible", counted)
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(brute(docs))
    assert made_pairs[1] < 500, made_pairs
