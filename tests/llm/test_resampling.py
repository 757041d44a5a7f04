import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from innlake.llm import resampling as r
from innlake.llm.arrowtext import LOWER, text_buffers

LONG = "x" * 70 + " " + "é" * 2000 + " " + "tail " * 3000


def words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(LOWER[b] for b in (text or "").encode()))


def features(text, buckets):
    w = words(text)
    return [zlib.crc32(b" ".join(w[i : i + k])) % buckets for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def test_buckets_equal_zlib():
    texts = ["One two, Two THREE 4 fünf", None, "", "a", LONG, "東京 -- 大阪"]
    text, bucket, n = r.feature_buckets(*text_buffers(pa.array(texts)), 10_000, 3)
    for k, t in enumerate(texts):
        assert sorted(bucket[text == k].tolist()) == sorted(features(t, 10_000)) and n[k] == len(words(t))


def test_planes_give_exact_sums():
    rng = np.random.default_rng(2)
    for low, high in ((-9000, 9000), (-16384, 16384), (0, 1), (3, 9), (-5, -1)):
        gains = rng.integers(low, high, 1000)
        row, bucket, count = rng.integers(0, 7, 900), rng.integers(0, 1000, 900), rng.integers(1, 70_000, 900)
        slots, first = np.unique(row * 1000 + bucket, return_index=True)
        row, bucket, count = slots // 1000, slots % 1000, count[first]
        want = np.bincount(row, (gains[bucket] * count).astype(float), 8).astype(int)
        assert r.GainPlanes(gains).weights(row, bucket, count, 8, 1000).tolist() == want.tolist()


def brute(docs, target, percent=5, least=20):
    """(doc_id, text) rows to (doc_id, n_features, weight, score, rank)."""
    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for _, x in docs:
        np.add.at(s, np.array(features(x, 10_000), int), 1)
    for x in target:
        np.add.at(t, np.array(features(x, 10_000), int), 1)
    S, T = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10_000) / ((a + 1) * (T + 10_000)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for k, x in docs:
        f = features(x, 10_000)
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([k, len(f), len(words(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((row for row in out if row[2] >= least), key=lambda row: (-row[4], row[0] is None, row[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[5] = place + 1
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr([x.doc_id, x.n_features, x.n_words, x.weight, x.score, x.rank]) for x in df.collect())


def test_equals_brute_force(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(r, "COPIES", 3)
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    docs += [(None, LONG), (None, None), (-1, ""), (-2, "short one"), (7, "the " * 30)] + [(-3, docs[5][1] + " of on " * 30)] * 8
    target = [d.text for d in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    df = spark.createDataFrame([(k, t, "x", "y", 1) for k, t in docs], "doc_id long, text string, rank string, weight string, _bucket int")
    other = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 60, 100):
        assert rows(r.resample(df, other, percent=percent)) == brute(docs, target, percent)


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(k, 30, 5) for k in (9, 3, None, 4)] + [(1, 30, 4), (2, 3, 99)], "doc_id long, n_words long, score long")
    got = {x.doc_id: x.rank for x in r.with_ranks(df, percent=80, least_words=20).collect()}
    assert got == {3: 1, 4: 2, 9: 3, None: 4, 1: None, 2: None}


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert r.resample(none, some).count() == 0
    row = r.resample(some, none, percent=100).first()
    assert row.rank == 1 and row.n_features == 117
