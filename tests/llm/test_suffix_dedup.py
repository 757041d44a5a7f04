import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from innlake.llm import queries, suffix_dedup
from innlake.llm.suffix_dedup import repeated, without_repeats


def brute(texts, length=200):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(60) for _ in range(4)]
    texts = [prose(rng.randint(5, 150)) for _ in range(12)]
    texts += [f"{prose(20)} {rng.choice(passages)[rng.randint(0, 40):]} {prose(30)}" for _ in range(20)]
    texts += [texts[0], texts[0], None, "", "short", "short", "x" * 450, "ab" * 150, "ab" * 99, prose(40) * 3, "é" * 210, passages[0][:200], "y" * 199]
    texts += [passages[1] + "a", passages[1] + "b", "c" + passages[1]]
    return texts


@pytest.mark.parametrize("seed,bucket_bytes", [(1, 2 << 20), (2, 3000)])
def test_against_brute_force(spark, monkeypatch, seed, bucket_bytes):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket_bytes)
    texts = made(seed)
    docs = spark.createDataFrame([(k if k % 7 else None, t, "old", k) for k, t in enumerate(texts)], "doc_id long, text string, kept string, at long")
    got = sorted(without_repeats(docs).collect(), key=lambda r: r["at"])
    assert len(got) == len(texts)
    for row, (size, removed, spans, kept), text in zip(got, brute(texts), texts):
        assert (sum(b - a for a, b in zip(row.removed_from, row.removed_to)), len(row.removed_from), bytes(row.kept)) == (removed, spans, kept)
        assert row.text == text


def test_whole_characters_stay_text(spark):
    texts = made(3)
    rows = without_repeats(spark.createDataFrame([(t,) for t in texts], "text string"), whole_characters=True).collect()
    assert all(bytes(r.kept).decode() in ("", r.text) or r.removed_from for r in rows)


def test_every_repeated_continuation_meets_the_other_buckets():
    rng = random.Random(6)
    prose = lambda n: bytes(rng.choice(b"abcdefgh ") for _ in range(n))
    prefix = prose(150)
    ends = [prefix + prose(50) for _ in range(4)]

    def bucket(slices, first_id):
        n = len(slices)
        rows = pa.RecordBatch.from_arrays([
            pa.array([True] * n), pa.array(range(first_id, first_id + n), pa.int64()), pa.array([0] * n, pa.int64()), pa.array([0] * n, pa.int64()), pa.array(slices, pa.binary()),
        ], names=["wide", "h1", "h2", "first", "slice"])
        return [b.select(["part", "packed"]) for b in suffix_dedup._found(rows, 200, 1) if b.column("part").null_count == 0]

    sent = bucket(ends * 2, 0) + bucket(ends, 100)
    met = suffix_dedup._meeting(200)(pa.Table.from_batches(sent))
    assert sorted(met.column("h1").to_pylist()) == [100, 101, 102, 103]


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_multikey_sort_marks_ties_in_all_keys():
    rng = np.random.default_rng(5)
    keys = [rng.integers(0, 4, 300).astype(np.uint64) for _ in range(3)]
    times = Counter(zip(*(k.tolist() for k in keys)))
    assert repeated(keys).tolist() == [times[t] > 1 for t in zip(*(k.tolist() for k in keys))]


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {r.doc_id: (n, c, s, hashlib.sha256(k).hexdigest()) for r, (n, c, s, k) in zip(docs, brute([r.text for r in docs]))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op8_suffix_dedup(spark, sf_dir).collect()}
    assert got == want and any(v[1] for v in want.values())
