import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from innlake.llm import ngram_lm, queries
from innlake.llm.ngram_lm import _xxhash_parts, score_held_out, train

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(rows):
    tokens = [[*WORD.findall((t or "").encode().lower()), None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    total, size = sum(counts.values()), len(counts)
    return sorted(((d, h, len(t), sum(counts[w] > 0 for w in t), total, round(sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (size + 1))) for w in t), 6))
                   for (d, _), t, h in zip(rows, tokens, held)), key=str)


def result(frame):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in frame.collect()), key=str)


ROWS = [(k, f"the Cat {'sat on the mat ' * (k % 4)} w{k % 7} end{k}") for k in range(40)] + [
    (40, None), (41, ""), (42, "  \t"), (43, "x" * 30_000), (44, "the " * 3000), (3, "again"), (3, "again"), (None, "no id at all")]


@pytest.mark.parametrize("head,size", [(1 << 20, 64 << 20), (5, 1 << 20), (5, 60)])
def test_base_against_brute_force_and_parts_agree(spark, head, size):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, row int")
    got = score_held_out(docs, head_words=head, filter_bytes=size)
    assert result(got) == brute(ROWS)
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got.collect())


def test_parts_do_not_change_scores(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    one, many = ([r.score for r in score_held_out(docs, filter_bytes=size).orderBy("doc_id", "n_tokens", "score").collect()] for size in (64 << 20, 100))
    assert np.allclose(one, many, atol=0.6)


@pytest.mark.parametrize("size", [64 << 20, 60])
def test_head_does_not_change_scores(spark, size):
    docs = spark.createDataFrame([*ROWS, (50, "never seen words only"), (7, "never seen the cat")], "doc_id long, text string")
    whole, few = (sorted((r.doc_id or -1, r.n_tokens, r.score) for r in score_held_out(docs, head_words=head, filter_bytes=size).collect()) for head in (1 << 20, 5))
    assert np.allclose([r[2] for r in whole], [r[2] for r in few], atol=1e-6)
    assert any(r.n_known < r.n_tokens for r in score_held_out(docs, head_words=5, filter_bytes=size).collect())


def brute_scores(rows):
    """Scores with exact tables in place of the filter, counts and shares rounded as its levels are."""
    tokens = [[*WORD.findall((t or "").encode().lower()), None] for _, t in rows]
    trained = [t for (d, _), t in zip(rows, tokens) if not (d is not None and zlib.crc32(str(d).encode()) % 5 == 1)]
    words, pairs = Counter(w for t in trained for w in t), Counter(p for t in trained for p in zip([None, *t], t))
    bottom = sum(words.values()) + 0.5 * (len(words) + 1)
    size = lambda level: 2 * 2 ** ((level - 1) / 2)
    level = {p: 1 + math.floor(2 * math.log2(n / 2) + 1e-9) for p, n in pairs.items() if n >= 2}
    kept = Counter()
    for (h, _), x in level.items():
        kept[h] += size(x) - 0.7
    out = []
    for (d, _), text in zip(rows, tokens):
        total = 0.0
        for h, w in zip([None, *text], text):
            p = (words[w] + 0.5) / bottom
            if h in kept:
                whole = size(max(1, 1 + math.ceil(2 * math.log2(words[h] / 2) - 1e-9)))
                seen = min(1.0, (size(level[h, w]) - 0.7) / whole) if (h, w) in level else 0.0
                share = min(8, math.ceil(8 * kept[h] / words[h])) / 8
                p = min(1.0, seen + max(1 - share, 1 / 64) * p)
            total += math.log10(p)
        out.append((d if d is not None else -1, len(text), total))
    return sorted(out)


@pytest.mark.parametrize("head", [1 << 20, 3, 0])
def test_scores_against_exact_counts(spark, head):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.score) for r in score_held_out(docs, head_words=head).collect())
    want = brute_scores(ROWS)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[2] for r in got], [r[2] for r in want], atol=1e-6)


def test_head_is_bounded(spark):
    docs = spark.createDataFrame([("a " * 5000 + "b " * 4000 + "c " * 3000 + "d e f",)], "text string")
    assert [len(train(docs, head_words=n).head) for n in (0, 1, 2, 3, 100)] == [0, 1, 2, 3, 7]


def test_hash_is_sparks(spark):
    values = [0, 1, 5, 2**35, 2**36 - 1]
    rows = spark.createDataFrame([(v,) for v in values], "h long").select(F.pmod(F.xxhash64("h"), F.lit(97)).alias("p")).collect()
    assert [r.p for r in rows] == _xxhash_parts(np.array(values, np.uint64), 97).tolist()


def test_filter_keeps_levels(spark):
    texts = spark.createDataFrame([("a b " * 64,), ("c d",), ("c d",)], "text string")
    part = train(texts).part(0)
    codes, _ = ngram_lm._tokens(np.frombuffer(b"a b c d", np.uint8), np.array([0, 7]))
    levels = part.levels(ngram_lm._pairs(codes)[1])
    assert levels.tolist() == [0, 11, 0, 1, 1]  # 64, 2 and 2 times; "d" and the end twice


def test_empty_tables(spark):
    assert score_held_out(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op2_ngram_lm(spark, sf_dir)
    assert result(got) == brute(rows)
    held = got.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_a_word_is_looked_up_once_per_chunk(monkeypatch):
    """The head is searched for distinct words, not for every token."""
    data = np.frombuffer(b"to be or not to be " * 500, np.uint8)
    codes, _ = ngram_lm._tokens(data, np.array([0, len(data)]))
    asked, search = [], np.searchsorted

    def counted(table, keys, *more, **named):
        if table is head:
            asked.append(np.size(keys))
        return search(table, keys, *more, **named)

    head = np.sort(np.unique(codes).view(np.int64))
    monkeypatch.setattr(ngram_lm.np, "searchsorted", counted)
    monkeypatch.setattr(ngram_lm, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda self: 0})()}))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([False]), pa.array([data.tobytes().decode()], pa.large_string())], names=["doc_id", "held_out", "text"])
    part = ngram_lm.FilterPart(0, 1, np.zeros(ngram_lm.BLOCK_BYTES, np.uint8))
    counts = np.full(len(head), 7)
    scored, = ngram_lm._scorer(part, head, counts, 100.0, True, True)(iter([batch]))
    assert sum(asked) == len(head) == 5
    assert scored.column("n_tokens").to_pylist() == [3001]
    assert scored.column("score").to_pylist() == pytest.approx([3001 * np.log10(7.5 / 100)])
