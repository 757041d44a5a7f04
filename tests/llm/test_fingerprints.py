import hashlib

import pytest
from pyspark.sql import functions as F

from innlake.llm import fingerprints as fp
from innlake.llm import queries


def prints(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    return {r.k: (list(r.lanes), r.features) for r in fp.fingerprints(rows, ["k"]).collect()}


def test_order_independent_and_exact(spark):
    got = prints(spark, ["a b\nc d", "c d\na b", "a b\nc d\nc d", "a b\nc e", "", None, "\n", "x" * 200_000, " ", "a  b\nc d"])
    assert got[0] == got[1] and got[4] == got[5]
    assert len({tuple(v[0]) for k, v in got.items() if k not in (1, 5)}) == 8


def test_insertion_and_deletion(spark):
    got = prints(spark, ["one two three four\nfive six", "seven\néight nine", "one two three four\nfive six\nseven\néight nine"])
    df = spark.createDataFrame([tuple(got[k][0] for k in range(3))], "a array<long>, b array<long>, both array<long>")
    row = df.select(fp.plus(F.col("a"), F.col("b")).alias("both"), fp.minus(F.col("both"), F.col("b")).alias("a")).first()
    assert list(row.both) == got[2][0] and list(row.a) == got[0][0]


def test_likeness_of_long_texts(spark):
    words = lambda name: " ".join(f"{name}{k % 50_021}" for k in range(200_000))
    a, b = words("a"), words("b")
    got = prints(spark, [a, b, a + " one more", "the same line again\n" * 70_000, "another line here now\n" * 70_000])
    df = spark.createDataFrame([(*got[x], *got[y]) for x, y in ((0, 1), (0, 2), (3, 4), (0, 0))], "a array<long>, m long, b array<long>, n long")
    unrelated, near, lines, same = (r.x for r in df.select(fp.likeness(F.col("a"), F.col("m"), F.col("b"), F.col("n")).alias("x")).collect())
    assert unrelated < 0.5 and lines < 0.5 and near > 0.99 and same == 1


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()), reverse=True)
    out = []
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [(1, "only")], [(1, "abcdef"), (1, "abcdef"), (1, "zz é😀 zz"), (None, "null id"), (None, None), (7, ""), (900, "x y z " * 50), (901, None)],
    [(k * k, f"text {k} " * (k % 5)) for k in range(60)],
])
def test_edits_against_python(spark, rows):
    got = fp.compared_with_edits(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bucket string")).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == brute(rows)
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


def test_empty_table(spark):
    assert fp.compared_with_edits(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op4_fingerprints(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == brute(rows)
    texts = dict(rows)
    by_print = {}
    for r in got:
        by_print.setdefault(r.fingerprint, set()).add(texts[r.doc_id])
    assert all(len(v) == 1 for v in by_print.values()) and len(by_print) == len(set(texts.values()))
    assert sum(r.near_edited > r.near_next for r in got) > 0.9 * len(got)
    assert sum(r.near_edited for r in got) / len(got) > 0.5 > 0.3 > sum(r.near_next for r in got) / len(got)
