import numpy as np
import pytest
from pyspark.sql import functions as F

from innlake.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, entries string, error double"


def frame(spark, vectors, ids=None, labels=None):
    ids, labels = ids or range(len(vectors)), labels or [0] * len(vectors)
    return spark.createDataFrame([(i, v, k, "x", 0.5) for i, v, k in zip(ids, vectors, labels)], SCHEMA)


def plain(vectors, parts, entries, rounds):
    """Codebooks, codes and errors by comparing every part with every entry."""
    points = np.floor(np.array(vectors, np.float32).astype(float) * 256).astype(int).reshape(len(vectors), parts, -1)
    books = points[:entries].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        away = ((points[:, :, None] - books[None]) ** 2).sum(3)
        code = away.argmin(2)
        if step < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    members = points[code[:, p] == e, p]
                    if len(members):
                        books[p, e] = members.sum(0) // len(members)
    return books, code, away.min(2).sum(1)


def test_grid_leaves_the_nearest(spark):
    rng = np.random.default_rng(4)
    for spread in (3, 40, 5000):
        points, entries = rng.integers(-spread, spread, (3000, 3)), rng.integers(-spread, spread, (40, 3))
        entries[7] = entries[3]
        got, away = vc.Grid(entries).nearest(points)
        every = ((points[:, None] - entries[None]) ** 2).sum(2)
        assert (got == every.argmin(1)).all() and (away == every.min(1)).all()


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(vc, "MOST_CELLS", 10)
    rng = np.random.default_rng(5)
    entries, grid = rng.integers(-50, 50, (9, 2)), None
    grid = vc.Grid(entries)
    for _ in range(20):
        points = rng.integers(-500, 500, (50, 2))
        assert (grid.nearest(points)[0] == ((points[:, None] - entries[None]) ** 2).sum(2).argmin(1)).all()
    assert len(grid.codes) <= 60


@pytest.mark.parametrize("parts,entries", [(4, 8), (16, 64)])
def test_codes_equal_plain_comparison(spark, parts, entries):
    vectors = np.random.default_rng(1).normal(0, 0.2, (300, 32)).round(3)
    vectors[40:60] = vectors[40]
    books, code, error = plain(vectors.tolist(), parts, entries, 2)
    df = frame(spark, vectors.tolist())
    got = vc.fit_codebooks(df, parts=parts, entries=entries)
    assert (got == books).all()
    rows = vc.compress(df, got).orderBy("vec_id").collect()
    assert [r.entries for r in rows] == code.tolist() and [r.error for r in rows] == error.tolist()
    back = vc.decompress(vc.compress(df, got), got).filter("vec_id = 3").first().approximate
    assert back == (np.concatenate([books[p, code[3, p]] for p in range(parts)]) / 256).tolist()


def test_what_is_dropped_and_ties(spark):
    good = [0.5, -0.25, 0.125, 1.0]
    vectors = [None, [0.5, None, 1.0, 2.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], good, good, [0.1, 0.2], [0.0] * 4, []]
    df = frame(spark, vectors, [0, 1, 2, 3, 7, 7, 8, None, 9], [None, 1, 1, 1, None, 1, 2, None, None])
    books = vc.fit_codebooks(df, parts=2, entries=64)
    assert books.tolist() == [[[128, -64], [128, -64], [0, 0]], [[32, 256], [32, 256], [0, 0]]]
    rows = {(r.vec_id, r.label): (r.entries, r.error, r.label_error) for r in vc.with_label_error(vc.compress(df, books)).collect()}
    assert rows == {(7, None): ([0, 0], 0, 0), (7, 1): ([0, 0], 0, 0), (8, 2): (None, None, None), (None, None): ([2, 2], 0, 0), (9, None): (None, None, 0)}


def test_empty_table(spark):
    df = frame(spark, [])
    books = vc.fit_codebooks(df)
    assert books.size == 0 and vc.with_label_error(vc.compress(df, books)).count() == 0
    unusable = frame(spark, [None, [1.0, 2.0, 3.0]])
    assert [r.entries for r in vc.compress(unusable, vc.fit_codebooks(unusable)).collect()] == [None]


def test_many_labels_go_by_shuffle(spark, monkeypatch):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id").cast("int")).alias("label"), F.col("id").alias("error"))
    few = {(r.label, r.error): r.label_error for r in vc.with_label_error(df).collect()}
    monkeypatch.setattr(vc, "BROADCAST_LABELS", 5)
    many = {(r.label, r.error): r.label_error for r in vc.with_label_error(df).collect()}
    assert few == many and many[(None, 3)] == sum(range(0, 3000, 3)) and len(many) == 3000


def test_large_components_are_refused(spark):
    df = frame(spark, [[3e38] * 32])
    with pytest.raises(Exception, match="too large"):
        vc.fit_codebooks(df)
