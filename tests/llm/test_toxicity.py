import os

import numpy as np
import pytest

from innlake.llm import queries, toxicity
from innlake.llm.toxicity import fit, fit_on_labels, score

LARGER = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    if not os.path.isdir(LARGER):
        pytest.skip("provided tables are not here")
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{LARGER}/labels.parquet")
    model = fit_on_labels(docs, labels, fit_rows=2500)
    assert np.all(np.diff(model.thresholds) > 0)
    held = docs.join(labels.orderBy("doc_id").withColumnRenamed("toxic", "label"), "doc_id")
    rows = score(held, model).select("label", "toxic", "severity").collect()
    wrong = [r for r in rows if r.label != r.toxic]
    assert sum(r.label == 0 for r in wrong) <= 2
    # some of the labels are noise: these documents hold no abusive word
    assert sum(r.label == 1 for r in wrong) <= 0.08 * sum(r.label == 1 for r in rows)
    severity = [np.mean([r.severity for r in rows if r.label == k]) for k in (0, 1)]
    assert severity[0] < 0.1 and severity[1] > 1


@pytest.fixture(scope="module")
def model(spark):
    rng = np.random.default_rng(3)
    clean = [(" ".join(rng.choice(["the", "of", "sun", "tree", "river"], 12)), 0) for _ in range(120)]
    bad = [(" ".join([*rng.choice(["the", "of", "sun", "tree"], 8), *["vile"] * k, "foul"]), 1) for k in range(1, 7) for _ in range(5)]
    return fit(spark.createDataFrame([*clean, *bad, (None, 0), ("unlabelled", None), ("", 0)], "text string, toxic int"))


def test_severity_grows_and_edge_texts_are_clean(spark, model):
    texts = ["the river", "vile tree", "vile vile foul tree", "Vile VILE vile vile vile vile foul", None, "", "x " * 50_000]
    docs = spark.createDataFrame([(k, t, "mine", 2) for k, t in enumerate(texts)], "doc_id long, text string, toxic string, other int")
    rows = sorted(score(docs, model).collect(), key=lambda r: r.doc_id)
    assert [r.toxic for r in rows] == [False, True, True, True, False, False, False]
    assert rows[0].severity < rows[1].severity < rows[2].severity < rows[3].severity <= 3
    assert rows[3].grade == 3 and rows[0].grade == 0 and rows[0].other == 2


@pytest.mark.parametrize("rows", [[], [("a", 0)], [("a", 1)]])
def test_without_both_labels_nothing_is_toxic(spark, rows):
    model = fit(spark.createDataFrame(rows, "text string, toxic int"))
    got = score(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (got.severity, got.toxic) == (0.0, False)


def test_repeated_rows_and_empty_tables(spark, model):
    docs = spark.createDataFrame([(1, "vile foul tree")] * 3, "doc_id long, text string")
    rows = score(docs, model).collect()
    assert len(rows) == 3 and len({r.severity for r in rows}) == 1
    assert score(docs.limit(0), model).count() == 0
    none = fit_on_labels(docs.limit(0), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert not score(docs, none).first().toxic


def test_rows_of_the_fit_are_bounded(spark, monkeypatch):
    taken = []
    saved = toxicity.saved
    monkeypatch.setattr(toxicity, "saved", lambda df: taken.append(df.count()) or saved(df))
    rows = [("the same text again", k % 2) for k in range(500)] + [(f"other {k}", k % 2) for k in range(20)]
    for size in (5, 100, 510):
        fit(spark.createDataFrame(rows, "text string, toxic int"), fit_rows=size)
        assert taken[0] == size
        taken.clear()


def test_query_covers_all_documents(spark, sf_dir):
    got = queries.op3_toxicity(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
