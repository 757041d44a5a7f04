from collections import Counter

import corpus_pipeline as cp
from tests.llm.test_decontaminate import brute as brute_hits
from tests.llm.test_jaccard_join import brute as brute_groups


def test_stages_in_order():
    assert [name for name, _ in cp.STAGES] == ["toxicity", "near_duplicates", "repeated_substrings", "decontaminate", "byte_bpe"]


def test_near_duplicates_keeps_one_of_each_group(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(5000, ""), (5001, None), (5002, " ")]
    more = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], docs.schema)
    got = sorted(r.doc_id for r in cp.near_duplicates(spark, more, sf_dir).collect())
    assert got == sorted(d for d, n, c in brute_groups(rows) if n == 0 or c == d)


def test_near_duplicates_loses_no_row_for_a_shared_id(spark, sf_dir):
    one, other, third = ("alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight", "red green blue black white grey brown pink")
    rows = [(1, one), (1, other), (2, one), (1, one), (None, other), (None, third), (None, third), (None, None), (3, "")]
    docs = spark.createDataFrame([(d, t, "s", k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, source string, _nth int")
    got = sorted(((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, sf_dir).collect()), key=str)
    assert got == sorted([(1, one), (1, other), (None, third), (None, None), (3, "")], key=str)


def test_decontaminate_drops_hit_documents_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = sorted(d for d, _, hit, _ in brute_hits([(r.doc_id, r.text) for r in docs.collect()], items) if not hit)
    assert sorted(r.doc_id for r in cp.decontaminate(spark, docs, sf_dir).collect()) == want


def test_repeated_substrings_keeps_columns_and_clean_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = cp.repeated_substrings(spark, docs, sf_dir)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(len(r.text) <= len(texts[r.doc_id]) and r.n_chars == len(r.text) for r in rows)
    assert sum(r.text == texts[r.doc_id] for r in rows) > 0.5 * len(texts)


def test_run(spark, sf_dir):
    rows = cp.run(spark, sf_dir).collect()
    assert 0 < len(rows) < 200 and all(r.round_trip and len(r.ids) == r.n_tokens for r in rows)
    assert max(Counter(r.doc_id for r in rows).values()) == 1


def test_empty_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
