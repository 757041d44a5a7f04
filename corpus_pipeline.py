"""Cleaning a corpus in stages; each keeps the documents the next one works on.

1. toxicity: documents that the severity model calls toxic go. The model is fitted on the labels of the tables' folder.
2. near_duplicates: of each group of documents linked by word shingles one row stays, the one with the smallest id (null ids
   last, equal ids by the text's hash); rows that share an id but are not linked stay both, and documents without a word
   link with nothing and stay.
3. repeated_substrings: what stands at two places or more goes from the text, character by character, and
   documents of which nothing is left go with it. Texts that were empty before stay.
4. decontaminate: documents with a benchmark passage go.
5. byte_bpe: what is left is encoded; ids, their number and the decoded text's equality with the text are returned.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents. Null texts stay null until the
last stage. What a stage wrote is removed when the next one has been written; only the last one's input stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from innlake.llm import bpe
from innlake.llm.decontaminate import contaminated
from innlake.llm.jaccard_join import jaccard_components
from innlake.llm.queries import byte_bpe, table
from innlake.llm.suffix_dedup import without_repeats
from innlake.llm.toxicity import fit_on_labels, score
from innlake.llm.workspace import removed, saved

#: SQL has no ordinal regression and no byte-pair merges; the stages are tested against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_on_labels(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).where("not toxic").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keys = ["_id", "_unnamed", "_code"]
    groups = jaccard_components(docs).where("n_shingles > 0")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_code")).alias("first")
    leaders = groups.groupBy("component").agg(first).select(
        F.coalesce("first.doc_id", F.lit(0)).alias("_id"), F.col("first.doc_id").isNull().alias("_unnamed"), F.col("first.text_code").alias("_code")).distinct()
    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    coded = docs.where(~wordless).withColumns({
        "_id": F.coalesce("doc_id", F.lit(0)), "_unnamed": F.col("doc_id").isNull(), "_code": F.xxhash64(F.col("text").cast("string"))})
    # rows of one id and text: the rank filter leaves one of each task before the shuffle
    once = F.row_number().over(Window.partitionBy(*keys).orderBy(*docs.columns))
    kept = coded.join(leaders, keys, "left_semi").withColumn("_nth", once).where("_nth = 1").select(*docs.columns)
    return kept.unionByName(docs.where(wordless))


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = without_repeats(docs, whole_characters=True)
    left = F.when(F.size("removed_from") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    kept = cut.where("octet_length(kept) > 0 or size(removed_from) = 0").withColumn("text", left)
    kept = kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept
    return kept.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contaminated(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select(*docs.columns)


def byte_bpe_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks, pattern = byte_bpe()
    texts = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    coded = bpe.decode(bpe.encode(texts, ranks, pattern, keep_text=False), ranks)
    same = F.sha2("decoded", 256) == F.col("digest")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("repeated_substrings", repeated_substrings),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, saved(stage(spark, docs, sf_dir))
        if k:
            removed(before)
    return STAGES[-1][1](spark, docs, sf_dir)
