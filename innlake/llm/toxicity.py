"""Severity of abuse by a cumulative-link ordinal regression on sparse word features.

Grades 0 (none) to 3 share one weight vector; ordered thresholds part them: P(grade >= k) = sigmoid(x w - t_k).
The labels say toxic or not, so grades 1 to 3 come from how many words a toxic document has that hardly
occur in clean ones: up to the first third of toxic documents, up to the second, and above. Features are
log(1 + count) of words and of the four- and six-byte beginnings of longer words, kept where their link with the label is beyond what chance
gives to any of so many words.

The fit takes at most ``FIT_ROWS`` labelled documents (those whose text hashes least, so the choice is the same
on every run and does not follow the order of the table); everything else covers all documents.

Defined results: null and empty texts have severity by the thresholds alone, hence none; labels that are null
are left out; several labels of one id count each; with no toxic or no clean label all documents are clean; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import NOT_ALNUM, list_array, row_chunks, span_codes, text_buffers, with_columns, words_of
from innlake.llm.workspace import saved

FIT_ROWS = 20_000
MOST_FEATURES = 20_000
GRADES = 3
BEGINNINGS = (4, 6)
STEPS = 200

RESULT = T.StructType([
    T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType()),
    T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType()),
])


@dataclass
class SeverityModel:
    """Sorted feature codes, their weights, and the rising thresholds."""

    codes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, latent: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.., one column each."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds - latent[:, None], -500, 500)))
        return np.where(np.isinf(self.thresholds), 0.0, above)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature code) of every occurrence."""
    words = words_of(data, offsets, NOT_ALNUM)
    owner = words.owners()
    owners, codes = [owner], [words.codes]
    for size in BEGINNINGS:
        long = np.flatnonzero(words.ends - words.starts > size)
        begins = words.starts[long]
        owners.append(owner[long])
        codes.append(span_codes(words.sums, begins, begins + size) ^ np.uint64(0x5555555555555555))
    return np.concatenate(owners), np.concatenate(codes).view(np.int64)


def _counted(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, count), sorted."""
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])))) if len(owner) else np.empty(0, np.int64)
    return owner[first], feature[first], np.diff(np.append(first, len(owner)))


def _lister(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(1))
        for low, high in row_chunks(offsets):
            owner, feature, count = _counted(*_features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]))
            bounds = np.searchsorted(owner, np.arange(high - low + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(low, high - low), list_array(pa.array(feature), bounds), list_array(pa.array(count, pa.int32()), bounds),
            ], names=["toxic", "features", "counts"])


def _picker(codes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            feature, count = batch.column("features").flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), np.diff(batch.column("features").offsets.to_numpy()))
            at = np.minimum(np.searchsorted(codes, feature), len(codes) - 1)
            known = np.flatnonzero(codes[at] == feature)
            bounds = np.searchsorted(owner[known], np.arange(len(batch) + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column("toxic"), list_array(pa.array(at[known], pa.int32()), bounds), list_array(pa.array(count[known], pa.int32()), bounds),
            ], names=["toxic", "features", "counts"])

    return run


def _descend(owner, feature, value, grade, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by Adam on the penalised likelihood of the grades."""
    rows, parameters = len(grade), np.zeros(n_features + GRADES)
    tail = [(grade >= k).mean() for k in range(1, GRADES + 1)]
    start = np.array([np.log((1 - t + 1e-6) / (t + 1e-6)) for t in tail])
    parameters[n_features] = start[0]
    parameters[n_features + 1 :] = np.log(np.maximum(np.diff(start), 0.1))
    moment, square = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        weights, gaps = parameters[:n_features], np.exp(parameters[n_features + 1 :])
        thresholds = parameters[n_features] + np.concatenate(([0], np.cumsum(gaps)))
        latent = np.bincount(owner, weights[feature] * value, rows)
        above = np.column_stack([np.ones(rows), 1 / (1 + np.exp(np.clip(thresholds - latent[:, None], -50, 50))), np.zeros(rows)])
        at = np.arange(rows)
        hit = np.maximum(above[at, grade] - above[at, grade + 1], 1e-12)
        slope = above * (1 - above) / hit[:, None]
        up = np.zeros((rows, GRADES + 2))
        up[at, grade] = slope[at, grade]
        up[at, grade + 1] = -slope[at, grade + 1]
        by_latent, by_threshold = up.sum(1), -up[:, 1 : GRADES + 1].sum(0)
        gradient = np.empty_like(parameters)
        gradient[:n_features] = np.bincount(feature, by_latent[owner] * value, n_features) / rows - 1e-4 * weights
        gradient[n_features] = by_threshold.sum() / rows
        gradient[n_features + 1 :] = [gaps[k] * by_threshold[k + 1 :].sum() / rows for k in range(GRADES - 1)]
        moment = 0.9 * moment + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        parameters += 0.1 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    gaps = np.exp(parameters[n_features + 1 :])
    return parameters[:n_features], parameters[n_features] + np.concatenate(([0], np.cumsum(gaps)))


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS, most_features: int = MOST_FEATURES) -> SeverityModel:
    """The model of labelled texts (label 0 or 1): of at most ``fit_rows`` of them, with at most ``most_features`` weights.

    The rows whose text hashes least are taken; of equal texts at the limit as many as there is room for.
    """
    none = SeverityModel(np.empty(0, np.int64), np.empty(0), np.full(GRADES, np.inf))
    rows = labelled.select(F.col(label_col).cast("int").alias("toxic"), F.col(text_col).cast("string").alias("text")).where("toxic is not null")
    total = rows.count()
    if total > fit_rows:
        code = F.xxhash64("text")
        cut = rows.select(code.alias("h")).orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0]
        below = rows.where(code < cut)
        rows = below.unionByName(rows.where(code == cut).limit(fit_rows - below.count()))
    sample = saved(rows.mapInArrow(_lister, "toxic int, features array<long>, counts array<int>"))
    size, toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not size or not toxic or toxic == size:
        return none
    base = toxic / size
    share = F.col("hits") / F.col("n")
    surprise = F.col("n") * (
        F.when(share > 0, share * F.log(share / base)).otherwise(0.0) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    seen = saved(sample.select("toxic", F.explode("features").alias("code")).groupBy("code").agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")).withColumn("surprise", surprise))
    kept = seen.where(F.col("surprise") > float(np.log(max(1, seen.count())) + 3)).orderBy(F.desc("surprise"), "code").limit(most_features).toArrow().to_pandas()
    if not len(kept):
        return none
    kept = kept.sort_values("code")
    codes = kept["code"].to_numpy(np.int64)
    marks = (kept["hits"] >= 0.8 * kept["n"]).to_numpy()
    table = sample.mapInArrow(_picker(codes), "toxic int, features array<int>, counts array<int>").toArrow().combine_chunks()
    lists = pc.list_value_length(table.column("features")).to_numpy()
    owner = np.repeat(np.arange(len(table)), lists)
    feature, count = (pc.list_flatten(table.column(c)).to_numpy().astype(np.int64) for c in ("features", "counts"))
    label = table.column("toxic").to_numpy().astype(np.int64)
    marked = np.bincount(owner, count * marks[feature], len(table))
    low, high = np.quantile(marked[label == 1], [1 / 3, 2 / 3])
    grade = label * (1 + (marked > low) + (marked > high))
    weights, thresholds = _descend(owner, feature, np.log1p(count), grade.astype(np.int64), len(codes))
    return SeverityModel(codes, weights, thresholds)


def _scorer(model: SeverityModel, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(text_col))
            latent = np.zeros(len(batch))
            for low, high in row_chunks(offsets) if len(model.codes) else ():
                owner, feature = _features(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                at = np.minimum(np.searchsorted(model.codes, feature), len(model.codes) - 1)
                known = np.flatnonzero(model.codes[at] == feature)
                owner, at, count = _counted(owner[known], at[known])
                latent[low:high] = np.bincount(owner, model.weights[at] * np.log1p(count), high - low)
            above = model.at_least(latent)
            each = np.column_stack([np.ones(len(batch)), above]) - np.column_stack([above, np.zeros(len(batch))])
            yield with_columns(batch, {
                "severity": pa.array(above.sum(1)), "grade": pa.array(each.argmax(1) if len(batch) else [], pa.int32()),
                "p_toxic": pa.array(above[:, 0]), "toxic": pa.array(above[:, 0] >= 0.5),
            })

    return run


def score(docs: DataFrame, model: SeverityModel, text_col: str = "text") -> DataFrame:
    """The documents with expected ``severity`` (0 to 3), most likely ``grade``, ``p_toxic`` and ``toxic``; clashing input columns are replaced."""
    docs = docs.drop(*(f.name for f in RESULT))
    return docs.mapInArrow(_scorer(model, text_col), T.StructType([*docs.schema.fields, *RESULT.fields]))


def fit_on_labels(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> SeverityModel:
    """``fit`` on the texts of labelled ids; only the ids of a bounded number of labels meet the documents."""
    labels = labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic")
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_rows)
    return fit(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), fit_rows=fit_rows)
