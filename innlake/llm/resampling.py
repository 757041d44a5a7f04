"""Importance resampling of documents towards a target set, by hashed n-grams and bit-sliced sums.

Features are runs of 1 to 3 words; a feature's bucket is the crc32 of its bytes modulo the number of buckets. A bucket's gain is the
scaled logarithm of its smoothed share in the target over that in the documents, as an integer. A document's weight is the sum of
gains over its features, taken bit by bit: plane j has a bit per bucket, bit j of the document's count there, plane k of the gains
one in two's complement. The ones in the AND of two planes count for 2 ** (j + k), those of the gains' sign plane against it; the sum is exact.

The documents with the greatest weight plus Gumbel noise (from the id alone) are drawn, which samples in proportion to the weights
without replacement. Ranks need no global sort: rows are dealt to score ranges, ranges from the top are ranked inside until
the draw is full, and equal rows are one row with a number of copies until then.

Every task reads texts once per pass; sent to tasks are the gains alone (one number per bucket, a parameter). Counts of all
documents leave a task as one row per bucket.

Defined results: null and empty texts have no words, no feature and weight 0; a null id draws its noise from the text ``42:``, is
greater than any id among equal scores, and stays; repeated rows are drawn as often as they occur; an empty target or an
empty table leaves all gains or all results defined (counts of 0). Extra columns are ignored. Very long words and texts are taken whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innlake.llm.arrowtext import LOWER, NOT_ALNUM, row_chunks, text_buffers, words_of
from innlake.llm.workspace import saved

BUCKETS = 10_000
LONGEST_RUN = 3
SCALE = 1000
PERCENT = 5
LEAST_WORDS = 20
SEED = "42"
#: Documents whose planes are built at once, and score ranges for ranks.
SLICE_ROWS = 512
RANGES = 256
#: Copies of equal drawn rows unfolded from one row at a time.
COPIES = 100_000

#: How a byte changes the checksum's register.
_CRC = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\x00") for b in range(256)], np.uint32)
_LONG_WORD = 64


def _moved(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Checksums moved on by the bytes that ``table`` (4 x 256) stands for; linear, one lookup per byte of the checksum."""
    out = table[0][crc & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ table[k][crc >> np.uint32(8 * k) & np.uint32(255)]
    return out


def _move_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables for moving by 0 .. _LONG_WORD bytes, and by 2 ** k bytes."""
    bits = np.arange(256, dtype=np.uint32)
    short = [np.stack([bits << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_LONG_WORD):
        last = short[-1]
        short.append(last >> np.uint32(8) ^ _CRC[last & np.uint32(255)])
    doubled = [short[1]]
    for _ in range(31):
        doubled.append(_moved(doubled[-1], doubled[-1]))
    return np.stack(short), doubled


_SHORT, _DOUBLED = _move_tables()
_SPACE = np.uint32(zlib.crc32(b" "))


def _joined(left: np.ndarray, right: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums of byte strings put together; ``sizes`` are the right ones' lengths."""
    usual = np.minimum(sizes, _LONG_WORD)
    out = _SHORT[usual, 0, left & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ _SHORT[usual, k, left >> np.uint32(8 * k) & np.uint32(255)]
    for at in np.flatnonzero(sizes > _LONG_WORD).tolist():
        crc, size = left[at : at + 1], int(sizes[at])
        for k in range(size.bit_length()):
            crc = _moved(crc, _DOUBLED[k]) if size >> k & 1 else crc
        out[at] = crc[0]
    return out ^ right


def word_crcs(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """crc32 of many byte spans, a byte of all words at a time; long words one by one."""
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.minimum(sizes, _LONG_WORD), kind="stable")
    where, state, left = starts[order], crc[order], np.minimum(sizes, _LONG_WORD)[order]
    for k in range(int(left.max(initial=0))):
        n = int(np.searchsorted(-left, -k, "left"))
        state[:n] = state[:n] >> np.uint32(8) ^ _CRC[(state[:n] ^ data[where[:n] + k]) & np.uint32(255)]
    crc[order] = state ^ np.uint32(0xFFFFFFFF)
    for at in np.flatnonzero(sizes > _LONG_WORD).tolist():
        crc[at] = zlib.crc32(data[starts[at] : starts[at] + sizes[at]])
    return crc


def feature_buckets(data: np.ndarray, offsets: np.ndarray, buckets: int, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every feature of some texts, and the number of words of each text."""
    lower = LOWER[data]
    words = words_of(data, offsets, NOT_ALNUM)
    sizes = words.ends - words.starts
    single, owner = word_crcs(lower, words.starts, sizes), words.owners()
    run, texts, found = single, [owner], [single % np.uint32(buckets)]
    for length in range(2, longest + 1):
        last = np.arange(length - 1, len(single))
        spaced = _moved(run[: len(last)], _SHORT[1]) ^ _SPACE
        run = _joined(spaced, single[last], sizes[last])
        inside = owner[last] == owner[last - length + 1]
        texts.append(owner[last][inside])
        found.append((run % np.uint32(buckets))[inside])
    return np.concatenate(texts), np.concatenate(found).astype(np.int64), np.diff(words.bounds)


def _counter(buckets: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            data, offsets = text_buffers(batch.column(0))
            for low, high in row_chunks(offsets):
                _, bucket, _ = feature_buckets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], buckets, longest)
                counts += np.bincount(bucket, minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "times"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> np.ndarray:
    """How many features of a one-column frame of texts fall into each bucket."""
    counted = texts.mapInArrow(_counter(buckets, longest), "bucket long, times long").groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[counted.column("bucket").to_numpy()] = counted.column("times").to_numpy()
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Scaled log ratio of smoothed shares, target over source, per bucket."""
    n, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(scale * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


class GainPlanes:
    """Signed gains as planes of bits, one bit per bucket, the last plane the sign's."""

    def __init__(self, gains: np.ndarray):
        self.words = -(-len(gains) // 64)
        width = max(int(gains.max(initial=0)).bit_length(), int(-1 - gains.min(initial=0)).bit_length() if gains.min(initial=0) < 0 else 0) + 1
        self.planes = [self.packed((gains >> k & 1).astype(bool)[None])[0] for k in range(width)]
        self.values = [1 << k for k in range(width - 1)] + [-(1 << (width - 1))]

    def packed(self, bits: np.ndarray) -> np.ndarray:
        """Rows of bits as rows of 64-bit words."""
        out = np.zeros((len(bits), self.words * 8), np.uint8)
        some = np.packbits(bits, axis=1, bitorder="little")
        out[:, : some.shape[1]] = some
        return out.view(np.uint64)

    def weights(self, row: np.ndarray, bucket: np.ndarray, count: np.ndarray, rows: int, buckets: int) -> np.ndarray:
        """The sum of count x gain of each row, from the rows' bucket counts."""
        out = np.zeros(rows, np.int64)
        for j in range(int(count.max(initial=0)).bit_length()):
            here = count >> j & 1 == 1
            who, index = np.unique(row[here], return_inverse=True)
            bits = np.zeros((len(who), buckets), bool)
            bits[index, bucket[here]] = True
            plane = self.packed(bits)
            for gain, value in zip(self.planes, self.values):
                out[who] += np.bitwise_count(plane & gain).sum(1, dtype=np.int64) * (value << j)
        return out


def _weigher(gains: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, buckets = GainPlanes(gains), len(gains)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for low, high in row_chunks(offsets):
                text, bucket, words = feature_buckets(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], buckets, longest)
                slots, count = np.unique(text * buckets + bucket, return_counts=True)
                row, bucket, weights = slots // buckets, slots % buckets, np.zeros(high - low, np.int64)
                edges = np.searchsorted(row, np.arange(0, high - low + SLICE_ROWS, SLICE_ROWS))
                for k in range(len(edges) - 1):
                    here, first = slice(edges[k], edges[k + 1]), k * SLICE_ROWS
                    rows = min(SLICE_ROWS, high - low - first)
                    weights[first : first + rows] = planes.weights(row[here] - first, bucket[here], count[here], rows, buckets)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(low, high - low), pa.array(words.astype(np.int64)),
                    pa.array(np.bincount(text, minlength=high - low).astype(np.int64)), pa.array(weights),
                ], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def weigh(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST_RUN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_weigher(gains, longest), "doc_id long, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: str = SEED, scale: int = SCALE) -> Column:
    """Scaled Gumbel noise from the hash of an id, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-scale) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def with_ranks(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows (doc_id, n_words, score, ..) with ``rank``, 1 for the greatest score, of the drawn rows; null for others."""
    others = [c for c in scored.columns if c not in ("rank", "_bucket")]
    able = F.col("n_words") >= least_words
    size, cuts = scored.where(able).agg(F.count("*"), F.percentile_approx("score", [k / RANGES for k in range(RANGES + 1)])).first()
    drawn = percent * size // 100
    if not drawn:
        return scored.select(*others, F.lit(None).cast("long").alias("rank"))
    edges = F.array(*(F.lit(c).cast("long") for c in sorted(set(cuts))))
    bucketed = scored.select(*others, F.when(able, F.size(F.filter(edges, lambda c: c <= F.col("score")))).alias("_bucket"))
    sizes = bucketed.where("_bucket is not null").groupBy("_bucket").count().orderBy(F.desc("_bucket")).collect()  # one row per range
    before, total = [], 0
    for row in sizes:
        if total < drawn:
            before.append((row["_bucket"], total))
        total += row["count"]
    lowest = before[-1][0]
    high = F.coalesce(F.col("_bucket") >= lowest, F.lit(False))
    shift = F.create_map(*(F.lit(x) for pair in before for x in pair))
    copied = bucketed.where(high).groupBy("_bucket", *others).agg(F.count("*").alias("_copies"))
    order = Window.partitionBy("_bucket").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), *(c for c in others if c not in ("score", "doc_id")))
    first = F.coalesce(F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.get(F.array(shift), F.lit(0))[F.col("_bucket")]
    ranked = copied.withColumn("_first", first)
    chunks = ranked.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES))))
    chunks = chunks.repartition("_first", "_chunk")
    low = F.col("_chunk") * COPIES + 1
    unfolded = chunks.withColumn("_copy", F.explode(F.sequence(low, F.least(F.col("_copies"), low + COPIES - 1))))
    rank = F.col("_first") + F.col("_copy")
    ranks = unfolded.select(*others, F.when(rank <= drawn, rank).cast("long").alias("rank"))
    return ranks.unionByName(bucketed.where(~high).select(*others, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: str = SEED, scale: int = SCALE) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of every document; the target's texts are in its column ``text``."""
    text = F.col("text").cast("string").alias("text")
    gains = bucket_gains(bucket_counts(docs.select(text), buckets, longest), bucket_counts(target.select(text), buckets, longest), scale)
    scored = saved(weigh(docs, gains, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed, scale)))
    return with_ranks(scored, percent, least_words)
