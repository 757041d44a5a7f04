"""Benchmark passages in documents, by Wu-Manber search over words.

A window is ``window`` consecutive words of an item (a shorter item is one window). Windows of one length
form one search: the SHIFT table says for each pair of adjacent words how far the search may jump, a zero
sends it to the bucket of windows that end in this pair, and only those are compared, word codes first
and then bytes. Documents stay where they are: the benchmark goes to them in blocks of bounded size
(``block_bytes``), one after the other and with what was found written in between, so neither side needs a shuffle.

Defined results: null and empty texts have no words; null items have no windows; items without an id are
left out; several items with one id count once; repeated documents give repeated rows; an empty benchmark
leaves every document clean. Input columns are kept; one named like a result is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import LOWER, NOT_ALNUM, list_array, mixed, ranges, row_chunks, text_buffers, with_columns, words_of
from innlake.llm.workspace import saved

WINDOW = 10
BLOCK_BYTES = 4 << 20
SEGMENT = 64
TABLE_BITS = 20

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_from", T.ArrayType(T.LongType())),
    T.StructField("hit_to", T.ArrayType(T.LongType())),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
])

_PLAIN = bytes(np.where(NOT_ALNUM[LOWER], 0x20, LOWER).astype(np.uint8))


def _pairs(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(31) + last)


class WuManber:
    """The windows of one length: shift table, buckets by the last block, and the windows themselves."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]], length: int):
        self.length, self.block = length, min(2, length)
        self.texts = list(windows)
        self.items = [sorted(windows[w]) for w in self.texts]
        joined = b" ".join(w for text in self.texts for w in text)
        data = np.frombuffer(joined, np.uint8)
        found = words_of(data, np.array([0, len(data)]), NOT_ALNUM)
        self.codes = found.codes.reshape(len(self.texts), length)
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, np.uint8 if length < 255 else np.uint32)
        for at in range(self.block - 1, length):
            np.minimum.at(self.shift, self._slot(self._block(self.codes, at)), length - 1 - at)
        ends = self._block(self.codes, length - 1)
        self.order = np.argsort(ends, kind="stable")
        self.ends = ends[self.order]

    def _slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def _block(self, codes: np.ndarray, at: int) -> np.ndarray:
        return codes[:, at] if self.block == 1 else _pairs(codes[:, at - 1], codes[:, at])

    def _blocks_at(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        return codes[at] if self.block == 1 else _pairs(codes[at - 1], codes[at])

    def candidates(self, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Word positions at which a window may end; every text is searched in segments, all at once."""
        first, last = bounds[:-1] + self.length - 1, bounds[1:]
        parts = np.maximum(0, -((first - last) // SEGMENT))
        owner = np.repeat(np.arange(len(first)), parts)
        at = np.repeat(first, parts) + SEGMENT * ranges(np.zeros(len(parts), np.int64), parts)
        stop = np.minimum(at + SEGMENT, last[owner])
        found = []
        while len(at):
            jump = self.shift[self._slot(self._blocks_at(codes, at))].astype(np.int64)
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            keep = at < stop
            at, stop = at[keep], stop[keep]
        return np.sort(np.concatenate(found)) if found else np.empty(0, np.int64)

    def matches(self, codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end position, window) pairs of equal word codes among the buckets that the last blocks select."""
        blocks = self._blocks_at(codes, at)
        low, high = np.searchsorted(self.ends, blocks, "left"), np.searchsorted(self.ends, blocks, "right")
        position = np.repeat(at, high - low)
        window = self.order[ranges(low, high - low)]
        for k in range(self.length):
            same = codes[position - self.length + 1 + k] == self.codes[window, k]
            position, window = position[same], window[same]
        return position, window


def searches(rows: list[tuple[str, str]], window: int) -> list[WuManber]:
    """One search per window length over (item id, text) rows."""
    by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in rows:
        words = text.encode().translate(_PLAIN).split()
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            by_length[size][tuple(words[k : k + size])].add(item)
    return [WuManber(windows, length) for length, windows in sorted(by_length.items())]


def _search(data: np.ndarray, offsets: np.ndarray, plans: list[WuManber]):
    """(words per text, hit spans by text, items by text) of one chunk of texts."""
    words = words_of(data, offsets, NOT_ALNUM)
    edge = np.zeros(len(words.codes) + 1, np.int64)
    items: dict[int, set[str]] = defaultdict(set)
    for plan in plans:
        at = plan.candidates(words.codes, words.bounds)
        position, window = plan.matches(words.codes, at)
        owner = np.searchsorted(words.bounds, position, "right") - 1
        first = position - plan.length + 1
        for p, f, w, o in zip(position.tolist(), first.tolist(), window.tolist(), owner.tolist()):
            span = data[words.starts[f] : words.ends[p]].tobytes().translate(_PLAIN).split()
            if tuple(span) == plan.texts[w]:
                edge[f] += 1
                edge[p + 1] -= 1
                items[o].update(plan.items[w])
    hit = np.cumsum(edge[:-1]) > 0
    return words.bounds, hit, items


def _finder(plans: list[WuManber], text_col: str, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(text_col))
            counts, starts, ends, bounds, named = [], [], [], [0], []
            before = None if first else batch.select(["hit_from", "hit_to", "hit_items"]).to_pylist()
            for low, high in row_chunks(offsets):
                part = data[offsets[low] : offsets[high]]
                words, hit, items = _search(part, offsets[low : high + 1] - offsets[low], plans)
                counts.append(np.diff(words))
                for row in range(high - low):
                    inside = hit[words[row] : words[row + 1]]
                    names = items.get(row, set())
                    if before:
                        old = before[low + row]
                        for a, b in zip(old["hit_from"], old["hit_to"]):
                            inside[a:b] = True
                        names = names | set(old["hit_items"])
                    if inside.any():
                        step = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
                        starts.extend(np.flatnonzero(step == 1).tolist())
                        ends.extend(np.flatnonzero(step == -1).tolist())
                    bounds.append(len(starts))
                    named.append(sorted(names))
            yield with_columns(batch, {
                "n_words": pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                "hit_from": list_array(pa.array(starts, pa.int64()), np.array(bounds)),
                "hit_to": list_array(pa.array(ends, pa.int64()), np.array(bounds)),
                "hit_items": pa.array(named, pa.list_(pa.string())),
            })

    return run


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with ``n_words``, the hit word ranges [``hit_from``, ``hit_to``), and the ``hit_items``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("words")).dropna()
    total = items.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs.drop(*(f.name for f in RESULT))
    schema = T.StructType([*out.schema.fields, *RESULT.fields])
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        plans = searches([(r.item, r.words) for r in part.collect()], window)
        out = out.mapInArrow(_finder(plans, text_col, block == 0), schema)
        if block < blocks - 1:  # written, so one block at a time is in the driver and the workers
            out = saved(out)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``find_benchmark`` plus ``n_hit`` (hit words)."""
    found = find_benchmark(docs, benchmark, **options)
    hits = F.aggregate(F.zip_with("hit_from", "hit_to", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.withColumn("n_hit", hits)
