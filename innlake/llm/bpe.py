"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words, and decoding.

Two forms of the fold give the same ids. ``word_ids`` is one Spark expression: higher-order functions fold the merges over
an array of byte strings, ranks come from a literal map (an array of slots in which a token has two possible
places). Interpreted, it takes most of a millisecond per distinct word, so ``encode`` runs the fold over all
distinct words of some texts at once, as array operations: in each round every word merges the first of its pairs of lowest rank. A
word of more than ``LONG`` bytes is folded by itself under a heap of its pairs, in n log n steps. Texts are split by the regex
module with the pattern that is given. Nothing is needed but the rows themselves: no shuffle, and no dictionary that grows with the data.

Defined results: null and empty texts have no ids and decode to nothing; a byte without a rank cannot occur
with a complete rank file and raises an error; repeated rows are encoded each. Input columns stay, clashing ones are replaced.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import list_array, ranges, row_chunks, text_buffers, with_columns
from innlake.llm.pieces import Splitter

SLOT_BITS = 16
NONE = 2**31 - 1
LONG = 256
CHUNK = 2 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: base64 and a number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class RankMap:
    """Literals for looking up ranks of byte strings and bytes of ranks. ``codes`` has Spark's xxhash64 of each token."""

    def __init__(self, ranks: dict[bytes, int], codes: dict[bytes, int]):
        slots = self._placed([(codes[token], rank) for token, rank in ranks.items()])
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.slots = F.from_json(F.lit(json.dumps(slots)), "array<int>")
        self.tokens = F.from_json(F.lit(json.dumps([base64.b64encode(t).decode() for t in tokens])), "array<binary>")

    @classmethod
    def of(cls, spark, ranks: dict[bytes, int]) -> RankMap:
        rows = spark.createDataFrame([(bytearray(t),) for t in ranks], "token binary").select("token", F.xxhash64("token")).collect()
        return cls(ranks, {bytes(token): code for token, code in rows})

    @staticmethod
    def _places(code: int) -> tuple[int, int]:
        mask = (1 << SLOT_BITS) - 1
        return code & mask, (1 << SLOT_BITS) + (code >> SLOT_BITS & mask)

    def _placed(self, entries: list[tuple[int, int]]) -> list[int]:
        slots: list = [None] * (2 << SLOT_BITS)
        for entry in entries:
            at = self._places(entry[0])[0]
            for _ in range(500):
                entry, slots[at] = slots[at], entry
                if entry is None:
                    break
                one, two = self._places(entry[0])
                at = two if at == one else one
            else:
                raise ValueError("the rank map needs more slots")
        return [-1 if s is None else s[1] for s in slots]

    def rank(self, piece: Column) -> Column:
        """The rank of a byte string, NONE if it is no token."""
        mask = (1 << SLOT_BITS) - 1

        def second(code):
            return _let(F.get(self.slots, (F.shiftrightunsigned(code, SLOT_BITS).bitwiseAND(F.lit(mask)) + (1 << SLOT_BITS)).cast("int")), lambda at: (
                F.when(F.get(self.tokens, at) == piece, at).otherwise(F.lit(NONE))))

        return _let(F.xxhash64(piece), lambda code: _let(F.get(self.slots, code.bitwiseAND(F.lit(mask)).cast("int")), lambda at: (
            F.when(F.get(self.tokens, at) == piece, at).otherwise(second(code)))))


def _let(value: Column, body) -> Column:
    """The body over a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def word_ids(word: Column, ranks: RankMap) -> Column:
    """The ids of one word (a string), by a fold of merges over the array of its byte strings."""
    none = F.array().cast("array<binary>")

    def start(parts):
        pairs = F.zip_with(F.slice(parts, 1, F.size(parts) - 1), F.slice(parts, 2, F.size(parts) - 1), lambda a, b: F.concat(a, b))
        return F.struct(parts.alias("parts"), F.transform(pairs, ranks.rank).alias("ranks"))

    def merged(state, at, one):
        parts, size = state["parts"], F.size(state["parts"])
        before = F.when(at > 1, F.array(F.concat(F.get(parts, at - 2), one))).otherwise(none)
        after = F.when(at + 1 < size, F.array(F.concat(one, F.get(parts, at + 1)))).otherwise(none)
        return F.struct(
            F.concat(F.slice(parts, F.lit(1), at - 1), F.array(one), F.slice(parts, at + 2, size)).alias("parts"),
            F.concat(F.slice(state["ranks"], F.lit(1), F.greatest(at - 2, F.lit(0))), F.transform(F.concat(before, after), ranks.rank),
                     F.slice(state["ranks"], at + 2, size)).alias("ranks"))

    def step(state, _):
        return _let(F.array_min(state["ranks"]), lambda low: F.when(low < NONE, _let(F.array_position(state["ranks"], low).cast("int"), lambda at: (
            _let(F.concat(F.get(state["parts"], at - 1), F.get(state["parts"], at)), lambda one: merged(state, at, one))))).otherwise(state))

    def fold(data):
        size = F.octet_length(data)
        parts = F.transform(F.sequence(F.lit(1), size), lambda k: data.substr(k, F.lit(1)))
        steps = F.slice(F.sequence(F.lit(0), size), 1, F.greatest(size - 1, F.lit(0)))
        return _let(ranks.rank(data), lambda whole: F.when(whole < NONE, F.array(whole)).otherwise(
            F.transform(F.aggregate(steps, _let(parts, start), step)["parts"], ranks.rank)))

    return _let(F.encode(word, "UTF-8"), fold)


class MergeTable:
    """Ranks as arrays: ids of bytes, the sorted pairs that merge, and the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.of_byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        merges = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    merges[left << 20 | right] = rank
        self.by_pair = merges
        self.pairs = np.array(sorted(merges), np.int64)
        self.merged = np.array([merges[p] for p in self.pairs.tolist()], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(left), NONE)
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.merged[at], NONE)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, bounds of each word's)."""
        long = [k for k, w in enumerate(words) if len(w) > LONG]
        if not long:
            return self._fold_all(words)
        ids, bounds = self._fold_all([b"" if len(w) > LONG else w for w in words])
        sizes, pieces = np.diff(bounds), {k: np.array(self.fold_long(words[k]), np.int64) for k in long}
        parts, last = [], 0
        for k, piece in pieces.items():
            parts += [ids[last : bounds[k]], piece]
            last, sizes[k] = bounds[k], len(piece)
        return np.concatenate([*parts, ids[last:]]), np.concatenate(([0], np.cumsum(sizes)))

    def fold_long(self, word: bytes) -> list[int]:
        """Ids of one long word: a heap holds its pairs by (rank, place); entries that no longer hold are passed over."""
        ids, known = self.of_byte[np.frombuffer(word, np.uint8)].tolist(), self.by_pair
        if min(ids, default=0) < 0:
            raise ValueError("the rank file has no token for a byte of the text")
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank, k) for k, pair in enumerate(zip(ids, ids[1:])) if (rank := known.get(pair[0] << 20 | pair[1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            following = after[at]
            if ids[at] < 0 or following < 0 or known.get(ids[at] << 20 | ids[following]) != rank:
                continue
            ids[at], ids[following] = rank, -1
            after[at] = following = after[following]
            if following >= 0:
                before[following] = at
                new = known.get(rank << 20 | ids[following])
                if new is not None:
                    heapq.heappush(heap, (new, at))
            if before[at] >= 0:
                new = known.get(ids[before[at]] << 20 | rank)
                if new is not None:
                    heapq.heappush(heap, (new, before[at]))
        return [x for x in ids if x >= 0]

    def _fold_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(w) for w in words], np.int64)
        ids = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        if len(ids) and ids.min() < 0:
            raise ValueError("the rank file has no token for a byte of the text")
        word = np.repeat(np.arange(len(words)), sizes)
        done_ids, done_words = [], []
        rank = self._next_ranks(ids, word)
        while len(ids):
            starts = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lengths = np.diff(np.append(starts, len(ids)))
            low = np.minimum.reduceat(rank, starts)
            over = np.repeat(low == NONE, lengths)
            if over.any():
                done_ids.append(ids[over])
                done_words.append(word[over])
                ids, word, rank = ids[~over], word[~over], rank[~over]
                lengths, low = lengths[low != NONE], low[low != NONE]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == np.repeat(low, lengths))
            first = hit[np.concatenate(([True], word[hit[1:]] != word[hit[:-1]]))]
            ids[first] = rank[first]
            keep = np.ones(len(ids), bool)
            keep[first + 1] = False
            moved = first - np.arange(len(first))
            ids, word, rank = ids[keep], word[keep], rank[keep]
            for at in (moved, moved[moved > 0] - 1):
                last = at + 1 >= len(ids)
                after = np.where(last, at, at + 1)
                same = ~last & (word[after] == word[at])
                rank[at] = np.where(same, self.ranks(ids[at], ids[after]), NONE)
            crossing = moved[moved > 0] - 1
            rank[crossing[word[crossing] != word[crossing + 1]]] = NONE
        ids, word = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (done_ids, done_words))
        order = np.argsort(word, kind="stable")
        return ids[order], np.searchsorted(word[order], np.arange(len(words) + 1))

    def _next_ranks(self, ids: np.ndarray, word: np.ndarray) -> np.ndarray:
        rank = np.full(len(ids), NONE)
        rank[:-1] = np.where(word[1:] == word[:-1], self.ranks(ids[:-1], ids[1:]), NONE) if len(ids) else NONE
        return rank


def spread(ids: np.ndarray, bounds: np.ndarray, index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, bounds by row) of rows of pieces from the ids of the distinct pieces."""
    sizes = np.diff(bounds)[index]
    return ids[ranges(bounds[:-1][index], sizes)], np.concatenate(([0], np.cumsum(sizes)))[rows]


def _encoder(table: MergeTable, pattern: str, text_col: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(pattern)
        for batch in batches:
            _, offsets = text_buffers(batch.column(text_col))
            for low, high in row_chunks(offsets, CHUNK):
                part = batch.slice(low, high - low)
                words, index, rows = splitter.distinct(part.column(text_col).to_pylist())
                ids, bounds = table.fold(words)
                ids, bounds = spread(ids, bounds, index, rows)
                part = part if keep_text else part.drop_columns([text_col])
                yield with_columns(part, {"ids": list_array(pa.array(ids, pa.int32()), bounds)})

    return run


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """The documents with ``ids``, array<int>; without ``keep_text`` the text stays behind. ``pattern`` is the regex module's."""
    docs = docs.drop("ids").withColumn(text_col, F.col(text_col).cast("string"))
    kept = [f for f in docs.schema.fields if keep_text or f.name != text_col]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_encoder(MergeTable(ranks), pattern, text_col, keep_text), schema)


def _decoder(tokens: list[bytes], ids_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(tokens), np.uint8)
        edges = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
        for batch in batches:
            lists = batch.column(ids_col)
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, np.diff(lists.offsets.to_numpy())) if len(batch) else np.empty(0, np.int64)
            ids, bounds = lists.flatten().to_numpy(), np.concatenate(([0], np.cumsum(sizes)))
            out = []
            for low, high in row_chunks(bounds, 1 << 20):
                part = ids[bounds[low] : bounds[high]]
                length = edges[part + 1] - edges[part]
                joined = data[ranges(edges[part], length)]
                ends = np.concatenate(([0], np.cumsum(length)))[bounds[low : high + 1] - bounds[low]]
                out.append(pa.BinaryArray.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(joined)]))
            yield with_columns(batch, {"decoded": pa.concat_arrays(out) if out else pa.array([], pa.binary())})

    return run


def decode(docs: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """The documents with ``decoded``, the concatenated bytes of their ids; null ids decode to nothing."""
    docs = docs.drop("decoded")
    schema = T.StructType([*docs.schema.fields, T.StructField("decoded", T.BinaryType())])
    return docs.mapInArrow(_decoder(MergeTable(ranks).tokens, ids_col), schema)
