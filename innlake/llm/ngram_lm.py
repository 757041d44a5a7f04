"""Bigram language model in a log-frequency Bloom filter, and scores of whole texts under it.

Tokens are lower-cased words and one end per text, which also is the history of the first word. Counts of words and word
pairs come from all training texts by one aggregation. Pairs seen ``LEAST_PAIR`` times or more enter the filter
under a level that rises with the logarithm of the count: level 1 to level l are set, and a count is read by
probing levels until one is missing. Every history has two more levels: its count (rounded up) and the share of it that its
pairs keep (rounded up), so probabilities sum to one at most, false positives aside:

    P(w | h) = (level count of h w - DISCOUNT) / count of h + (1 - share of h) * P(w)

P(w) is the smoothed exact word frequency. The workers have it for the ``HEAD_WORDS`` most frequent words; for words outside this head
they note what the filter says of the pair, and a join on the word completes both scores, which so do not depend on the head.

What is sent to the workers is bounded: the head table by HEAD_WORDS, and the filter by ``FILTER_BYTES`` at a time. A larger
filter is cut by history into parts of that size that pass over the texts one after the other, each
adding what its histories change and written before the next one is read.

Words are told apart by 64-bit codes, pairs by 36 and 28 bits of them. Defined results: null and empty texts are one end;
a null id belongs to the training texts; without training texts every probability is that of an unknown word; repeated rows count and are scored each.
Extra columns are ignored. Pairs seen less than LEAST_PAIR times are not kept: their mass goes to P(w).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.llm.arrowtext import SPACES, list_array, mixed, row_chunks, text_buffers, with_columns, words_of
from innlake.llm.workspace import removed, saved

LEAST_PAIR = 2
DISCOUNT = 0.7
HEAD_WORDS = 1 << 20
FILTER_BYTES = 64 << 20
BLOCK_BYTES = 1 << 16
COUNTED_BYTES = 12 << 20
BITS_PER_ENTRY = 11
PROBES = 6
SHARES = 8
END = np.uint64(0x9E3779B97F4A7C15)
_WORD_BITS = 28
_COUNT_TAG, _SHARE_TAG = np.uint64(0xA5A5), np.uint64(0x5A5A)


def held_out(doc_id: Column) -> Column:
    """The fifth of the ids that is kept from training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all texts with their ends, bounds of each text)."""
    words = words_of(data, offsets, SPACES)
    bounds = words.bounds + np.arange(len(words.bounds))
    codes = np.empty(len(words.codes) + len(bounds) - 1, np.uint64)
    last = np.zeros(len(codes), bool)
    last[bounds[1:] - 1] = True
    codes[last] = END
    codes[~last] = words.codes
    return codes, bounds


def _pairs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(history, pair) codes of every token."""
    history = np.concatenate(([END], codes[:-1])) >> np.uint64(_WORD_BITS)
    return history, history << np.uint64(_WORD_BITS) | codes >> np.uint64(64 - _WORD_BITS)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffers(batch.column(0))
        for begin, end in row_chunks(offsets, COUNTED_BYTES):
            words, pairs = [], []
            for low, high in row_chunks(offsets[begin : end + 1]):
                edges = offsets[begin + low : begin + high + 1]
                codes, _ = _tokens(data[edges[0] : edges[-1]], edges - edges[0])
                words.append(codes)
                pairs.append(_pairs(codes)[1])
            for kind, found in ((0, words), (1, pairs)):
                keys, times = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(times, pa.int64())], names=["kind", "key", "n"])


def _level(count: Column) -> Column:
    """1 + floor(2 log2(count / LEAST_PAIR))."""
    return (1 + F.floor(2 * F.log2(count / LEAST_PAIR) + 1e-9)).cast("int")


def _level_count(level):
    return LEAST_PAIR * 2 ** ((level - 1) / 2)


_COUNTS = _level_count(np.arange(256.0))


def _bits(keys: np.ndarray, level) -> tuple[np.ndarray, np.ndarray]:
    code = mixed(keys + np.uint64(0x632BE59BD9B4E019) * np.asarray(level).astype(np.uint64))
    return code & np.uint64(BLOCK_BYTES * 8 - 1), code >> np.uint64(32) | np.uint64(1)


def _block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    return ((mixed(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def _placer(blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(_block_of(keys, blocks))], names=["part", "key", "level", "block"])

    return run


def _block_builder(table: pa.Table) -> pa.Table:
    """The bits of one block."""
    keys, levels = table.column("key").to_numpy().view(np.uint64), table.column("level").to_numpy()
    block = np.zeros(BLOCK_BYTES, np.uint8)
    for level in range(1, int(levels.max()) + 1):
        start, step = _bits(keys[levels >= level], level)
        for k in range(PROBES):
            bit = (start + np.uint64(k) * step) & np.uint64(BLOCK_BYTES * 8 - 1)
            np.bitwise_or.at(block, (bit >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (bit & np.uint64(7)).astype(np.uint8)))
    return pa.table({"part": table.column("part").slice(0, 1), "block": table.column("block").slice(0, 1), "bits": pa.array([block.tobytes()], pa.binary())})


@dataclass
class FilterPart:
    """The blocks that hold all histories of one part."""

    part: int
    parts: int
    bits: np.ndarray

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of each key: as many as are found one after the other."""
        level = np.zeros(len(keys), np.int32)
        base = _block_of(keys, len(self.bits) // BLOCK_BYTES) * BLOCK_BYTES
        active, at = np.arange(len(keys)), 0
        while len(active):
            at += 1
            start, step = _bits(keys[active], at)
            for k in range(PROBES):
                bit = (start + np.uint64(k) * step) & np.uint64(BLOCK_BYTES * 8 - 1)
                hit = self.bits[base[active] + (bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1)
                keep = hit.astype(bool)
                active, start, step = active[keep], start[keep], step[keep]
            level[active] = at
        return level


@dataclass
class BigramModel:
    """Totals, the head of the vocabulary, and how to get the filter's parts."""

    train_tokens: int
    vocabulary: int
    head: np.ndarray
    head_counts: np.ndarray
    words: DataFrame
    blocks: DataFrame
    parts: int
    blocks_per_part: int

    @property
    def denominator(self) -> float:
        return self.train_tokens + 0.5 * (self.vocabulary + 1)

    def part(self, k: int) -> FilterPart:
        bits = np.zeros(self.blocks_per_part * BLOCK_BYTES, np.uint8)
        for row in self.blocks.where(F.col("part") == k).select("block", "bits").toLocalIterator():
            bits[row.block * BLOCK_BYTES : (row.block + 1) * BLOCK_BYTES] = np.frombuffer(row.bits, np.uint8)
        return FilterPart(k, self.parts, bits)


def train(texts: DataFrame, text_col: str = "text", head_words: int = HEAD_WORDS, filter_bytes: int = FILTER_BYTES) -> BigramModel:
    """The model of all given texts."""
    counted = texts.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_counter, "kind int, key long, n long")
    counts = saved(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")).where(f"kind = 0 or n >= {LEAST_PAIR}"))
    words = counts.where("kind = 0").select("key", "n")
    total, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    kind = F.when(F.col("n") < 1000, F.col("n")).otherwise(1000 + F.floor(8 * F.log2(F.col("n") / 1000)))
    classes = words.groupBy(kind.alias("kind")).agg(F.count("*").alias("words")).orderBy(F.desc("kind")).collect()
    cut, held = 1 << 60, 0
    for row in classes:
        if held + row.words > head_words:
            break
        held, cut = held + row.words, row.kind
    rows = words.where(kind >= cut).select("key", "n").toArrow()
    head, head_counts = rows.column("key").to_numpy(), rows.column("n").to_numpy()
    order = np.argsort(head)
    head, head_counts = head[order], head_counts[order]

    pairs = counts.where("kind = 1").select("key", _level(F.col("n")).alias("level"))
    history = F.shiftrightunsigned("key", _WORD_BITS)
    kept = pairs.groupBy(history.alias("history")).agg(F.sum(_level_count(F.col("level")) - DISCOUNT).alias("kept"))
    whole = words.groupBy(history.alias("history")).agg(F.sum("n").alias("n"))
    histories = kept.join(whole, "history").select(
        "history", F.greatest(F.lit(1), 1 + F.ceil(2 * F.log2(F.col("n") / LEAST_PAIR) - 1e-9)).cast("int").alias("count"),
        F.least(F.lit(SHARES), F.ceil(SHARES * F.col("kept") / F.col("n"))).cast("int").alias("share"))
    tagged = lambda tag: F.col("history").bitwiseXOR(F.lit(int(tag) << 40))
    entries = pairs.select(history.alias("history"), "key", "level").unionByName(
        histories.select("history", tagged(_COUNT_TAG).alias("key"), F.col("count").alias("level"))).unionByName(
        histories.select("history", tagged(_SHARE_TAG).alias("key"), F.col("share").alias("level")))
    entries = saved(entries.where("level > 0"))
    size = (entries.agg(F.sum("level")).first()[0] or 0) * BITS_PER_ENTRY // 8
    parts = max(1, -(-size // filter_bytes))
    blocks = max(1, -(-size // (parts * BLOCK_BYTES)))
    placed = entries.select(F.pmod(F.xxhash64("history"), F.lit(parts)).cast("int").alias("part"), "key", "level").mapInArrow(
        _placer(blocks), "part int, key long, level int, block long")
    built = saved(placed.groupBy("part", "block").applyInArrow(_block_builder, "part int, block long, bits binary"))
    return BigramModel(int(total), int(vocabulary), head, head_counts, words, built, parts, blocks)


def _states(codes: np.ndarray, words: np.ndarray, which: np.ndarray, part: FilterPart) -> np.ndarray:
    """What the part says of every token: level of the pair, level of the history's count << 8, and share << 16; 0 for other histories.

    ``words`` are the rising distinct codes, ``which`` has each token's place among them; all texts end, so each word is a history.
    """
    histories = words >> np.uint64(_WORD_BITS)
    fresh = np.concatenate(([True], histories[1:] != histories[:-1]))
    known, place = histories[fresh], np.cumsum(fresh) - 1
    which = place[np.concatenate(([np.searchsorted(words, END)], which[:-1]))]
    pair = known[which] << np.uint64(_WORD_BITS) | codes >> np.uint64(64 - _WORD_BITS)
    mine = _xxhash_parts(known, part.parts) == part.part if part.parts > 1 else np.ones(len(known), bool)
    state = np.zeros(len(known), np.int32)
    at = np.flatnonzero(mine)
    found = part.levels(known[at] ^ _COUNT_TAG << np.uint64(40))
    at, found = at[found > 0], found[found > 0]
    state[at] = found << 8 | np.minimum(part.levels(known[at] ^ _SHARE_TAG << np.uint64(40)), SHARES) << 16
    state = state[which]
    open_at = np.flatnonzero(state)
    if len(open_at):
        pairs, same = np.unique(pair[open_at], return_inverse=True)
        state[open_at] |= part.levels(pairs)[same]
    return state


def _gain(state: np.ndarray, prior: np.ndarray, log_prior: np.ndarray) -> np.ndarray:
    """log10 P(w | h) - log10 P(w) of tokens; 0 where the history is not known."""
    gain = np.zeros(len(state))
    at = np.flatnonzero(state)
    level, count, share = state[at] & 0xFF, state[at] >> 8 & 0xFF, (state[at] >> 16) / SHARES
    seen = np.where(level > 0, np.minimum(1.0, (_COUNTS[level] - DISCOUNT) / _COUNTS[count]), 0.0)
    mixture = np.minimum(1.0, seen + np.maximum(1 - share, 1 / 64) * prior[at])
    gain[at] = np.log10(mixture) - log_prior[at]
    return gain


def _mixture(state: Column, prior: Column) -> Column:
    """P(w | h), as in ``_gain``."""
    level, count = state.bitwiseAND(0xFF), F.shiftright(state, 8).bitwiseAND(0xFF)
    power = lambda x: LEAST_PAIR * F.pow(F.lit(2.0), (x - 1) / 2)
    seen = F.when(level > 0, F.least(F.lit(1.0), (power(level) - DISCOUNT) / power(count))).otherwise(0.0)
    mixture = F.least(F.lit(1.0), seen + F.greatest(1 - F.shiftright(state, 16) / SHARES, F.lit(1 / 64)) * prior)
    return F.when(state == 0, prior).otherwise(mixture)


def _xxhash_parts(history: np.ndarray, parts: int) -> np.ndarray:
    """pmod(xxhash64(history), parts) as Spark computes it for a long (seed 42)."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    turn = lambda x, r: x << np.uint64(r) | x >> np.uint64(64 - r)
    code = np.full(len(history), 42, np.uint64) + p5 + np.uint64(8)
    code = turn(code ^ turn(history * p2, 31) * p1, 27) * p1 + p4
    code = (code ^ code >> np.uint64(33)) * p2
    code = (code ^ code >> np.uint64(29)) * p3
    return (code ^ code >> np.uint64(32)).view(np.int64) % parts


def _scorer(model_part: FilterPart, head, head_counts, denominator: float, first: bool, last: bool):
    """Scores of the head's words; for the others their states in text order, grouped by word and state after the last part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            earlier, read = None if first else batch.column("tail_states").flatten().to_numpy(), 0
            out = {name: [np.empty(0, kind)] for name, kind in (("n_tokens", np.int64), ("head_known", np.int64), ("head_score", float), ("score", float))}
            tail, states, counts, bounds = [np.empty(0, np.int64)], [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
            for low, high in row_chunks(offsets):
                codes, edges = _tokens(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                owner = np.repeat(np.arange(high - low), np.diff(edges))
                # what depends on the word alone is worked out once for the chunk's distinct words
                words, which = np.unique(codes, return_inverse=True)
                at = np.minimum(np.searchsorted(head, words.view(np.int64)), max(len(head) - 1, 0))
                in_head = head[at] == words.view(np.int64) if len(head) else np.zeros(len(words), bool)
                priors = np.where(in_head, head_counts[at] + 0.5, 0.5) / denominator if len(head) else np.full(len(words), 0.5 / denominator)
                logs, known = np.log10(priors), in_head[which]
                state = _states(codes, words, which, model_part)
                own, of = owner[known], which[known]
                score = np.bincount(own, _gain(state[known], priors[of], logs[of]), high - low)
                if first:
                    alone = np.bincount(own, logs[of], high - low)
                    score = score + alone
                    out["n_tokens"].append(np.diff(edges))
                    out["head_known"].append(np.bincount(own, minlength=high - low).astype(np.int64))
                    out["head_score"].append(alone)
                out["score"].append(score)
                rest, own, state = codes[~known], owner[~known], state[~known]
                if not first:
                    state = state | earlier[read : read + len(state)]
                    read += len(state)
                if last:
                    order = np.lexsort((state, rest, own))
                    rest, own, state = rest[order], own[order], state[order]
                    new = np.ones(len(rest), bool)
                    new[1:] = (rest[1:] != rest[:-1]) | (own[1:] != own[:-1]) | (state[1:] != state[:-1])
                    new = np.flatnonzero(new)
                    counts.append(np.diff(np.append(new, len(rest))).astype(np.int32))
                    tail.append(rest[new].view(np.int64))
                    own, state = own[new], state[new]
                states.append(state)
                bounds.append(bounds[-1][-1] + np.searchsorted(own, np.arange(1, high - low + 1)))
            edges = np.concatenate(bounds)
            found = {"score": pa.array(np.concatenate(out["score"]) if first else batch.column("score").to_numpy() + np.concatenate(out["score"]))}
            for name, parts, ends in (("tail", tail, edges if last else 0 * edges), ("tail_states", states, edges), ("tail_counts", counts, edges if last else 0 * edges)):
                found[name] = list_array(pa.array(np.concatenate(parts)), ends)
            if first:
                found |= {name: pa.array(np.concatenate(out[name])) for name in ("n_tokens", "head_known", "head_score")}
                found["row"] = pa.array(row + np.arange(len(batch)))
                row += len(batch)
            yield with_columns(batch, found).select(_SCORED_NAMES)

    return run


_SCORED = ("doc_id long, held_out boolean, row long, text string, n_tokens long, head_known long, head_score double, "
           "score double, tail array<long>, tail_states array<int>, tail_counts array<int>")
_SCORED_NAMES = [field.split()[0] for field in _SCORED.split(", ")]


def score(docs: DataFrame, model: BigramModel) -> DataFrame:
    """Per row of (doc_id, held_out, text): n_tokens, n_known, train_tokens, base_score and score."""
    scored = docs.select("doc_id", "held_out", F.col("text").cast("string").alias("text"))
    for k in range(model.parts):
        first, last, before = k == 0, k == model.parts - 1, scored
        scored = scored.mapInArrow(_scorer(model.part(k), model.head, model.head_counts, model.denominator, first, last), _SCORED)
        scored = saved(scored.drop("text") if last else scored)  # so one part at a time is in the driver and the workers
        if not first:
            removed(before)
    rare = scored.select("row", F.inline(F.arrays_zip(F.col("tail").alias("key"), F.col("tail_states").alias("state"), F.col("tail_counts").alias("times"))))
    rare = rare.join(model.words, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    prior = (F.col("n") + 0.5) / F.lit(model.denominator)
    each = rare.groupBy("row").agg(
        F.sum(F.col("times") * F.log10(prior)).alias("rare_base"),
        F.sum(F.col("times") * F.log10(_mixture(F.col("state"), prior))).alias("rare_score"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    return scored.join(each, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("head_score") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", F.lit(0.0))).alias("score"))


def score_held_out(docs: DataFrame, head_words: int = HEAD_WORDS, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Scores of all documents by the model of those that are not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return score(docs, train(docs.where("not held_out"), head_words=head_words, filter_bytes=filter_bytes))
