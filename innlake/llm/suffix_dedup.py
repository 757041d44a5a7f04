"""Byte strings of a given length that start at two places or more, found by sorting suffixes in range buckets.

A suffix counts by its first ``length`` bytes. Its leading token is the 32-byte string with the least code among
those inside these bytes, so equal suffixes have the same token wherever they stand, and neighbouring
suffixes mostly share one: a run of them is one row. Only runs whose token occurs at two places go on.
Splitters sampled from the tokens cut them into ranges; each bucket sorts its suffixes by a multikey quicksort (first
eight bytes, then two codes of the rest, each key only among suffixes still tied) and compares neighbours.
A token so frequent that splitters repeat spreads over several buckets; each of them sends on what is left to compare,
suffixes repeated inside it only once, and these meet by code across the boundaries. Copies of a whole text are one text from the start.

Nothing is capped: every suffix whose token repeats is sorted, whole texts, any number of copies.

Defined results: null and empty texts have nothing to remove; a text below ``length`` bytes keeps all; overlaps
and matches inside one text count; repeated rows are copies of each other; a null id is as good as another.
Input columns stay, a clashing one is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innlake.llm.arrowtext import list_array, mixed, prefix_codes, ranges, row_chunks, span_codes, text_buffers, with_columns
from innlake.llm.workspace import saved

LENGTH = 200
TOKEN_BYTES = 32
BUCKET_BYTES = 2 << 20
MOST_BUCKETS = 1 << 14
SAMPLES_PER_BUCKET = 64

_LOW = np.uint64(0xFFFFFFFF)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """least[i] = min(values[i : i + width])."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, token_bytes: int):
    """(text, first suffix within it, suffixes, token) of each run of suffixes that share a token's place."""
    sizes = np.diff(offsets) - length + 1
    rows = np.flatnonzero(sizes > 0)
    if not len(rows):
        none = np.empty(0, np.int64)
        return none, none, none, none
    sums = prefix_codes(data)
    at = np.arange(len(data) - token_bytes + 1)
    codes = span_codes(sums, at, at + token_bytes)
    least = _sliding_least(codes & ~_LOW | at.astype(np.uint64), length - token_bytes + 1)
    suffixes = ranges(offsets[rows], sizes[rows])
    place = (least[suffixes] & _LOW).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    text = np.searchsorted(offsets, suffixes[first], "right") - 1
    return text, suffixes[first] - offsets[text], np.diff(np.append(first, len(place))), codes[place[first]].view(np.int64)


def _lister(length: int, token_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            _, once = np.unique(np.stack([h1, h2]), axis=1, return_index=True)  # copies met here go on as one
            batch = batch.take(pa.array(np.sort(once)))
            data, offsets = text_buffers(batch.column(2))
            h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for low, high in row_chunks(offsets):
                text, first, count, token = runs_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], length, token_bytes)
                yield pa.RecordBatch.from_arrays([
                    pa.array(token), pa.array(h1[low + text]), pa.array(h2[low + text]), pa.array(first << 32 | count),
                ], names=["token", "h1", "h2", "run"])

    return run


def _slicer(length: int, splitters: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            runs = batch.column("runs")
            text = np.repeat(np.arange(len(batch)), np.diff(runs.offsets.to_numpy()))
            token, packed = (runs.flatten().field(k).to_numpy() for k in (0, 1))
            order = np.lexsort((packed, text))
            text, token, packed = text[order], token[order], packed[order]
            first, count = packed >> 32, packed & 0xFFFFFFFF
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (token[1:] != token[:-1]) | (first[1:] != first[:-1] + count[:-1])
            heads = np.flatnonzero(new)
            if not len(heads):
                continue
            count = np.add.reduceat(count, heads)
            text, token, first = text[heads], token[heads], first[heads]
            low, high = np.searchsorted(splitters, token, "left"), np.searchsorted(splitters, token, "right")
            wide = high - low >= 2
            bucket = low + np.where(wide, (first * 7919 + batch.column("h1").to_numpy()[text]) % (high - low + 1), 0)
            sizes = count + length - 1
            for a, b in row_chunks(np.concatenate(([0], np.cumsum(sizes)))):
                part = slice(a, b)
                slices = data[ranges(offsets[text[part]] + first[part], sizes[part])]
                ends = np.concatenate(([0], np.cumsum(sizes[part]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[part]), pa.array(wide[part]), pa.array(token[part]),
                    batch.column("h1").take(pa.array(text[part])), batch.column("h2").take(pa.array(text[part])), pa.array(first[part]),
                    pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends), pa.py_buffer(slices)]),
                ], names=["bucket", "wide", "token", "h1", "h2", "first", "slice"])

    return run


def repeated(keys: list[np.ndarray]) -> np.ndarray:
    """Mask of the items that agree with another in all keys: each key sorts only items tied so far."""
    active = np.arange(len(keys[0]))
    group = np.zeros(len(active), np.int64)
    for key in keys:
        values = key[active]
        order = np.lexsort((values, group)) if group.any() else np.argsort(values, kind="stable")
        active, group, values = active[order], group[order], values[order]
        new = np.ones(len(active), bool)
        new[1:] = (values[1:] != values[:-1]) | (group[1:] != group[:-1])
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        active = active[~alone]
        if not len(active):
            break
    mask = np.zeros(len(keys[0]), bool)
    mask[active] = True
    return mask


def _suffix_keys(data: np.ndarray, at: np.ndarray, length: int) -> list[np.ndarray]:
    head = np.zeros(len(data), np.uint64)
    for k in range(8):
        head[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    sums, middle = prefix_codes(data), 8 + (length - 8) // 2
    return [head[at], span_codes(sums, at + 8, at + middle), span_codes(sums, at + middle, at + length)]


_EXCHANGED = np.dtype([("code", np.uint64), ("code2", np.uint64), ("h1", np.int64), ("h2", np.int64), ("start", np.int64), ("alone", np.bool_)])
_FOUND = "h1 long, h2 long, start long, stop long, part int, packed binary"


def _spans(h1, h2, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(h1), pa.array(h2), pa.array(start), pa.array(stop), pa.nulls(len(h1), pa.int32()), pa.nulls(len(h1), pa.binary()),
    ], names=["h1", "h2", "start", "stop", "part", "packed"])


def _found(rows: pa.RecordBatch, length: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated suffixes of whole token groups; of a token spread over buckets, also what to compare elsewhere.

    What is repeated here goes on once by all its keys, what is alone here goes on to meet the other buckets, dealt by its code.
    """
    data, offsets = text_buffers(rows.column("slice"))
    count = np.diff(offsets) - length + 1
    at = ranges(offsets[:-1], count)
    row = np.repeat(np.arange(len(count)), count)
    keys = _suffix_keys(data, at, length)
    hit = repeated(keys)
    first, h1, h2 = (rows.column(c).to_numpy() for c in ("first", "h1", "h2"))
    place = at - offsets[row] + first[row]

    index = np.flatnonzero(hit)
    if len(index):
        new = np.ones(len(index), bool)
        new[1:] = (np.diff(index) != 1) | (row[index[1:]] != row[index[:-1]])
        begin = index[new]
        end = index[np.append(np.flatnonzero(new)[1:] - 1, len(index) - 1)]
        yield _spans(h1[row[begin]], h2[row[begin]], place[begin], place[end] + length)
    spread = rows.column("wide").to_numpy(zero_copy_only=False)[row]
    if spread.any():
        code = mixed(keys[0] + mixed(keys[1]))
        again = np.flatnonzero(spread & hit)
        again = again[np.lexsort((keys[2][again], code[again]))]
        once = np.ones(len(again), bool)
        once[1:] = (np.diff(code[again]) != 0) | (np.diff(keys[2][again]) != 0)
        go = np.concatenate([again[once], np.flatnonzero(spread & ~hit)])
        packed = np.empty(len(go), _EXCHANGED)
        packed["code"], packed["code2"], packed["start"], packed["alone"] = code[go], keys[2][go], place[go], ~hit[go]
        packed["h1"], packed["h2"] = h1[row[go]], h2[row[go]]
        part = (packed["code"] % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        some = np.flatnonzero(np.diff(edges))
        none = pa.nulls(len(some), pa.int64())
        yield pa.RecordBatch.from_arrays([
            none, none, none, none, pa.array(some, pa.int32()),
            pa.array([packed[order[edges[k] : edges[k + 1]]].tobytes() for k in some.tolist()], pa.binary()),
        ], names=["h1", "h2", "start", "stop", "part", "packed"])


def _meeting(length: int):
    def run(group: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(p, _EXCHANGED) for p in group.column("packed").to_pylist()])
        rows = rows[repeated([rows["code"], rows["code2"]])]
        rows = rows[rows["alone"]]
        return pa.Table.from_batches([_spans(rows["h1"], rows["h2"], rows["start"], rows["start"] + length)]).select(["h1", "h2", "start", "stop"])

    return run


def _sorter(length: int, limit: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            token = batch.column("token").to_numpy()
            sizes = np.diff(text_buffers(batch.column("slice"))[1])
            edges = np.concatenate(([0], np.flatnonzero(token[1:] != token[:-1]) + 1, [len(token)]))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if held and size > limit and token[a] != held[-1].column("token")[-1].as_py():
                    yield from _found(pa.Table.from_batches(held).combine_chunks().to_batches()[0], length, parts)
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += int(sizes[a:b].sum())
        if size:
            yield from _found(pa.Table.from_batches(held).combine_chunks().to_batches()[0], length, parts)

    return run


def _keyed(docs: DataFrame, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit(1), text)})


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(h1, h2, copies, spans): per distinct text of ``length`` bytes or more that has any, its byte spans to remove."""
    keyed = _keyed(docs.select(F.col(text_col).cast("string").alias("text")), "text").where(F.octet_length("text") >= length)
    runs = keyed.select("h1", "h2", "text").mapInArrow(_lister(length, TOKEN_BYTES), "token long, h1 long, h2 long, run long")
    place = F.xxhash64("h1", "h2", "run")
    twice = runs.groupBy("token").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a != b").select("token")
    twice = saved(twice)  # a table of its own, so that the join is one whose hot tokens can be split
    open_runs = saved(runs.join(twice, "token"))

    total = open_runs.agg(F.count("*").alias("rows"), F.sum(F.col("run").bitwiseAND(0xFFFFFFFF) + length - 1).alias("bytes")).first()
    buckets = max(1, min(MOST_BUCKETS, -(-(total.bytes or 0) // BUCKET_BYTES)))
    share = min(1.0, SAMPLES_PER_BUCKET * buckets / max(1, total.rows))
    sample = np.sort(open_runs.sample(share, seed=7).select("token").toArrow().column("token").to_numpy())
    splitters = sample[np.arange(1, buckets) * len(sample) // buckets] if len(sample) else sample

    per_text = open_runs.groupBy("h1", "h2").agg(F.collect_set(F.struct("token", "run")).alias("runs"))
    texts = keyed.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    slices = texts.join(per_text, ["h1", "h2"]).mapInArrow(
        _slicer(length, splitters), "bucket long, wide boolean, token long, h1 long, h2 long, first long, slice binary")
    in_buckets = slices.repartition("bucket").sortWithinPartitions("token")
    found = saved(in_buckets.mapInArrow(_sorter(length, BUCKET_BYTES, buckets), _FOUND))

    across = found.where("part is not null").groupBy("part").applyInArrow(_meeting(length), "h1 long, h2 long, start long, stop long")
    spans = found.where("part is null").select("h1", "h2", "start", "stop").unionByName(across)
    spans = spans.groupBy("h1", "h2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    copies = keyed.groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1")
    return spans.join(copies, ["h1", "h2"], "full").select("h1", "h2", F.coalesce("copies", F.lit(1)).alias("copies"), "spans")


def _cutter(text_col: str, whole_characters: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffers(batch.column(text_col))
            copies, spans = batch.column("copies").to_pylist(), batch.column("spans")
            bounds = spans.offsets.to_numpy()
            start, stop = (spans.flatten().field(k).to_numpy() for k in (0, 1))
            bounds = np.where(spans.is_null().to_numpy(zero_copy_only=False), 0, np.diff(bounds)) if len(batch) else np.empty(0, np.int64)
            bounds = np.concatenate(([0], np.cumsum(bounds)))
            kept, begins, ends, counts = [], [], [], [0]
            for row in range(len(batch)):
                text = data[offsets[row] : offsets[row + 1]]
                if (copies[row] or 0) > 1:
                    gone = np.ones(len(text), bool)
                elif bounds[row + 1] > bounds[row]:
                    edge = np.zeros(len(text) + 1, np.int64)
                    own = slice(bounds[row], bounds[row + 1])
                    np.add.at(edge, start[own], 1)
                    np.add.at(edge, stop[own], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    if whole_characters:
                        heads = np.flatnonzero((text & 0xC0) != 0x80)
                        sizes = np.diff(np.append(heads, len(text)))
                        gone = np.repeat(np.logical_and.reduceat(gone, heads), sizes)
                else:
                    gone = np.zeros(0, bool)
                step = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                begins.append(step[::2])
                ends.append(step[1::2])
                counts.append(counts[-1] + len(step) // 2)
                kept.append((text[~gone] if len(gone) else text).tobytes())
            flat = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
            yield with_columns(batch.drop_columns(["copies", "spans", "h1", "h2"]), {
                "removed_from": list_array(flat(begins), np.array(counts)), "removed_to": list_array(flat(ends), np.array(counts)),
                "kept": pa.array(kept, pa.binary()),
            })

    return run


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH, whole_characters: bool = False) -> DataFrame:
    """The documents with the removed byte spans [``removed_from``, ``removed_to``) and the ``kept`` bytes.

    With ``whole_characters`` a character goes only if all its bytes do, so that the kept bytes are text.
    """
    docs = docs.drop("h1", "h2", "copies", "spans", "removed_from", "removed_to", "kept")
    spans = repeated_spans(docs, text_col, length)
    schema = T.StructType([*docs.schema.fields, T.StructField("removed_from", T.ArrayType(T.LongType())),
                           T.StructField("removed_to", T.ArrayType(T.LongType())), T.StructField("kept", T.BinaryType())])
    return _keyed(docs, text_col).join(spans, ["h1", "h2"], "left").mapInArrow(_cutter(text_col, whole_characters), schema)
