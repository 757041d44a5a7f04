"""Token ids in wavelet-matrix shards: compressed files with random access, counts and occurrences.

A shard holds the ids of consecutive documents (by id) as bit planes, highest bit first: each plane keeps one bit of every
id, after the ids were parted by the bits above. Ones before every 512th bit are stored with it, so rank and select read one
block. A shard's bytes are a JSON header and compressed planes; shards are rows of Parquet files, which Spark
writes and commits, so a lost executor leaves no partial file.

Documents are dealt to ranges of ids (quantiles) and sorted there; a range becomes shards of about ``SHARD_IDS`` ids, a longer document
one of its own. Only ids travel, not texts. Texts are cut at added tokens and into units that the byte-level rule never joins
(``pieces.units``); each distinct unit of a task is split by the byte-level pattern, and the library's model encodes every distinct piece.

Defined results: null and empty texts are the end id alone; null document ids come first, equal ones are ordered by their
ids; an empty table makes no shard.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innlake.llm.arrowtext import inserted, prefix_codes, row_chunks, span_codes, text_buffers
from innlake.llm.bpe import spread
from innlake.llm.fingerprints import _range_of
from innlake.llm.pieces import units
from innlake.llm.workspace import saved, shared_folder

SHARD_IDS = 1 << 20
BLOCK = 512
MAGIC = b"IDWM1\n"
MOST_KNOWN = 1_000_000
_BITS_SET = np.array([bin(b).count("1") for b in range(256)], np.uint8)

SHARD = "bucket long, shard int, n_ids long, data binary"


class Plane:
    """One bit per id, with the ones before each block."""

    def __init__(self, packed: np.ndarray, size: int):
        self.packed, self.size = packed, size
        ones = _BITS_SET[packed].reshape(-1, BLOCK // 8).sum(1, dtype=np.int64)
        self.before = np.concatenate(([0], np.cumsum(ones)))
        self.zeros = size - int(self.before[-1])

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.zeros(-(-max(1, len(bits)) // BLOCK) * BLOCK // 8, np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        return cls(packed, len(bits))

    def bit(self, at: np.ndarray) -> np.ndarray:
        return self.packed[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)

    def ones_before(self, at: np.ndarray) -> np.ndarray:
        block = at // BLOCK
        inside = np.minimum(block, len(self.before) - 2)
        bits = np.unpackbits(self.packed.reshape(-1, BLOCK // 8)[inside], axis=1, bitorder="little")
        part = (bits * (np.arange(BLOCK) < (at - inside * BLOCK)[:, None])).sum(1, dtype=np.int64)
        return self.before[inside] + part

    def select(self, value: int, k: np.ndarray) -> np.ndarray:
        """Positions of the k-th (from 0) zero or one."""
        before = self.before if value else np.arange(len(self.before)) * BLOCK - self.before
        block = np.searchsorted(before, k, "right") - 1
        bits = np.unpackbits(self.packed.reshape(-1, BLOCK // 8)[block], axis=1, bitorder="little")
        running = np.cumsum(bits if value else 1 - bits, axis=1)
        return block * BLOCK + (running <= (k - before[block])[:, None]).sum(1)


class WaveletMatrix:
    """Ids under rank and select."""

    def __init__(self, planes: list[Plane], size: int):
        self.planes, self.size = planes, size

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids)
        width, planes = max(1, int(ids.max(initial=0)).bit_length()), []
        ids = ids.astype(np.uint16 if width <= 16 else np.uint32)
        for shift in range(width - 1, -1, -1):
            ids = ids.astype(np.uint8) if shift == 7 else ids  # the bits above have had their planes
            bits = ids & ids.dtype.type(1 << shift) != 0
            planes.append(Plane.of(bits))
            ids = np.concatenate([ids.take(np.flatnonzero(~bits)), ids.take(np.flatnonzero(bits))])
        return cls(planes, len(ids))

    def all(self) -> np.ndarray:
        """Every id, in order: from the lowest plane up, each undoes the parting by its bits."""
        wide = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.size, np.uint8)
        for shift, plane in enumerate(reversed(self.planes)):
            kind = np.uint8 if shift < 8 else wide
            bits = np.unpackbits(plane.packed, count=self.size, bitorder="little").view(bool)
            parted, out = out, np.empty(self.size, kind)
            out[np.flatnonzero(~bits)] = parted[: plane.zeros]
            out[np.flatnonzero(bits)] = parted[plane.zeros :] | kind(1 << shift)
        return out.astype(np.uint32)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at some places."""
        at, out = np.asarray(at, np.int64), np.zeros(len(at), np.uint32)
        for plane in self.planes:
            bit, ones = plane.bit(at), plane.ones_before(at)
            out = out << np.uint32(1) | bit
            at = np.where(bit == 1, plane.zeros + ones, at - ones)
        return out

    def _span(self, value: int, start: int, stop: int) -> tuple[int, int]:
        if value >> len(self.planes):
            return 0, 0
        edge = np.array([start, stop])
        for k, plane in enumerate(self.planes):
            ones = plane.ones_before(edge)
            edge = plane.zeros + ones if value >> (len(self.planes) - 1 - k) & 1 else edge - ones
        return int(edge[0]), int(edge[1])

    def count(self, value: int, start: int = 0, stop: int | None = None) -> int:
        """How often an id occurs in [start, stop)."""
        low, high = self._span(value, start, self.size if stop is None else stop)
        return high - low

    def occurrences(self, value: int) -> np.ndarray:
        """All places of an id, rising."""
        low, high = self._span(value, 0, self.size)
        at = np.arange(low, high)
        for k in range(len(self.planes) - 1, -1, -1):
            plane, bit = self.planes[k], value >> (len(self.planes) - 1 - k) & 1
            at = plane.select(bit, at - plane.zeros if bit else at) if len(at) else at
        return at


def write_shard(doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one shard."""
    matrix, pack = WaveletMatrix.of(ids), zstandard.ZstdCompressor(level=1)
    planes = [pack.compress(p.packed.tobytes()) for p in matrix.planes]
    table = pack.compress(json.dumps({"doc_ids": doc_ids, "sizes": sizes.tolist()}).encode())
    header = json.dumps({"n": matrix.size, "table": len(table), "planes": [len(p) for p in planes]}).encode()
    return b"".join([MAGIC, len(header).to_bytes(4, "little"), header, table, *planes])


def read_shard(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """(document ids, number of ids of each, the matrix)."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a shard of token ids")
    at = len(MAGIC) + 4
    end = at + int.from_bytes(data[len(MAGIC) : at], "little")
    header, unpack = json.loads(data[at:end]), zstandard.ZstdDecompressor()
    table = json.loads(unpack.decompress(data[end : end + header["table"]]))
    end += header["table"]
    planes = []
    for size in header["planes"]:
        planes.append(Plane(np.frombuffer(unpack.decompress(data[end : end + size]), np.uint8), header["n"]))
        end += size
    return table["doc_ids"], np.array(table["sizes"], np.int64), WaveletMatrix(planes, header["n"])


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself where it is printable, else one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256)}


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rising distinct codes, a place of each, the index of every code among them)."""
    order = np.argsort(codes)
    rising = codes[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = rising[1:] != rising[:-1]
    index = np.empty(len(codes), np.int64)
    index[order] = np.cumsum(fresh) - 1
    return rising[fresh], order[fresh], index


class Memo:
    """Ids by the code of what they encode."""

    def __init__(self):
        self.known, self.order = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.ids, self.bounds = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def places(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where each of some rising codes is or is to be, which of them are not kept yet)."""
        at = np.searchsorted(self.known, codes)
        old = np.zeros(len(codes), bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == codes[inside]
        places, fresh = np.empty(len(codes), np.int64), np.flatnonzero(~old)
        places[old] = self.order[at[old]]
        places[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
        return places, fresh

    def add(self, codes: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> None:
        """Keep the ids of the codes that ``places`` did not find."""
        self.known, self.order = inserted(self.known, self.order, codes, len(self.bounds) - 1 + np.arange(len(codes)))
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])


class Encoder:
    """Ids of texts by a tokenizer file with byte-level splitting; its library's model encodes each distinct piece once while it is kept.

    ``ascii_pattern`` may name a cheaper pattern that splits ASCII units as ``pattern`` does.
    """

    def __init__(self, content: str, pattern: str, ascii_pattern: str | None = None):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        added = json.loads(content)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that depend on what surrounds them are not supported")
        self.added, self.matches = {t["content"]: (t["id"],) for t in added}, regex.compile(pattern, regex.V1).findall
        self.ascii_matches = regex.compile(ascii_pattern or pattern, regex.V1).findall
        self.letters = np.array([ord(letter) for _, letter in sorted(byte_letters().items())], "<u4")
        names = sorted((t.encode() for t in self.added), key=len, reverse=True)
        self.cut = re.compile(b"|".join(map(re.escape, names))) if names else None
        self.forget()

    def forget(self) -> None:
        self.units, self.pieces = Memo(), Memo()

    def _borders(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where texts and added tokens begin and end."""
        found = [m.span() for m in self.cut.finditer(data.tobytes())] if self.cut else []
        if not found:
            return offsets
        spans = np.array(found, np.int64)
        inside = np.searchsorted(offsets, spans[:, 0], "right") == np.searchsorted(offsets, spans[:, 1], "left")
        return np.union1d(offsets, spans[inside].ravel()) if inside.all() else np.union1d(offsets, self._by_text(data, offsets))

    def _by_text(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The same, text by text, for texts whose seams make an added token."""
        raw = data.tobytes()
        return np.array([x for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in self.cut.finditer(raw, low, high) for x in m.span()], np.int64)

    def _new(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of units not met before; an added token is a piece of its own."""
        added, matches, ascii_matches = self.added, self.matches, self.ascii_matches
        split = [(u,) if u in added else ascii_matches(u) if u.isascii() else matches(u) for u in texts]
        pieces = list(chain.from_iterable(split))
        data = np.frombuffer("".join(pieces).encode(), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        if len(data) and data.max() > 0x7F:  # from characters to bytes
            ends = np.append(np.flatnonzero(data & 0xC0 != 0x80), len(data))[ends]
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        codes, first, index = _distinct(span_codes(prefix_codes(data), starts, ends))
        places, fresh = self.pieces.places(codes)
        if len(fresh):
            spelled, tokenize = self.letters[data].tobytes().decode("utf-32-le"), self.tokenizer.model.tokenize
            at = first[fresh]
            found = [
                added[pieces[k]] if pieces[k] in added else [t.id for t in tokenize(spelled[low:high])]
                for k, low, high in zip(at.tolist(), starts[at].tolist(), ends[at].tolist())]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
            self.pieces.add(codes[fresh], ids, np.concatenate(([0], np.cumsum(sizes))))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        return spread(self.pieces.ids, self.pieces.bounds, places[index], np.concatenate(([0], np.cumsum(counts))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds by text) of texts given as bytes and offsets."""
        if max(len(self.units.known), len(self.pieces.known)) > MOST_KNOWN:  # start anew; only time depends on what is kept
            self.forget()
        starts = units(data, self._borders(data, offsets))
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        codes, first, index = _distinct(span_codes(prefix_codes(data), starts, ends))
        places, fresh = self.units.places(codes)
        if len(fresh):
            raw, at = data.tobytes(), first[fresh]
            new = [raw[low:high].decode() for low, high in zip(starts[at].tolist(), ends[at].tolist())]
            with _uncollected():
                self.units.add(codes[fresh], *self._new(new))
        return spread(self.units.ids, self.units.bounds, places[index], np.searchsorted(starts, offsets))


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without collections of cycles: hundreds of thousands of small lists, none in a cycle, would be gone through again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def id_type(tokenizer: str, end_id: int) -> str:
    """The integers that ids travel as: of 16 bits where the vocabulary's ids, the added ones and the end id have no more."""
    known = json.loads(tokenizer)
    vocabulary = known["model"]["vocab"]
    most = max(end_id, max(vocabulary.values(), default=0), *(t["id"] for t in known["added_tokens"]))
    return "<u2" if most < 1 << 16 else "<u4"


def _encoder(tokenizer: str, pattern: str, end_id: int, ascii_pattern: str | None = None, kind: str = "<u4"):
    """Ids of each document with the end id, as little-endian integers."""
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, pattern, ascii_pattern)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for low, high in row_chunks(offsets):
                ids, bounds = encoder.encode(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
                ids = np.insert(ids.astype(kind), bounds[1:], end_id)
                bounds = (bounds + np.arange(len(bounds))) * width
                yield pa.RecordBatch.from_arrays([
                    batch.column("bucket").slice(low, high - low), batch.column("doc_id").slice(low, high - low),
                    pa.BinaryArray.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(ids)]),
                ], names=["bucket", "doc_id", "ids"])

    return run


def _sharder(limit: int, kind: str = "<u4"):
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, shard, docs, parts, size = None, 0, [], [], 0

        def row():
            sizes = np.array([len(p) // width for p in parts], np.int64)
            data = write_shard(docs, sizes, np.frombuffer(b"".join(parts), kind))
            return pa.RecordBatch.from_pylist([{"bucket": bucket, "shard": shard, "n_ids": int(sizes.sum()), "data": data}], pa.schema(
                [("bucket", pa.int64()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())]))

        for batch in batches:
            for where, doc, ids in zip(*(batch.column(c).to_pylist() for c in ("bucket", "doc_id", "ids"))):
                if docs and (where != bucket or size + len(ids) // width > limit):
                    yield row()
                    shard = shard + 1 if where == bucket else 0
                    docs, parts, size = [], [], 0
                bucket = where
                docs.append(doc)
                parts.append(ids)
                size += len(ids) // width
        if docs:
            yield row()

    return run


def write_ids(
    docs: DataFrame, tokenizer: str, pattern: str, folder: str, end_id: int = 0, shard_ids: int = SHARD_IDS, ascii_pattern: str | None = None,
) -> None:
    """Encode (doc_id, text) with a tokenizers file's content and write the shards to a folder."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = id_type(tokenizer, end_id)
    encoded = docs.select(_range_of(docs).alias("bucket"), "doc_id", "text").mapInArrow(_encoder(tokenizer, pattern, end_id, ascii_pattern, kind), "bucket long, doc_id long, ids binary")
    dealt = encoded.repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("doc_id"), "ids")
    dealt.mapInArrow(_sharder(shard_ids, kind), SHARD).write.option("compression", "uncompressed").parquet(folder)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(len(batch)):
            doc_ids, sizes, matrix = read_shard(batch.column("data")[k].as_buffer().to_pybytes())
            data = matrix.all().astype("<u4")
            ends = np.concatenate(([0], np.cumsum(sizes)))
            for low, high in row_chunks(ends, 1 << 22):
                part = data[ends[low] : ends[high]]
                edges = ((ends[low : high + 1] - ends[low]) * 4).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([batch.column("bucket")[k].as_py()] * (high - low), pa.int64()), pa.array([batch.column("shard")[k].as_py()] * (high - low), pa.int32()),
                    pa.array(ends[low:high]), pa.array(doc_ids[low:high], pa.int64()), pa.array(sizes[low:high]),
                    pa.BinaryArray.from_buffers(pa.binary(), high - low, [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(part))]),
                ], names=["bucket", "shard", "inside", "doc_id", "n_ids", "ids"])


def _checker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
        yield batch.drop_columns(["ids"]).append_column("ids_crc32", pa.array(sums, pa.int64()))


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Checksums beside the reader, so that ids read back do not leave their task."""
    return _checker(_reader(batches))


def _starts(spark, folder: str) -> DataFrame:
    """(bucket, shard, first): how many ids stand before each shard."""
    sizes = saved(spark.read.schema(SHARD).parquet(folder).select("bucket", "shard", "n_ids"))
    of_bucket = sizes.groupBy("bucket").agg(F.sum("n_ids").alias("all"))
    before = of_bucket.withColumn("base", F.sum("all").over(Window.orderBy("bucket")) - F.col("all")).drop("all")  # one row per range
    inside = Window.partitionBy("bucket").orderBy("shard")
    return saved(sizes.withColumn("from", F.sum("n_ids").over(inside) - F.col("n_ids")).join(before, "bucket").select(
        "bucket", "shard", (F.col("base") + F.col("from")).alias("first")))


def read_ids(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_ids, ids) of every document in the shards; ids are little-endian 32-bit integers."""
    rows = spark.read.schema(SHARD).parquet(folder).mapInArrow(_reader, "bucket long, shard int, inside long, doc_id long, n_ids long, ids binary")
    return rows.join(_starts(spark, folder), ["bucket", "shard"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_ids", "ids")


def ids_with_sums(
    docs: DataFrame, tokenizer: str, pattern: str, end_id: int = 0, shard_ids: int = SHARD_IDS, ascii_pattern: str | None = None,
) -> DataFrame:
    """Write the shards of (doc_id, text) and read them back: doc_id, start, n_tokens and a checksum of each document's ids."""
    spark, folder = docs.sparkSession, shared_folder(docs.sparkSession)
    write_ids(docs, tokenizer, pattern, folder, end_id, shard_ids, ascii_pattern)
    summed = spark.read.schema(SHARD).parquet(folder).mapInArrow(_summer, "bucket long, shard int, inside long, doc_id long, n_ids long, ids_crc32 long")
    return summed.join(_starts(spark, folder), ["bucket", "shard"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), F.col("n_ids").alias("n_tokens"), "ids_crc32")
