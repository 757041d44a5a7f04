"""Product codes of vectors: every part of a vector becomes the index of its nearest codebook entry.

Components are scaled to integers, so assignments, sums and errors are exact. The space of a part is cut into a coarse grid, as wide
as the codebook's spread asks for. A task keeps, for each cell it has met, the entries that may be nearest to some point of
the cell's box: one whose least distance to the box exceeds the greatest distance of another entry can never win. Parts
are then compared with their cell's entries alone. Codes are the same with any grid; it only sets how much is compared.

A round sends one row per codebook component and task through one aggregation; a codebook (parts x entries x
components, all parameters) is all that reaches the driver and the tasks. Vectors never move, so copies of a vector cost no more than others.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; the first codebook takes the
smallest ids (equal ids in order of their vectors, null ids last), with fewer kept rows it has fewer entries; repeated
rows are coded each; a vector of another length than the first one has no code, no error and no part in the codebooks;
components whose squared distances could leave 64 bits raise an error; an empty table gives no rows. Labels are summed as they are, nulls
together. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innlake.llm.arrowtext import list_array, mixed, ranges
from innlake.llm.workspace import saved

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Cells that a codebook's spread is cut into, per component; a task's memo starts anew beyond so many cells.
CELLS_ACROSS = 16
MOST_CELLS = 1 << 16
CHUNK_ROWS = 4096
#: Labels up to this number are broadcast with their sums; of more, only those with a thousandth of the rows, which are at most a thousand.
BROADCAST_LABELS = 500_000
HOT_SHARE = 1000


class Grid:
    """One part's codebook, and the memo of the entries that each met cell leaves to compare."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        spread = int((entries.max(0) - entries.min(0)).max()) if len(entries) else 0
        self.shift = max(0, (spread // CELLS_ACROSS).bit_length())
        self.forget()

    def forget(self) -> None:
        self.codes, self.order = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.listed, self.bounds = np.empty(0, np.int64), np.zeros(1, np.int64)

    def possible(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, bounds) that each cell's box leaves: no other entry is nearer from everywhere in the box."""
        low = cells[:, None, :] << self.shift
        high = low + (1 << self.shift) - 1
        entry = self.entries[None]
        least = (np.maximum(0, np.maximum(low - entry, entry - high)) ** 2).sum(2)
        most = (np.maximum(np.abs(entry - low), np.abs(entry - high)) ** 2).sum(2)
        kept = least <= most.min(1)[:, None]
        return np.nonzero(kept)[1], np.concatenate(([0], np.cumsum(kept.sum(1))))

    def _places(self, points: np.ndarray) -> np.ndarray:
        """Index of every point's cell in the memo, which takes up the new ones."""
        cells = points >> self.shift
        codes = np.zeros(len(cells), np.uint64)
        for k in range(cells.shape[1]):
            codes = mixed(codes * np.uint64(0x9E3779B97F4A7C15) + cells[:, k].astype(np.uint64))
        found, first, index = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.codes) > MOST_CELLS:
            self.forget()
        at = np.minimum(np.searchsorted(self.codes, found), max(len(self.codes) - 1, 0))
        old = self.codes[at] == found if len(self.codes) else np.zeros(len(found), bool)
        fresh = np.flatnonzero(~old)
        places = np.empty(len(found), np.int64)
        places[old] = self.order[at[old]] if len(self.codes) else 0
        places[fresh] = len(self.bounds) - 1 + np.arange(len(fresh))
        if len(fresh):
            listed, bounds = self.possible(cells[first[fresh]])
            self.listed = np.concatenate([self.listed, listed])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
            codes, order = np.concatenate([self.codes, found[fresh]]), np.concatenate([self.order, places[fresh]])
            by_code = np.argsort(codes, kind="stable")
            self.codes, self.order = codes[by_code], order[by_code]
        return places[index]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each point; of equally near entries the first."""
        place = self._places(points)
        sizes = np.diff(self.bounds)[place]
        entry = self.listed[ranges(self.bounds[place], sizes)]
        point = np.repeat(np.arange(len(points)), sizes)
        away = ((points[point] - self.entries[entry]) ** 2).sum(1)
        starts = np.cumsum(sizes) - sizes
        least = np.minimum.reduceat(away, starts)
        hit = np.flatnonzero(away == np.repeat(least, sizes))
        first = hit[np.concatenate(([True], point[hit[1:]] != point[hit[:-1]]))]
        return entry[first], least


def _kept(vector: Column) -> Column:
    bounded = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(bounded, F.lit(False))


def _integers(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """Vectors of one length as rows of integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    whole = np.floor(flat * scale)
    if np.abs(whole).max(initial=0) >= 1 << 27:
        raise ValueError("vector components are too large for exact squared distances")
    return whole.astype(np.int64)


def _assigned(column: pa.Array, grids: list[Grid], scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points by row and part, entries, squared distances) of chunks of vectors."""
    width = sum(g.entries.shape[1] for g in grids)
    for low in range(0, len(column), CHUNK_ROWS):
        points = _integers(column.slice(low, CHUNK_ROWS), scale, width).reshape(-1, len(grids), width // len(grids))
        entries, errors = np.empty(points.shape[:2], np.int64), np.empty(points.shape[:2], np.int64)
        for part, grid in enumerate(grids):
            entries[:, part], errors[:, part] = grid.nearest(np.ascontiguousarray(points[:, part]))
        yield points, entries, errors


def _summer(codebooks: np.ndarray, scale: int):
    """One row per codebook component: the sum and number of the parts assigned to its entry."""
    parts, entries, size = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(c) for c in codebooks]
        sums, counts = np.zeros((parts * entries, size), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            for points, entry, _ in _assigned(batch.column(0), grids, scale):
                slot = (entry + np.arange(parts) * entries).ravel()
                counts += np.bincount(slot, minlength=len(counts))
                for k in range(size):
                    np.add.at(sums[:, k], slot, points[:, :, k].ravel())
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(used, size)), pa.array(np.tile(np.arange(size), len(used))), pa.array(sums[used].ravel()), pa.array(np.repeat(counts[used], size)),
        ], names=["slot", "at", "total", "times"])

    return run


def _coder(codebooks: np.ndarray, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(c) for c in codebooks]
        for batch in batches:
            for k, (_, entry, error) in enumerate(_assigned(batch.column("vector"), grids, scale)):
                rows = batch.slice(k * CHUNK_ROWS, CHUNK_ROWS).drop_columns(["vector"])
                bounds = np.arange(len(rows) + 1) * len(grids)
                yield rows.append_column("entries", list_array(pa.array(entry.ravel(), pa.int32()), bounds)).append_column("error", pa.array(error.sum(1)))

    return run


def _vectors(df: DataFrame, vector_col: str) -> Column:
    return F.col(vector_col).cast("array<double>")


def fit_codebooks(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS, scale: int = SCALE) -> np.ndarray:
    """Integer codebooks, an array by part, entry and position; of no length without a usable vector."""
    rows = df.select(F.col(id_col).alias("id"), _vectors(df, vector_col).alias("vector")).where(_kept(F.col("vector")))
    first = rows.orderBy(F.asc_nulls_last("id")).select("vector").first()
    if first is None or not first.vector or len(first.vector) % parts:
        return np.empty((parts, 0, 0), np.int64)
    width = len(first.vector)
    rows = rows.where(F.size("vector") == width)
    start = rows.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).collect()
    points = _integers(pa.array([r.vector for r in start], pa.list_(pa.float64())), scale, width)
    codebooks = np.ascontiguousarray(points.reshape(-1, parts, width // parts).transpose(1, 0, 2))
    used = len(start)
    for _ in range(rounds):
        sums = rows.select("vector").mapInArrow(_summer(codebooks, scale), "slot long, at long, total long, times long")
        means = sums.groupBy("slot", "at").agg(F.sum("total").alias("total"), F.sum("times").alias("times")).toArrow()
        slot, at, total, times = (means.column(c).to_numpy() for c in ("slot", "at", "total", "times"))
        codebooks = codebooks.copy()
        codebooks[slot // used, slot % used, at] = np.floor_divide(total, times)
    return codebooks


def compress(df: DataFrame, codebooks: np.ndarray, vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The kept rows without their vector, with ``entries`` (array<int>, one index per part) and ``error`` (long)."""
    rows = df.drop("entries", "error").withColumn("vector", _vectors(df, vector_col)).where(_kept(F.col("vector")))
    rows = rows if vector_col == "vector" else rows.drop(vector_col)
    kept = [f for f in rows.schema.fields if f.name != "vector"]
    fits = (F.size("vector") == codebooks.shape[0] * codebooks.shape[2]) & F.lit(codebooks.size > 0)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "entries array<int>, error long"])
    others = rows.where(~fits).drop("vector").withColumns({"entries": F.lit(None).cast("array<int>"), "error": F.lit(None).cast("long")})
    if not codebooks.size:
        return others
    return rows.where(fits).mapInArrow(_coder(codebooks, scale), schema).unionByName(others)


def decompress(codes: DataFrame, codebooks: np.ndarray, scale: int = SCALE) -> DataFrame:
    """The codes with ``approximate``: the entries' components, back in the vectors' scale."""
    books = F.array(*(F.array(*(F.array(*(F.lit(float(x) / scale) for x in entry)) for entry in part)) for part in codebooks.tolist()))
    picked = F.transform("entries", lambda e, part: F.get(F.get(books, part), e))
    return codes.drop("approximate").withColumn("approximate", F.flatten(picked))


def with_label_error(codes: DataFrame, label_col: str = "label") -> DataFrame:
    """The codes with ``label_error``, the error summed over equal labels, nulls together.

    Few labels are sent to the rows. Of many, only those that hold a thousandth of the rows are; the rest meet their rows by shuffle.
    """
    codes = codes.drop("label_error")
    sums = saved(codes.groupBy(F.col(label_col).alias("_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")))
    size = sums.agg(F.count("*"), F.sum("_rows")).first()
    same = F.col(label_col).eqNullSafe(F.col("_label"))
    if size[0] <= BROADCAST_LABELS:
        return codes.join(F.broadcast(sums), same, "left").drop("_label", "_rows")
    hot = F.broadcast(sums.where(F.col("_rows") * HOT_SHARE >= F.lit(size[1])))
    with_hot = codes.join(hot, same, "left")
    rest = with_hot.where("_rows is null").drop("_label", "_rows", "label_error").join(sums, same, "left")
    return with_hot.where("_rows is not null").unionByName(rest).drop("_label", "_rows")
