"""Tables kept in parts, of which a load writes only those it changes.

The rows of a load go to a folder of their own, one sub-folder per part (``<column>=<value>``). A version file then says
which folders make up each part: putting it in place is the commit, so readers see a load whole or not at all, and parts
that a load leaves alone are named again without being read. Older versions stay readable until they are dropped
together with the folders that only they name.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from innlake.sources.tables import LakeStore

KEEP = 24


class Versions:
    """One table; ``column`` (an integer, never NULL) says which part a row belongs to. Versions are ordered by name."""

    def __init__(self, store: LakeStore, layer: str, table: str, column: str):
        self.store, self.column = store, column
        self.root = store.path(layer, table)

    # ---- version files ------------------------------------------------------

    def names(self, before: str | None = None) -> list[str]:
        names = sorted(n.removesuffix(".json") for n in self.store.files(f"{self.root}/versions") if n.endswith(".json"))
        return [n for n in names if before is None or n < before]

    def latest(self, before: str | None = None) -> str | None:
        """Newest version, or the newest one before a name."""
        return max(self.names(before), default=None)

    def _load(self, name: str) -> dict:
        return json.loads(self.store.read_text(f"{self.root}/versions/{name}.json"))

    def parts(self, name: str) -> dict[int, list[str]]:
        """The folders of every part of a version."""
        return {int(part): folders for part, folders in self._load(name)["parts"].items()}

    def folders(self, name: str) -> list[str]:
        """Paths of the loads that a version has parts of."""
        return sorted({f"{self.root}/data/{folder}" for folders in self.parts(name).values() for folder in folders})

    def note(self, name: str, key: str):
        """What a version was written with, see ``commit``."""
        return self._load(name)["notes"].get(key)

    # ---- reading ------------------------------------------------------------

    def read(self, name: str, only: Iterable[int] | None = None, but: Iterable[int] = ()) -> DataFrame:
        """Rows of a version with its part column: all parts, ``only`` some, or all ``but`` some."""
        known = self._load(name)
        schema = T.StructType.fromJson(known["schema"])
        wanted, unwanted = None if only is None else set(only), set(but)
        paths = [
            f"{self.root}/data/{folder}/{self.column}={part}" for part, folders in known["parts"].items() for folder in folders
            if (wanted is None or int(part) in wanted) and int(part) not in unwanted
        ]
        spark = self.store.spark
        if not paths:
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())]))
        return rows.option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    # ---- writing ------------------------------------------------------------

    def commit(
        self, df: DataFrame | Sequence[DataFrame], name: str, base: str | None = None, replace: Sequence[int] | None = None,
        append: Sequence[int] = (), **notes,
    ) -> DataFrame:
        """Write the rows, of several frames one frame after the other, and make them version ``name``.

        Without a ``base`` they are the whole table. Otherwise they stand for the parts in ``replace`` (one of them
        without rows disappears), join what the parts in ``append`` hold, and all other parts stay as the base has them.
        Repeating a load writes its folder and its version anew.
        """
        load = f"load={name}"
        folder = f"{self.root}/data/{load}"
        frames = [df] if isinstance(df, DataFrame) else df
        schema = T.StructType([*[f for f in frames[0].schema.fields if f.name != self.column], T.StructField(self.column, T.IntegerType())])
        for n, frame in enumerate(frames):
            rows = frame.select(*schema.names).withColumn(self.column, F.col(self.column).cast("int"))
            rows.hint("rebalance", self.column).write.mode("append" if n else "overwrite").partitionBy(self.column).parquet(folder)
        prefix = f"{self.column}="
        written = [int(n[len(prefix):]) for n in self.store.files(folder) if n.startswith(prefix)]
        parts = {} if base is None else self.parts(base)
        for part in replace or ():
            parts.pop(part, None)
        strangers = set(written) - set(replace or ()) - set(append) if base is not None else ()
        if strangers:
            raise ValueError(f"rows of parts that are not to be written: {sorted(strangers)[:5]}")
        for part in written:
            parts[part] = [*parts.get(part, ()), load]
        text = json.dumps({"schema": schema.jsonValue(), "notes": notes, "parts": {k: v for k, v in sorted(parts.items()) if v}})
        self.store.put_text(f"{self.root}/versions/{name}.json", text)
        return self.read(name)

    def drop_old(self, keep: int = KEEP) -> None:
        """Drop all but the newest versions, and the folders that none of those names."""
        names = self.names()
        kept = names[-keep:]
        for name in names[:-keep]:
            self.store.delete(f"{self.root}/versions/{name}.json")
        needed = {(f, p) for name in kept for p, folders in self.parts(name).items() for f in folders}
        for load in self.store.files(f"{self.root}/data"):
            if not kept or load.removeprefix("load=") > kept[-1]:
                continue  # of a load that has not been committed yet
            held = [n for n in self.store.files(f"{self.root}/data/{load}") if n.startswith(f"{self.column}=")]
            unused = [n for n in held if (load, int(n.split("=", 1)[1])) not in needed]
            if len(unused) == len(held):
                self.store.delete(f"{self.root}/data/{load}")
            else:
                for n in unused:
                    self.store.delete(f"{self.root}/data/{load}/{n}")
