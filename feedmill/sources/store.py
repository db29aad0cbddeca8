"""Core tables as versioned Parquet.

A commit writes its slices to a folder of its own and then publishes, in one
rename, a small file that says which commits hold each slice. Readers see the
old version or the new one, a failed load leaves the old one, and a load rewrites
the slices it replaces rows in; rows that are only new are added to theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedmill.sources import files
from feedmill.tables import CoreTable, table

SLICE = "_slice"


class TableStore:
    """``buckets`` is the number of slices of tables that are sliced by hash; it
    is fixed for a table by its first commit. One writer per table at a time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark = spark
        self.root = root
        self.buckets = buckets

    def _log(self, name: str) -> str:
        return files.join(self.root, name, "log")

    def _data(self, name: str) -> str:
        return files.join(self.root, name, "data")

    def manifest(self, name: str) -> dict:
        log = self._log(name)
        published = [n for n in files.names_in(self.spark, log) if n.endswith(".json")]
        if not published:
            return {"version": 0, "buckets": self.buckets, "slices": {}}
        return files.read_json(self.spark, files.join(log, published[-1]))

    def parts(self, name: str) -> dict[str, list[str]]:
        """The commits that hold each slice."""
        slices = self.manifest(name)["slices"]
        return {s: [c] if isinstance(c, str) else c for s, c in slices.items()}

    def slice_of(self, name: str):
        return table(name).slice_of(self.manifest(name)["buckets"])

    def slices_in(self, name: str, rows: DataFrame) -> list[str]:
        """Slices that ``rows`` belong to: at most one small row each."""
        found = rows.select(self.slice_of(name).alias(SLICE)).distinct()
        return [r[0] for r in found.collect()]

    def read(
        self, name: str, slices: Iterable[str] | None = None, with_slice: bool = False
    ) -> DataFrame:
        """The current version, or the given slices of it, with their names if asked for."""
        core: CoreTable = table(name)
        live = self.parts(name)
        wanted = live if slices is None else [s for s in slices if s in live]
        paths = [
            files.join(self._data(name), f"commit={c}", f"{SLICE}={s}")
            for s in wanted
            for c in live[s]
        ]
        shown = [*core.schema.names, SLICE] if with_slice else core.schema.names
        schema = T.StructType(
            [
                *core.schema.fields,
                T.StructField("commit", T.StringType()),
                T.StructField(SLICE, T.StringType()),
            ]
        )
        if not paths:
            return self.spark.createDataFrame([], schema).select(*shown)
        rows = self.spark.read.schema(schema).option("basePath", self._data(name)).parquet(*paths)
        return rows.select(*shown)

    def overwrite(self, name: str, rows: DataFrame) -> int:
        return self._commit(name, rows, None)

    def replace_slices(self, name: str, rows: DataFrame, slices: Iterable[str]) -> int:
        """Publish ``rows`` as the whole content of ``slices``."""
        return self._commit(name, rows, set(slices))

    def add(self, name: str, rows: DataFrame, replaced: Iterable[str] = (), note=None) -> int:
        """Publish ``rows``: as the whole content of the slices named, as further rows of others."""
        return self._commit(name, rows, set(replaced), adding=True, note=note)

    def notes(self, name: str, after: int = 0) -> list:
        """What the versions after one were published with; None for those that are gone."""
        log, last = self._log(name), self.manifest(name)["version"]
        held = set(files.names_in(self.spark, log))
        named = [f"{v:010d}.json" for v in range(after + 1, last + 1)]
        return [files.read_json(self.spark, files.join(log, n)).get("note") if n in held else None for n in named]

    def _commit(
        self, name: str, rows: DataFrame, replaced: set[str] | None, adding: bool = False, note=None
    ) -> int:
        core = table(name)
        before = self.manifest(name)
        version = before["version"] + 1
        commit = f"{version:010d}-{uuid.uuid4().hex[:8]}"
        path = files.join(self._data(name), f"commit={commit}")
        # Rebalancing gives files of even size: small slices are put together in
        # a task, a slice that holds much of the data is split over several.
        # A table of one slice is written as it comes, without a shuffle.
        sliced = rows.select(*core.schema.names).withColumn(SLICE, core.slice_of(before["buckets"]))
        if core.slice_date or core.slices_by_hash:
            sliced = sliced.hint("rebalance", SLICE)
        sliced.write.partitionBy(SLICE).parquet(path)
        written = self._written(path)
        if replaced is None:
            slices = {}
        else:
            stray = set(written) - replaced
            if stray and not adding:
                raise ValueError(f"{name}: rows outside the replaced slices: {sorted(stray)[:5]}")
            slices = {s: c for s, c in self.parts(name).items() if s not in replaced}
        for s in written:
            slices[s] = [*slices.get(s, []), commit]
        manifest = {"version": version, "buckets": before["buckets"], "slices": slices}
        if note is not None:
            manifest["note"] = note
        files.write_new_json(self.spark, files.join(self._log(name), f"{version:010d}.json"), manifest)
        return version

    def expire(self, name: str, keep: int = 2) -> int:
        """Delete commits that none of the last ``keep`` versions refer to."""
        log, data = self._log(name), self._data(name)
        published = [n for n in files.names_in(self.spark, log) if n.endswith(".json")]
        live = set()
        for n in published[-keep:]:
            for held in files.read_json(self.spark, files.join(log, n))["slices"].values():
                live |= {held} if isinstance(held, str) else set(held)
        newest = int(published[-1].removesuffix(".json")) if published else 0
        old = [
            c
            for c in files.folders_in(self.spark, data)
            if c.startswith("commit=")
            and c.removeprefix("commit=") not in live
            and int(c.removeprefix("commit=").split("-")[0]) <= newest
        ]
        for c in old:
            files.delete_tree(self.spark, files.join(data, c))
        for n in published[:-keep]:
            files.delete_tree(self.spark, files.join(log, n))
        return len(old)

    def _written(self, path: str) -> list[str]:
        names = files.folders_in(self.spark, path)
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{SLICE}=")]
