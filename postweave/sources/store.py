"""Tables that grow by commits: parts are written first, then one manifest names them all, so a reader sees a commit whole or not at all."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Store:
    """A folder with the parts of several tables and numbered manifests; the one with the highest number holds.

    A crash before the manifest leaves the earlier state; what it wrote belongs to no manifest and is removed by
    ``clean``.  Two writers cannot commit the same number: the second rename fails.  Manifests hold folder names and
    settings only.
    """

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark, self.base = spark, base.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self._conf)
        self.version, self.parts, self.meta = -1, {}, {}
        self.refresh()

    def _path(self, name: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def _names(self, folder: str) -> list[str]:
        p = self._path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def refresh(self) -> Store:
        """The newest committed state."""
        numbers = sorted(int(n[9:-5]) for n in self._names("") if n.startswith("manifest-") and n.endswith(".json"))
        if numbers:
            self.version = numbers[-1]
            stream = self.fs.open(self._path(f"manifest-{self.version:08d}.json"))
            try:
                body = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
            self.parts, self.meta = body["parts"], body["meta"]
        return self

    def read(self, name: str) -> DataFrame | None:
        """All committed rows of a table in one scan, None before its first commit."""
        folders = self.parts.get(name)
        return self.spark.read.schema(StructType.fromJson(self.meta["_schemas"][name])).parquet(*[f"{self.base}/{f}" for f in folders]) if folders else None

    def stage(self, name: str, df: DataFrame) -> str:
        """Write rows that the next commit may take; they can be read back from the folder returned."""
        folder = f"{name}/{uuid.uuid4().hex}"
        df.write.parquet(f"{self.base}/{folder}")
        return folder

    def commit(self, tables: dict[str, DataFrame | str], meta: dict[str, Any] | None = None, replace: bool = False) -> int:
        """Add the tables' rows (or staged folders), or put them in place of what was there, in their order; all become visible at once."""
        parts, schemas = {n: list(f) for n, f in self.parts.items()}, dict(self.meta.get("_schemas", {}))
        for name, rows in tables.items():
            folder = rows if isinstance(rows, str) else self.stage(name, rows)
            if name not in schemas or replace:
                schemas[name] = (self.spark.read.parquet(f"{self.base}/{folder}") if isinstance(rows, str) else rows).schema.jsonValue()
            parts[name] = [folder] if replace else [*parts.get(name, []), folder]
        body = json.dumps({"parts": parts, "meta": {**self.meta, **(meta or {}), "_schemas": schemas}}, ensure_ascii=False)
        target, draft = self._path(f"manifest-{self.version + 1:08d}.json"), self._path(f"draft-{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(body.encode()))
        out.close()
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            raise RuntimeError(f"another writer has committed version {self.version + 1} of {self.base}")
        return self.refresh().version

    def clean(self) -> None:
        """Remove earlier manifests, drafts and the parts that the newest does not name; not while others read or write."""
        keep = {f for fs in self.parts.values() for f in fs}
        for n in self._names(""):
            if n.startswith("draft-") or (n.startswith("manifest-") and n != f"manifest-{self.version:08d}.json"):
                self.fs.delete(self._path(n), False)
            elif not n.startswith("manifest-"):
                for f in self._names(n):
                    if f"{n}/{f}" not in keep:
                        self.fs.delete(self._path(f"{n}/{f}"), True)
