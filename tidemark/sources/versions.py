"""Write, audit, publish: versioned table folders, and one pointer per layer that names what readers see.

    <layer>/_pointers/00000007.json        which folders are the layer's tables, as of version 7
    <layer>/<table>/<version>/             a whole table
    <layer>/<table>/<version>/part=3/      the parts of a table that the version rewrote

A draft writes new folders beside the old ones, its checks read them, and only its commit shows them to
readers: all tables of the layer at once, by the creation of one small file that must not exist yet. A
driver killed before that leaves the old version; one killed after it leaves the new one. Nothing that a
pointer names is ever changed, so a reader keeps what it resolved, and going back is one more pointer.

A draft that began before another one's commit cannot be committed any more. Folders that no kept pointer
names go with ``prune``, and so do those of drafts that can no longer be committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

POINTERS = "_pointers"
PART = "part"
#: Pointers that ``prune`` keeps, the newest included.
KEPT_VERSIONS = 3


class VersionConflict(RuntimeError):
    """Another version was committed since this draft began."""


class MissingTable(LookupError):
    """No committed version of the layer has this table."""


class FileStore:
    """A few file operations of the driver, in any store that Spark reads."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self.path(folder).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [x.getPath().getName() for x in self._files.listStatus(where)] if self._files.exists(where) else []

    def text(self, name: str) -> str:
        stream = self._files.open(self.path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A file that is there with all its text or not at all; False if there is one of that name."""
        target = self.path(name)
        aside = self.path(f"{target.getParent()}/.{uuid.uuid4().hex}")
        stream = self._files.create(aside, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        kinds = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        overwrite = self._jvm.java.lang.reflect.Array.newInstance(kinds.NONE.getClass(), 0)
        try:
            context.rename(aside, target, overwrite)  # refuses to replace
        except Exception:
            self._files.delete(aside, False)
            if self._files.exists(target):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self._files.delete(self.path(name), True)

    def move(self, name: str, to: str) -> None:
        self._files.mkdirs(self.path(to).getParent())
        if not self._files.rename(self.path(name), self.path(to)):
            raise OSError(f"{name} could not be moved to {to}")


class Layer:
    """The tables of a layer as of its newest pointer."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._store = FileStore(spark, self.path)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return sorted(int(n[:-5]) for n in self._store.names(f"{self.path}/{POINTERS}") if n.endswith(".json") and n[:-5].isdigit())

    def pointer(self, version: int | None = None) -> dict:
        """``version``, ``tables`` and ``notes`` of a version; of the newest unless one is named."""
        known = self.versions()
        if version is None and not known:
            return {"version": 0, "tables": {}, "notes": {}}
        return json.loads(self._store.text(self._pointer_file(known[-1] if version is None else version)))

    def _pointer_file(self, version: int) -> str:
        return f"{self.path}/{POINTERS}/{version:08d}.json"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.frame(name, self.pointer(version)["tables"])

    def frame(self, name: str, tables: Mapping[str, dict]) -> DataFrame:
        """A table's ``folders`` are one, or one for each part (a part without rows has none)."""
        if name not in tables:
            raise MissingTable(f"{self.path} has no table {name}")
        schema, folders = tables[name]["schema"], tables[name]["folders"]
        shape = T.StructType.fromJson(json.loads(schema))
        if isinstance(folders, str):
            return self.spark.read.schema(shape).parquet(f"{self.path}/{folders}")
        if not folders:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(*[f"{self.path}/{x}" for x in folders.values()])

    def names(self, folder: str) -> list[str]:
        """What is in a folder of the layer."""
        return self._store.names(f"{self.path}/{folder}")

    def draft(self) -> Draft:
        return Draft(self)

    def roll_back(self, version: int) -> int:
        """Shows the tables of an older version again, as a new version."""
        old, new = self.pointer(version), self.pointer()["version"] + 1
        return self._commit(new, old["tables"], old["notes"])

    def _commit(self, version: int, tables: dict, notes: dict) -> int:
        text = json.dumps({"version": version, "tables": tables, "notes": notes}, indent=1)
        if not self._store.create(self._pointer_file(version), text):
            raise VersionConflict(f"{self.path}: version {version} was committed by another draft")
        return version

    def prune(self, keep: int = KEPT_VERSIONS) -> list[str]:
        """Deletes what no version but the newest ``keep`` needs; the folders that went."""
        known = self.versions()
        if not known:
            return []
        kept, old = known[-keep:], known[:-keep]
        needed = {x for v in kept for x in _folders(self.pointer(v)["tables"])}
        gone = []
        for name in self._store.names(self.path):
            if name.startswith("_"):
                continue
            for folder in self._store.names(f"{self.path}/{name}"):
                place = f"{name}/{folder}"
                # a draft's number is that of the version it wants to become
                number = folder.removeprefix("version=").split("-")[0]
                if number.isdigit() and int(number) <= known[-1] and not any(x == place or x.startswith(f"{place}/") for x in needed):
                    self._store.delete(f"{self.path}/{place}")
                    gone.append(place)
        for version in old:
            self._store.delete(self._pointer_file(version))
        return sorted(gone)


def _folders(tables: Mapping[str, dict]) -> set[str]:
    found: set[str] = set()
    for table in tables.values():
        folders = table["folders"]
        found.update([folders] if isinstance(folders, str) else folders.values())
    return found


class Draft:
    """The next version of a layer; what it does not write stays as it is."""

    def __init__(self, layer: Layer) -> None:
        before = layer.pointer()
        self.layer, self.version = layer, before["version"] + 1
        self.tables, self.notes = dict(before["tables"]), dict(before["notes"])
        self.name = f"{self.version:08d}-{uuid.uuid4().hex[:12]}"

    def write(self, name: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.layer.path}/{name}/{self.name}")
        self.tables[name] = {"schema": rows.schema.json(), "folders": f"{name}/{self.name}"}

    def write_parts(self, name: str, rows: DataFrame, parts: Iterable[int]) -> None:
        """Replaces the given parts by ``rows``, which have a column ``part``; other parts stay."""
        place = f"{name}/{self.name}"
        rows.write.partitionBy(PART).parquet(f"{self.layer.path}/{place}")
        self.point_parts(name, rows.drop(PART), place, parts)

    def point_parts(self, name: str, shape: DataFrame, place: str, parts: Iterable[int]) -> None:
        there = set(self.layer._store.names(f"{self.layer.path}/{place}"))
        before = self.tables.get(name, {}).get("folders", {})
        folders = dict(before) if isinstance(before, dict) else {}
        for part in parts:
            folder = f"{PART}={part}"
            folders.pop(str(part), None)
            if folder in there:
                folders[str(part)] = f"{place}/{folder}"
        self.tables[name] = {"schema": shape.schema.json(), "folders": folders}

    def read(self, name: str) -> DataFrame:
        return self.layer.frame(name, self.tables)

    def commit(self) -> int:
        return self.layer._commit(self.version, self.tables, self.notes)
