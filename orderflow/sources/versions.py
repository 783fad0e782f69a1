"""Versioned result sets: a run's tables become visible all at once.

A run writes its tables below ``<out_dir>/versions/<version>``. Publishing replaces one small
file, the manifest, which names the version that readers see; until then they see the set
before. The version is a digest of the inputs and settings, so a run that failed finds the
tables it has finished, and goes on from there. Scratch tables of a run lie beside its
results until it is published. The set before stays on disk for those who are reading it;
older ones are deleted.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

MANIFEST = "_manifest.json"
VERSIONS = "versions"
SCRATCH = "_work"


class Files:
    """Files in any store that Spark reaches."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._new_array = spark.sparkContext._gateway.new_array

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        fs, place = self._at(path)
        return fs.exists(place)

    def delete(self, path: str) -> None:
        fs, place = self._at(path)
        fs.delete(place, True)

    def names(self, path: str) -> list[str]:
        fs, place = self._at(path)
        return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []

    def read(self, path: str) -> str | None:
        fs, place = self._at(path)
        if not fs.exists(place):
            return None
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def move(self, source: str, target: str) -> None:
        """Rename; a file at ``target`` is replaced in one step."""
        _, start = self._at(source)
        _, end = self._at(target)
        options = self._jvm.org.apache.hadoop.fs.Options
        replace = self._new_array(options.Rename, 1)
        replace[0] = options.Rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(end.toUri(), self._conf)
        context.rename(context.makeQualified(start), context.makeQualified(end), replace)

    def replace(self, path: str, text: str) -> None:
        """Readers of ``path`` see the old text or the new one."""
        fresh = f"{path}.new"
        fs, place = self._at(fresh)
        stream = fs.create(place, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        self.move(fresh, path)

    def marks(self, path: str) -> list[str]:
        """Name, size and time of every file that a scan of ``path`` reads."""
        fs, place = self._at(path)
        found = []
        for start in fs.globStatus(place) or []:
            files = fs.listFiles(start.getPath(), True)
            while files.hasNext():
                f = files.next()
                found.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        return sorted(found)


def version_of(spark: SparkSession, inputs: Iterable[str], settings: Iterable[object]) -> str:
    """A digest of the input files and the settings of a run."""
    files = Files(spark)
    parts = [[path, files.marks(path)] for path in inputs] + [repr(s) for s in settings]
    return hashlib.sha256(json.dumps(parts).encode()).hexdigest()[:20]


def published(spark: SparkSession, out_dir: str) -> dict | None:
    """The manifest: version, the one before, and the tables; None if nothing is published."""
    text = Files(spark).read(f"{out_dir}/{MANIFEST}")
    return json.loads(text) if text else None


def table_path(spark: SparkSession, out_dir: str, name: str) -> str:
    """Where readers find a table now; a folder that is not versioned has it directly."""
    manifest = published(spark, out_dir)
    if manifest and name in manifest["tables"]:
        return f"{out_dir}/{VERSIONS}/{manifest['version']}/{name}"
    return f"{out_dir}/{name}"


class Run:
    """One version while it is written."""

    def __init__(self, spark: SparkSession, out_dir: str, version: str):
        self.spark, self.out_dir, self.version = spark, out_dir, version
        self.files = Files(spark)
        self.folder = f"{out_dir}/{VERSIONS}/{version}"

    @property
    def is_published(self) -> bool:
        manifest = published(self.spark, self.out_dir)
        return manifest is not None and manifest["version"] == self.version

    def finished(self, *names: str) -> bool:
        return all(self.files.exists(f"{self.folder}/{n}/_SUCCESS") for n in names)

    def table(
        self, name: str, make: Callable[[], DataFrame], write: Callable[[DataFrame, str, str], None]
    ) -> DataFrame:
        """The table as read back; written by ``write(df, folder, name)`` unless it is finished."""
        if not self.finished(name):
            write(make(), self.folder, name)
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def scratch(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A table that only the run itself needs."""
        return self.table(
            f"{SCRATCH}/{name}",
            make,
            lambda df, folder, at: df.write.mode("overwrite").parquet(f"{folder}/{at}"),
        )

    def publish(self, tables: Sequence[str], beside: Sequence[str] = ()) -> None:
        """Let readers see this version, then move the folders ``beside`` to ``out_dir``."""
        missing = [t for t in tables if not self.finished(t)]
        if missing:
            raise ValueError(f"not published, unfinished tables: {', '.join(missing)}")
        before = published(self.spark, self.out_dir)
        if before is None or before["version"] != self.version:
            manifest = {
                "version": self.version,
                "before": before and before["version"],
                "tables": list(tables),
            }
            self.files.replace(f"{self.out_dir}/{MANIFEST}", json.dumps(manifest))
        self.settle(beside)

    def settle(self, beside: Sequence[str] = ()) -> None:
        """What follows publication; done again if a run was stopped in it."""
        for name in beside:
            if self.files.exists(f"{self.folder}/{name}"):
                self.files.delete(f"{self.out_dir}/{name}")
                self.files.move(f"{self.folder}/{name}", f"{self.out_dir}/{name}")
        self.files.delete(f"{self.folder}/{SCRATCH}")
        manifest = published(self.spark, self.out_dir)
        for version in self.files.names(f"{self.out_dir}/{VERSIONS}"):
            if version not in (manifest["version"], manifest["before"]):
                self.files.delete(f"{self.out_dir}/{VERSIONS}/{version}")
