"""Folders that are replaced as a whole and stay readable while they are.

Every write makes a version of its own, ``{path}/versions/{id}``. Which one is current
is said by ``{path}/current``, a small file that replaces its predecessor in one rename.
So a reader finds either the old version or the new one, never half of one, and a write
that fails leaves the old version current. The version before the current one is kept
for readers that have opened it; older ones are deleted after the next is published.

There is one writer at a time, as with the audited job. Everything goes through the
Hadoop file system of the path, which may be any that Spark writes to.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "current"


class Files:
    """The few file-system calls this needs, on the file system of ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self.path(path).getFileSystem(conf)
        self.context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self.fs.makeQualified(self.path(path)).toUri(), conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def read(self, p: str) -> str | None:
        if not self.fs.exists(self.path(p)):
            return None
        stream = self.fs.open(self.path(p))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, p: str, text: str) -> None:
        """Write ``text`` beside ``p`` and rename it over ``p``."""
        draft = f"{p}.{uuid.uuid4().hex[:12]}"
        stream = self.fs.create(self.path(draft), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        option = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(option, 1)
        options[0] = option.OVERWRITE
        self.context.rename(self.fs.makeQualified(self.path(draft)),
                            self.fs.makeQualified(self.path(p)), options)

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)


@dataclass(frozen=True)
class Version:
    path: str
    rows: int


class Versioned:
    """The versions of one Parquet table under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def _pointer(self) -> dict:
        return json.loads(self.files.read(f"{self.path}/{POINTER}") or "{}")

    def _folder(self, version: str) -> str:
        return f"{self.path}/versions/{version}"

    def current(self) -> Version | None:
        at = self._pointer()
        return Version(self._folder(at["version"]), at["rows"]) if at else None

    def read(self) -> DataFrame:
        found = self.current()
        if found is None:
            raise FileNotFoundError(f"no version at {self.path}")
        return self.spark.read.parquet(found.path)

    def write(self, df: DataFrame, empty: bool = True) -> Version | None:
        """Write ``df`` as a new version and make it current. Its rows are counted as
        they are written. With ``empty`` False a result without rows is not published:
        the version before it stays current, and None is returned."""
        old = self._pointer()
        version = uuid.uuid4().hex
        count = Observation()
        try:
            (df.observe(count, F.count(F.lit(1)).alias("rows"))
             .write.parquet(self._folder(version)))
            rows = count.get["rows"]
            if not rows and not empty:
                self.files.delete(self._folder(version))
                return None
            self.files.replace(f"{self.path}/{POINTER}", json.dumps(
                {"version": version, "rows": rows, "before": old.get("version")}))
        except Exception:
            self.files.delete(self._folder(version))
            raise
        if old.get("before"):
            self.files.delete(self._folder(old["before"]))
        return Version(self._folder(version), rows)
