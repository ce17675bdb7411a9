"""What makes a folder of tables a published bundle: a manifest, written last."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

MANIFEST = "_manifest.json"


class NotPublished(ValueError):
    """A folder has no manifest: it is being written, or a run broke off."""


class SharedFiles:
    """One bundle's folder on any file system Spark knows."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self.folder, self._path = folder, self._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._path("/".join([self.folder, *parts]))

    def published(self) -> bool:
        return self._system.exists(self._at(MANIFEST))

    def refuse_published(self) -> None:
        if self.published():
            raise FileExistsError(f"{self.folder} already exists")

    def publish(self, beside: str, tables: list[str]) -> None:
        """Give a folder written beside the bundle's name, then say so."""
        self.refuse_published()
        if self._system.exists(self._path(self.folder)):
            kept = f"{self.folder}.incomplete-{uuid.uuid4().hex}"
            self._moved(self.folder, kept)
        self._moved(beside, self.folder)
        out = self._system.create(self._at(MANIFEST), False)
        try:
            out.write(bytearray(json.dumps({"tables": tables}), "utf-8"))
        finally:
            out.close()

    def _moved(self, old: str, new: str) -> None:
        if not self._system.rename(self._path(old), self._path(new)):
            raise OSError(f"{old} could not be renamed to {new}")

    def tables(self) -> list[str]:
        """Names of the bundle's tables; refuses a folder that is not published."""
        if not self.published():
            raise NotPublished(f"{self.folder} has no {MANIFEST}: it is not published")
        read = self._system.open(self._at(MANIFEST))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(read, "UTF-8"))["tables"]
        finally:
            read.close()
