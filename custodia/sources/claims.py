"""Small files created at most once: numbered records by many writers, and pointers to the current version of a table.

A record gets the next free number. It is written whole under another name first and then given its own, which fails if
the name exists, so of several writers that read the same state one wins and the others read again (optimistic
concurrency). The file system has to give a name to one writer only: local disks do by hard links, HDFS and the like by
a rename that does not overwrite.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession

_WIDTH = 12


def _local(path: str) -> str | None:
    parts = urlparse(path)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


class Claims:
    """Records 1, 2, 3, ... in one folder, without gaps and each written once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self.folder = spark, folder.rstrip("/")

    def _name(self, number: int) -> str:
        return f"{self.folder}/{number:0{_WIDTH}d}.json"

    def _hadoop(self):
        jvm = self._spark.sparkContext._jvm
        configuration = self._spark.sparkContext._jsc.hadoopConfiguration()
        return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            jvm.org.apache.hadoop.fs.Path(self.folder).toUri(), configuration
        )

    def numbers(self) -> list[int]:
        """Numbers of the records that are there."""
        local = _local(self.folder)
        if local is not None:
            names = os.listdir(local) if os.path.isdir(local) else []
        else:
            jvm, files = self._hadoop()
            path = jvm.org.apache.hadoop.fs.Path(self.folder)
            names = [f.getPath().getName() for f in files.util().listStatus(path)] if files.util().exists(path) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def records(self) -> list[dict]:
        """All records in order."""
        return [self.read(n) for n in self.numbers()]

    def read(self, number: int) -> dict:
        local = _local(self._name(number))
        if local is not None:
            with open(local, encoding="utf-8") as file:
                return json.load(file)
        return json.loads(self._spark.read.text(self._name(number), wholetext=True).first()[0])

    def put(self, number: int, record: dict) -> bool:
        """Write the record under this number; False if another writer had it first."""
        text = json.dumps(record, sort_keys=True)
        unnamed = f"{self.folder}/.{uuid.uuid4().hex}"
        local = _local(self.folder)
        if local is not None:
            os.makedirs(local, exist_ok=True)
            draft = _local(unnamed)
            with open(draft, "w", encoding="utf-8") as file:
                file.write(text)
                file.flush()
                os.fsync(file.fileno())
            try:
                os.link(draft, _local(self._name(number)))
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(draft)
        jvm, files = self._hadoop()
        path = jvm.org.apache.hadoop.fs.Path
        flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
        parents = jvm.org.apache.hadoop.fs.Options.CreateOpts.createParent()
        options = self._spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 1)
        options[0] = parents
        out = files.create(path(unnamed), flags, options)
        out.write(bytearray(text, "utf-8"))
        out.close()
        none = self._spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            files.rename(path(unnamed), path(self._name(number)), none)
            return True
        except Exception as error:
            files.delete(path(unnamed), False)
            if "FileAlreadyExists" in str(error):
                return False
            raise


class Versions:
    """A table at a known place whose content is replaced as a whole.

    Every version lies in a folder of its own; a numbered record names the folder. A write that fails leaves no record,
    so readers go on seeing the version before; a plan that reads an older version goes on reading it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self.path = spark, path.rstrip("/")
        self._claims = Claims(spark, f"{self.path}/_versions")

    def current(self) -> str | None:
        """Folder of the newest version."""
        numbers = self._claims.numbers()
        return f"{self.path}/{self._claims.read(numbers[-1])['folder']}" if numbers else None

    def _written(self, df) -> str:
        folder = f"version-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return folder

    def create(self, df) -> str:
        """The current version; ``df`` if there is none yet. Of several writers the first wins."""
        if self.current() is None:
            self._claims.put(1, {"folder": self._written(df)})
        return self.current()

    def replace(self, df, expected: str | None = None) -> str:
        """Write ``df`` as the new version. With ``expected``, fail if another version has become current meanwhile."""
        folder = self._written(df)
        while True:
            numbers = self._claims.numbers()
            if expected is not None and self.current() != expected:
                raise RuntimeError(f"{self.path} was replaced by another writer")
            if self._claims.put(numbers[-1] + 1 if numbers else 1, {"folder": folder}):
                return f"{self.path}/{folder}"
