"""An append-only log of what has been committed, and the exclusive creation of files that it rests on.

Each version is one file of JSON lines, made whole under another name and then given its own, which fails if that is
taken: of two writers one wins, and a reader sees a version whole or not at all. That holds where a rename does not replace
a file, as on HDFS and local disks; object stores without such a rename need one writer at a time.
"""

from __future__ import annotations

import contextlib
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.functions.layout import normalise_root


def _hadoop(path: str):
    """The Hadoop path of ``path`` and its file system: Spark's default one for paths without a scheme."""
    spark = SparkSession.active()
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _local(path: str) -> str | None:
    """The plain path of one on a local disk; null for others."""
    if path.startswith("file:"):
        return normalise_root(path)
    if "://" in path or SparkSession.getActiveSession() is not None and _hadoop(path)[1].getScheme() != "file":
        return None
    return path


def create_exclusively(path: str, content: bytes) -> bool:
    """Make the file at once with its content; false if there is one."""
    plain = _local(path)
    if plain is not None:
        folder, name = os.path.split(plain)
        os.makedirs(folder, exist_ok=True)
        draft = os.path.join(folder, f".{name}.{uuid.uuid4().hex}.draft")
        with open(draft, "wb") as stream:
            stream.write(content)
        try:
            os.link(draft, plain)  # unlike a rename on local disks, this never replaces a file
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    there, system = _hadoop(path)
    draft = _hadoop(f"{path.rsplit('/', 1)[0]}/.{there.getName()}.{uuid.uuid4().hex}.draft")[0]
    stream = system.create(draft, False)
    stream.write(bytearray(content))
    stream.close()
    try:
        made = not system.exists(there) and system.rename(draft, there)
    finally:
        with contextlib.suppress(Exception):
            system.delete(draft, False)
    return bool(made)


def remove(path: str) -> None:
    """Remove the file, which may be gone already."""
    plain = _local(path)
    if plain is None:
        there, system = _hadoop(path)
        system.delete(there, False)
    elif os.path.exists(plain):
        os.unlink(plain)


class Overtaken(RuntimeError):
    """Another writer has made the version that was to be made."""


class CommitLog:
    """Versions 0, 1, 2 ... of a log under ``root``; each adds lines with the fields of ``schema``."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def versions(self) -> int:
        """How many versions there are: one listing of the log's own folder."""
        folder, system = _hadoop(self.root)
        if not system.exists(folder):
            return 0
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return 1 + max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=-1)

    def append(self, lines: list[dict]) -> int:
        """Commit ``lines`` as the next version, or raise if another writer was first."""
        version = self.versions()
        content = "".join(json.dumps(line) + "\n" for line in lines).encode()
        if not create_exclusively(f"{self.root}/{version:012d}.json", content):
            raise Overtaken(f"version {version} of {self.root} was made by another writer")
        return version

    def entries(self) -> DataFrame:
        """All lines with the ``version`` that added them."""
        if not self.versions():
            return self.spark.createDataFrame([], f"{self.schema}, version bigint")
        name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.json$", 1)
        return self.spark.read.schema(self.schema).json(self.root).select("*", name.cast("bigint").alias("version"))
