"""Parallel fetch of a URL manifest with a caller-supplied fetcher."""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from itertools import batched
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.schemas import CARRIED_COLUMNS, FAILED, SHARD_META, SUCCESS
from mediacurate.session import task_count
from mediacurate.sources import files


#: Seconds for which a host is left alone after a failure, and the most that they grow to.
PAUSE, LONGEST_PAUSE = 0.5, 60.0


class Fetcher(Protocol):
    def fetch(self, url: str, timeout: float) -> bytes:
        """The payload of ``url``; raises when it cannot be had in time."""


class PathFetcher:
    """Reads URLs that are paths on a file system the executors share."""

    def fetch(self, url: str, timeout: float) -> bytes:
        return files.read_bytes(url)


class UrlFetcher:
    """Reads any URL the standard library opens."""

    def fetch(self, url: str, timeout: float) -> bytes:
        from urllib.request import urlopen

        with urlopen(url, timeout=timeout) as reply:
            return reply.read()


def image_size(content: bytes) -> tuple[int | None, int | None]:
    """Width and height from a payload's header, nulls when it has none."""
    if content[:8] == b"\x89PNG\r\n\x1a\n" and len(content) >= 24:
        return int.from_bytes(content[16:20], "big"), int.from_bytes(content[20:24], "big")
    if content[:4] == b"RIFF" and content[8:12] == b"WEBP" and len(content) >= 30:
        return _webp_size(content)
    if content[:2] == b"\xff\xd8":
        return _jpeg_size(content)
    return None, None


def _webp_size(content: bytes):
    kind = content[12:16]
    if kind == b"VP8X":
        return int.from_bytes(content[24:27], "little") + 1, int.from_bytes(content[27:30], "little") + 1
    if kind == b"VP8L":
        bits = int.from_bytes(content[21:25], "little")
        return (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
    if kind == b"VP8 ":
        sides = int.from_bytes(content[26:28], "little"), int.from_bytes(content[28:30], "little")
        return sides[0] & 0x3FFF, sides[1] & 0x3FFF
    return None, None


def _jpeg_size(content: bytes):
    at = 2
    while at + 9 <= len(content) and content[at] == 0xFF:
        marker = content[at + 1]
        if marker == 0xFF:  # padding
            at += 1
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            return int.from_bytes(content[at + 7 : at + 9], "big"), int.from_bytes(content[at + 5 : at + 7], "big")
        else:
            at += 2 + int.from_bytes(content[at + 2 : at + 4], "big")
    return None, None


def _attempt(fetcher: Fetcher, url: str, timeout: float) -> dict:
    try:
        content = fetcher.fetch(url, timeout)
    except Exception as problem:
        return {"status": FAILED, "error": f"{type(problem).__name__}: {problem}"}
    width, height = image_size(content)
    sizes = {"width": width, "height": height, "original_width": width, "original_height": height}
    return {"status": SUCCESS, "content": content, "sha256": hashlib.sha256(content).hexdigest(), **sizes}


def _host(url: str | None) -> str:
    """Whom a request goes to; paths go to nobody, and are never put off."""
    try:
        return urlsplit(url or "").netloc
    except ValueError:
        return ""


def sliding(rows: Iterator[dict], attempt: Callable[[dict], dict], threads: int, retries: int, pause: float) -> Iterator[dict]:
    """Each row with the outcome of its last attempt, as requests end: at most ``threads`` are open, and one that ends makes room for the next.

    A host that fails is left alone for ``pause`` seconds, twice as long with each failure that follows, until it
    answers; its rows wait without holding a thread, while those of other hosts go on.
    """
    open_requests: dict = {}
    waiting: list = []  # (not before, number, attempts so far, row)
    failures: dict[str, int] = {}
    free_from: dict[str, float] = {}
    number = itertools.count()
    rows = iter(rows)
    more = True
    with ThreadPoolExecutor(threads) as pool:
        while True:
            while len(open_requests) < threads:
                if waiting and waiting[0][0] <= time.monotonic():
                    _, _, tried, row = heapq.heappop(waiting)
                elif more and len(waiting) < 16 * threads:
                    tried, row = 0, next(rows, None)
                    if row is None:
                        more = False
                        continue
                else:
                    break
                at = free_from.get(_host(row["url"]), 0.0)
                if at > time.monotonic():
                    heapq.heappush(waiting, (at, next(number), tried, row))
                else:
                    open_requests[pool.submit(attempt, row)] = (tried + 1, row)
            if not open_requests:
                if not waiting:
                    return
                time.sleep(max(0.0, waiting[0][0] - time.monotonic()))
                continue
            soon = None
            if waiting and len(open_requests) < threads:
                soon = max(0.0, waiting[0][0] - time.monotonic())
            for ended in wait(open_requests, soon, FIRST_COMPLETED)[0]:
                tried, row = open_requests.pop(ended)
                outcome, host = ended.result(), _host(row["url"])
                if outcome["status"] == SUCCESS:
                    failures.pop(host, None)
                    free_from.pop(host, None)
                elif host:
                    failures[host] = failures.get(host, 0) + 1
                    free_from[host] = time.monotonic() + min(LONGEST_PAUSE, pause * 2 ** min(failures[host] - 1, 20))
                if outcome["status"] != SUCCESS and tried <= retries:
                    heapq.heappush(waiting, (free_from.get(host, 0.0), next(number), tried, row))
                else:
                    yield {**row, **outcome, "attempts": tried}


def _store(images_dir: str, row: dict) -> None:
    """Payload, caption text and metadata of one fetched row, side by side."""
    if row["status"] != SUCCESS:
        return
    stem = f"{images_dir.rstrip('/')}/{row['shard']}/{row['key']}"
    record = {name: None if pd.isna(row[name]) else row[name] for name in SHARD_META.names}
    files.write_bytes(f"{stem}.jpg", row["content"])
    files.write_bytes(f"{stem}.txt", (row["caption"] or "").encode())
    files.write_bytes(f"{stem}.json", json.dumps(record, default=int).encode())


FETCHED = T.StructType(
    [f for f in SHARD_META.fields]
    + [
        T.StructField("shard", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("content", T.BinaryType()),
    ]
)


_WHOLE = {f.name: "Int32" for f in FETCHED.fields if f.dataType == T.IntegerType()}


def fetch(
    manifest: DataFrame,
    fetcher: Fetcher,
    retries: int = 3,
    timeout: float = 30,
    threads: int = 64,
    partitions: int | None = None,
    images_dir: str | None = None,
    pause: float = PAUSE,
) -> DataFrame:
    """Fetch every row of a manifest (key, shard, url, caption and the carried columns).

    One row out per row in, payload unmodified, with status, attempts and the
    error text. Payloads leave the task a few at a time, so memory is bounded by
    ``threads`` payloads. With ``images_dir`` they are written there as files,
    with their caption and metadata beside them, and ``content`` stays null: no
    payload passes through the JVM. The result is not repeatable: write it once
    with ``write_fetched`` and use what that returns.
    """

    def attempt(row: dict) -> dict:
        outcome = _attempt(fetcher, row["url"], timeout)
        if images_dir is not None and outcome["status"] == SUCCESS:
            _store(images_dir, {**dict.fromkeys(FETCHED.names), **row, **outcome})
            del outcome["content"]
        return outcome

    def work(frames):
        rows = (row for frame in frames for row in frame.to_dict("records"))
        for part in batched(sliding(rows, attempt, threads, retries, pause), threads):
            yield pd.DataFrame([{**dict.fromkeys(FETCHED.names), **row} for row in part], columns=FETCHED.names).astype(_WHOLE)

    rows = manifest.select("key", "shard", "url", "caption", *CARRIED_COLUMNS)
    tasks = partitions or task_count(manifest.sparkSession)
    # By range: a task holds whole runs of keys, and a large shard is shared by several tasks.
    return rows.repartitionByRange(tasks, "shard", "key").mapInPandas(work, FETCHED)


def write_fetched(fetched: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write per shard, replacing only the shards present; returns payloads and shard metadata."""
    (
        fetched.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("shard")
        .parquet(path)
    )
    return read_fetched(fetched.sparkSession, path)


def read_fetched(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    table = spark.read.schema(FETCHED).parquet(path)
    return (
        table.filter(F.col("status") == SUCCESS).select("shard", "key", "content"),
        table.select(*SHARD_META.names, "shard", "attempts", "error"),
    )


def fetch_from_table(manifest: DataFrame, payloads: DataFrame) -> DataFrame:
    """Fetch where the payloads are a table (key, content): a join in place of a worker."""
    held = payloads.select(
        "key", F.sha2("content", 256).alias("sha256"), F.octet_length("content").cast("bigint").alias("n_bytes")
    )
    return manifest.join(held, "key", "left").withColumn(
        "status", F.when(F.col("sha256").isNotNull(), SUCCESS).otherwise(FAILED)
    )


def unfetched(manifest: DataFrame, shard_meta: DataFrame) -> DataFrame:
    """Rows of shards not finished yet."""
    return manifest.join(shard_meta.select("shard").distinct(), "shard", "left_anti")


def export_files(payloads: DataFrame, root: str, extension: str = "jpg") -> DataFrame:
    """Write payloads as ``<root>/<shard>/<key>.<extension>``, without a shard directly under the root; a lazy frame of the paths."""

    def work(frames):
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                files.write_bytes(path, bytes(content))
            yield frame[["path"]]

    path = F.concat_ws("/", F.lit(root.rstrip("/")), "shard", F.concat("key", F.lit("." + extension)))
    return payloads.select(path.alias("path"), "content").mapInPandas(work, "path string")


def payload_sizes(df: DataFrame, content: str = "content") -> DataFrame:
    """Width and height by the payload's header, null where it has none."""
    fields = T.StructType([T.StructField(n, T.IntegerType()) for n in ("width", "height")])

    @F.pandas_udf(fields)
    def sizes(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([image_size(bytes(b or b"")) for b in bodies], columns=fields.names).astype("Int32")

    return df.withColumn("_sizes", sizes(F.col(content))).select("*", "_sizes.*").drop("_sizes")


def payload_hashes(df: DataFrame, content: str = "content") -> DataFrame:
    """Digests and size of a text or binary payload."""
    body = F.col(content).cast("binary")
    return df.withColumns(
        {"md5": F.md5(body), "sha256": F.sha2(body, 256), "n_bytes": F.octet_length(body).cast("bigint")}
    )
