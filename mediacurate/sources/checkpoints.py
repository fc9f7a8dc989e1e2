"""Key lists left by earlier runs in other layouts."""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.functions.layout import normalise_root
from mediacurate.operators.resume import processed_keys
from mediacurate.session import settle_table, task_count
from mediacurate.sources import files
from mediacurate.sources.assets import list_files

#: The state file of such a run, and the list in it.
STATE, KEY_LIST = "checkpoint.json", "processed_keys"
_PIECE = 1 << 20
_ROWS = 10_000
#: Signs of one value; what is longer is taken for damage.
_LONGEST = 16 << 20


class _Pulled:
    """The text of a JSON file, taken piece by piece; what has been passed is let go."""

    def __init__(self, stream):
        self.stream, self.decode = stream, codecs.getincrementaldecoder("utf-8")()
        self.text, self.at, self.ended = "", 0, False

    def more(self) -> bool:
        if self.ended:
            return False
        piece = self.stream.read(_PIECE)
        self.ended = not piece
        self.text, self.at = self.text[self.at :] + self.decode.decode(piece, self.ended), 0
        return True

    def sign(self) -> str:
        """The next sign that is no blank, empty at the end."""
        while True:
            while self.at < len(self.text) and self.text[self.at] in " \t\r\n":
                self.at += 1
            if self.at < len(self.text) or not self.more():
                return self.text[self.at : self.at + 1]

    def take(self, wanted: str) -> None:
        if self.sign() != wanted:
            raise ValueError(f"{wanted} expected")
        self.at += 1

    def value(self):
        """The next text, number, or word; no list or object."""
        self.sign()
        while True:
            try:
                found, end = json.JSONDecoder().raw_decode(self.text, self.at)
                following = self.text[end : end + 1]
                if isinstance(found, str) or self.ended or following and following not in ".eE+-0123456789":  # a number may go on
                    self.at = end
                    return found
            except ValueError:
                if self.ended or len(self.text) - self.at > _LONGEST:
                    raise
            self.more()

    def skip(self) -> None:
        """Pass over a value of any kind without holding it."""
        depth = 0
        while True:
            sign = self.sign()
            if sign and sign in "[{":
                depth, self.at = depth + 1, self.at + 1
            elif sign and sign in "]}":
                depth, self.at = depth - 1, self.at + 1
            elif sign and sign in ",:":
                self.at += 1
            else:
                self.value()
            if not depth:
                return


def keys_of_state(stream) -> Iterator[str]:
    """The keys that the list ``processed_keys`` of a JSON object names, whatever their number."""
    pulled = _Pulled(stream)
    pulled.take("{")
    while pulled.sign() != "}":
        name = pulled.value()
        pulled.take(":")
        if name == KEY_LIST and pulled.sign() == "[":
            pulled.take("[")
            while pulled.sign() != "]":
                key = pulled.value()
                if key is not None:
                    yield str(key)
                if pulled.sign() != "]":
                    pulled.take(",")
            pulled.take("]")
        else:
            pulled.skip()
        if pulled.sign() != "}":
            pulled.take(",")
    pulled.take("}")


def _batches_of_state(path: str) -> Iterator[pa.Array]:
    with files.open_at(path) as handle:
        held: list[str] = []
        for key in keys_of_state(handle):
            held.append(key)
            if len(held) == _ROWS:
                yield pa.array(held, pa.string())
                held = []
        yield pa.array(held, pa.string())


def _batches_of_table(path: str) -> Iterator[pa.Array]:
    import pyarrow.parquet as pq

    with files.open_at(path) as handle:
        source = pq.ParquetFile(handle)
        if "key" in source.schema_arrow.names:
            for batch in source.iter_batches(batch_size=_ROWS, columns=["key"]):
                yield batch.column(0).cast(pa.string())


def read_checkpoint_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys in ``checkpoint.json`` and in every readable parquet file that has a ``key`` column, of whatever type.

    Each file is read by a task, a piece at a time; keys of a file that cannot be read to its end don't count.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(path: str, keys: pa.Array, error: str | None = None) -> pa.RecordBatch:
            columns = [pa.array([x] * len(keys), pa.string()) for x in (path, error)]
            return pa.RecordBatch.from_arrays([columns[0], keys, columns[1]], names=["path", "key", "error"])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    for keys in _batches_of_state(path) if path.endswith(f"/{STATE}") else _batches_of_table(path):
                        yield rows(path, keys)
                except Exception as problem:
                    yield rows(path, pa.array([None], pa.string()), f"{type(problem).__name__}: {problem}")

    path = F.col("path")
    state = path.endswith(f"/{STATE}") & ~F.col("is_dir")
    entry = state | path.rlike(r"\.parquet$|/shard=[^/]+$")
    wanted = (path == f"{normalise_root(folder)}/{STATE}") | path.endswith(".parquet")
    found = list_files(spark, folder, entry).filter(wanted).select("path").repartition(task_count(spark), "path")
    read = settle_table(found.mapInArrow(work, "path string, key string, error string"), "checkpoint-keys")
    damaged = read.filter("error IS NOT NULL").select("path")
    return processed_keys(read.join(damaged, "path", "left_anti"))
