"""Captioning with a caller-supplied model."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mediacurate.functions.text import strip
from mediacurate.sources import files
from mediacurate.worker import worker_table

REJECT = "reject"
EMPTY = "empty"
# Rows whose payloads and captions a task holds apart from their batch, in whole model batches.
HELD = 256


@dataclass(frozen=True)
class CaptionOptions:
    """Generation options, handed to the captioner's ``setup``."""

    prompt: str = "Describe this image in detail."
    batch_size: int = 4
    max_new_tokens: int = 256
    temperature: float = 0.7
    do_sample: bool = True


class Captioner(Protocol):
    """What the caller brings. Sent to the tasks, then set up once in each."""

    def setup(self, options: CaptionOptions) -> None: ...

    def caption(self, batch: list[Any]) -> list[str]: ...


def load_path(path: str) -> bytes:
    """Default loader for path columns: the payload is read where it is captioned, never shuffled."""
    return files.read_bytes(path)


def _caption_all(captioner, items: list, loader, size: int) -> Iterator[tuple[str | None, str | None]]:
    for start in range(0, len(items), size):
        part = items[start : start + size]
        try:
            loaded = [loader(i) for i in part] if loader else part
            told = captioner.caption(loaded)
            if len(told) != len(part):
                raise ValueError(f"{len(told)} captions for {len(part)} items")
            yield from ((text, None) for text in told)
        except Exception:
            # Find the culprit: one at a time, so that its neighbours keep their captions.
            for item in part:
                yield _caption_one(captioner, item, loader)


def _caption_one(captioner, item, loader) -> tuple[str | None, str | None]:
    try:
        return captioner.caption([loader(item) if loader else item])[0], None
    except Exception as problem:
        return None, f"{type(problem).__name__}: {problem}"


def caption(
    df: DataFrame,
    captioner: Captioner,
    column: str,
    on_error: str = REJECT,
    options: CaptionOptions | None = None,
    loader=None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Add ``vlm_caption`` and ``error``, one model call per row.

    ``reject`` leaves the caption null and the reason in ``error``; ``empty``
    puts an empty caption in its place. Sampling models give other text on a
    second run, so the result is marked nondeterministic: write it once and
    read it back. With ``profile`` the tasks ask for its resources (a GPU).
    """
    chosen = options or CaptionOptions()
    if on_error not in (REJECT, EMPTY):
        raise ValueError(f"unknown policy {on_error!r}")

    label = hashlib.sha256(cloudpickle.dumps((captioner, chosen))).hexdigest()

    def ready():
        """The captioner, set up by the first task of a worker and kept for the others."""
        kept = worker_table("captioners")
        if label not in kept:
            captioner.setup(chosen)
            kept[label] = captioner
        return kept[label]

    size = max(1, chosen.batch_size)
    held = -(-HELD // size) * size

    def texts(batches):
        model = ready()
        for items in batches:
            for at in range(0, len(items), held):
                told = list(_caption_all(model, items.slice(at, held).to_pylist(), loader, size))
                columns = [pa.array([one[place] for one in told], pa.string()) for place in (0, 1)]
                yield pa.StructArray.from_arrays(columns, names=["caption", "error"])

    if profile is not None:
        schema = T.StructType(
            df.schema.fields
            + [T.StructField("vlm_caption", T.StringType()), T.StructField("error", T.StringType())]
        )

        def frames(batches):
            model = ready()
            for whole in batches:
                for at in range(0, len(whole), held):
                    frame = whole.iloc[at : at + held].copy()
                    told = _caption_all(model, list(frame[column]), loader, size)
                    frame[["vlm_caption", "error"]] = pd.DataFrame(list(told), index=frame.index, columns=["c", "e"])
                    yield frame

        told = df.mapInPandas(frames, schema, profile=profile)
    else:

        @F.arrow_udf("caption string, error string")
        def told_by(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            yield from texts(batches)

        told = (
            df.withColumn("_told", told_by.asNondeterministic()(F.col(column)))
            .withColumns({"vlm_caption": F.col("_told.caption"), "error": F.col("_told.error")})
            .drop("_told")
        )
    text = strip(F.col("vlm_caption"))
    return told.withColumn("vlm_caption", F.coalesce(text, F.lit("")) if on_error == EMPTY else text)


class LeadingWords:
    """A captioner for tests and trial runs: all words of a text payload, or the first and how many follow."""

    def __init__(self, words: int | None = None, fail_on: str | None = None):
        self.words = words
        self.fail_on = fail_on

    def setup(self, options: CaptionOptions) -> None:
        import re

        self._word = re.compile(r"[^ \t\r\n\f]+")

    def caption(self, batch: list[str]) -> list[str]:
        return [self._one(text or "") for text in batch]

    def _one(self, text: str) -> str:
        if self.fail_on is not None and self.fail_on in text:
            raise ValueError("cannot caption")
        found = self._word.findall(text)
        rest = 0 if self.words is None else len(found) - self.words
        return " ".join(found[: self.words]) + (f" +{rest}" if rest > 0 else "")
