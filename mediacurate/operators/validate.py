"""Validity of payloads, and what to do with the corrupt ones."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from mediacurate.functions import layout, signatures
from mediacurate.functions.text import one_line
from mediacurate.schemas import IMAGE_EXTENSIONS, SUCCESS, VALIDITY
from mediacurate.session import scratch_path, settle_table, task_count
from mediacurate.sources import containers, files
from mediacurate.sources.assets import list_directory

# Directories whose files the image source lists at once on the driver.
DIRECTORIES_PER_SCAN = 500
# Single files that it is given at once.
FILES_PER_SCAN = 50_000
# What a file counts beside its bytes where files are put together in tasks: some hundreds are in one, not Spark's thirty-two.
FILE_BYTES = 256 << 10
_WALKED = StructType([StructField("format", StringType()), StructField("error", StringType())])


def _verdict(df: DataFrame, error: Column, found: Column, level: Column) -> DataFrame:
    return df.withColumns({"format": found, "error": error, "check_level": level}).withColumn(
        "is_valid", F.col("error").isNull()
    )


@F.arrow_udf(_WALKED)
def _inspected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Payloads are taken out of their batch one by one, so a task holds one batch and one payload."""
    for content in batches:
        found = [containers.inspect(containers.Held(body.as_py() or b"")) for body in content]
        columns = [pa.array([told[place] for told in found], pa.string()) for place in (0, 1)]
        yield pa.StructArray.from_arrays(columns, names=["format", "error"])


def check_content(df: DataFrame, content: str = "content") -> DataFrame:
    """Structural verdict on a binary column."""
    walked = df.withColumn("_walked", _inspected(F.col(content)))
    return _verdict(walked, F.col("_walked.error"), F.col("_walked.format"), F.lit("structural")).drop("_walked")


def check_html(df: DataFrame, html: str = "html") -> DataFrame:
    """Structural verdict on a text column holding a web page."""
    return _verdict(df, signatures.html_error(F.col(html)), F.lit("html"), F.lit("structural"))


def check_structure(assets: DataFrame) -> DataFrame:
    """Structural verdict on files, each walked inside the task in bounded reads."""

    def work(frames):
        for frame in frames:
            found = [_structure_of(path) for path in frame["path"]]
            frame["_format"], frame["_problem"] = zip(*found) if found else ((), ())
            yield frame

    schema = StructType(assets.schema.fields + [StructField("_format", StringType()), StructField("_problem", StringType())])
    walked = assets.mapInPandas(work, schema)
    return _verdict(walked, F.col("_problem"), F.col("_format"), F.lit("structural")).drop("_format", "_problem")


def _structure_of(path: str) -> tuple[str | None, str | None]:
    try:
        with files.open_at(path) as handle:
            return containers.inspect(handle)
    except Exception as problem:
        return None, f"{type(problem).__name__}: {problem}"


def check_decoder(assets: DataFrame, decoder: Callable[[bytes], object]) -> DataFrame:
    """Full-decode verdict by a caller's decoder, which raises on a corrupt payload.

    Each file is read once, inside the task; only the verdict leaves it.
    """

    def work(frames):
        for frame in frames:
            frame["_problem"] = [_decode_problem(path, decoder) for path in frame["path"]]
            yield frame

    schema = StructType(assets.schema.fields + [StructField("_problem", StringType())])
    decoded = assets.mapInPandas(work, schema)
    return _verdict(decoded, F.col("_problem"), F.lit(None).cast("string"), F.lit("decode")).drop("_problem")


def _decode_problem(path: str, decoder) -> str | None:
    try:
        decoder(files.read_bytes(path))
    except Exception as problem:
        return str(problem) or type(problem).__name__
    return None


def _chunks(items: Iterable[str], size: int) -> Iterator[list[str]]:
    left = iter(items)
    while some := list(islice(left, size)):
        yield some


@contextmanager
def _many_small_files(spark: SparkSession) -> Iterator[None]:
    """Spark starts a task for each path that it lists and for each thirty-two files that it reads; here tasks are fewer."""
    wanted = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": task_count(spark),
        "spark.sql.files.openCostInBytes": FILE_BYTES,
    }
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def _files_under(spark: SparkSession, root: str) -> Iterator[str]:
    """The image files directly under ``root`` as the image source is to be given them."""
    image = F.col("path").rlike(rf"(?s)\.({'|'.join(IMAGE_EXTENSIONS)})\z")
    for row in list_directory(spark, root).filter(~F.col("is_dir") & image).select("path").toLocalIterator():
        yield re.sub(r"([\\{}\[\]*?])", r"\\\1", row["path"])  # a name, not a pattern


def decode_with_image_source(spark: SparkSession, directories: list[str], root: str | None = None) -> DataFrame:
    """Path and ``decoded`` for files Spark's image source can judge (JPEG, PNG).

    The source lists on the driver, so it is given some directories at a time
    and each round's verdicts are written before the next. ``root`` names a folder
    whose files are scanned too, but not the directories in it: a task lists them,
    and the source is given some of them at a time. For single directories too
    large to list, pass a decoder to ``validate`` instead.
    Files whose names start with an underscore or a dot are hidden from the source.
    """
    target = scratch_path(spark, "decoded")
    glob = "*.{" + ",".join(IMAGE_EXTENSIONS) + "}"

    def shown(paths: list[str], only_good: bool) -> DataFrame:
        images = spark.read.format("image").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        images = images.option("dropInvalid", str(only_good).lower()).load(paths)
        return images.select(layout.decode_origin(F.col("_metadata.file_path")).alias("path"), F.lit(only_good).alias("decoded"))

    def scan(paths: list[str]) -> None:
        # Where no column of a picture is asked for, the source opens files only to drop those that it cannot decode; for a column it
        # would also generate code anew for each file, which takes longer than to decode it.
        shown(paths, False).union(shown(paths, True)).write.mode("append").parquet(target)

    scans = 0
    with _many_small_files(spark):
        for some in _chunks(directories, DIRECTORIES_PER_SCAN):
            scan(some)
            scans += 1
        for some in _chunks(_files_under(spark, root) if root is not None else [], FILES_PER_SCAN):
            scan(some)
            scans += 1
    schema = StructType([StructField("path", StringType()), StructField("decoded", BooleanType())])
    if not scans:
        return spark.createDataFrame([], schema)
    # directories may overlap
    return spark.read.schema(schema).parquet(target).groupBy("path").agg(F.some("decoded").alias("decoded"))


def validate(
    assets: DataFrame,
    level: str = "structural",
    decoder: Callable[[bytes], object] | None = None,
    directories: list[str] | None = None,
    root: str | None = None,
) -> DataFrame:
    """Validity of each listed file, written once so that every later branch shares it.

    ``structural`` walks the container of each file. ``decode`` adds a full decode:
    by ``decoder`` if one is given, else by Spark's image source over
    ``directories`` and the files directly under ``root``. What that source
    cannot decode (WebP) or does not show (hidden names) keeps its structural
    verdict; ``check_level`` says which check decided.
    """
    if level == "structural":
        checked = check_structure(_spread(assets))
    elif level == "decode" and decoder is not None:
        checked = check_decoder(_spread(assets), decoder)
    elif level == "decode":
        decoded = decode_with_image_source(assets.sparkSession, directories or [], root)
        checked = _merge_decoded(check_structure(_spread(assets)), decoded)
    else:
        raise ValueError(f"unknown level {level!r}")
    return settle_table(checked.select(*VALIDITY.names, "shard", "ext"), "validity")


def _spread(assets: DataFrame) -> DataFrame:
    """Files of one directory come from the one task that listed it; here they go to all."""
    return assets.repartition(task_count(assets.sparkSession), "path")


def _merge_decoded(structural: DataFrame, decoded: DataFrame) -> DataFrame:
    joined = structural.join(decoded, "path", "left")
    judged = F.coalesce(F.col("format") != "webp", F.lit(True)) & F.col("decoded").isNotNull()
    # The image source shows what is there of a file cut short, so a container that does not end still counts.
    error = F.coalesce(F.col("error"), F.when(judged & ~F.col("decoded"), F.lit("undecodable")))
    level = F.when(judged, "decode").otherwise("structural")
    return _verdict(joined.withColumn("error", error), F.col("error"), F.col("format"), level)


def not_decoded(validity: DataFrame) -> DataFrame:
    """Files that no decoder saw, by format and verdict."""
    return validity.filter("check_level = 'structural'").groupBy("format", "is_valid").agg(F.count("*").alias("files"))


def misnamed(validity: DataFrame) -> DataFrame:
    """Files whose content is of another format than their name says."""
    odd = validity.filter(signatures.format_mismatch(F.col("format"), F.col("ext")))
    return odd.groupBy("ext", "format").agg(F.count("*").alias("files"))


def valid_keys(validity: DataFrame) -> DataFrame:
    """A key is valid when any of its files is."""
    return validity.filter("is_valid").select("key").distinct()


def validity_counts(validity: DataFrame) -> DataFrame:
    return validity.groupBy("is_valid").agg(F.count("*").alias("rows"))


def corrupt_log(validity: DataFrame) -> DataFrame:
    return validity.filter("NOT is_valid").select("path", one_line(F.col("error")).alias("error"))


def missing_files(shard_meta: DataFrame, assets: DataFrame) -> DataFrame:
    """Keys fetched successfully whose file is absent or empty."""
    present = assets.filter("length > 0").select("shard", "key")
    fetched = shard_meta.filter(F.col("status") == SUCCESS).select("shard", "key")
    return fetched.join(present, ["shard", "key"], "left_anti").withColumn("error", F.lit("missing_or_empty"))


def delete_plan(corrupt: DataFrame, existing: DataFrame, mode: str = "file") -> DataFrame:
    """Existing paths to remove for the corrupt ones.

    ``file``: the corrupt file. ``pair``: with its JSON sidecar. ``stem``: every
    file that shares its stem, good ones too.
    """
    path = F.col("path")
    if mode == "file":
        wanted = F.array(path)
    elif mode == "pair":
        wanted = F.array(path, layout.with_suffix(path, ".json"))
    elif mode == "stem":
        wanted = layout.stem_files(path)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    plan = corrupt.select(F.explode(wanted).alias("path")).distinct()
    return plan.join(existing.select("path"), "path", "left_semi")


def remove_files(plan: DataFrame) -> DataFrame:
    """Carry out a plan; the log says which paths are gone. It is written, so the work is done once."""

    def work(frames):
        for frame in frames:
            frame["removed"] = [files.delete_file(path) for path in frame["path"]]
            yield frame

    return settle_table(plan.select("path").mapInPandas(work, "path string, removed boolean"), "removed")
