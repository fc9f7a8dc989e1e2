"""The jobs from end to end: download, regenerate, rebuild, caption."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.functions import layout
from mediacurate.operators import fetch as fetching
from mediacurate.operators import manifest, metadata, numbering, resume
from mediacurate.operators import validate as validation
from mediacurate.operators.caption import EMPTY, REJECT, CaptionOptions, Captioner, caption, load_path
from mediacurate.schemas import ROWS_PER_SHARD, SHARD_META
from mediacurate.session import settle_table, task_count
from mediacurate.sources import assets as listing
from mediacurate.sources import files
from mediacurate.sources.checkpoints import read_checkpoint_keys
from mediacurate.sources.commits import create_exclusively, remove
from mediacurate.sources.shards import success_captions, unify_shards
from mediacurate.sources.sinks import write_corrupt_log, write_training_csv

# Work committed at a time, so that a crash loses one round at most.
SHARDS_PER_ROUND = 200
BATCHES_PER_ROUND = 200


# Called with a name and a small table of counts; counts nobody asks for are not computed.
Report = Callable[[str, DataFrame], None]


def _silent(name: str, counts: DataFrame) -> None:
    pass


@dataclass(frozen=True)
class Dataset:
    """Where things lie under one root that all executors reach."""

    root: str

    def at(self, name: str) -> str:
        return f"{layout.normalise_root(self.root)}/{name}"

    @property
    def images(self) -> str:
        return self.at("images")

    @property
    def shards(self) -> str:
        """Shard metadata: our own table, or the files beside the shard directories."""
        own = self.at("shards")
        return own if exists(own) else self.images


def exists(path: str) -> bool:
    system, plain = files.locate(path)
    return bool(system.get_file_info(plain).type)


@contextmanager
def single_writer(path: str, take_over: bool = False) -> Iterator[None]:
    """Refuse to start while another run writes here; ``take_over`` after a crash. Of two that start at once, one is refused."""
    marker = f"{path.rstrip('/')}/_writer"
    if take_over:
        remove(marker)
    if not create_exclusively(marker, b"writing\n"):
        raise RuntimeError(f"{marker} exists: another run is writing, or one crashed")
    try:
        yield
    finally:
        remove(marker)


def _rounds(items: list, size: int) -> Iterator[list]:
    for start in range(0, len(items), size):
        yield items[start : start + size]


def download(
    spark: SparkSession,
    source: str,
    root: str,
    fetcher: fetching.Fetcher,
    threads: int = 64,
    timeout: float = 30,
    retries: int = 3,
    per_shard: int = ROWS_PER_SHARD,
    shards_per_round: int = SHARDS_PER_ROUND,
    validate: str = "report",
    level: str = "decode",
    decoder: Callable[[bytes], object] | None = None,
    report: Report = _silent,
) -> None:
    """Source table to files, shard metadata, unified metadata and training manifest.

    A rerun keeps the keys given before, numbers the rows the source has gained, and skips the shards already fetched.
    Rows that left the source stay.
    """
    data = Dataset(root)
    keyed = data.at("keyed_urls")
    if not exists(f"{keyed}/_SUCCESS"):
        rows = listing.read_source(spark, source)
        metadata.project_source(rows).write.mode("overwrite").parquet(data.at("urls.parquet"))
        named = metadata.project_source(rows, "source_file", "source_row")
        numbered = numbering.assign_keys(named, "source_file", "source_row", per_shard=per_shard)
        numbered.write.mode("overwrite").parquet(keyed)
    else:
        _append_new(spark, source, data, per_shard, report)
    wanted = spark.read.parquet(keyed)

    table = data.at("shards")
    todo = wanted
    if exists(table):
        _, done = fetching.read_fetched(spark, table)
        todo = fetching.unfetched(wanted, done)
    # Five-digit names, one per shard.
    names = sorted(row["shard"] for row in todo.select("shard").distinct().collect())
    for some in _rounds(names, shards_per_round):
        rows = wanted.filter(F.col("shard").isin(some))
        fetched = fetching.fetch(rows, fetcher, retries, timeout, threads, images_dir=data.images)
        fetching.write_fetched(fetched, table)
    rows, audit = unify(spark, root)
    report("shard files", audit.groupBy(F.col("error").isNull().alias("read")).agg(F.count("*").alias("files")))
    report("keys more than once", metadata.duplicate_keys(rows).agg(F.count("*").alias("keys")))
    report("fetched", rows.groupBy("status").agg(F.count("*").alias("rows")))
    regenerate(spark, root, validate, level, decoder, report=report, rows=rows)


def _append_new(spark: SparkSession, source: str, data: Dataset, per_shard: int, report: Report) -> None:
    """Number the rows that the source has and the keyed rows have not, from the next shard on.

    Rows are told apart by their contents, so files may be renamed or written anew; of equal rows the copies count. New
    rows get shards of their own, since a fetched shard is never fetched again.
    """
    path = data.at("keyed_urls")
    keyed = spark.read.parquet(path)
    rows = metadata.project_source(listing.read_source(spark, source), "source_file", "source_row")
    columns = [c for c in rows.columns if c not in ("source_file", "source_row")]
    digest = F.sha2(F.to_json(F.struct(*columns)), 256).alias("_digest")
    held = keyed.groupBy(digest).agg(F.count("*").alias("_held"))
    had = rows.groupBy(digest, *columns).agg(
        F.count("*").alias("_copies"), F.min(F.struct("source_file", "source_row")).alias("_first")
    )
    more = had.join(held, "_digest", "left").withColumn("_more", F.col("_copies") - F.coalesce("_held", F.lit(0)))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_more")))
    new = settle_table(more.filter("_more > 0").select(*columns, "_first.*", copies.alias("_copy")).drop("_copy"), "new_rows")
    report("source rows added", new.agg(F.count("*").alias("rows")))
    if new.isEmpty():
        return
    last = keyed.agg(F.max("gidx"), F.max(F.col("shard").cast("bigint"))).first()
    start = per_shard * (1 + max(last[0] // per_shard, last[1])) if last[0] is not None else 0
    numbered = numbering.assign_keys(new, "source_file", "source_row", per_shard=per_shard, start=start)
    # The numbered rows come last: after a crash before them, all is done again.
    urls = settle_table(keyed.select(*columns).union(new.select(*columns)), "urls")
    urls.write.mode("overwrite").parquet(data.at("urls.parquet"))
    numbered.select(*keyed.columns).write.mode("append").parquet(path)


def unify(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Write the unified metadata, every status kept, and the audit of the shard files."""
    data = Dataset(root)
    rows, audit = unify_shards(spark, data.shards)
    rows.write.mode("overwrite").parquet(data.at("full_metadata.parquet"))
    audit.write.mode("overwrite").parquet(data.at("shard_audit.parquet"))
    return spark.read.parquet(data.at("full_metadata.parquet")), spark.read.parquet(data.at("shard_audit.parquet"))


def _directories(spark: SparkSession, root: str) -> list[str]:
    """The directories directly under ``root``: one per shard."""
    return sorted(row["path"] for row in listing.list_directory(spark, root).filter("is_dir").collect())


def _validity(spark, data: Dataset, found: DataFrame, level: str, decoder) -> DataFrame:
    directories = _directories(spark, data.images) if level == "decode" and decoder is None else None
    return validation.validate(found, level, decoder, directories, data.images)


def _report_validity(report: Report, validity: DataFrame, level: str) -> None:
    """Counts of the verdicts, also per 50,000 files in the order of their paths."""
    report("validity", validation.validity_counts(validity))
    report("named as another format", validation.misnamed(validity))
    if level == "decode":
        report("seen by no decoder", validation.not_decoded(validity))
    if report is not _silent:  # numbering sorts the paths
        report("progress", numbering.progress(numbering.global_index(validity.select("path", "is_valid"), "path"), "is_valid"))


def regenerate(
    spark: SparkSession,
    root: str,
    validate: str = "none",
    level: str = "decode",
    decoder: Callable[[bytes], object] | None = None,
    delete_mode: str = "file",
    report: Report = _silent,
    rows: DataFrame | None = None,
    per_file: bool = False,
) -> DataFrame:
    """Training manifest from shard captions; ``validate`` is none, report or clean.

    ``none`` lists every captioned file. ``report`` keeps keys with a valid
    file, one file each, or with ``per_file`` every valid file. ``clean`` also
    removes what the delete plan names.
    """
    if validate not in ("none", "report", "clean"):
        raise ValueError(f"unknown choice {validate!r}")
    data = Dataset(root)
    if rows is None:
        rows, _ = unify_shards(spark, data.shards)
    captions = metadata.caption_by_key(success_captions(rows), ["row_no"], unique=True)
    told = metadata.told_by_key(success_captions(rows), ["row_no"])
    everything = settle_table(listing.with_layout(listing.list_files(spark, data.images)), "listing")
    images = listing.image_assets(everything)
    if validate == "none":
        made, counters = manifest.build_manifest("listing", images, captions, root=data.root, told=told)
    else:
        found = images
        validity = _validity(spark, data, images, level, decoder)
        _report_validity(report, validity, level)
        report("fetched without a file", validation.missing_files(rows, images).groupBy("error").count())
        write_corrupt_log(validation.corrupt_log(validity), data.at("corrupt_images.log"))
        if validate == "clean":
            plan = validation.delete_plan(validity.filter("NOT is_valid"), everything, delete_mode)
            gone = validation.remove_files(plan)
            images = images.join(gone.select("path"), "path", "left_anti")
        else:
            corrupt = validity.filter("NOT is_valid").select("path")
            images = images.join(corrupt, "path", "left_anti")
        if per_file:
            made = manifest.listing(images, captions, validity, data.root)
            counters = manifest.listing_counters(found, told, validity)
        else:
            keys = validation.valid_keys(validity)
            made, counters = manifest.build_manifest(
                "validated", images, captions, valid_keys=keys, root=data.root, images_dir=data.images, told=told
            )
    report("manifest", counters)
    write_training_csv(made, data.at("metadata.csv"))
    return made


def rebuild(
    spark: SparkSession,
    root: str,
    clean: bool = False,
    level: str = "decode",
    decoder: Callable[[bytes], object] | None = None,
    report: Report = _silent,
) -> DataFrame:
    """Validate the JPEG-named files of every subdirectory and write the manifest from their sidecars."""
    data = Dataset(root)
    everything = settle_table(listing.with_layout(listing.list_files(spark, data.images)), "listing")
    direct = layout.relative_path(F.col("path"), data.images).rlike("^[^/]+/[^/]+$")
    found = listing.image_assets(everything, ("jpg",)).filter(direct)
    validity = _validity(spark, data, found, level, decoder)
    _report_validity(report, validity, level)
    write_corrupt_log(validation.corrupt_log(validity), data.at("corrupt_images.log"))
    if clean:
        validation.remove_files(validation.delete_plan(validity.filter("NOT is_valid"), everything, "pair"))
    made = manifest.from_sidecars(validity.filter("is_valid"), root=data.root)
    write_training_csv(made, data.at("metadata.csv"))
    return made


def caption_dataset(
    spark: SparkSession,
    root: str,
    out: str,
    captioner: Captioner,
    rows_per_batch: int = 500,
    max_images: int | None = None,
    resume_run: bool = True,
    publish_to: str | None = None,
    options: CaptionOptions | None = None,
    loader=load_path,
    profile: ResourceProfile | None = None,
    tasks: int | None = None,
    batches_per_round: int = BATCHES_PER_ROUND,
    take_over: bool = False,
    report: Report = _silent,
    on_error: str = REJECT,
    resume_from: str | None = None,
) -> DataFrame:
    """Caption every unprocessed image and return the complete table.

    With ``on_error`` empty, an image that fails gets an empty caption and counts
    as processed. ``resume_from`` is a folder an earlier run left, whose keys
    count as processed. The limit comes before the resume, as users expect of a repeated command.
    Batches are committed a round at a time; a crash loses the round at hand and
    the next run takes it up. Metadata rows travel through the joins, images do
    not: each is opened by the task that captions it.
    """
    data = Dataset(root)
    batches, rejects = f"{out.rstrip('/')}/batches", f"{out.rstrip('/')}/rejects"
    tasks = tasks or task_count(spark)
    with single_writer(out, take_over):
        found = listing.list_assets(spark, data.images, ("jpg",), shard_dirs_only=True)
        assets = settle_table(listing.limit_assets(found, max_images), "assets")
        stored = resume.read_committed(spark, batches)
        if resume_run:
            done = resume.processed_keys(resume.captioned(stored))
            if resume_from is not None:
                done = resume.processed_keys(done, read_checkpoint_keys(spark, resume_from))
            report("assets", resume.skip_counts(assets, done))
            assets = resume.pending(assets, done)
        rows, _ = unify_shards(spark, data.shards, absent="")
        alone = metadata.shards_without_metadata(assets, rows)
        report("without metadata", alone.agg(F.count("*").alias("shards")))
        records = metadata.last_by_key(
            rows.select(*SHARD_META.names, "shard", "row_no"), ["shard", "key"], ["row_no"], unique=True
        )
        marked = settle_table(
            metadata.enrich_marked(assets.select("path", "shard", "key"), records), "enriched"
        )
        marked.filter(F.col("error").isNotNull()).select("key", "path", "error").write.mode("overwrite").parquet(rejects)

        start = resume.next_batch_id(resume.commit_log(spark, batches).entries())
        good = marked.filter(F.col("error").isNull()).drop("error")
        staged = settle_table(numbering.assign_batches(good, rows_per_batch, "path", start=start), "staged")
        last = staged.agg(F.max("batch_id")).first()[0]
        for low in range(start, (start if last is None else last + 1), batches_per_round):
            this_round = F.col("batch_id").between(low, low + batches_per_round - 1)
            # Rows are light and captions are slow, so tasks are set by number, not by size.
            spread = staged.filter(this_round).repartitionByRange(tasks, "gidx")
            told = caption(spread, captioner, "path", on_error, options=options, loader=loader, profile=profile)
            if on_error == EMPTY:
                told = told.withColumn("error", F.lit(None).cast("string"))
            numbers = range(low, min(low + batches_per_round, last + 1))
            written = resume.commit_batches(metadata.captioned_projection(told, "error", "batch_id"), batches, numbers)
            report("written", written.groupBy(F.col("error").isNull().alias("captioned")).agg(F.count("*").alias("rows")))
            if publish_to:
                report("published", resume.publish(written, publish_to, rows_per_batch).agg(F.count("*").alias("batches")))
        complete = f"{out.rstrip('/')}/all_captions"
        resume.complete_table(resume.read_committed(spark, batches)).write.mode("overwrite").parquet(complete)
        if publish_to:
            resume.publish_complete(spark.read.parquet(complete), publish_to)
    return spark.read.parquet(complete)
