"""Every operator as a query over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediacurate.functions import layout
from mediacurate.functions.text import sidecar_caption
from mediacurate.operators import fetch as fetching
from mediacurate.operators import manifest, metadata, numbering, resume
from mediacurate.operators import validate as validation
from mediacurate.operators.caption import EMPTY, LeadingWords, caption
from mediacurate.plans import views
from mediacurate.schemas import META_RECORD, SHARD_META
from mediacurate.session import scratch_path, settle_table
from mediacurate.sources import assets as listing
from mediacurate.sources.checkpoints import read_checkpoint_keys
from mediacurate.sources.files import locate
from mediacurate.sources.shards import shard_name, shard_status, success_captions, unify_shards
from mediacurate.sources.sinks import read_training_csv, write_training_csv
from mediacurate.streaming.ingest import stream_ingest

ROWS_PER_BATCH = 50
FAILING_WORD = " the "


# --- sources ---------------------------------------------------------------


def source_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.project_source(views.source_rows(spark, sf_dir))


def assign_keys(spark, sf_dir):
    rows = views.table(spark, sf_dir, "documents").select("doc_id")
    return numbering.assign_keys(rows, "doc_id", per_shard=views.PER_SHARD)


def assign_keys_far(spark, sf_dir):
    """Numbers past nine digits: key and shard grow longer, and no two shards share a name."""
    rows = views.table(spark, sf_dir, "documents").select("doc_id")
    return numbering.assign_keys(rows, "doc_id", start=1_000_000_000)


def discover_shards(spark, sf_dir):
    return listing.discover_shards(views.asset_files(spark, sf_dir, other_dir=True))


def list_assets(spark, sf_dir):
    return listing.image_assets(views.asset_files(spark, sf_dir)).select("path", "key", "ext")


def list_shard_assets(spark, sf_dir):
    found = views.asset_files(spark, sf_dir, other_dir=True)
    return listing.image_assets(found, ("jpg",), shard_dirs_only=True).select("path", "shard", "key")


def list_assets_any_dir(spark, sf_dir):
    found = views.asset_files(spark, sf_dir, other_dir=True)
    return listing.image_assets(found, ("jpg",)).select("path", "shard", "key")


def limit_assets(spark, sf_dir):
    return listing.limit_assets(views.asset_files(spark, sf_dir), 100)


def parse_path(spark, sf_dir):
    return metadata.parse_paths(views.asset_files(spark, sf_dir, other_dir=True))


def _write_shards(spark, sf_dir) -> str:
    """Shard files as different writers leave them: sizes as int, as double, or left out."""
    rows = views.shard_rows(spark, sf_dir).select(*SHARD_META.names, "shard")
    number = F.col("shard").cast("int") % 3
    root = scratch_path(spark, "shards")
    variants = [
        rows.filter(number == 0),
        rows.filter(number == 1).withColumns({n: F.col(n).cast("double") for n in ("width", "original_width")}),
        rows.filter(number == 2).drop("original_width", "original_height"),
    ]
    for variant in variants:
        variant.write.mode("append").partitionBy("shard").parquet(root)
    return root


def _unified(spark, root: str) -> DataFrame:
    rows, _ = unify_shards(spark, root)
    return rows.select(*SHARD_META.names, "shard")


def unify(spark, sf_dir):
    return _unified(spark, _write_shards(spark, sf_dir))


def unify_audit(spark, sf_dir):
    """Rows read and files left out per shard; one file in each is broken on purpose."""
    root = _write_shards(spark, sf_dir)

    def spoil(frames):
        for frame in frames:
            for shard in frame["shard"]:
                system, path = locate(f"{root}/shard={shard}/broken.parquet")
                with system.open_output_stream(path) as stream:
                    stream.write(b"PAR1 this is no parquet file PAR1")
            yield frame

    shards = views.document_keys(spark, sf_dir).select(layout.key_shard(F.col("key")).alias("shard")).distinct()
    shards.mapInPandas(spoil, "shard string").write.format("noop").mode("overwrite").save()
    rows, audit = unify_shards(spark, root)
    left_out = audit.filter(F.col("error").isNotNull()).groupBy(shard_name(F.col("path")).alias("shard"))
    counts = rows.groupBy("shard").agg(F.count("*").alias("rows"))
    return counts.join(left_out.agg(F.count("*").alias("files_left_out")), "shard")


# --- fetch -----------------------------------------------------------------


def _manifest(spark, sf_dir) -> DataFrame:
    return views.shard_rows(spark, sf_dir).select(
        "key", "shard", "url", "caption", "original_key", "md5", "tags", "merged_tags"
    )


def fetch_status(spark, sf_dir):
    payloads = views.page_assets(spark, sf_dir).select("key", F.col("html").cast("binary").alias("content"))
    wanted = _manifest(spark, sf_dir).select("key", "url", "original_key")
    return fetching.fetch_from_table(wanted, payloads)


def fetch_files(spark, sf_dir):
    """Fetch with the worker: pages are written as files, and every document's URL is tried."""
    root = scratch_path(spark, "payloads")
    pages = views.page_assets(spark, sf_dir).select(
        layout.key_shard(F.col("key")).alias("shard"), "key", F.col("html").cast("binary").alias("content")
    )
    fetching.export_files(pages, root, "html").write.format("noop").mode("overwrite").save()
    url = F.concat(F.lit(root + "/"), "shard", F.lit("/"), "key", F.lit(".html"))
    fetched = fetching.fetch(_manifest(spark, sf_dir).withColumn("url", url), fetching.PathFetcher(), threads=16)
    _, shard_meta = fetching.write_fetched(fetched, scratch_path(spark, "fetched"))
    return shard_meta.select("key", "shard", "status", "attempts", "sha256", "original_key", "md5")


def _finished(spark, sf_dir) -> DataFrame:
    """Shards that count as fetched: those with a low share of toxic labels."""
    labels = views.table(spark, sf_dir, "labels")
    per_shard = labels.groupBy(layout.key_shard(views.key_of("doc_id")).alias("shard"))
    return per_shard.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).filter("toxic * 8 <= n")


def fetch_incremental(spark, sf_dir):
    return fetching.unfetched(_manifest(spark, sf_dir), _finished(spark, sf_dir)).select("key", "shard", "url")


def payload_hash(spark, sf_dir):
    return fetching.payload_hashes(views.table(spark, sf_dir, "documents"), "text").select(
        "doc_id", "md5", "sha256", "n_bytes"
    )


def payload_sizes(spark, sf_dir):
    """Sizes of the pictures drawn from the documents, damaged ones too as long as their header is there."""
    return fetching.payload_sizes(views.payloads(spark, sf_dir)).select("key", "width", "height")


# --- manifests -------------------------------------------------------------


def _placed_captions(spark, sf_dir) -> DataFrame:
    """Captions of the fetched rows; a document's number is its row's place among all shards."""
    return success_captions(views.shard_rows(spark, sf_dir).withColumnRenamed("doc_id", "row_no"))


def _captions(spark, sf_dir) -> DataFrame:
    return metadata.caption_by_key(_placed_captions(spark, sf_dir), ["row_no"], unique=True)


def _told(spark, sf_dir) -> DataFrame:
    return metadata.told_by_key(_placed_captions(spark, sf_dir), ["row_no"])


def _assets(spark, sf_dir) -> DataFrame:
    return listing.image_assets(views.asset_files(spark, sf_dir))


def _page_validity(spark, sf_dir) -> DataFrame:
    return validation.check_html(views.page_assets(spark, sf_dir)).drop("html")


def success(spark, sf_dir):
    return success_captions(views.shard_rows(spark, sf_dir)).select("key", "caption")


def status_by_shard(spark, sf_dir):
    return shard_status(views.shard_rows(spark, sf_dir))


def key_caption_last(spark, sf_dir):
    """Documents of one source stand for the rows of one key."""
    rows = views.table(spark, sf_dir, "documents").select(
        F.col("source").alias("key"),
        F.col("text").alias("caption"),
        metadata.row_number(layout.key_shard(views.key_of("doc_id")), F.col("doc_id")).alias("row_no"),
    )
    return metadata.caption_by_key(rows, ["row_no"], unique=True)


def ext_priority(spark, sf_dir):
    return manifest.preferred_file(_assets(spark, sf_dir))


def manifest_validated(spark, sf_dir):
    keys = validation.valid_keys(_page_validity(spark, sf_dir))
    return manifest.validated(keys, _captions(spark, sf_dir), _assets(spark, sf_dir))


def csv_round_trip(spark, sf_dir):
    """The validated manifest as training CSV, read back."""
    path = scratch_path(spark, "train-csv")
    write_training_csv(manifest_validated(spark, sf_dir), path)
    return read_training_csv(spark, path)


def parquet_round_trip(spark, sf_dir):
    """The manifest of the source as Parquet, read back."""
    return settle_table(source_projection(spark, sf_dir), "urls")


def manifest_listing(spark, sf_dir):
    absolute = _assets(spark, sf_dir).withColumn("path", F.concat(F.lit("file:/data/set/"), "path"))
    return manifest.listing(absolute, _captions(spark, sf_dir), root="/data/set")


def manifest_sidecar(spark, sf_dir):
    return manifest.from_sidecars(_assets(spark, sf_dir), views.sidecars(spark, sf_dir))


def manifest_counters(spark, sf_dir):
    keys = validation.valid_keys(_page_validity(spark, sf_dir))
    return manifest.validated_counters(keys, _told(spark, sf_dir), _assets(spark, sf_dir))


def manifest_file_counters(spark, sf_dir):
    """Counters of the per-file mode, with the pages' verdicts on the files of the same key."""
    files = _assets(spark, sf_dir)
    verdicts = _page_validity(spark, sf_dir).select("key", "is_valid")
    validity = files.join(verdicts, "key").select("path", "is_valid")
    return manifest.listing_counters(files, _told(spark, sf_dir), validity)


# --- metadata --------------------------------------------------------------


def _enriched(spark, sf_dir, keep: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    chosen = listing.with_layout(manifest.preferred_file(_assets(spark, sf_dir)).select("path"))
    if keep is not None:
        chosen = resume.pending(chosen, keep)
    known = metadata.last_by_key(views.shard_meta(spark, sf_dir), ["shard", "key"], ["doc_id"], unique=True)
    return metadata.enrich(chosen.select("path", "shard", "key"), known, views.sidecars(spark, sf_dir))



def metadata_enrich(spark, sf_dir):
    rows, _ = _enriched(spark, sf_dir)
    return rows.select("path", *META_RECORD.names)


def enrich_rejects(spark, sf_dir):
    _, rejects = _enriched(spark, sf_dir)
    return rejects.select("key", "path", "error")


def captioned_rows(spark, sf_dir):
    """The whole captioning job: unprocessed assets, their metadata, a caption, the output columns."""
    rows, _ = _enriched(spark, sf_dir, views.checkpoint_keys(spark, sf_dir))
    told = caption(rows, LeadingWords(), "caption")
    return metadata.captioned_projection(told.filter(F.col("error").isNull()))


def url_dataset(spark, sf_dir):
    rows, _ = _enriched(spark, sf_dir)
    told = rows.withColumn("vlm_caption", F.col("md5"))
    return metadata.url_dataset(metadata.captioned_projection(told))


def sidecar_captions(spark, sf_dir):
    """Event properties as sidecars: some truncated, some without a caption."""
    whole = F.concat(F.lit('{"caption":"'), "event_type", F.lit('","props":'), "props", F.lit("}"))
    body = (
        F.when(F.col("event_id") % 17 == 0, F.substring("props", 1, 4))
        .when(F.col("event_type") == "error", F.col("props"))
        .otherwise(whole)
    )
    return views.table(spark, sf_dir, "events").select("event_id", sidecar_caption(body).alias("caption"))


# --- validity --------------------------------------------------------------


def validate_html(spark, sf_dir):
    return _page_validity(spark, sf_dir).select("page_id", "key", "is_valid")


def validate_split(spark, sf_dir):
    return _page_validity(spark, sf_dir).select("page_id", "path", "is_valid", "error")


def validate_counts(spark, sf_dir):
    return validation.validity_counts(_page_validity(spark, sf_dir))


def valid_keys(spark, sf_dir):
    return validation.valid_keys(_page_validity(spark, sf_dir))


def corrupt_log(spark, sf_dir):
    return validation.corrupt_log(_page_validity(spark, sf_dir))


def progress_counts(spark, sf_dir):
    verdicts = _page_validity(spark, sf_dir).select("page_id", "is_valid")
    return numbering.progress(numbering.global_index(verdicts, "page_id"), "is_valid", every=ROWS_PER_BATCH)


def validate_content(spark, sf_dir):
    """Structural verdict on binary payloads drawn from the documents."""
    return validation.check_content(views.payloads(spark, sf_dir)).select("key", "format", "is_valid", "error")


def validate_decode(spark, sf_dir):
    """The same payloads as files, some directly under the root, listed and decoded."""
    root = scratch_path(spark, "images")
    at_root = F.substring("key", -1, 1) == "1"
    placed = views.payloads(spark, sf_dir).withColumn("shard", F.when(~at_root, F.col("shard")))
    written = fetching.export_files(placed, root, "png")
    written.write.format("noop").mode("overwrite").save()
    directories = [row["path"] for row in listing.list_directory(spark, root).filter("is_dir").collect()]
    verdicts = validation.validate(listing.list_assets(spark, root), "decode", directories=directories, root=root)
    return verdicts.select("key", layout.key_shard(F.col("key")).alias("shard"), "is_valid", "error", "check_level")


def _corrupt(spark, sf_dir) -> DataFrame:
    return _page_validity(spark, sf_dir).filter("NOT is_valid").select("path")


def delete_plan_all(spark, sf_dir):
    return validation.delete_plan(_corrupt(spark, sf_dir), views.asset_files(spark, sf_dir), "stem")


def delete_plan_pair(spark, sf_dir):
    beside = views.sidecars(spark, sf_dir).select(
        F.concat(F.lit("images/"), "shard", F.lit("/"), "key", F.lit(".json")).alias("path")
    )
    existing = beside.unionByName(views.page_assets(spark, sf_dir).select("path"))
    return validation.delete_plan(_corrupt(spark, sf_dir), existing, "pair")


# --- captioning and resume ---------------------------------------------------


def checkpoint_keys(spark, sf_dir):
    return views.checkpoint_keys(spark, sf_dir)


def checkpoint_files(spark, sf_dir):
    """The processed keys as an earlier run leaves them: parquet files with a key, and one without."""
    folder = scratch_path(spark, "checkpoint")
    done = views.checkpoint_keys(spark, sf_dir)
    hash_of = F.pmod(F.xxhash64("key"), F.lit(2))
    done.filter(hash_of == 0).write.parquet(f"{folder}/first.parquet")
    done.filter(hash_of == 1).withColumn("vlm_caption", F.lit("")).write.parquet(f"{folder}/second.parquet")
    done.agg(F.count("*").alias("rows")).write.parquet(f"{folder}/statistics.parquet")
    return read_checkpoint_keys(spark, folder)


def pending(spark, sf_dir):
    return resume.pending(views.document_keys(spark, sf_dir).select("key"), views.checkpoint_keys(spark, sf_dir))


def skip_counts(spark, sf_dir):
    return resume.skip_counts(views.document_keys(spark, sf_dir), views.checkpoint_keys(spark, sf_dir))


def batch_assign(spark, sf_dir):
    batched = numbering.assign_batches(views.document_keys(spark, sf_dir).select("key"), ROWS_PER_BATCH, "key")
    return numbering.batch_counts(batched)


def batch_names(spark, sf_dir):
    batched = numbering.assign_batches(pending(spark, sf_dir), ROWS_PER_BATCH, "key")
    return numbering.batch_names(numbering.batch_counts(batched), ROWS_PER_BATCH)


def caption_rows_udf(spark, sf_dir):
    rows = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return caption(rows, LeadingWords(), "text").select("doc_id", "vlm_caption")


def caption_error_empty(spark, sf_dir):
    rows = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    told = caption(rows, LeadingWords(fail_on=FAILING_WORD), "text", on_error=EMPTY)
    return told.select("doc_id", "vlm_caption")


def caption_reject(spark, sf_dir):
    rows = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    told = caption(rows, LeadingWords(fail_on=FAILING_WORD), "text")
    return told.filter(F.col("error").isNull()).select("doc_id", "vlm_caption")


def _stored_batches(spark, sf_dir) -> str:
    """Pending shard rows captioned and committed in batches; some are rejected."""
    rows = resume.pending(views.shard_rows(spark, sf_dir), views.checkpoint_keys(spark, sf_dir))
    batched = numbering.assign_batches(rows.drop("status", "shard", "doc_id"), ROWS_PER_BATCH, "key")
    told = caption(batched, LeadingWords(fail_on=FAILING_WORD), "caption")
    path = scratch_path(spark, "captions")
    resume.write_batches(metadata.captioned_projection(told, "error", "batch_id"), path)
    return path


def publish_manifest(spark, sf_dir):
    stored = resume.read_batches(spark, _stored_batches(spark, sf_dir))
    out = scratch_path(spark, "published")
    published = resume.publish(stored, out, ROWS_PER_BATCH)
    return published.withColumn("path", layout.relative_path(F.col("path"), out))


def publish_complete(spark, sf_dir):
    """Batches published one by one, then the whole table in their place."""
    stored = resume.read_batches(spark, _stored_batches(spark, sf_dir))
    out = scratch_path(spark, "published")
    resume.publish(stored, out, ROWS_PER_BATCH)
    return resume.publish_complete(resume.complete_table(stored), out).drop("publish_name")


def rejected_rows(spark, sf_dir):
    return resume.rejected(resume.read_batches(spark, _stored_batches(spark, sf_dir))).select("key", "batch_id")


def _repeated_batches(spark, sf_dir) -> str:
    """Batches and a republished copy of each row under a later batch."""
    path = _stored_batches(spark, sf_dir)
    stored = resume.read_batches(spark, path)
    start = resume.next_batch_id(stored)
    again = stored.withColumns(
        {"batch_id": F.col("batch_id") + F.lit(start), "vlm_caption": F.concat("vlm_caption", F.lit(" (again)"))}
    )
    resume.write_batches(again, path)
    return path


def _complete(spark, path: str) -> DataFrame:
    return resume.complete_table(resume.read_batches(spark, path))


def final_dedupe(spark, sf_dir):
    """One row per key remains of batches that repeat."""
    return _complete(spark, _repeated_batches(spark, sf_dir))


# --- streaming ---------------------------------------------------------------


def _arrivals(spark, sf_dir, copies: int = 1) -> str:
    rows = views.shard_rows(spark, sf_dir).select(*SHARD_META.names)
    source = scratch_path(spark, "incoming")
    for _ in range(copies):
        rows.repartition(8, "key").write.mode("append").parquet(source)
    return source


def _ingested(spark, source: str) -> DataFrame:
    rows = stream_ingest(
        spark,
        source,
        scratch_path(spark, "ingested"),
        scratch_path(spark, "progress"),
        files_per_trigger=4,
        transform=lambda rows: success_captions(rows).select("key", "caption"),
    )
    return rows.select("key", "caption")


def ingest(spark, sf_dir):
    return _ingested(spark, _arrivals(spark, sf_dir))


def ingest_once_by_key(spark, sf_dir):
    source = _arrivals(spark, sf_dir, copies=2)
    rows = stream_ingest(
        spark,
        source,
        scratch_path(spark, "ingested"),
        scratch_path(spark, "progress"),
        files_per_trigger=6,
    )
    return rows.select("key", "url", "status", "sha256")


#: Of queries on files written before: what writes them, and the query itself.
ON_FILES = {
    "final_dedupe": (_repeated_batches, _complete),
    "unify_shards": (_write_shards, _unified),
    "stream_ingest": (_arrivals, _ingested),
}

QUERIES = {
    "source_projection": source_projection,
    "assign_keys": assign_keys,
    "assign_keys_far": assign_keys_far,
    "fetch_status": fetch_status,
    "fetch_files": fetch_files,
    "fetch_incremental": fetch_incremental,
    "payload_hash": payload_hash,
    "payload_sizes": payload_sizes,
    "discover_shards": discover_shards,
    "list_assets": list_assets,
    "list_shard_assets": list_shard_assets,
    "list_assets_any_dir": list_assets_any_dir,
    "limit_assets": limit_assets,
    "parse_path": parse_path,
    "unify_shards": unify,
    "unify_audit": unify_audit,
    "success_captions": success,
    "shard_status": status_by_shard,
    "key_caption_last": key_caption_last,
    "ext_priority": ext_priority,
    "manifest_validated": manifest_validated,
    "csv_round_trip": csv_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "manifest_listing": manifest_listing,
    "manifest_sidecar": manifest_sidecar,
    "manifest_counters": manifest_counters,
    "manifest_file_counters": manifest_file_counters,
    "metadata_enrich": metadata_enrich,
    "enrich_rejects": enrich_rejects,
    "captioned_rows": captioned_rows,
    "url_dataset": url_dataset,
    "sidecar_caption": sidecar_captions,
    "validate_html": validate_html,
    "validate_split": validate_split,
    "validate_counts": validate_counts,
    "valid_keys": valid_keys,
    "corrupt_log": corrupt_log,
    "progress_counts": progress_counts,
    "validate_content": validate_content,
    "validate_decode": validate_decode,
    "delete_plan_all": delete_plan_all,
    "delete_plan_pair": delete_plan_pair,
    "checkpoint_keys": checkpoint_keys,
    "checkpoint_files": checkpoint_files,
    "pending": pending,
    "skip_counts": skip_counts,
    "batch_assign": batch_assign,
    "batch_names": batch_names,
    "publish_manifest": publish_manifest,
    "publish_complete": publish_complete,
    "rejected_rows": rejected_rows,
    "final_dedupe": final_dedupe,
    "caption_rows_udf": caption_rows_udf,
    "caption_error_empty": caption_error_empty,
    "caption_reject": caption_reject,
    "stream_ingest": ingest,
    "stream_dedupe": ingest_once_by_key,
}
