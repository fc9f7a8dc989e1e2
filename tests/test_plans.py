"""What the plans must and must not do at scale."""

import re
from pathlib import Path

import pytest
import __spark_entry__ as contract

from mediacurate.operators import manifest, metadata
from mediacurate.plans import views
from mediacurate.sources import assets as listing
from mediacurate.sources.shards import success_captions

# Queries whose single-partition step works on counts: one row per partition,
# per bucket or per table, never on rows.
COUNTS_ONLY = {
    "assign_keys",
    "assign_keys_far",
    "batch_assign",
    "batch_names",
    "manifest_counters",
    "manifest_file_counters",
    "progress_counts",
    "skip_counts",
}
PACKAGE = Path(manifest.__file__).resolve().parent.parent


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LAZY = [
    "assign_keys", "assign_keys_far", "batch_assign", "captioned_rows", "checkpoint_keys", "delete_plan_all", "discover_shards",
    "ext_priority", "fetch_incremental", "fetch_status", "key_caption_last", "list_assets", "manifest_counters",
    "manifest_listing", "manifest_sidecar", "manifest_validated", "metadata_enrich", "pending", "progress_counts",
    "shard_status", "skip_counts", "valid_keys", "validate_content", "validate_counts",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_row_passes_through_one_task(spark, sf_dir, no_broadcast, name):
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name not in COUNTS_ONLY:
        assert "SinglePartition" not in plan
    else:
        for step in re.findall(r"Exchange SinglePartition[^\n]*\n[^\n]*", plan):
            # What is gathered has been aggregated in the stage before.
            assert "Aggregate" in step


@pytest.mark.parametrize("name", ["metadata_enrich", "key_caption_last", "captioned_rows", "manifest_counters", "final_dedupe"])
def test_the_last_row_is_found_by_numbers(spark, sf_dir, no_broadcast, name):
    """Whole records are not sorted into aggregates; a number per key is, and only keys with copies meet their rows."""
    plan = plan_of(contract.queries()[name](spark, sf_dir))
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "max(" in plan


def test_pending_is_an_anti_join(spark, sf_dir, no_broadcast):
    assert "LeftAnti" in plan_of(contract.queries()["pending"](spark, sf_dir))


def test_status_filter_reaches_the_scan(spark, sf_dir, tmp_path):
    views.shard_rows(spark, sf_dir).write.parquet(str(tmp_path / "s"))
    plan = plan_of(success_captions(spark.read.parquet(str(tmp_path / "s"))).select("key", "caption"))
    assert "EqualTo(status,success)" in plan
    assert "ReadSchema: struct<key:string,caption:string,status:string>" in plan


def test_counters_leave_captions_behind(spark, sf_dir, no_broadcast):
    """Caption texts end at the flag; only keys and flags are exchanged for the counters."""
    captions = spark.createDataFrame([("a", "x")], "key string, caption string")
    keys = captions.select("key")
    files = listing.with_layout(spark.createDataFrame([("images/a/a.jpg",)], "path string"))
    plan = plan_of(manifest.validated_counters(keys, captions, files))
    moved = [line for line in plan.splitlines() if "Exchange" in line or "Join" in line]
    assert moved and not any("caption#" in line for line in moved)
    assert re.search(r"Project \[key#\d+, .*AS _told#", plan)


def test_enrich_joins_once_per_side(spark, sf_dir, no_broadcast):
    """Metadata and sidecars are joined on the same columns: the asset side moves once for both."""
    assets = listing.with_layout(views.asset_files(spark, sf_dir)).select("path", "shard", "key")
    meta, sidecars = (spark.createDataFrame([], s) for s in (views.shard_meta(spark, sf_dir).schema, "shard string, key string, body string"))
    plan = plan_of(metadata.enrich_marked(assets, meta, sidecars))
    assert plan.count("Exchange hashpartitioning(shard") == 3


def test_rules_of_the_code():
    """No local checkpoints, no data frames pulled to the driver, no RDDs, no cross joins."""
    for path in PACKAGE.rglob("*.py"):
        text = path.read_text()
        for banned in ("localCheckpoint", ".toPandas(", ".rdd", "crossJoin", ".cache(", "coalesce(1)", "sparkContext.parallelize"):
            assert banned not in text, f"{banned} in {path}"
