"""Mix sources to target weights by Pfair scheduling; rows meet built-in expressions only.

The rows of a source are dealt, in a fixed pseudo-random order, into blocks. Block j (from 0) of a source of weight w
may not start before slot floor(j / w) and must be done by slot ceil((j + 1) / w); of the blocks that may start, the one
with the earliest deadline takes the slot. So after t slots a source has had w * t blocks give or take less than one,
for as long as it has blocks; a slot in which no block may start, since sources have run out, stays empty.

The windows come from the target weights themselves (as whole parts of 2**62). The driver works the slots out from one row per
source, a stretch at a time, each written as a table before the next: its steps are as many as blocks, whatever the
weights, and its memory is that of the sources and a stretch.

With a ``frame``, weights are rounded to parts of a frame of slots, the frame alone is worked out and repeats, and a block finds
its slot by arithmetic; slots of a source that has run out stay empty and all other slots keep their place. The bound then holds for
the rounded weights only: against the target weights the deviation grows with the rows. The SQL of the query says this form.

Ranks within a source come from counts per source and sub-bucket of the order, so that no window holds a whole source.

Defined results: a null source is a source of its own; rows of a null id are ordered by nothing else and so come first
in any order; rows that repeat an id each have a place; a source without a named weight gets the smallest one;
an empty table gives no rows; other columns are untouched, but for block, slot and place, which are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediacurate.session import scratch_path

BLOCK = 8
FRAME = 1000
#: Parts that target weights are given in, and blocks worked out at a time, by the schedule without a frame.
PARTS = 1 << 62
STRETCH = 1_000_000
#: Sub-buckets of a source are the values of so many leading hexadecimal digits of the order.
DIGITS = 3

_SOURCE, _ORDER, _SUB = "_source", "_order", "_sub"


def _named(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit("null"))


def _weight(weights: dict[str, float] | None, temperature: float) -> Column:
    """Without ``weights`` a source weighs its rows to the power of ``temperature``."""
    if weights is None:
        return F.pow(F.col("_rows").cast("double"), F.lit(float(temperature)))
    least = min(weights.values(), default=1.0)
    given = [F.when(F.col(_SOURCE) == f"={name}", F.lit(float(w))) for name, w in weights.items()]
    return F.coalesce(*given, F.lit(float(least)))


def source_shares(
    sizes: DataFrame, weights: dict[str, float] | None, temperature: float, frame: int
) -> DataFrame:
    """Slots of a frame per source: one each, the rest by weight and largest remainder.

    ``sizes`` has one row per source (_source, _rows). Without ``weights`` a source weighs its rows to the power of
    ``temperature``. The frame is ``frame`` slots for each hundred sources begun.
    """
    weight = _weight(weights, temperature)
    every = Window.partitionBy()  # one row per source
    by_name = Window.orderBy(_SOURCE)
    by_rest = Window.orderBy(F.col("_rest").desc(), F.col(_SOURCE))
    weighed = sizes.select(_SOURCE, weight.alias("_weight")).withColumns(
        {
            "_frame": F.ceil(F.count("*").over(every) / F.lit(100)).cast("bigint") * F.lit(frame),
            "_sum": F.sum("_weight").over(every),
            "_n": F.count("*").over(every),
        }
    )
    wanted = (F.col("_frame") - F.col("_n")) * F.col("_weight") / F.col("_sum")
    floored = weighed.withColumns({"_whole": F.floor(wanted), "_rest": wanted - F.floor(wanted)})
    spare = F.col("_frame") - F.col("_n") - F.sum("_whole").over(every)
    return floored.withColumn("_spare", spare).select(
        _SOURCE,
        "_frame",
        (F.row_number().over(by_name) - 1).alias("_number"),
        (
            1 + F.col("_whole") + F.when(F.row_number().over(by_rest) <= F.col("_spare"), 1).otherwise(0)
        ).cast("bigint").alias("_slots"),
    )


def frame_schedule(shares: DataFrame) -> DataFrame:
    """Earliest deadline first over one frame: (_number, _turn, _slot), one row per slot."""
    state = F.struct(
        F.transform("_all", lambda s: F.lit(0).cast("bigint")).alias("served"), F.array().cast("array<int>").alias("picked")
    )

    def step(now: Column, slot: Column) -> Column:
        def window(share: Column, i: Column) -> Column:
            had = F.get(now["served"], i)
            deadline = F.ceil((had + 1) * F.col("_frame") / share).cast("bigint")
            released = had * F.col("_frame") < (slot + 1) * share
            return F.when(released, F.struct(deadline.alias("deadline"), i.alias("i")))

        chosen = F.array_min(F.transform("_all", window))["i"]
        return F.struct(
            F.transform(now["served"], lambda n, i: n + F.when(i == chosen, 1).otherwise(0)).alias("served"),
            F.concat(now["picked"], F.array(chosen)).alias("picked"),
        )

    # One row, whose arrays have an entry per source and per slot of the frame.
    whole = (
        shares.groupBy()
        .agg(F.array_sort(F.collect_list(F.struct("_number", "_slots"))).alias("_pairs"), F.max("_frame").alias("_frame"))
        .filter("_frame IS NOT NULL")
        .select(F.col("_pairs._slots").alias("_all"), "_frame")
    )
    slots = F.sequence(F.lit(0).cast("bigint"), F.col("_frame") - 1)
    picked = whole.select(F.posexplode(F.aggregate(slots, state, step, lambda s: s["picked"])).alias("_slot", "_number"))
    turn = Window.partitionBy("_number").orderBy("_slot")
    return picked.select("_number", (F.row_number().over(turn) - 1).cast("bigint").alias("_turn"), "_slot")


def whole_schedule(parts: list[int], blocks: list[int], stretch: int = STRETCH) -> Iterator[np.ndarray]:
    """Earliest deadline first over all blocks: stretches of rows (number, block, slot).

    Source ``number`` has ``parts[number]`` of the sum of the parts and ``blocks[number]`` blocks. A source that has run
    out asks for no slots, so the others only gain by it.
    """
    whole, out = sum(parts), []
    waiting = [(0, n) for n, many in enumerate(blocks) if many]  # by the slot from which the next block may start
    heapify(waiting)
    ready: list[tuple[int, int]] = []  # by deadline
    served, slot = [0] * len(parts), 0
    while waiting or ready:
        if not ready:
            slot = max(slot, waiting[0][0])
        while waiting and waiting[0][0] <= slot:
            n = heappop(waiting)[1]
            heappush(ready, (-(-(served[n] + 1) * whole // parts[n]), n))
        n = heappop(ready)[1]
        out.append((n, served[n], slot))
        served[n] += 1
        slot += 1
        if served[n] < blocks[n]:
            heappush(waiting, (served[n] * whole // parts[n], n))
        if len(out) == stretch:
            yield np.array(out, np.int64)
            out = []
    if out:
        yield np.array(out, np.int64)


def _scheduled(sizes: DataFrame, weights: dict[str, float] | None, temperature: float, block: int) -> DataFrame:
    """(_source, block, slot) of all blocks, as a table in the checkpoint folder."""
    spark = sizes.sparkSession
    # One row per source.
    given = sorted(tuple(r) for r in sizes.select(_SOURCE, "_rows", _weight(weights, temperature)).collect())
    total = sum(w for *_, w in given)
    parts = [max(1, round(w / total * PARTS)) for *_, w in given]
    path = scratch_path(spark, "schedule")
    schema = f"{_SOURCE} string, block bigint, slot bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    names = pa.array([name for name, *_ in given], pa.string())
    for rows in whole_schedule(parts, [-(-n // block) for _, n, _ in given]):
        made = [names.take(pa.array(rows[:, 0])), *(pa.array(rows[:, i].copy()) for i in (1, 2))]
        table = pa.Table.from_arrays(made, names=[_SOURCE, "block", "slot"])
        spark.createDataFrame(table).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = 0.5,
    block: int = BLOCK,
    frame: int | None = None,
    source: str = "source",
    doc_id: str = "doc_id",
    seed: str = "",
) -> DataFrame:
    """``docs`` with ``block`` (number within the source), ``slot`` (of the whole mix) and ``place`` (within the block).

    Sorted by slot and place, any stretch of the rows has the sources in the wanted proportions. With a ``frame`` these are
    rounded to parts of it.
    """
    # Rows travel as one struct, so that their columns cannot meet the names used here.
    order = F.coalesce(F.md5(F.concat(F.lit(seed), F.col(doc_id).cast("string")).cast("binary")), F.lit(""))
    keyed = [_named(F.col(source)).alias(_SOURCE), F.substring(order, 1, DIGITS).alias(_SUB)]
    rows = docs.select(F.struct("*").alias("_row"), *keyed, order.alias(_ORDER))
    slim = docs.select(*keyed)
    counts = slim.groupBy(_SOURCE, _SUB).agg(F.count("*").alias("_in_sub"))
    sizes = counts.groupBy(_SOURCE).agg(F.sum("_in_sub").alias("_rows"))
    earlier = Window.partitionBy(_SOURCE).orderBy(_SUB).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_SOURCE, _SUB, F.coalesce(F.sum("_in_sub").over(earlier), F.lit(0)).alias("_before"))
    if frame is not None:
        shares = source_shares(sizes, weights, temperature, frame)
        offsets = offsets.join(shares, _SOURCE)

    own = Window.partitionBy(_SOURCE, _SUB).orderBy(_ORDER)
    ranked = rows.withColumn("_own", F.row_number().over(own) - 1).join(offsets, [_SOURCE, _SUB])
    rank = F.col("_before") + F.col("_own")
    placed = ranked.withColumns(
        {"block": F.floor(rank / F.lit(block)).cast("bigint"), "place": (rank % F.lit(block)).cast("int")}
    )
    if frame is None:
        slotted = placed.join(_scheduled(sizes, weights, temperature, block), [_SOURCE, "block"])
    else:
        # The frame has a bounded number of rows: ``frame`` for each hundred sources.
        turned = placed.withColumn("_turn", F.col("block") % F.col("_slots"))
        slot = F.floor(F.col("block") / F.col("_slots")).cast("bigint") * F.col("_frame") + F.col("_slot")
        slotted = turned.join(F.broadcast(frame_schedule(shares)), ["_number", "_turn"]).withColumn("slot", slot)
    return slotted.select(
        *(F.col("_row")[c].alias(c) for c in docs.columns if c not in ("block", "slot", "place")),
        "block",
        "slot",
        "place",
    )
