"""Mixing sources to target weights: a curriculum whose weights change over the training run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trialmart.llm.common import stored

#: A schedule is a piecewise-linear weight over training time 0 to 1: (time, weight) knots.
Schedule = tuple[tuple[float, float], ...]
#: Sources in order take these schedules in turn; they integrate to 5, 2 and 1.
SCHEDULES: tuple[Schedule, ...] = (
    ((0.0, 7.5), (1.0, 2.5)),
    ((0.0, 2.0), (1.0, 2.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)
#: No source is repeated more often.
CAP = 3

WORD = r"[^\x20\x09-\x0D]+"


def total_weight(schedule: Schedule) -> float:
    """Integral of a schedule over the training run."""
    return sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False))


def training_time(demand: Column, schedule: Schedule) -> Column:
    """When a source has met this share (0 to 1) of its demand: the inverse of the integral."""
    total = total_weight(schedule)
    area, pieces = 0.0, []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        slope, here = (w1 - w0) / (t1 - t0), (t1 - t0) * (w0 + w1) / 2
        rest = F.greatest(demand * total - area, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * rest, F.lit(0.0)))
        spent = F.when(rest == 0, F.lit(0.0)).otherwise(2 * rest / (F.lit(w0) + root))
        area += here
        pieces.append((area, F.least(F.lit(t0) + spent, F.lit(t1))))
    out = pieces[-1][1]
    for bound, when in reversed(pieces[:-1]):
        out = F.when(demand * total < bound, when).otherwise(out)
    return out


def source_targets(totals: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """Targets of sources: totals (source, source_size) plus place, weight and target.

    All targets add up to all sizes, in proportion to weight, but none is above cap times its
    source's size; what is cut is shared again by weight. In order of size per weight, the
    sources before some place are at their cap, and the others share the rest at one rate. The
    table has one row per source, so its windows run in one task.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("place", (F.row_number().over(order) - 1) % len(schedules))
    weights = F.array(*[F.lit(total_weight(s)) for s in schedules])
    ranked = ranked.withColumn("weight", F.get(weights, F.col("place")))
    full = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("source_size").over(full.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(full.rowsBetween(0, W.unboundedFollowing))
    all_words = F.sum("source_size").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    rate = (all_words - cap * before) / rest
    ranked = ranked.withColumn("rate", F.when(rate * F.col("weight") <= cap * F.col("source_size"), rate))
    rate = F.max("rate").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    target = F.least((cap * F.col("source_size")).cast("double"), F.coalesce(rate, F.lit(0.0)) * F.col("weight"))
    return ranked.select("source", "source_size", "place", "weight", target.alias("target"))


def assign(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, cap: int = CAP, carry: list[str] | None = None) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, copies, taken and
    positions (the training times of its copies), and the columns in `carry`.

    size is the number of words (runs without ASCII white space; null text: 0). A source is taken
    whole as often as its target allows, and once more the documents that come first in the order
    of the md5 of their id (then id and size), until the target is met within half a document.
    A copy is due when its source's demand, the integral of its schedule, has reached the words
    taken before it. Empty documents take nothing but keep a place. Rows are not merged: repeated
    rows and null ids count one by one; a null source is a source of its own.

    Running sums are taken within 256 slices per source and added to the sums of the slices
    before, so a source that holds most rows is spread over many tasks.
    """
    carry = carry or []
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    own = [F.col(c).alias(f"_carried_{i}") for i, c in enumerate(carry)]
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"),
        F.substring(key, 1, 2).alias("slice"),
        *own,
    )
    light = stored(sized.select("doc_id", "source", "size", "key", "slice"), "sizes")
    sized = sized if carry else light
    slices = light.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    totals = light.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(totals, schedules, cap).withColumnRenamed("source", "_source")
    facts = slices.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "words")
    facts = stored(facts, "slices").select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "ahead", "source_size", "place", "target")
    inside = W.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)

    def placed(rows: DataFrame) -> DataFrame:
        """Adds the words before a document in its source, whole rounds, and words left after those."""
        rows = rows.withColumn("c", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        rows = rows.join(facts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("slice") == F.col("_slice")))
        rows = rows.withColumn("before", F.col("c") + F.col("ahead")).withColumn("whole", whole)
        return rows.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))

    fits = (F.col("left") > 0) & (F.col("before") + F.col("size") <= F.col("left"))
    first = stored(placed(light).select("source", "size", "before", "left", fits.alias("fits")), "placed")
    gaps = first.groupBy("source").agg((F.max("left") - F.sum(F.when(F.col("fits"), F.col("size")).otherwise(0))).alias("gap"))
    gaps = gaps.select(F.col("source").alias("_source"), "gap")
    late = first.where("NOT fits AND size > 0").join(gaps, F.col("source").eqNullSafe(F.col("_source")))
    miss = F.abs(F.col("gap") - F.col("size"))
    late = late.where(miss < F.col("gap")).groupBy("source").agg(F.min_by("before", F.struct(miss, "before")).alias("filler"))
    fillers = stored(late, "fillers").select(F.col("source").alias("_source2"), "filler")
    taken = placed(sized).join(fillers, F.col("source").eqNullSafe(F.col("_source2")), "left")
    filler = (F.col("size") > 0) & F.coalesce(F.col("before") == F.col("filler"), F.lit(False)) & ~fits
    copies = (F.col("whole") + (fits | filler).cast("int")).cast("int")

    def due(j: Column) -> Column:
        share = F.least((j * F.col("source_size") + F.col("before")) / F.col("target"), F.lit(1.0))
        out = training_time(share, schedules[-1])
        for k, schedule in enumerate(schedules[:-1]):
            out = F.when(F.col("place") == k, training_time(share, schedule)).otherwise(out)
        return out

    taken = taken.withColumn("copies", copies)
    turns = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>"))
    return taken.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
        F.transform(turns, due).alias("positions"),
        *[F.col(f"_carried_{i}").alias(f"_carried_{i}") for i in range(len(carry))],
    )


def by_first_position(assigned: DataFrame) -> DataFrame:
    """Documents range-sorted by the training time of their first copy, those not taken last."""
    first = F.get("positions", F.lit(0))
    return assigned.orderBy(first.asc_nulls_last(), "doc_id", "size")


def training_order(docs: DataFrame, schedules: tuple[Schedule, ...] = SCHEDULES, cap: int = CAP) -> DataFrame:
    """The mix itself: the rows of the documents it takes, as often as it takes them, range-sorted by
    position. Columns are those of the input."""
    carry = docs.columns
    mixed = assign(docs, schedules, cap, carry)
    mixed = mixed.withColumn("_position", F.explode("positions")).orderBy("_position", "doc_id")
    return mixed.select(*[F.col(f"_carried_{i}").alias(c) for i, c in enumerate(carry)])
