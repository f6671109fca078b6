"""Partitions, phases, sectors and groupings on the lap, as window expressions over one key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ringlake.functions import cyclic
from ringlake.operators import slices

#: Metres of braking and exit by severity 1..6.
BRAKE_M = [250.0, 180.0, 120.0, 70.0, 35.0, 0.0]
EXIT_M = [170.0, 130.0, 100.0, 70.0, 45.0, 0.0]
DEFAULT_SCALE = 3


def cumulative_partition(rows: DataFrame, key: list[str], order: list[str], length: str) -> DataFrame:
    """Adds ``number, start, end``: each row's share of its key's total length, 0 and 1 forced at the ends."""
    o = W.partitionBy(*key).orderBy(*order)
    upto = F.sum(length).over(o.rowsBetween(W.unboundedPreceding, 0))
    total = F.nullif(F.sum(length).over(W.partitionBy(*key)), F.lit(0.0))
    number, count = F.row_number().over(o), F.count("*").over(W.partitionBy(*key))
    return rows.withColumn("number", number).withColumn("start", F.when(number == 1, 0.0).otherwise((upto - F.col(length)) / total)).withColumn("end", F.when(number == count, 1.0).otherwise(upto / total))


def between_boundaries(rows: DataFrame, bounds: str) -> DataFrame:
    """Explodes an array of boundaries to consecutive ``number, start, end``."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(bounds) - 1), lambda i: F.struct(i.alias("number"), F.element_at(bounds, i).alias("start"), F.element_at(bounds, i + 1).alias("end")))
    return rows.where(F.size(bounds) > 1).select("*", F.inline(pairs))


def three_sectors(marks: DataFrame, key: list[str], marker: str) -> DataFrame:
    """``b1, b2`` of S1, S2, S3: the internal marks (0.02 to 0.98) nearest a third and, past ``b1 + 0.05``, two thirds."""
    m = F.round(F.col(marker), 5)
    inner = marks.groupBy(*key).agg(F.array_sort(F.collect_set(F.when((F.col(marker) > 0.02) & (F.col(marker) < 0.98), m))).alias("_m"))

    def nearest(xs: Column, goal: float) -> Column:
        return F.array_min(F.transform(xs, lambda x: F.struct(F.abs(x - goal).alias("d"), x.alias("x"))))["x"]

    b1 = F.when(F.size("_m") >= 2, nearest(F.col("_m"), 1 / 3)).when(F.size("_m") == 1, F.col("_m")[0]).otherwise(F.lit(1 / 3))
    s = inner.withColumn("b1", b1)
    b2 = F.when(F.size("_m") >= 2, F.coalesce(nearest(F.filter("_m", lambda x: x > F.col("b1") + 0.05), 2 / 3), (F.col("b1") + 1.0) / 2)).when(F.size("_m") == 1, (F.col("b1") + 1.0) / 2).otherwise(F.lit(2 / 3))
    return s.withColumn("b2", b2).select(*key, F.round("b1", 5).alias("b1"), F.round("b2", 5).alias("b2"))


def sector_rows(bounds: DataFrame) -> DataFrame:
    """One row each of S1, S2 and S3."""
    one = lambda n, a, b: F.struct(F.lit(n).alias("sector"), a.alias("start"), b.alias("end"))
    return bounds.select("*", F.inline(F.array(one("S1", F.lit(0.0), F.col("b1")), one("S2", F.col("b1"), F.col("b2")), one("S3", F.col("b2"), F.lit(1.0))))).drop("b1", "b2")


def phases(corners: DataFrame, key: list[str], marker: str, number: str, scale: str, lap_m: str, group: str, digits: int | None = 5) -> DataFrame:
    """Adds ``start, apex, end, brakes`` (fractions, rounded to ``digits`` places unless None): braking and exit distances by severity, split with a cyclic neighbour
    where they overlap or where both corners belong to one non-empty group. Rows without marker or lap length go."""
    c = corners.where(F.col(marker).isNotNull() & (F.col(lap_m) > 0))
    at = F.coalesce(F.nullif(scale, F.lit(0)), F.lit(DEFAULT_SCALE))
    table = lambda v, other: F.when(at.between(1, 6), F.element_at(F.array(*map(F.lit, v)), at.cast("int"))).otherwise(other)
    c = c.withColumn("apex", cyclic.frac(F.col(marker))).withColumn("_brake_m", table(BRAKE_M, 120.0)).withColumn("_b", F.col("_brake_m") / F.col(lap_m)).withColumn("_x", table(EXIT_M, 100.0) / F.col(lap_m))
    o = W.partitionBy(*key).orderBy(marker, number)
    whole = o.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    me = F.struct("apex", "_b", "_x", F.col(group).alias("g"))
    c = c.withColumn("_n", F.coalesce(F.lead(me).over(o), F.first(me).over(whole))).withColumn("_p", F.coalesce(F.lag(me).over(o), F.last(me).over(whole)))

    def border(a: Column, b: Column) -> Column:
        """Where the two neighbours meet; null where each keeps its own end."""
        room, want = cyclic.gap(a["apex"], b["apex"]), a["_x"] + b["_b"]
        meet = (want > room) | F.coalesce((a["g"] == b["g"]) & (a["g"] != ""), F.lit(False))
        return F.when(meet, cyclic.frac(a["apex"] + room * F.when(want > 0, a["_x"] / want).otherwise(0.5)))

    own = F.struct("apex", "_b", "_x", F.col(group).alias("g"))
    end = F.coalesce(border(own, F.col("_n")), cyclic.frac(F.col("apex") + F.col("_x")))
    start = F.coalesce(border(F.col("_p"), own), cyclic.frac(F.col("apex") - F.col("_b")))
    fixed = (lambda x: x) if digits is None else (lambda x: F.round(x, digits))
    return c.withColumn("start", fixed(start)).withColumn("end", fixed(end)).withColumn("apex", fixed(F.col("apex"))).withColumn("brakes", F.col("_brake_m") > 0).drop("_b", "_x", "_n", "_p", "_brake_m")


def usable_bounds(rows: DataFrame, key: list[str], lap_m: str, marker: str = "marker", start: str = "start", end: str = "end") -> DataFrame:
    """``start, end`` of a group: its outermost bounds, or 15 m about the mean marker where those are empty or wrap."""
    g = rows.groupBy(*key).agg(F.min(F.coalesce(start, marker)).alias("_a"), F.max(F.coalesce(end, marker)).alias("_b"), F.avg(marker).alias("_m"), F.max(lap_m).alias("_l"))
    half = F.coalesce(F.lit(15.0) / F.nullif("_l", F.lit(0.0)), F.lit(0.001))
    ok = F.coalesce(F.col("_a") < F.col("_b"), F.lit(False))
    return g.where(ok | F.col("_m").isNotNull()).select(*key, F.when(ok, F.col("_a")).otherwise(F.greatest(F.lit(0.0), F.col("_m") - half)).alias("start"), F.when(ok, F.col("_b")).otherwise(F.least(F.lit(1.0), F.col("_m") + half)).alias("end"))


def equal_runs(rows: DataFrame, key: list[str], order: list[str], value: str, joins: Column | None = None) -> DataFrame:
    """Adds ``run``: consecutive rows of equal value (null joins nothing); ``joins`` tells which rows may be part of a run."""
    o = W.partitionBy(*key).orderBy(*order)
    may = F.lit(True) if joins is None else joins
    same = F.coalesce((F.col(value) == F.lag(value).over(o)) & may & F.lag(may).over(o), F.lit(False))
    return rows.withColumn("_new", (~same).cast("int")).withColumn("run", F.sum("_new").over(o.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def complexes(corners: DataFrame, key: list[str], number: str, group: str, label: str, named: str, scale: str) -> DataFrame:
    """``label, members, first_number`` of each corner group: all corners of an explicit group; else a run of adjacent
    corners with one real name and no group. A single corner of severity 5 or 6 is left out."""
    ungrouped = F.coalesce(F.col(group), F.lit("")) == ""
    runs = equal_runs(corners, key, [number], label, ungrouped & F.col(named))
    gid = F.when(ungrouped, F.concat(F.lit("r"), F.col("run").cast("string"))).otherwise(F.concat(F.lit("g"), F.col(group)))
    g = runs.withColumn("_g", gid).groupBy(*key, "_g").agg(
        F.array_sort(F.collect_list(number)).alias("members"), F.min(number).alias("first_number"), F.max(scale).alias("_s"),
        F.min_by(F.when(ungrouped, F.col(label)).otherwise(F.col(group)), number).alias("label"))
    return g.where(~((F.size("members") == 1) & (F.coalesce("_s", F.lit(0)) >= 5))).drop("_g", "_s")


def suffixed_ids(rows: DataFrame, key: list[str], base: str, order: list[str], out: str = "id") -> DataFrame:
    """The base id, then the first free of ``-2``, ``-3`` ... for its repeats in order.

    Where no base of a key ends in such a suffix, the place among its repeats tells; the other keys fold over their rows.
    """
    n = F.row_number().over(W.partitionBy(*key, base).orderBy(*order))
    plain = F.when(n == 1, F.col(base)).otherwise(F.concat(F.col(base), F.lit("-"), n.cast("string")))
    marked = rows.withColumn("_plain", plain).withColumn("_chained", F.max(F.col(base).rlike("-[0-9]+$")).over(W.partitionBy(*key)))
    items = marked.where("_chained").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(base).alias("_base"), F.struct(*rows.columns).alias("_row")))).alias("_all"))

    def put(used, x):
        free = F.filter(F.sequence(F.lit(2), F.size(used) + 2), lambda i: ~F.array_contains(used, F.concat(x["_base"], F.lit("-"), i.cast("string"))))
        return F.array_append(used, F.when(F.array_contains(used, x["_base"]), F.concat(x["_base"], F.lit("-"), free[0].cast("string"))).otherwise(x["_base"]))

    ids = F.aggregate("_all", F.array().cast("array<string>"), put)
    folded = items.select(F.inline(F.arrays_zip(F.col("_all._row").alias("r"), ids.alias("i")))).select("r.*", F.col("i").alias(out))
    return marked.where("not coalesce(_chained, false)").withColumn(out, F.col("_plain")).drop("_plain", "_chained").unionByName(folded.select(*rows.columns, out))


def merged_into(runs: DataFrame, groups: DataFrame, key: list[str], members: str = "members") -> DataFrame:
    """Runs with ``merged``: whether all their members are in one group of the same key."""
    g = groups.select(*key, F.col(members).alias("_g"))
    own = F.array_sort(F.col(members))
    hit = runs.withColumn("_id", own).join(g, key).where(F.size(F.array_except(F.col(members), F.col("_g"))) == 0).select(*key, "_id").distinct().withColumn("merged", F.lit(True))
    return runs.withColumn("_id", own).join(hit, [*key, "_id"], "left").withColumn("merged", F.coalesce("merged", F.lit(False))).drop("_id")


def spread_out(labels: DataFrame, key: list[str], at: str, order: list[str], apart: float = 32.0, most: float | None = None) -> DataFrame:
    """``at`` pushed up so that neighbours of one key stand ``apart``: the greatest of each predecessor's place plus the steps between,
    which a running maximum gives; held to ``most`` at the end."""
    o = W.partitionBy(*key).orderBy(at, *order)
    moved = labels.withColumn("_i", F.row_number().over(o)).withColumn("_free", F.col(at) - F.col("_i") * apart).withColumn("placed", F.max("_free").over(o.rowsBetween(W.unboundedPreceding, 0)) + F.col("_i") * apart)
    return moved.withColumn("placed", F.least(F.col("placed"), F.lit(most)) if most is not None else F.col("placed")).drop("_i", "_free")


def partition_faults(ranges: DataFrame, key: list[str], start: str = "start", end: str = "end", tolerance: float = 1e-6) -> DataFrame:
    """Keys whose ranges do not cover 0..1 without gap or overlap: ``starts_late, ends_early, gaps, overlaps``."""
    o = W.partitionBy(*key).orderBy(start, end)
    r = ranges.withColumn("_d", F.col(start) - F.lag(end).over(o))
    g = r.groupBy(*key).agg((F.abs(F.min(start)) > tolerance).alias("starts_late"), (F.abs(F.max(end) - 1.0) > tolerance).alias("ends_early"), F.count_if(F.col("_d") > tolerance).alias("gaps"), F.count_if(F.col("_d") < -tolerance).alias("overlaps"))
    return g.where("starts_late or ends_early or gaps > 0 or overlaps > 0")


def inversions(rows: DataFrame, key: list[str], a: str, b: str, least: int = 3, first: list[str] | None = None, block: int = 4096) -> DataFrame:
    """``n, inversions``: discordant pairs of two orders over each key with at least ``least`` rows. With ``first``, an order of the rows, ``b`` is a
    fraction of a lap and counts from that of the key's first row on.

    Merge counting: rows get their ranks in both orders; a pair differs first at one bit of its ``b`` ranks, so for each bit, rows
    that share the higher ones are counted where a 1 stands before a 0 in the order of ``a``. Blocks of ``a`` ranks are
    counted apart and then against what stands in earlier blocks, so no task sorts a large key. Equal values are no
    inversion, null ones take no part in pairs, and repeated rows each count.
    """
    sized = rows.groupBy(*key).agg(F.count("*").alias("n"), *([F.min_by(b, F.struct(*first)).alias("_from")] if first else [])).where(F.col("n") >= least)
    x = rows.select(*key, F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")).join(sized, key)
    x = x.withColumn("_b", cyclic.frac(F.col("_b") - F.col("_from") + 1.0)).drop("_from") if first else x
    x = slices.ranked(slices.ranked(x.where("_a is not null and _b is not null"), key, "_a", "_ra"), key, "_b", "_rb")
    bits = F.greatest(F.lit(1), F.ceil(F.log2(F.col("n").cast("double"))).cast("int"))
    top, total = sized.agg(F.max("n"), F.sum("n")).first()
    x = x.withColumn("_bit", F.explode(F.sequence(F.lit(0), bits - 1)))
    high, one = F.expr("shiftright(_rb, _bit + 1)"), F.expr("shiftright(_rb, _bit) & 1L")
    x = x.select(*key, "_bit", high.alias("_high"), one.alias("_one"), "_ra", F.floor(F.col("_ra") / block).alias("_block"))
    same = [*key, "_bit", "_high"]
    if (top or 0) > slices.SLICE:  # a row for each bit: more parts than adaptive execution would make
        x = x.repartition(math.ceil(total * math.log2(top) / 1_000_000), *same, "_block")
    earlier = F.coalesce(F.sum("_one").over(W.partitionBy(*same, "_block").orderBy("_ra").rangeBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = x.withColumn("_before", earlier).groupBy(*same, "_block").agg(F.sum(F.when(F.col("_one") == 0, F.col("_before")).otherwise(F.lit(0))).alias("_inner"), F.sum("_one").alias("_ones"), F.count_if(F.col("_one") == 0).alias("_zeros"))
    ahead = F.coalesce(F.sum("_ones").over(W.partitionBy(*same).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    found = parts.withColumn("_ahead", ahead).groupBy(*key).agg(F.sum(F.col("_inner") + F.col("_zeros") * F.col("_ahead")).alias("inversions"))
    return sized.select(*key, "n").join(found, key, "left").select(*key, "n", F.coalesce("inversions", F.lit(0)).cast("long").alias("inversions"))
