"""Ordered operators that stay distributed when one key holds a large part of the rows.

A window over one hot key is one task. Two ways around it are used here:

* places from a sample cut the series of a key with many rows into ranges, and the first and last row
  of each range supply the values that cross its edge;
* a range partitioning on the whole sort key, where each range knows how many rows precede it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from siltbed.scratch import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


#: Sampled rows for each shuffle partition; a key with twice as many is cut into ranges.
_SAMPLED = 20


def _hot_cuts(rows: DataFrame, key: str, order: Column) -> dict:
    """Key -> places (values of ``order``) that cut its series, for keys that are more than a task's share.

    A sample of ``_SAMPLED`` rows for each shuffle partition; every key of at least twice as many sampled
    rows gets a cut after each ``_SAMPLED``. So there are fewer cuts than partitions, whatever the data.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = rows.select(F.col(key).alias("k"), order.alias("o")).orderBy(F.rand(11)).limit(_SAMPLED * parts)
    sampled: dict = {}
    for r in picked.collect():
        sampled.setdefault(r["k"], []).append(r["o"])
    return {k: sorted(o, key=_nulls_first)[_SAMPLED::_SAMPLED] for k, o in sampled.items() if len(o) >= 2 * _SAMPLED}


def _nulls_first(place: tuple) -> tuple:
    return tuple((x is not None, x) for x in place)


def _cells(rows: DataFrame, key: str, order: Column, cuts: dict) -> DataFrame:
    """``rows`` with ``_cell``, the number of the key's cuts at or before the row's place; -1 without cuts."""
    if not cuts:
        return rows.withColumn("_cell", F.lit(-1))
    place = rows.select(order.alias("o")).schema["o"].dataType
    fields = StructType([StructField("_hot", rows.schema[key].dataType), StructField("_cuts", ArrayType(place))])
    known = rows.sparkSession.createDataFrame([(k, [tuple(c) for c in v]) for k, v in cuts.items()], fields)
    # Fewer cuts than shuffle partitions in all.
    joined = rows.join(F.broadcast(known), F.col(key) == F.col("_hot"), "left")
    passed = F.size(F.filter("_cuts", lambda c: c <= order))
    return joined.withColumn("_cell", F.when(F.col("_cuts").isNull(), -1).otherwise(passed)).drop("_hot", "_cuts")


def _carried(cells: DataFrame, key: str, value: str, order: Column) -> DataFrame:
    """(key, cell, value before the cell, value after it) of the cut keys: one row per cell."""
    ends = (
        cells.where("_cell >= 0")
        .groupBy(F.col(key).alias("k"), "_cell")
        .agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
    )
    per_key: dict = {}
    for r in sorted(ends.collect(), key=lambda r: r["_cell"]):
        per_key.setdefault(r["k"], []).append(r)
    rows = [
        (k, r["_cell"], own[i - 1]["last"] if i else None, own[i + 1]["first"] if i + 1 < len(own) else None)
        for k, own in per_key.items()
        for i, r in enumerate(own)
    ]
    kind = cells.schema[value].dataType
    names = [("_hot", cells.schema[key].dataType), ("_hot_cell", IntegerType()), ("_before", kind), ("_after", kind)]
    return cells.sparkSession.createDataFrame(rows, StructType([StructField(n, t) for n, t in names]))


def neighbours(
    df: DataFrame,
    key: str,
    time: str,
    value: str,
    tie: Sequence[str] = (),
    prev_name: str = "prev_amt",
    next_name: str = "next_amt",
    sampled: DataFrame | None = None,
) -> DataFrame:
    """Previous and next ``value`` of the same key in the order of (time, tie).

    Rows without key or time have no place in a series and are left out. A key that holds more than a
    task's share of a sample is cut into ranges of its own order, each of which is sorted by a task of its
    own; the first and last row of each range, carried over by the driver (fewer than twice the shuffle
    partitions), join them. All rows are shuffled and sorted once; a table without such keys is not read
    again. The sample, and the edges if there are cuts, are read when this is called. ``sampled`` are rows
    to take the sample from, if ``df`` itself is costly to compute; any places cut rightly.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
    order = F.struct(time, *tie)
    cuts = _hot_cuts(rows if sampled is None else sampled, key, order)
    cells = _cells(rows, key, order, cuts)
    within = Window.partitionBy(key, "_cell").orderBy(time, *tie)
    # A struct is NULL only where the range has no such row; its field may be NULL where the value is.
    boxed = F.struct(F.col(value).alias("v"))
    sided = cells.withColumns({"_p": F.lag(boxed).over(within), "_n": F.lead(boxed).over(within)})
    before, after = F.col("_p.v"), F.col("_n.v")
    if cuts:
        edges = _carried(cells, key, value, order)
        sided = sided.join(F.broadcast(edges), (F.col(key) == F.col("_hot")) & (F.col("_cell") == F.col("_hot_cell")), "left")
        before = F.when(F.col("_p").isNull(), F.col("_before")).otherwise(before)
        after = F.when(F.col("_n").isNull(), F.col("_after")).otherwise(after)
    return sided.select(*df.columns, before.alias(prev_name), after.alias(next_name))


def _ranged(df: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """Rows range-partitioned and sorted on the whole key, each with its partition and position.

    Written once: range bounds come from a sample, so recomputing could move rows.
    """
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    staged = materialize(placed, label)
    return staged.select(
        *df.columns,
        F.shiftright("_id", _POSITION_BITS).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
    )


def _preceding(per_part: DataFrame, amount: str) -> DataFrame:
    """Sum of ``amount`` over the earlier ranges; one row per range, so one task is enough."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select(
        "_part", F.coalesce(F.sum(amount).over(earlier), F.lit(0)).alias("_before")
    )


def row_number_global(
    df: DataFrame, order: Sequence[str | Column], name: str = "row_num", start: int = 1
) -> DataFrame:
    """Consecutive numbers over the whole table in ``order`` (which should be unique)."""
    placed = _ranged(df, order, "numbered")
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per shuffle partition: the broadcast side cannot outgrow that setting.
    joined = placed.join(F.broadcast(_preceding(counts, "_n")), "_part")
    return joined.select(
        *df.columns, (F.col("_before") + F.col("_pos") + F.lit(start)).cast("bigint").alias(name)
    )


def row_number_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str | Column],
    name: str = "row_num",
) -> DataFrame:
    """Row number inside each group, with hot groups split over several ranges."""
    numbered = row_number_global(df, [*group, *order], "_global")
    starts = (
        numbered.groupBy(*group)
        .agg(F.min("_global").alias("_start"))
        .withColumnsRenamed({g: f"_key_{g}" for g in group})
    )
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_key_{g}"))
    position = (F.col("_global") - F.col("_start") + 1).cast("bigint").alias(name)
    return numbered.join(starts, same).select(*df.columns, position)


#: Buckets that a column's remaining values are counted in at once, and values that are fetched to end with.
_BUCKETS, _FETCHED = 1024, 4096


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], q: float = 0.5
) -> DataFrame:
    """Exact interpolated quantile of each numeric column, NULLs left out: (column, value).

    By selection: the values between two bounds are counted in buckets, and only the bucket that holds the
    rank is looked at again, between its own least and greatest value. Two or three passes of counting are
    usual; nothing is sorted, shuffled or stored, and the driver sees bucket counts only, and at the end at
    most a few thousand different values. NaN counts as greater than all numbers. Reads ``df`` when called.
    """
    spark = df.sparkSession
    number = {c: F.col(f"`{c}`").cast("double") for c in columns}
    found: dict[str, float] = {}
    open_: dict[str, tuple[float, float, int]] = {}  # bounds, and the values below them
    rank: dict[str, float] = {}
    finite = {c: ~F.isnan(v) & (F.abs(v) < float("inf")) for c, v in number.items()}
    sums = []
    for c, v in number.items():
        sums += [F.count(v), F.count_if(v == float("-inf")), F.count_if(finite[c]), F.count_if(F.isnan(v)), F.min(F.when(finite[c], v)), F.max(F.when(finite[c], v))]
    row = df.agg(*sums).first()
    for k, c in enumerate(columns):
        n, below, inside, nan, low, high = row[6 * k : 6 * k + 6]
        if n:
            rank[c] = q * (n - 1)
            parts = [(below, float("-inf")), (inside, None), (n - below - inside - nan, float("inf")), (nan, float("nan"))]
            if (at := _part_of(parts, int(rank[c]))) is None:
                open_[c] = (low, high, below)
            else:
                found[c] = at
    while open_:
        counts = _bucket_counts(df, number, open_)
        fetch = {}
        for c, rows in counts.items():
            before = open_[c][2]
            for r in sorted(rows, key=lambda r: r["low"]):
                if int(rank[c]) < before + r["n"]:
                    break
                before += r["n"]
            if r["low"] == r["high"]:
                found[c] = r["low"]
                del open_[c]
            else:
                open_[c] = (r["low"], r["high"], before)
                if r["n"] <= _FETCHED:
                    fetch[c] = open_.pop(c)
        if fetch:
            pairs = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.when(number[c].between(*b[:2]), number[c]).alias("v")) for c, b in fetch.items()])))
            each: dict[str, list] = {}
            for r in pairs.where("v is not null").groupBy("column", "v").agg(F.count("*").alias("n")).collect():
                each.setdefault(r["column"], []).append((r["v"], r["n"]))
            for c, values in each.items():
                before = fetch[c][2]
                for v, n in sorted(values):
                    if int(rank[c]) < before + n:
                        break
                    before += n
                found[c] = v
    rows = _interpolated(df, number, found, rank)
    return spark.createDataFrame(rows, "column STRING, value DOUBLE")


def _part_of(parts: list[tuple[int, float | None]], rank: int) -> float | None:
    """The value of the part that holds a rank; None where its values differ."""
    for n, value in parts:
        if rank < n:
            return value
        rank -= n
    raise ValueError("rank beyond the values")


def _bucket_counts(df: DataFrame, number: dict[str, Column], bounds: dict[str, tuple]) -> dict[str, list]:
    """Per column the count, least and greatest value of each bucket between its bounds: one pass."""
    cells = []
    for c, (low, high, _) in bounds.items():
        v, half = number[c], high / 2 - low / 2  # halves, so that the width stays a number
        part = F.least(F.floor((v / 2 - F.lit(low / 2)) / F.lit(half) * _BUCKETS), F.lit(_BUCKETS - 1)) if half else F.lit(0)
        inside = v.between(low, high)
        cells.append(F.struct(F.lit(c).alias("column"), F.when(inside, v).alias("v"), F.when(inside, part.cast("int")).alias("bucket")))
    rows = df.select(F.inline(F.array(*cells))).where("v is not null")
    counted = rows.groupBy("column", "bucket").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    out: dict[str, list] = {}
    for r in counted.collect():
        out.setdefault(r["column"], []).append(r)
    return out


def _interpolated(df: DataFrame, number: dict[str, Column], found: dict[str, float], rank: dict[str, float]) -> list[tuple]:
    """Between the value at the rank below and the next one, where the rank is no whole number."""
    between = [c for c in found if rank[c] != int(rank[c])]
    if between:
        # NaN is the greatest value for Spark's comparisons as well.
        row = df.agg(*[a for c in between for a in (F.count_if(number[c] <= found[c]), F.min(F.when(number[c] > found[c], number[c])))]).first()
        after = {c: (row[2 * i], row[2 * i + 1]) for i, c in enumerate(between)}
    out = []
    for c, low in found.items():
        value = low
        if c in between and after[c][0] <= int(rank[c]) + 1:
            value = low + (after[c][1] - low) * (rank[c] - int(rank[c]))
        out.append((c, float(value)))
    return out


def latest_by_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``order`` of each key.

    An aggregate, not a window: each task keeps one row per key before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    picked = df.groupBy(*key).agg(newest)
    return picked.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows: each task keeps ``k`` before the merge."""
    return df.orderBy(*order).limit(k)
