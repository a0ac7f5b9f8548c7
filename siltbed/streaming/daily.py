"""Per-day, per-device partial statistics of silver, kept by commit.

A row of the table ``daily`` holds what one device's readings of one day come to: count, mean, sum of
squared deviations and greatest reading, the number of broken ones, and the first and last reading. Such
rows add up to the statistics of any span, so gold is made from them; they say which days a repair has to
read, and what stands beside the first and last reading of a day.

``refresh`` looks at the folder names of silver's commits since its last run and computes the days anew that
these hold rows of, and no others. Each of its commits holds whole days; a reader sees the newest row of
each day and device. So the work follows what is new, and a lost run is simply run again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltbed.operators import versions

DAY = "p_eventdate"
SOURCE = "daily"


def partials(silver: DataFrame) -> DataFrame:
    """One row per day and device of ``silver``. Of several copies of a reading the greatest counts as the
    first or last; all copies count in the statistics."""
    value, time = F.col("heartrate"), F.col("eventtime")
    lowest, highest = F.lit(float("-inf")), F.lit(float("inf"))
    return silver.groupBy(DAY, "device_id").agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        (F.var_pop(value) * F.count(value)).alias("m2"),
        F.max(value).alias("greatest"),
        F.count_if(value < 0).alias("broken"),
        F.min_by(value, F.struct(time, F.coalesce(-value, highest))).alias("first"),
        F.max_by(value, F.struct(time, F.coalesce(value, lowest))).alias("last"),
    )


def refresh(spark: SparkSession, silver: str, daily: str, keys: list[str]) -> list[str | None]:
    """Bring ``daily`` up to silver's newest commit; the days that were computed anew."""
    done, now = versions.last_batch(spark, daily, SOURCE), versions.latest_version(spark, silver)
    after = -1 if done is None else done
    if now <= after:
        return []
    days = versions.changed_partitions(spark, silver, DAY, after, now)
    if days:
        rows = versions.read_as_of(spark, silver, now, keys, DAY, days)
        versions.commit(partials(rows), daily, SOURCE, now)
    return days


def current(spark: SparkSession, daily: str) -> DataFrame:
    """The newest row of each day and device. Silver loses no rows, so a day that was computed anew still has
    all of its devices."""
    commits = versions.read_commits(spark, daily)
    values = [c for c in commits.columns if c not in (DAY, "device_id", *versions.COMMIT_COLUMNS)]
    newest = commits.groupBy(DAY, "device_id").agg(F.max_by(F.struct(*values), "commit_v").alias("_newest"))
    return newest.select(DAY, "device_id", "_newest.*")


def stats(rows: DataFrame) -> DataFrame:
    """Mean, sample standard deviation and maximum per device, from partial rows.

    A device's days (one small row each) are merged pairwise by their counts, means and squared deviations,
    so nothing cancels."""
    day = F.struct("n", "mean", "m2")
    grouped = rows.groupBy("device_id").agg(F.collect_list(F.when(F.col("n") > 0, day)).alias("days"), F.max("greatest").alias("max_heartrate"))

    def merged(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2")
        )

    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    whole = grouped.select("device_id", "max_heartrate", F.aggregate("days", nothing, merged).alias("w"))
    return whole.select(
        "device_id",
        F.when(F.col("w.n") > 0, F.col("w.mean")).alias("mean_heartrate"),
        F.when(F.col("w.n") > 1, F.sqrt(F.col("w.m2") / (F.col("w.n") - 1))).alias("std_heartrate"),
        "max_heartrate",
    )


def broken_days(rows: DataFrame) -> list[str]:
    """Days with a broken reading of a known device and time."""
    found = rows.where(F.col("broken") > 0).where(F.col("device_id").isNotNull() & F.col(DAY).isNotNull())
    return sorted(r[0] for r in found.select(F.col(DAY).cast("string")).distinct().collect())


def beside(rows: DataFrame) -> DataFrame:
    """(device, day, before, after): structs of the last reading before each of a device's days and the
    first one after it; NULL where there is none. One row per device and day is windowed."""
    known = rows.where(F.col("device_id").isNotNull() & F.col(DAY).isNotNull())
    days = Window.partitionBy("device_id").orderBy(DAY)
    boxed = lambda c: F.struct(F.col(c).alias("v"))
    return known.select(
        F.col("device_id").alias("_device"), F.col(DAY).alias("_day"), F.lag(boxed("last")).over(days).alias("_before"), F.lead(boxed("first")).over(days).alias("_after")
    )
