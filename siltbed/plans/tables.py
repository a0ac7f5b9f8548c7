"""Sources, sinks, commit tables, schema rules and streams.

Queries here write what they need into shared scratch, read it back and must agree with plain SQL
over the driver tables.
"""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from siltbed.operators import aggregates, ordering, schemas, transforms, versions
from siltbed.plans.registry import query, r6, r9, table
from siltbed.plans.relational import (
    GOLD_SQL,
    READINGS_SQL,
    as_lines,
    readings,
    rounded_gold,
)
from siltbed.scratch import fresh_dir
from siltbed.sources import catalog, files, readers, writers
from siltbed.streaming import control, medallion, sinks

EVENTS_DDL = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
BY_TYPE_SQL = "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type"


def by_type(events):
    return events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")
    )


def run_complete(spark, stream, label):
    """Run an aggregate stream over all its input and return the table it wrote."""
    home = fresh_dir(spark, label)
    writer = sinks.complete_writer(stream, f"{home}/table", f"{home}/checkpoint", label)
    control.finish(writer.trigger(availableNow=True).start())
    return spark.read.parquet(f"{home}/table")


def unique_name(label):
    return f"{label}_{uuid.uuid4().hex[:8]}"


# --- sources -------------------------------------------------------------------------------------


@query(
    "src_text_stream",
    f"SELECT device_id, count(*) AS n FROM ({READINGS_SQL}) GROUP BY device_id",
)
def _(spark, sf):
    raw = fresh_dir(spark, "raw")
    writers.write_lines(as_lines(readings(spark, sf)), raw)
    parsed = transforms.parse_readings(readers.text_stream(spark, raw))
    return run_complete(spark, parsed.groupBy("device_id").agg(F.count("*").alias("n")), "text_stream")


@query("src_text_batch", "SELECT props AS value FROM events")
def _(spark, sf):
    raw = fresh_dir(spark, "raw")
    writers.write_lines(table(spark, sf, "events").select("props"), raw)
    return readers.text_batch(spark, raw)


@query("src_table_stream", BY_TYPE_SQL)
def _(spark, sf):
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    return run_complete(spark, by_type(stream), "table_stream")


@query("src_named_stream", BY_TYPE_SQL)
def _(spark, sf):
    name = unique_name("events")
    writers.overwrite_table(table(spark, sf, "events"), name, fresh_dir(spark, "named"))
    out = run_complete(spark, by_type(readers.named_stream(spark, name)), "named_stream")
    spark.sql(f"DROP TABLE {name}")
    return out


@query("src_table_batch", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    nation = readers.table_batch(spark, f"{sf}/nation.parquet")
    table(spark, sf, "region").createOrReplaceTempView("regions_by_name")
    region = readers.table_batch(spark, "regions_by_name")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_name", "r_name")


@query("src_csv_infer", "SELECT p_brand, p_size, p_retailprice FROM part")
def _(spark, sf):
    path = fresh_dir(spark, "csv")
    writers.write_csv(table(spark, sf, "part").select("p_brand", "p_size", "p_retailprice"), path)
    return readers.csv_inferred(spark, path)


@query("src_csv_sql", "SELECT p_brand, CAST(p_size AS VARCHAR) AS p_size FROM part")
def _(spark, sf):
    path = fresh_dir(spark, "csv")
    writers.write_csv(table(spark, sf, "part").select("p_brand", "p_size"), path)
    return readers.csv_as_table(spark, unique_name("parts"), path)


@query("src_csv_ddl", "SELECT c_name AS name, c_acctbal AS value FROM customer")
def _(spark, sf):
    path = fresh_dir(spark, "csv")
    writers.write_csv(table(spark, sf, "customer").select("c_name", "c_acctbal"), path)
    return readers.csv_typed(spark, path, "name STRING, value DOUBLE", header=True)


@query("src_json_stream", BY_TYPE_SQL)
def _(spark, sf):
    path = fresh_dir(spark, "json")
    table(spark, sf, "events").select("event_id", "event_type", "value").write.json(path)
    ddl = "event_id BIGINT, event_type STRING, value DOUBLE, _corrupt_record STRING"
    stream = readers.json_stream(spark, path, ddl, files_per_batch=10_000)
    return run_complete(spark, by_type(stream), "json_stream")


@query("src_parquet", "SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    return (
        table(spark, sf, "orders")
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))
    )


# --- sinks and layout ------------------------------------------------------------------------------


@query(
    "sink_stream_append",
    "SELECT event_id, event_type, value, CAST(ts AS DATE) AS day FROM events",
)
def _(spark, sf):
    home = fresh_dir(spark, "append")
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet").select(
        "event_id", "event_type", "value", F.col("ts").cast("date").alias("day")
    )
    writer = sinks.append_writer(
        stream, f"{home}/table", f"{home}/checkpoint", "append_events", partition_by=["day"]
    )
    control.finish(writer.trigger(availableNow=True).start())
    return versions.read_as_of(spark, f"{home}/table")


@query(
    "sink_stream_evolve",
    """SELECT event_id, value, CAST(NULL AS VARCHAR) AS event_type FROM events
       UNION ALL SELECT event_id, value, event_type FROM events""",
)
def _(spark, sf):
    home = fresh_dir(spark, "evolve")
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    for step, names in enumerate([["event_id", "value"], ["event_id", "value", "event_type"]]):
        writer = sinks.append_writer(
            stream.select(*names), f"{home}/table", f"{home}/checkpoint{step}",
            f"evolve_{step}", evolve=True,
        )
        control.finish(writer.trigger(availableNow=True).start())
    return versions.read_as_of(spark, f"{home}/table")


@query(
    "sink_stream_complete",
    """SELECT user_id, round(avg(value), 9) AS mean_value, round(stddev(value), 6) AS std_value,
              max(value) AS max_value FROM events GROUP BY user_id""",
)
def _(spark, sf):
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    gold = run_complete(spark, aggregates.key_stats(stream, "user_id", "value"), "gold")
    return gold.withColumns({"mean_value": r9("mean_value"), "std_value": r6("std_value")})


@query("sink_table_overwrite", "SELECT s_suppkey, s_acctbal FROM supplier")
def _(spark, sf):
    name, path = unique_name("suppliers"), fresh_dir(spark, "overwrite")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    writers.overwrite_table(s.withColumn("s_acctbal", F.lit(0.0)), name, path)
    return writers.overwrite_table(s, name, path)


@query("sink_csv", "SELECT o_orderkey, round(o_totalprice / 2, 4) AS prediction FROM orders")
def _(spark, sf):
    path = fresh_dir(spark, "predictions")
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 2).alias("prediction"))
    writers.write_csv(o, path)
    back = readers.csv_typed(spark, path, "o_orderkey BIGINT, prediction DOUBLE", header=True)
    return back.withColumn("prediction", F.round("prediction", 4))


@query("sink_register", "SELECT c_mktsegment, c_custkey FROM customer")
def _(spark, sf):
    path = fresh_dir(spark, "registered")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    writers.overwrite_path(c, path, ["c_mktsegment"])
    return writers.register(spark, unique_name("customers"), path)


@query("sink_preview", BY_TYPE_SQL)
def _(spark, sf):
    # The view holds one row per event type, so the driver's memory sink stays tiny.
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    name = unique_name("preview")
    writer = sinks.preview(by_type(stream), name, "complete")
    writer = writer.option("checkpointLocation", fresh_dir(spark, "preview"))
    control.finish(writer.trigger(availableNow=True).start())
    return spark.table(name)


@query("count_stream", "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def _(spark, sf):
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    return run_complete(spark, aggregates.count_by_key(stream, "event_type"), "count_stream")


def _z_sql(bits):
    def cell(c):
        return (
            f"least(greatest(CAST(floor(({c} - (SELECT min({c}) FROM part)) / "
            f"((SELECT max({c}) - min({c}) FROM part) / {1 << bits}.0e0)) AS BIGINT), 0), {(1 << bits) - 1})"
        )

    terms = [
        f"((({name} >> {b}) & 1) << {2 * b + i})" for b in range(bits) for i, name in enumerate(["a", "b"])
    ]
    return (
        f"SELECT p_partkey, {' | '.join(terms)} AS z FROM "
        f"(SELECT p_partkey, {cell('p_size')} AS a, {cell('p_retailprice')} AS b FROM part)"
    )


@query("layout_cluster", _z_sql(8))
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return writers.clustered(p, ["p_size", "p_retailprice"], bits=8).select("p_partkey", "z")


@query(
    "layout_cluster_table",
    """SELECT event_type, count(*) AS n, max(value) AS top FROM events
       WHERE value > 100 GROUP BY event_type""",
)
def _(spark, sf):
    path = fresh_dir(spark, "clustered")
    e = table(spark, sf, "events")
    writers.write_clustered(e, path, ["user_id", "value"], partition_by=["event_type"])
    hit = spark.read.parquet(path).where("value > 100")
    return hit.groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top"))


@query(
    "manifest_diff",
    """WITH e AS (SELECT CAST(doc_id AS VARCHAR) AS name, n_chars AS size FROM documents),
            a AS (SELECT CAST(doc_id AS VARCHAR) AS name, n_chars + toxic AS size FROM labels JOIN documents USING (doc_id))
       SELECT coalesce(e.name, a.name) AS name, e.size AS expected_size, a.size AS actual_size,
              CASE WHEN a.name IS NULL THEN 'missing' WHEN e.name IS NULL THEN 'extra' ELSE 'size_mismatch' END AS verdict
       FROM e FULL OUTER JOIN a ON e.name = a.name WHERE e.size IS DISTINCT FROM a.size""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    name = F.col("doc_id").cast("string").alias("name")
    found = table(spark, sf, "labels").join(docs, "doc_id")
    return files.manifest_diff(
        docs.select(name, F.col("n_chars").alias("size")),
        found.select(name, (F.col("n_chars") + F.col("toxic")).alias("size")),
    )


# --- commit tables and schema rules ------------------------------------------------------------------


@query(
    "commit_append",
    "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
)
def _(spark, sf):
    home = fresh_dir(spark, "commits")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    named = ["F", "O", "P"]
    parts = [F.col("o_orderstatus") == s for s in named] + [~F.coalesce(F.col("o_orderstatus").isin(named), F.lit(False))]
    for batch, which in enumerate(parts):  # the last batch holds all other statuses
        part = o.where(which)
        versions.commit(part, home, "orders", batch)
        versions.commit(part, home, "orders", batch)  # a retry: skipped
    return versions.read_as_of(spark, home).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def _order_commits(spark, sf):
    """Commit 0: finished orders; commit 1: the others; commit 2: corrected urgent prices."""
    home = fresh_dir(spark, "versions")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    versions.commit(o.where("o_orderstatus = 'F'"), home, "load", 0)
    versions.commit(o.where("o_orderstatus <> 'F'"), home, "load", 1)
    fix = o.where("o_orderpriority = '1-URGENT'").withColumn("o_totalprice", -F.col("o_totalprice"))
    versions.commit(fix, home, "fix", 0, op="update")
    return home


@query(
    "read_as_of",
    """SELECT c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN abs(c_acctbal) ELSE c_acctbal END AS c_acctbal
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def _(spark, sf):
    """Two loads and a correction are visible; a third load that came later is not."""
    home = fresh_dir(spark, "as-of")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    versions.commit(c.where("c_mktsegment = 'MACHINERY'"), home, "load", 0)
    versions.commit(c.where("c_mktsegment not in ('MACHINERY', 'BUILDING')"), home, "load", 1)
    fix = c.where("c_nationkey % 2 = 0 and c_mktsegment <> 'BUILDING'").withColumn("c_acctbal", F.abs("c_acctbal"))
    versions.commit(fix, home, "fix", 0, op="update")
    versions.commit(c.where("c_mktsegment = 'BUILDING'"), home, "load", 2)
    return versions.read_as_of(spark, home, 2, ["c_custkey"]).select("c_custkey", "c_acctbal")


@query(
    "commit_text_partitions",
    """SELECT c_custkey, right('00' || c_nationkey, 3) AS nation, c_acctbal FROM customer""",
)
def _(spark, sf):
    """Two commits partitioned by a text of digits, which stays text with its zeros."""
    home = fresh_dir(spark, "text-partitions")
    nation = F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("nation")
    c = table(spark, sf, "customer").select("c_custkey", nation, "c_acctbal")
    for batch in range(2):
        versions.commit(c.where(F.col("c_custkey") % 2 == batch), home, "load", batch, partition_by=["nation"])
    return versions.read_as_of(spark, home)


@query(
    "read_as_of_commits",
    """SELECT 0 AS version, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 1, o_orderkey, o_totalprice FROM orders
       UNION ALL SELECT 2, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -o_totalprice ELSE o_totalprice END FROM orders""",
)
def _(spark, sf):
    home = _order_commits(spark, sf)
    parts = [
        versions.read_as_of(spark, home, v, ["o_orderkey"]).select(
            F.lit(v).alias("version"), "o_orderkey", "o_totalprice"
        )
        for v in range(3)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "read_as_of_days",
    """SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN day(ts) = 3 THEN -value ELSE value END AS value FROM events""",
)
def _(spark, sf):
    """A table by day, one of whose days was corrected: all others are plain scans."""
    home = fresh_dir(spark, "by-day")
    e = table(spark, sf, "events").select("event_id", "value", F.col("ts").cast("date").alias("day"))
    versions.commit(e, home, "load", 0, partition_by=["day"])
    versions.commit(e.where("day(day) = 3").withColumn("value", -F.col("value")), home, "fix", 0, op="update", partition_by=["day"])
    return versions.read_as_of(spark, home, None, ["event_id", "day"], "day")


@query(
    "table_history",
    """SELECT CAST(day(CAST(ts AS DATE)) AS BIGINT) AS version, count(*) AS n_rows, min(event_id) AS first_id
       FROM events GROUP BY day(CAST(ts AS DATE))""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("ts", "event_id")
    return versions.history(e, F.dayofmonth("ts"), F.min("event_id").alias("first_id"))


@query(
    "table_history_commits",
    """SELECT 0 AS version, 'append' AS operation, 'load' AS source, CAST(0 AS BIGINT) AS batch_id, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 1, 'append', 'load', 1, count(*) FROM orders WHERE o_orderstatus <> 'F'
       UNION ALL SELECT 2, 'update', 'fix', 0, count(*) FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def _(spark, sf):
    return versions.table_history(spark, _order_commits(spark, sf)).drop("committed_at")


@query("schema_enforce", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_acctbal", "c_custkey")
    return schemas.enforce(c, "c_custkey BIGINT, c_phone STRING, c_acctbal DOUBLE")


@query(
    "schema_evolve",
    """SELECT c_custkey, c_acctbal, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal < 0
       UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= 0""",
)
def _(spark, sf):
    home = fresh_dir(spark, "evolved")
    c = table(spark, sf, "customer")
    versions.commit(c.where("c_acctbal < 0").select("c_custkey", "c_acctbal"), home, "v1", 0)
    later = c.where("c_acctbal >= 0").select("c_custkey", "c_acctbal", "c_mktsegment")
    versions.commit(later, home, "v2", 0, evolve=True)
    return versions.read_as_of(spark, home)


@query("schema_assert", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    schemas.assert_schema(n, "n_nationkey INT, n_name STRING")
    return n


@query("file_present_assert", "SELECT count(*) AS n_rows FROM events")
def _(spark, sf):
    files.assert_file_present(spark, sf, "events.parquet")
    return aggregates.count_all(table(spark, sf, "events"))


@query("cache_as", "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment")
def _(spark, sf):
    n = aggregates.count_by_key(table(spark, sf, "customer"), "c_mktsegment")
    return catalog.cache_as(n, "segment_counts")


@query("timed_count", "SELECT count(*) AS n_rows, true AS took_time FROM orders")
def _(spark, sf):
    _df, total, ms = catalog.timed_count(lambda: table(spark, sf, "orders"))
    return spark.createDataFrame([(total, ms > 0)], "n_rows BIGINT, took_time BOOLEAN")


# --- streams chained through tables --------------------------------------------------------------------


@query(
    "stream_checkpoint",
    f"""SELECT CASE WHEN t < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS version, count(*) AS n_rows
        FROM ({READINGS_SQL}) GROUP BY 1""",
)
def _(spark, sf):
    """Two deliveries, three runs: each delivery is one commit, the idle run adds none."""
    layers = medallion.Layers(fresh_dir(spark, "checkpointed"))
    rows = readings(spark, sf)
    first = F.col("t") < F.lit("2024-01-16").cast("timestamp")
    writers.write_lines(as_lines(rows.where(first)), layers.raw)
    medallion.raw_to_bronze(spark, layers)
    writers.write_lines(as_lines(rows.where(~first)), layers.raw, mode="append")
    medallion.raw_to_bronze(spark, layers)
    medallion.raw_to_bronze(spark, layers)
    return versions.table_history(spark, layers.bronze).select("version", "n_rows")


@query(
    "ingest_incremental",
    f"SELECT device_id, name, round(hr, 6) AS heartrate FROM ({READINGS_SQL})",
)
def _(spark, sf):
    """The whole ingest run twice over one delivery gives the rows once."""
    layers = medallion.Layers(fresh_dir(spark, "incremental"))
    writers.write_lines(as_lines(readings(spark, sf)), layers.raw)
    for _run in range(2):
        medallion.raw_to_bronze(spark, layers)
        medallion.bronze_to_silver(spark, layers)
    silver = medallion.silver_now(spark, layers)
    return silver.select("device_id", "name", r6("heartrate").alias("heartrate"))


@query("stream_output_mode", BY_TYPE_SQL)
def _(spark, sf):
    """Rows by an append stream, then their aggregate by a complete stream over that table."""
    home = fresh_dir(spark, "modes")
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    writer = sinks.append_writer(stream, f"{home}/table", f"{home}/checkpoint", "mode_append")
    control.finish(writer.trigger(availableNow=True).start())
    again = versions.stream_appends(spark, f"{home}/table", EVENTS_DDL)
    return run_complete(spark, by_type(again), "mode_complete")


def _run_named(spark, sf, label):
    """Start an endless stream, wait for its reports, and hand over its name and table path."""
    home, name = fresh_dir(spark, label), unique_name(label)
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    writer = sinks.complete_writer(by_type(stream), f"{home}/table", f"{home}/checkpoint", name)
    started = writer.trigger(processingTime="200 milliseconds").start()
    started.processAllAvailable()
    return name, f"{home}/table"


FLAGGED_SQL = BY_TYPE_SQL.replace("SELECT ", "SELECT true AS as_told, ", 1)


@query("stream_until_ready", FLAGGED_SQL)
def _(spark, sf):
    name, path = _run_named(spark, sf, "ready")
    told = control.until_stream_is_ready(spark, name, 1)
    control.stop_named_stream(spark, name)
    return spark.read.parquet(path).withColumn("as_told", F.lit(told))


@query("stream_list", FLAGGED_SQL)
def _(spark, sf):
    name, path = _run_named(spark, sf, "listed")
    listed = name in control.stream_names(spark)
    control.stop_named_stream(spark, name)
    gone = name not in control.stream_names(spark)
    return spark.read.parquet(path).withColumn("as_told", F.lit(listed and gone))


@query("stream_stop_named", FLAGGED_SQL)
def _(spark, sf):
    name, path = _run_named(spark, sf, "stopped")
    told = control.stop_named_stream(spark, name) and not control.stop_named_stream(spark, name)
    return spark.read.parquet(path).withColumn("as_told", F.lit(told))


@query("stream_schema_halt", "SELECT event_id, value, true AS halted FROM events")
def _(spark, sf):
    """A stream that brings an unknown column dies and leaves the table as it was."""
    home = fresh_dir(spark, "halt")
    stream = readers.table_stream(spark, sf, EVENTS_DDL, glob="events.parquet")
    halted = False
    for step, names in enumerate([["event_id", "value"], ["event_id", "value", "event_type"]]):
        writer = sinks.append_writer(
            stream.select(*names), f"{home}/table", f"{home}/checkpoint{step}", f"halt_{step}"
        )
        try:
            control.finish(writer.trigger(availableNow=True).start())
        except StreamingQueryException as exc:
            halted = "columns not in the table: event_type" in str(exc)
    return versions.read_as_of(spark, f"{home}/table").withColumn("halted", F.lit(halted))


@query("stream_chain", GOLD_SQL)
def _(spark, sf):
    layers = medallion.Layers(fresh_dir(spark, "chain"))
    writers.write_lines(as_lines(readings(spark, sf)), layers.raw)
    return rounded_gold(medallion.run_chain(spark, layers))


@query(
    "late_merge",
    f"""SELECT device_id, count(*) AS n_rows, CAST(sum(CASE WHEN hr < -20 THEN 1 ELSE 0 END) AS BIGINT) AS n_late
        FROM ({READINGS_SQL}) GROUP BY device_id""",
)
def _(spark, sf):
    """The lowest readings are missing from the delivery; a late file with everything follows."""
    layers = medallion.Layers(fresh_dir(spark, "late"))
    rows = readings(spark, sf)
    writers.write_lines(as_lines(rows.where("heartrate >= -20")), layers.raw)
    writers.write_lines(as_lines(rows), layers.late)
    medallion.raw_to_bronze(spark, layers)
    medallion.bronze_to_silver(spark, layers)
    medallion.merge_late(spark, layers, layers.late, 0)
    medallion.merge_late(spark, layers, layers.late, 1)  # nothing is left to add
    medallion.bronze_to_silver(spark, layers)
    silver = medallion.silver_now(spark, layers)
    late = F.sum(F.when(F.col("heartrate") < -20, 1).otherwise(0))
    return silver.groupBy("device_id").agg(
        F.count("*").alias("n_rows"), late.cast("bigint").alias("n_late")
    )
