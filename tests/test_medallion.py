"""The layered pipeline on generated device readings, with the known record counts."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.operators import datagen, repair, transforms, versions
from siltbed.operators.schemas import SchemaMismatch
from siltbed.sources import readers, writers
from siltbed.streaming import control, medallion, sinks

DEVICES, JANUARY, FEBRUARY, MARCH = 5, 31, 29, 31


def january(spark):
    return datagen.device_readings(spark, "2020-01-01", JANUARY, DEVICES, series_id=1)


def february(spark):
    return datagen.device_readings(spark, "2020-02-01", FEBRUARY, DEVICES, series_id=2)


def february_short(spark):
    """February without the last three days of device 4."""
    cut = F.timestamp_seconds("time") < F.lit("2020-02-27").cast("timestamp")
    return february(spark).where((F.col("device_id") != 4) | cut)


def drop_file(readings, path, mode="append"):
    writers.write_lines(datagen.as_json_lines(readings).coalesce(1), path, mode)


@pytest.fixture
def two_months(spark, home):
    layers = medallion.Layers(f"{home}/layers")
    for month in (january(spark), february_short(spark)):
        drop_file(month, layers.raw)
        medallion.raw_to_bronze(spark, layers)
    drop_file(february(spark), layers.late)
    medallion.bronze_to_silver(spark, layers)
    return layers


def test_bronze_schema(spark):
    raw = readers.rows(spark, [('{"device_id":0}',)], "value STRING")
    expected = StructType.fromDDL(transforms.BRONZE_SCHEMA)
    assert transforms.ingest_metadata(raw).schema == expected


def test_late_merge_counts(spark, two_months):
    layers = two_months
    silver = medallion.silver_now(spark, layers)
    assert silver.count() == 7128
    per_device = {r["device_id"]: r["n"] for r in silver.groupBy("device_id").agg(F.count("*").alias("n")).collect()}
    assert per_device[4] == 1440 - 72

    assert readers.text_batch(spark, layers.late).count() == 3480
    assert medallion.merge_late(spark, layers, layers.late, 0) is not None
    medallion.bronze_to_silver(spark, layers)
    silver = medallion.silver_now(spark, layers)
    assert silver.count() == 7200
    counts = silver.groupBy("device_id").agg(F.count("*").alias("n")).select("n").distinct().collect()
    assert [r["n"] for r in counts] == [1440]

    # nothing new: neither a late merge nor a stream run adds a commit
    before = versions.latest_version(spark, layers.silver)
    assert medallion.merge_late(spark, layers, layers.late, 1) is None
    medallion.raw_to_bronze(spark, layers)
    medallion.bronze_to_silver(spark, layers)
    assert versions.latest_version(spark, layers.silver) == before


def test_missing_report_names_the_gap(spark, two_months):
    silver = medallion.silver_now(spark, two_months)
    start, end = (F.lit(t).cast("timestamp") for t in ("2020-01-01", "2020-02-29 23:00:00"))
    report = repair.missing_report(silver, "device_id", F.col("eventtime"), start, end)
    assert {r["device_id"]: r["missing"] for r in report.collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 4: 72}
    slots = repair.missing_slots(silver, "device_id", F.col("eventtime"), start, end)
    span = slots.agg(F.count("*"), F.min("slot").cast("string"), F.max("slot").cast("string")).first()
    assert tuple(span) == (72, "2020-02-27 00:00:00", "2020-02-29 23:00:00")


def test_repair_then_nothing_left_but_ends_and_pairs(spark, two_months):
    layers = two_months
    v0 = versions.latest_version(spark, layers.silver)
    broken = transforms.negative(medallion.silver_now(spark, layers), "heartrate").count()
    assert broken > 0
    assert medallion.repair_silver(spark, layers)

    silver = medallion.silver_now(spark, layers)
    assert silver.count() == 7128
    # the very first and last reading of device 0 have one neighbour only
    ends = silver.where("heartrate IS NULL").select("device_id").collect()
    assert [r["device_id"] for r in ends] == [0, 0]

    # history stays readable
    old = medallion.silver_now(spark, layers, v0)
    assert transforms.negative(old, "heartrate").count() == broken
    assert old.count() == 7128

    # repaired until no negative is left; then a run writes no commit
    for _ in range(5):
        if not medallion.repair_silver(spark, layers):
            break
    else:
        raise AssertionError("repair never came to an end")
    assert transforms.negative(medallion.silver_now(spark, layers), "heartrate").count() == 0
    assert not medallion.repair_silver(spark, layers)


def test_repair_matches_a_plain_python_pass(spark, two_months):
    before = medallion.silver_now(spark, two_months).select("device_id", "eventtime", "heartrate").collect()
    medallion.repair_silver(spark, two_months)
    after = medallion.silver_now(spark, two_months).select("device_id", "eventtime", "heartrate").collect()
    series = {}
    for r in sorted(before, key=lambda r: (r[0], r[1])):
        series.setdefault(r[0], []).append((r[1], r[2]))
    want = {}
    for device, points in series.items():
        for i, (t, v) in enumerate(points):
            if v < 0:
                inside = 0 < i < len(points) - 1
                v = (points[i - 1][1] + points[i + 1][1]) / 2 if inside else None
            want[device, t] = v
    assert {(r[0], r[1]): r[2] for r in after} == want


def test_stream_over_a_repaired_table_sees_each_reading_once(spark, two_months, home):
    layers = two_months
    assert medallion.repair_silver(spark, layers)
    stream = versions.stream_appends(spark, layers.silver, transforms.SILVER_V1_SCHEMA)
    counts = stream.groupBy("device_id").agg(F.count("*").alias("n"))
    writer = sinks.complete_writer(counts, f"{home}/counts", f"{home}/c", "silver_counts")
    control.finish(writer.trigger(availableNow=True).start())
    assert spark.read.parquet(f"{home}/counts").agg(F.sum("n")).first()[0] == 7128


def test_gold_from_chain(spark, home):
    layers = medallion.Layers(f"{home}/chain")
    drop_file(january(spark), layers.raw)
    gold = medallion.run_chain(spark, layers)
    assert gold.columns == ["device_id", "mean_heartrate", "std_heartrate", "max_heartrate"]
    assert gold.count() == DEVICES
    assert gold.where("mean_heartrate BETWEEN 60 AND 80").count() == DEVICES


def parse_v2(bronze):
    return transforms.parse_readings(bronze, with_type=True)


def test_new_column_halts_the_stream_then_evolves(spark, two_months):
    layers = two_months
    march = datagen.device_readings(spark, "2020-03-01", MARCH, DEVICES, with_type=True, series_id=3)
    drop_file(march, layers.raw)
    medallion.raw_to_bronze(spark, layers)
    with pytest.raises((StreamingQueryException, SchemaMismatch), match="device_type"):
        medallion.bronze_to_silver(spark, layers, parse_v2)
    assert medallion.silver_now(spark, layers).count() == 7128

    # same checkpoint, now with evolution: the failed batch is read again, nothing is lost or doubled
    medallion.bronze_to_silver(spark, layers, parse_v2, evolve=True)
    silver = medallion.silver_now(spark, layers)
    assert silver.count() == 7128 + 3720
    by_type = {r["device_type"]: r["count"] for r in silver.groupBy("device_type").count().collect()}
    assert by_type == {None: 7128, "tracker": 3720}
    # the repair of a widened table keeps the new column
    medallion.repair_silver(spark, layers)
    silver = medallion.silver_now(spark, layers)
    assert silver.where("device_type = 'tracker'").count() == 3720


def test_float_time_moves_readings_inside_the_day(spark):
    line = readers.rows(spark, [('{"device_id":1,"heartrate":60.0,"name":"x","time":1.5778404E9}',)], "value STRING")
    exact = transforms.parse_readings(line).first()
    single = transforms.parse_readings(line, time_type="FLOAT").first()
    assert str(exact["eventtime"]) == "2020-01-01 01:00:00"
    assert str(single["eventtime"]) == "2020-01-01 00:59:44"
    assert exact["p_eventdate"] == single["p_eventdate"]


def test_malformed_line_is_kept_and_listed(spark):
    lines = readers.rows(
        spark, [('{"device_id":1,"heartrate":60.0,"name":"x","time":1.5E9}',), ("{oops",), ("",)], "value STRING"
    )
    out = transforms.parse_readings(lines)
    assert out.count() == 3
    assert out.where("device_id IS NULL").count() == 2
    assert {r["value"] for r in transforms.bad_rows(lines).collect()} == {"{oops", ""}


def test_all_null_rows_survive_updates(spark, home):
    ddl = transforms.SILVER_V1_SCHEMA
    t = f"{home}/silver"
    rows = readers.rows(spark, [(None, None, None, None, None)] * 2 + [(1, -5.0, None, "x", None)], ddl)
    versions.commit(rows, t, "s", 0)
    fix = readers.rows(spark, [(1, 5.0, None, "x", None)], ddl)
    versions.commit(fix, t, "fix", 0, op="update")
    # the NULL event time is part of the key, so nothing was replaced
    assert versions.read_as_of(spark, t, keys=medallion.READING_KEY).count() == 4


def test_stream_stops_and_waits(spark, home):
    drop_file(january(spark), f"{home}/raw")
    lines = readers.text_stream(spark, f"{home}/raw")
    writer = sinks.append_writer(lines, f"{home}/t", f"{home}/c1", "named_a")
    control_b = sinks.preview(lines.groupBy().count(), "named_b", "complete")
    writer.start()
    control_b.option("checkpointLocation", f"{home}/c2").start()
    assert sorted(control.stream_names(spark)) == ["named_a", "named_b"]
    assert control.until_stream_is_ready(spark, "named_b", 1, timeout=60)
    with pytest.raises(TimeoutError):
        control.until_stream_is_ready(spark, "no_such_stream", 1, timeout=0.2, poll=0.05)
    assert control.stop_named_stream(spark, "named_a")
    assert not control.stop_named_stream(spark, "named_a")
    assert control.stream_names(spark) == ["named_b"]
    assert control.stop_all_streams(spark)
    assert not control.stop_all_streams(spark)
    assert spark.table("named_b").first()["count"] == 3720


def test_json_folder_stream_one_file_per_batch(spark, home):
    rows = readers.rows(
        spark, [(f"phone{i % 3}", i, "stand", float(i)) for i in range(40)],
        "Device STRING, Index BIGINT, gt STRING, x DOUBLE",
    )
    rows.repartition(4).write.json(f"{home}/activity")
    writers.write_lines(readers.rows(spark, [("{broken",)], "value STRING"), f"{home}/activity", "append")
    ddl = "Device STRING, Index BIGINT, gt STRING, x DOUBLE, _corrupt_record STRING"
    stream = readers.json_stream(spark, f"{home}/activity", ddl)
    query = sinks.preview(stream, "activity").option("checkpointLocation", f"{home}/c")
    done = control.finish(query.trigger(availableNow=True).start())
    files = len([p for p in done.recentProgress if p["numInputRows"]])
    assert files == 5
    got = spark.table("activity")
    assert got.count() == 41
    assert got.where("_corrupt_record IS NOT NULL").count() == 1


def test_fresh_checkpoint_is_a_new_source_and_a_kept_one_is_not(spark, home):
    drop_file(january(spark), f"{home}/raw")
    lines = readers.text_stream(spark, f"{home}/raw")
    for checkpoint, rows in (("a", 3720), ("a", 3720), ("b", 7440)):
        writer = sinks.append_writer(lines, f"{home}/t", f"{home}/{checkpoint}", "lines")
        control.finish(writer.trigger(availableNow=True).start())
        assert versions.read_as_of(spark, f"{home}/t").count() == rows


def test_batch_that_failed_after_its_commit_is_not_doubled(spark, home):
    """The commit is in place but the checkpoint does not know: the retry is skipped."""
    drop_file(january(spark), f"{home}/raw")
    lines = readers.text_stream(spark, f"{home}/raw")
    write_once = sinks.append_writer

    def crash_after(batch, batch_id):
        checkpoint_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        versions.commit(batch, f"{home}/t", f"lines.{checkpoint_id}", batch_id)
        raise RuntimeError("lost the driver here")

    crashing = lines.writeStream.queryName("lines").option("checkpointLocation", f"{home}/c")
    with pytest.raises(StreamingQueryException):
        control.finish(crashing.foreachBatch(crash_after).trigger(availableNow=True).start())
    assert versions.read_as_of(spark, f"{home}/t").count() == 3720
    writer = write_once(lines, f"{home}/t", f"{home}/c", "lines")
    control.finish(writer.trigger(availableNow=True).start())
    assert versions.read_as_of(spark, f"{home}/t").count() == 3720


def test_a_batch_of_bad_lines_only_stops_nothing(spark, home):
    layers = medallion.Layers(f"{home}/layers", limit=600)
    for lines in (["not json", "{}"], ['{"device_id": 1, "heartrate": 2.5, "name": "a", "time": 1577836800.0}']):
        writers.write_lines(readers.rows(spark, [(x,) for x in lines], "value STRING"), layers.raw, "append")
        medallion.raw_to_bronze(spark, layers)
        medallion.bronze_to_silver(spark, layers)
    silver = medallion.silver_now(spark, layers)
    assert dict(silver.dtypes)["p_eventdate"] == "date"
    assert silver.count() == 3 and silver.where("heartrate = 2.5").count() == 1


def test_repair_of_doubled_readings(spark, home):
    """Copies of one reading that differ in spacing: a sound copy wins, broken ones are repaired alike."""
    layers = medallion.Layers(f"{home}/layers")
    lines = [f'{{"device_id": 1, "heartrate": {h}, "name": "a", "time": {1577836800 + 60 * i}}}' for i, h in enumerate([10, -5, 30, -7, 50])]
    lines += [lines[1].replace(": ", ":"), lines[3].replace("-7", "45").replace(": ", ":")]
    writers.write_lines(readers.rows(spark, [(x,) for x in lines], "value STRING"), layers.raw)
    medallion.raw_to_bronze(spark, layers)
    medallion.bronze_to_silver(spark, layers)
    assert medallion.repair_silver(spark, layers)
    got = medallion.silver_now(spark, layers).orderBy("eventtime").collect()
    assert [r["heartrate"] for r in got] == [10.0, 20.0, 20.0, 30.0, 45.0, 45.0, 50.0]
    assert not medallion.repair_silver(spark, layers)


def test_steps_wait_as_long_as_they_need_or_are_told(spark, home):
    drop_file(january(spark), f"{home}/raw")
    stream = readers.text_stream(spark, f"{home}/raw")
    writer = sinks.preview(stream.groupBy().agg(F.count("*").alias("n")), "slow_preview", "complete")
    query = writer.start()
    with pytest.raises(TimeoutError, match="still runs after 1"):
        control.finish(query, 1)
    assert not query.isActive


def readings_of(spark, days, device=1, beat=lambda i: 60.0 + i % 7, step=3600):
    rows = []
    for d in days:
        for i in range(24):
            rows.append((f'{{"device_id": {device}, "heartrate": {beat(24 * d + i)}, "name": "a", "time": {1577836800 + 86400 * d + step * i}}}',))
    return readers.rows(spark, rows, "value STRING")


def test_a_second_run_reads_only_the_touched_days(spark, home, monkeypatch):
    """Gold after one more day equals a recompute; of silver only that day, and its broken neighbour, is read."""
    from siltbed.operators import aggregates
    from siltbed.streaming import daily

    layers = medallion.Layers(f"{home}/layers")
    beat = lambda i: -5.0 if i % 24 == 0 and i else 60.0 + i % 7  # noqa: E731  the first reading of a day is broken
    writers.write_lines(readings_of(spark, range(6), beat=beat).coalesce(1), layers.raw)
    medallion.run_chain(spark, layers)
    asked = []
    read = versions.read_as_of

    def spied(spark, table, version=None, keys=(), within=None, only=None):
        if table == layers.silver:
            asked.append(None if only is None else list(only))
        return read(spark, table, version, keys, within, only)

    monkeypatch.setattr(versions, "read_as_of", spied)
    writers.write_lines(readings_of(spark, [6], beat=beat).coalesce(1), layers.raw, "append")
    gold = medallion.run_chain(spark, layers)
    # new day: partial rows, repair, partial rows of what was repaired
    assert asked == [["2020-01-07"]] * 3
    monkeypatch.undo()
    whole = aggregates.key_stats(medallion.silver_now(spark, layers), "device_id", "heartrate").first()
    got = gold.first()
    assert got["max_heartrate"] == whole["max_heartrate"]
    assert abs(got["mean_heartrate"] - whole["mean_heartrate"]) < 1e-9 and abs(got["std_heartrate"] - whole["std_heartrate"]) < 1e-9
    # the broken first reading of the new day lies between the last of the day before and its own second
    fixed = medallion.silver_now(spark, layers).where("eventtime = '2020-01-07 00:00:00'").first()["heartrate"]
    assert fixed == ((60.0 + 143 % 7) + (60.0 + 145 % 7)) / 2
    assert daily.current(spark, layers.daily).count() == 7


def test_gold_of_bad_lines_and_late_days(spark, home):
    """A line without device or time, a device with one reading, a late day between others."""
    from siltbed.operators import aggregates

    layers = medallion.Layers(f"{home}/layers")
    for days, extra in (([0, 3], ["not json", "{}"]), ([1], ['{"device_id": 2, "heartrate": -1.0, "name": "b", "time": 1577836800.0}']), ([3], [])):
        lines = readings_of(spark, days).unionAll(readers.rows(spark, [(x,) for x in extra], "value STRING"))
        writers.write_lines(lines, layers.raw, "append")
        gold = medallion.run_chain(spark, layers)
    want = aggregates.key_stats(medallion.silver_now(spark, layers), "device_id", "heartrate").collect()
    key = lambda rows: {r[0]: tuple(None if x is None else round(x, 9) for x in r[1:]) for r in rows}
    assert key(gold.collect()) == key(want)
    assert medallion.silver_now(spark, layers).where("device_id = 1").count() == 96


def test_partial_statistics_do_not_cancel(spark):
    from siltbed.operators import aggregates
    from siltbed.streaming import daily

    rows = spark.range(2000).selectExpr("cast(id % 3 as int) AS device_id", "1e9 + (id % 10) * 1e-3 AS heartrate", "timestamp_seconds(id * 500) AS eventtime", "to_date(timestamp_seconds(id * 500)) AS p_eventdate")
    got = {r["device_id"]: r for r in daily.stats(daily.partials(rows)).collect()}
    for r in aggregates.key_stats(rows, "device_id", "heartrate").collect():
        assert abs(got[r["device_id"]]["std_heartrate"] / r["std_heartrate"] - 1) < 1e-4


def test_a_late_file_of_new_lines_opens_no_bronze_file(spark, home, monkeypatch):
    layers = medallion.Layers(f"{home}/layers")
    for day in range(3):
        writers.write_lines(readings_of(spark, [day]), layers.raw, "append")
        medallion.raw_to_bronze(spark, layers)
    opened = []
    read = versions.read_commits
    monkeypatch.setattr(versions, "read_commits", lambda *a, **k: opened.append(a[1]) or read(*a, **k))
    writers.write_lines(readings_of(spark, [7]), layers.late)
    assert medallion.merge_late(spark, layers, layers.late, 0) is not None
    assert opened == []
    monkeypatch.undo()
    assert versions.holders(spark, layers.bronze, readings_of(spark, [1]), ["value"]) == [1]
    writers.write_lines(readings_of(spark, [1, 8]), f"{home}/more")
    medallion.merge_late(spark, layers, f"{home}/more", 1)
    assert versions.read_as_of(spark, layers.bronze).count() == 24 * 5
    assert medallion.merge_late(spark, layers, f"{home}/more", 2) is None


def test_a_failure_before_the_rename_leaves_the_old_table(spark, home, monkeypatch):
    path = f"{home}/result"
    writers.publish(spark.range(3), path)
    move = writers._move

    def lost(spark, source, target):
        raise OSError("lost the driver here")

    monkeypatch.setattr(writers, "_move", lost)
    with pytest.raises(OSError):
        writers.publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3 and writers.published(spark, path).count() == 3

    def between(spark, source, target):
        if target == path:
            raise OSError("and here")
        move(spark, source, target)

    monkeypatch.setattr(writers, "_move", between)
    with pytest.raises(OSError):
        writers.publish(spark.range(9), path)
    assert writers.published(spark, path).count() == 3
    monkeypatch.undo()
    assert writers.publish(writers.published(spark, path).union(spark.range(2)), path).count() == 5
    assert writers.published(spark, path).count() == 5


def test_a_failing_batch_of_a_complete_stream_leaves_the_old_result(spark, home, monkeypatch):
    writers.write_lines(readings_of(spark, [0]).coalesce(1), f"{home}/raw")
    stream = readers.text_stream(spark, f"{home}/raw").groupBy().agg(F.count("*").alias("n"))
    run = lambda: control.finish(sinks.complete_writer(stream, f"{home}/n", f"{home}/c", "n_lines").trigger(availableNow=True).start())
    run()
    writers.write_lines(readings_of(spark, [1]).coalesce(1), f"{home}/raw", "append")
    move = writers._move
    monkeypatch.setattr(writers, "_move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(StreamingQueryException):
        run()
    assert writers.published(spark, f"{home}/n").first()["n"] == 24
    monkeypatch.setattr(writers, "_move", move)
    run()
    assert writers.published(spark, f"{home}/n").first()["n"] == 48


def test_missing_slots_of_silent_keys_and_fine_steps(spark):
    """A key without any row, a NULL key, rows off the grid, and holes of many seconds."""
    import datetime as dt

    rows = [("a", "2020-01-01 00:00:03"), ("a", "2020-01-01 00:00:03"), ("a", "2020-01-01 00:00:07.5"), ("b", "2019-01-01 00:00:00"), (None, "2020-01-01 00:00:00")]
    df = readers.rows(spark, rows, "k STRING, t STRING").withColumn("t", F.col("t").cast("timestamp"))
    start, end = (F.lit(t).cast("timestamp") for t in ("2020-01-01 00:00:00", "2020-01-01 04:00:00"))
    expected = readers.rows(spark, [("a",), ("z",)], "k STRING")
    n = 4 * 3600 + 1
    got = repair.missing_slots(df, "k", F.col("t"), start, end, "1 second", expected)
    every = {dt.datetime(2020, 1, 1) + dt.timedelta(seconds=i) for i in range(n)}
    held = {"a": {dt.datetime(2020, 1, 1, 0, 0, 3)}, None: {dt.datetime(2020, 1, 1)}}
    found = {}
    for r in got.select("k", F.date_format("slot", "yyyy-MM-dd HH:mm:ss").alias("s")).collect():
        found.setdefault(r["k"], []).append(dt.datetime.fromisoformat(r["s"]))
    assert set(found) == {"a", "b", "z", None}
    for k, slots in found.items():
        assert len(slots) == len(set(slots)) and set(slots) == every - held.get(k, set())
    report = {r["k"]: (r["expected"], r["actual"], r["missing"]) for r in repair.missing_report(df, "k", F.col("t"), start, end, "1 second", expected).collect()}
    assert report == {"a": (n, 2, n - 2), "b": (n, 0, n), "z": (n, 0, n), None: (n, 1, n - 1)}


def test_missing_months_and_days(spark):
    df = readers.rows(spark, [("a", "2020-03-01"), ("a", "2020-05-01")], "k STRING, d STRING").withColumn("d", F.col("d").cast("date"))
    start, end = F.lit("2020-01-01").cast("date"), F.lit("2020-06-01").cast("date")
    got = repair.missing_slots(df, "k", F.col("d"), start, end, "1 month")
    assert sorted(str(r["slot"]) for r in got.collect()) == ["2020-01-01", "2020-02-01", "2020-04-01", "2020-06-01"]
    week = repair.missing_slots(df, "k", F.col("d"), F.lit("2020-02-28").cast("date"), F.lit("2020-03-08").cast("date"), "2 days")
    assert sorted(str(r["slot"]) for r in week.collect()) == ["2020-02-28", "2020-03-03", "2020-03-05", "2020-03-07"]
    with pytest.raises(ValueError, match="whole days"):
        repair.missing_slots(df, "k", F.col("d"), start, end, "5 hours")


def test_a_bounded_preview_holds_a_sample_of_all_batches(spark, home):
    for day in range(4):
        writers.write_lines(readings_of(spark, [day]).coalesce(1), f"{home}/raw", "append")
    stream = readers.text_stream(spark, f"{home}/raw")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{home}/raw") if stream.columns == ["value"] else stream
    query = sinks.preview(stream, "bounded", rows=10).option("checkpointLocation", f"{home}/c")
    control.finish(query.trigger(availableNow=True).start())
    shown = spark.table("bounded")
    assert shown.count() == 10 and shown.columns == stream.columns
    days = {r[0] for r in shown.select((F.get_json_object("value", "$.time").cast("double") / 86400).cast("int")).collect()}
    assert len(days) > 1
