"""Projections, filters, joins, merges, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators import aggregates, joins, merge, ordering, repair, transforms
from siltbed.plans.registry import query, r6, r9, table
from siltbed.scratch import materialize

# --- projections and filters ---------------------------------------------------------------


@query(
    "ingest_metadata",
    "SELECT 'events' AS datasource, props AS value, true AS stamped FROM events",
)
def _(spark, sf):
    raw = table(spark, sf, "events").select(F.col("props").alias("value"))
    out = transforms.ingest_metadata(raw, "events")
    same_day = F.col("ingesttime").cast("date") == F.col("p_ingestdate")
    return out.select("datasource", "value", same_day.alias("stamped"))


def readings(spark, sf):
    """Events as device readings, one for one: user = device, value - 50 = reading, the event's number
    in the name, and the time to the microsecond."""
    time = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("int").alias("device_id"),
        time.alias("t"),
        (F.col("value") - 50).alias("heartrate"),
        F.concat(F.lit("reading "), "event_id").alias("name"),
        F.get_json_object("props", "$.k").alias("device_type"),
        (F.unix_micros(time) / 1e6).alias("time"),
    )


def as_lines(rows, with_type=False):
    """Readings as raw JSON lines."""
    kind = ["device_type"] if with_type else []
    return rows.select(
        F.to_json(F.struct("device_id", "heartrate", *kind, "name", "time")).alias("value")
    )


READINGS_SQL = """SELECT CAST(user_id AS INTEGER) AS device_id, date_trunc('second', ts) AS t, ts, event_id,
    value - 50 AS hr, 'reading ' || event_id AS name, json_extract_string(props, '$.k') AS device_type FROM events"""

GOLD_SQL = f"""WITH r AS ({READINGS_SQL}),
    w AS (SELECT *, lag(hr) OVER (PARTITION BY device_id ORDER BY ts, event_id) AS p,
                    lead(hr) OVER (PARTITION BY device_id ORDER BY ts, event_id) AS n FROM r),
    s AS (SELECT device_id, CASE WHEN hr < 0 THEN (p + n) / 2 ELSE hr END AS hr FROM w)
    SELECT device_id, round(avg(hr), 9) AS mean_heartrate, round(stddev(hr), 6) AS std_heartrate,
           round(max(hr), 6) AS max_heartrate FROM s GROUP BY device_id"""


def rounded_gold(gold):
    return gold.select(
        "device_id",
        r9("mean_heartrate").alias("mean_heartrate"),
        r6("std_heartrate").alias("std_heartrate"),
        r6("max_heartrate").alias("max_heartrate"),
    )


@query(
    "parse_json_v1",
    f"""SELECT device_id, round(hr, 6) AS heartrate, t AS eventtime, name, CAST(t AS DATE) AS p_eventdate
        FROM ({READINGS_SQL})""",
)
def _(spark, sf):
    out = transforms.parse_readings(as_lines(readings(spark, sf)))
    return out.withColumns(
        {"heartrate": r6("heartrate"), "eventtime": F.date_trunc("second", "eventtime").cast("timestamp_ntz")}
    )


@query(
    "parse_json_v2",
    f"""SELECT device_id, device_type, round(hr, 6) AS heartrate, t AS eventtime, name,
               CAST(t AS DATE) AS p_eventdate FROM ({READINGS_SQL})""",
)
def _(spark, sf):
    lines = as_lines(readings(spark, sf), with_type=True)
    out = transforms.parse_readings(lines, with_type=True)
    return out.withColumns(
        {"heartrate": r6("heartrate"), "eventtime": F.date_trunc("second", "eventtime").cast("timestamp_ntz")}
    )


@query("rename_col", "SELECT c_custkey AS customer_id, c_name FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name").withColumnRenamed(
        "c_custkey", "customer_id"
    )


@query("drop_col", "SELECT p_partkey, p_brand, p_size FROM part")
def _(spark, sf):
    return table(spark, sf, "part").drop("p_name", "p_type", "p_retailprice")


@query("alias", "SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance")
    )


@query("select_cols", "SELECT p_brand, p_retailprice FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_retailprice")


@query("select_star", "SELECT * FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("*")


@query("filter_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def _(spark, sf):
    return transforms.negative(table(spark, sf, "customer"), "c_acctbal").select(
        "c_custkey", "c_acctbal"
    )


@query(
    "filter_last_n_days",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) > CAST('2001-08-01' AS DATE) - 30",
)
def _(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return transforms.last_n_days(table(spark, sf, "orders"), day, "2001-08-01", 30).select(
        "o_orderkey"
    )


@query(
    "filter_params",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_custkey = 7 AND o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'""",
)
def _(spark, sf):
    return transforms.with_params(
        spark,
        """SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}
           WHERE o_custkey = :wallet AND o_orderdate >= to_timestamp_ntz(:start)""",
        {"wallet": 7, "start": "1996-01-01"},
        orders=table(spark, sf, "orders"),
    )


@query("temp_view", "SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal < 0 GROUP BY c_mktsegment")
def _(spark, sf):
    transforms.negative(table(spark, sf, "customer"), "c_acctbal").createOrReplaceTempView(
        "broken_balances"
    )
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM broken_balances GROUP BY c_mktsegment")


# --- joins and merges ------------------------------------------------------------------------


@query(
    "join_inner_using",
    """SELECT e.event_id, e.user_id, round(g.m, 9) AS mean_value FROM events e
       JOIN (SELECT user_id, avg(value) AS m FROM events GROUP BY user_id) g ON e.user_id = g.user_id
       WHERE CAST(e.ts AS DATE) > CAST('2024-01-31' AS DATE) - 7""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    mean = e.groupBy("user_id").agg(F.avg("value").alias("m"))
    recent = F.col("ts").cast("date") > F.date_sub(F.lit("2024-01-31").cast("date"), 7)
    out = joins.attach_aggregate(e, mean, "user_id", recent)
    return out.select("event_id", "user_id", r9("m").alias("mean_value"))


@query(
    "join_broadcast",
    "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return joins.lookup(c, n, c.c_nationkey == n.n_nationkey).select("c_custkey", "n_name")


@query(
    "join_positional",
    """WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn FROM customer),
            b AS (SELECT p_partkey, row_number() OVER (ORDER BY p_name, p_partkey) AS rn FROM part)
       SELECT c_custkey, p_partkey FROM a JOIN b USING (rn)""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    out = joins.positional(c, ["c_acctbal", "c_custkey"], p, ["p_name", "p_partkey"])
    return out.select("c_custkey", "p_partkey")


@query(
    "join_by_id",
    """SELECT e.event_id, e.value, w.word FROM events e
       JOIN (SELECT event_id, upper(event_type) AS word FROM events) w USING (event_id)""",
)
def _(spark, sf):
    e = table(spark, sf, "events")
    words = e.select("event_id", F.upper("event_type").alias("word"))
    return joins.by_id(e.select("event_id", "value"), words, "event_id")


@query(
    "merge_update",
    """WITH u AS (SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer WHERE c_acctbal < 0)
       SELECT t.c_custkey, CASE WHEN u.c_custkey IS NOT NULL THEN u.c_acctbal ELSE t.c_acctbal END AS c_acctbal
       FROM customer t LEFT JOIN u ON t.c_custkey = u.c_custkey""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    updates = transforms.negative(c, "c_acctbal").withColumn("c_acctbal", F.abs("c_acctbal"))
    return merge.merge_update(c, updates, ["c_custkey"], {"c_acctbal": "c_acctbal"})


@query(
    "merge_insert_new",
    """WITH tgt AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus <> 'P'),
            src AS (SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 200000)
       SELECT * FROM tgt UNION ALL SELECT * FROM src
       WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey)""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    have = o.where("o_orderstatus <> 'P'").select("o_orderkey", "o_custkey")
    late = o.where("o_totalprice > 200000").select("o_orderkey", "o_custkey")
    return merge.merge_insert_new(have, late, ["o_orderkey"])


@query(
    "merge_general",
    """WITH tgt AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'),
            src AS (SELECT o_orderkey, -o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT')
       SELECT t.o_orderkey, CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.price END AS o_totalprice
       FROM tgt t LEFT JOIN src s ON t.o_orderkey = s.o_orderkey
       UNION ALL
       SELECT o_orderkey, price FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.o_orderkey = src.o_orderkey)""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    have = o.where("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    urgent = o.where("o_orderpriority = '1-URGENT'").select(
        "o_orderkey", (-F.col("o_totalprice")).alias("o_totalprice")
    )
    return merge.merge_into(
        have, urgent, ["o_orderkey"], {"o_totalprice": "o_totalprice"}, insert_new=True
    )


@query(
    "join_outer_compare",
    """WITH a AS (SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'),
            b AS (SELECT c_custkey, abs(c_acctbal) AS c_acctbal FROM customer WHERE c_mktsegment <> 'MACHINERY')
       SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, a.c_acctbal AS c_acctbal_a, b.c_acctbal AS c_acctbal_b,
              CASE WHEN b.c_custkey IS NULL THEN 'only_a' WHEN a.c_custkey IS NULL THEN 'only_b'
                   WHEN a.c_acctbal IS NOT DISTINCT FROM b.c_acctbal THEN 'same' ELSE 'changed' END AS verdict
       FROM a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey""",
)
def _(spark, sf):
    c = table(spark, sf, "customer")
    a = c.where("c_mktsegment <> 'BUILDING'").select("c_custkey", "c_acctbal")
    b = c.where("c_mktsegment <> 'MACHINERY'").select(
        "c_custkey", F.abs("c_acctbal").alias("c_acctbal")
    )
    return joins.outer_compare(a, b, ["c_custkey"], ["c_acctbal"])


# --- aggregates --------------------------------------------------------------------------------


@query("count_all", "SELECT count(*) AS n_rows FROM lineitem")
def _(spark, sf):
    return aggregates.count_all(table(spark, sf, "lineitem"))


@query("count_by_key", "SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id")
def _(spark, sf):
    return aggregates.count_by_key(table(spark, sf, "events"), "user_id")


@query(
    "broken_per_day",
    """SELECT CAST(ts AS DATE) AS day, count(value - 50) AS n_broken FROM events
       WHERE value - 50 < 0 GROUP BY CAST(ts AS DATE)""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("day"), (F.col("value") - 50).alias("heartrate")
    )
    return aggregates.broken_per_key(e, "day", "heartrate").withColumnRenamed(
        "count(heartrate)", "n_broken"
    )


@query(
    "sum_of_counts",
    """SELECT CAST(sum(n) AS BIGINT) AS n_broken FROM
       (SELECT count(c_acctbal) AS n FROM customer WHERE c_acctbal < 0 GROUP BY c_nationkey)""",
)
def _(spark, sf):
    broken = aggregates.broken_per_key(table(spark, sf, "customer"), "c_nationkey", "c_acctbal")
    return broken.agg(F.sum("count(c_acctbal)").alias("n_broken"))


@query(
    "gold_stats",
    """SELECT user_id, round(avg(value), 9) AS mean_value, round(stddev(value), 6) AS std_value,
              max(value) AS max_value FROM events GROUP BY user_id""",
)
def _(spark, sf):
    gold = aggregates.key_stats(table(spark, sf, "events"), "user_id", "value")
    return gold.withColumns({"mean_value": r9("mean_value"), "std_value": r6("std_value")})


@query(
    "avg_sorted",
    "SELECT p_brand, round(avg(p_retailprice), 9) AS avg_price FROM part GROUP BY p_brand ORDER BY p_brand",
)
def _(spark, sf):
    out = aggregates.average_sorted(table(spark, sf, "part"), "p_brand", "p_retailprice")
    return out.select("p_brand", r9("avg_p_retailprice").alias("avg_price"))


@query(
    "missing_report",
    """WITH a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')
       SELECT user_id, CAST(30 AS BIGINT) AS expected, count(*) AS actual, 30 - count(*) AS missing FROM a GROUP BY user_id""",
)
def _(spark, sf):
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")
    return repair.missing_report(
        table(spark, sf, "events"), "user_id", F.col("ts").cast("date"), first, last, "1 day"
    )


@query(
    "missing_slots",
    """WITH u AS (SELECT DISTINCT user_id FROM events),
            d AS (SELECT CAST(x AS DATE) AS slot FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) t(x)),
            a AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS slot FROM events)
       SELECT u.user_id, d.slot FROM u CROSS JOIN d LEFT JOIN a ON a.user_id = u.user_id AND a.slot = d.slot WHERE a.user_id IS NULL""",
)
def _(spark, sf):
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")
    return repair.missing_slots(
        table(spark, sf, "events"), "user_id", F.col("ts").cast("date"), first, last, "1 day"
    )


@query(
    "missing_expected",
    """WITH a AS (SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS actual FROM events
                  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY user_id),
            k AS (SELECT user_id FROM events UNION SELECT c_custkey FROM customer)
       SELECT k.user_id, CAST(30 AS BIGINT) AS expected, coalesce(actual, 0) AS actual, 30 - coalesce(actual, 0) AS missing
       FROM k LEFT JOIN a ON a.user_id = k.user_id""",
)
def _(spark, sf):
    """Customers are the expected keys; most of them have no event at all."""
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-30").cast("date")
    return repair.missing_report(
        table(spark, sf, "events"), "user_id", F.col("ts").cast("date"), first, last, "1 day", table(spark, sf, "customer").select("c_custkey")
    )


@query(
    "null_profile",
    """SELECT 'c_custkey' AS col_name, count(*) - count(c_custkey) AS n_null FROM customer
       UNION ALL SELECT 'c_nationkey', count(*) - count(c_nationkey) FROM customer
       UNION ALL SELECT 'balance', count(*) FILTER (WHERE c_acctbal < 0) FROM customer""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", F.expr("CASE WHEN c_acctbal >= 0 THEN c_acctbal END").alias("balance")
    )
    return aggregates.null_profile(c)


@query("partition_counts", "SELECT count(*) AS n_rows, true AS each_once FROM lineitem")
def _(spark, sf):
    """How rows lie in partitions differs from run to run; their sum does not."""
    n = aggregates.partition_counts(table(spark, sf, "lineitem"))
    part, rows = n.columns
    return n.agg(F.sum(rows).alias("n_rows"), (F.count_distinct(part) == F.count("*")).alias("each_once"))


# --- windows, sorts, set operations --------------------------------------------------------------


@query(
    "interpolate_neighbors",
    """SELECT event_id, user_id, ts, round((p + n) / 2, 6) AS hr FROM
         (SELECT event_id, user_id, ts, value - 50 AS hr,
                 lag(value - 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
                 lead(value - 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) t
       WHERE hr < 0""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", (F.col("value") - 50).alias("hr")
    )
    out = repair.interpolate_neighbors(e, "user_id", "ts", "hr", tie=("event_id",))
    return out.withColumn("hr", r6("hr"))


@query(
    "interpolate_few",
    """SELECT event_id, round((p + n) / 2, 6) AS hr FROM
         (SELECT event_id, 200 - value AS hr, lag(200 - value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
                 lead(200 - value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) t
       WHERE hr < 0""",
)
def _(spark, sf):
    """Only the highest values are broken here."""
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", (F.lit(200) - F.col("value")).alias("hr")
    )
    out = repair.interpolate_neighbors(e, "user_id", "ts", "hr", tie=("event_id",))
    return out.select("event_id", r6("hr").alias("hr"))


@query(
    "row_number_global",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_num FROM orders",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_totalprice", "o_orderkey")
    return ordering.row_number_global(o, ["o_totalprice", "o_orderkey"]).drop("o_totalprice")


@query(
    "latest_by_key",
    """SELECT user_id, event_id, event_type, value FROM
         (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
       WHERE rn = 1""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return ordering.latest_by_key(e, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("sort_asc", "SELECT p_partkey, p_size FROM part ORDER BY p_size, p_partkey")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size").orderBy("p_size", "p_partkey")


@query("sort_desc", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def _(spark, sf):
    return (
        table(spark, sf, "part")
        .select("p_partkey", "p_retailprice")
        .orderBy(F.desc("p_retailprice"), "p_partkey")
    )


@query("sort_limit", "SELECT event_id, value FROM events ORDER BY event_id LIMIT 300")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value")
    return ordering.top_k(e, [F.col("event_id")], 300)


@query(
    "top_k_by_metric",
    """SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 10""",
)
def _(spark, sf):
    n = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n"))
    return ordering.top_k(n, [F.desc("n"), F.asc("l_suppkey")], 10)


@query(
    "df_equal",
    """WITH a AS (SELECT l_suppkey, l_quantity FROM lineitem),
            b AS (SELECT l_suppkey, least(l_quantity, 49) AS l_quantity FROM lineitem)
       SELECT l_suppkey, l_quantity, CAST(sum(s) AS BIGINT) AS surplus FROM
         (SELECT *, 1 AS s FROM a UNION ALL SELECT *, -1 AS s FROM b)
       GROUP BY l_suppkey, l_quantity HAVING sum(s) <> 0""",
)
def _(spark, sf):
    a = table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    b = a.withColumn("l_quantity", F.least("l_quantity", F.lit(49.0)))
    return aggregates.table_diff(a, b)


@query(
    "append_union",
    """SELECT c_custkey AS k, c_acctbal AS bal, CAST(NULL AS VARCHAR) AS s_name FROM customer
       UNION ALL SELECT s_suppkey, s_acctbal, s_name FROM supplier""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey AS k", "c_acctbal AS bal")
    s = table(spark, sf, "supplier").selectExpr("s_suppkey AS k", "s_acctbal AS bal", "s_name")
    return aggregates.append_union(c, s, evolve=True)


# --- the flagship: raw JSON to gold in one batch -----------------------------------------------


@query("flagship_gold", GOLD_SQL)
def flagship(spark, sf):
    """Raw JSON readings through bronze and silver, repaired, to per-device statistics.

    Silver is stored, so each line is parsed once and the repair scans three typed columns.
    """
    bronze = transforms.ingest_metadata(as_lines(readings(spark, sf)))
    silver = materialize(transforms.parse_readings(bronze), "silver")
    return rounded_gold(aggregates.key_stats(repair.repaired(silver, tie=("name",)), "device_id", "heartrate"))


@query(
    "repair_job",
    """WITH w AS (SELECT event_id, value - 50 AS hr,
                         lag(value - 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p,
                         lead(value - 50) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
       SELECT event_id, round(CASE WHEN hr < 0 THEN (p + n) / 2 ELSE hr END, 6) AS hr FROM w""",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts", (F.col("value") - 50).alias("hr")
    )
    updates = repair.interpolate_neighbors(e, "user_id", "ts", "hr", tie=("event_id",))
    out = merge.merge_update(e, updates, ["event_id"], {"hr": "hr"})
    return out.select("event_id", r6("hr").alias("hr"))
