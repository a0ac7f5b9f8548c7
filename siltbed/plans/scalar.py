"""One query per scalar function, plus the feature columns made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.functions import columns as fn
from siltbed.plans.registry import query, r6, table


@query("fn_lit", "SELECT 'files' AS datasource, 7 AS seven, c_custkey FROM customer")
def _(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(F.lit("files").alias("datasource"), F.lit(7).alias("seven"), "c_custkey")


@query("fn_alias", "SELECT n_name AS nation FROM nation")
def _(spark, sf):
    return table(spark, sf, "nation").select(F.col("n_name").alias("nation"))


@query("fn_col", "SELECT r_name FROM region")
def _(spark, sf):
    return table(spark, sf, "region").select(F.col("r_name"))


@query(
    "fn_now",
    "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_instants, true AS after_all FROM events",
)
def _(spark, sf):
    """One instant for all rows of a query, later than every event."""
    e = table(spark, sf, "events").select("ts", F.current_timestamp().alias("now"))
    after = F.min(F.col("now").cast("timestamp_ntz") > F.col("ts"))
    return e.agg(F.count("*").alias("n_rows"), F.count_distinct("now").alias("n_instants"), after.alias("after_all"))


@query("fn_from_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _(spark, sf):
    parsed = F.from_json("props", "k INT")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "fn_from_unixtime",
    "SELECT event_id, date_trunc('second', ts) AS t, CAST(ts AS DATE) AS d FROM events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select(
        "event_id", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("s")
    )
    return e.select(
        "event_id",
        fn.epoch_to_timestamp("s").cast("timestamp_ntz").alias("t"),
        fn.epoch_to_date("s").alias("d"),
    )


@query(
    "fn_cast",
    """SELECT event_id, CAST(ts AS DATE) AS d, CAST(trunc(value) AS INTEGER) AS i,
              CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x FROM events""",
)
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        F.col("ts").cast("date").alias("d"),
        F.col("value").cast("int").alias("i"),
        F.get_json_object("props", "$.k").cast("double").alias("x"),
    )


@query(
    "fn_arith",
    """SELECT p_partkey, round((p_retailprice + p_size) / 2, 6) AS mid,
              CASE WHEN p_size % 10 = 0 THEN NULL ELSE round(p_retailprice / (p_size % 10), 6) END AS per
       FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        r6(fn.midpoint("p_retailprice", "p_size")).alias("mid"),
        r6(fn.ratio("p_retailprice", F.col("p_size") % 10)).alias("per"),
    )


@query("fn_date_sub", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - 30 AS DATE) AS d FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.date_sub(F.col("o_orderdate").cast("date"), 30).alias("d")
    )


@query(
    "fn_round",
    "SELECT l_suppkey, round(l_extendedprice / 7, 2) AS up, round_even(l_quantity / 8, 2) AS even FROM lineitem",
)
def _(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_suppkey",
        F.round(F.col("l_extendedprice") / 7, 2).alias("up"),
        F.bround(F.col("l_quantity") / 8, 2).alias("even"),
    )


@query("fn_format_number", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS shown FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.format_number("o_totalprice", 2).alias("shown")
    )


@query("fn_concat", "SELECT p_partkey, concat(p_brand, '/', p_type) AS label FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("label")
    )


@query("fn_regexp_price", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", fn.price_to_text("o_totalprice").alias("p"))
    return o.select("o_orderkey", fn.price_to_double("p").alias("price"))


@query(
    "fn_when",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS balance FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("balance"),
    )


@query("fn_ltrim", "SELECT p_partkey, ltrim('  ' || p_name) AS t FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.ltrim(F.concat(F.lit("  "), "p_name")).alias("t")
    )


@query(
    "fn_initcap",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
              lambda w: upper(w[1:1]) || lower(w[2:])), ' ') AS t FROM part""",
)
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.initcap("p_name").alias("t"))


@query(
    "fn_split",
    "SELECT p_partkey, array_to_string(string_split(p_name, ' '), '|') AS words, len(string_split(p_name, ' ')) AS n FROM part",
)
def _(spark, sf):
    words = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(words, "|").alias("words"), F.size(words).cast("bigint").alias("n")
    )


@query("fn_date_format", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t")
    )


@query(
    "fn_hash",
    "SELECT count(DISTINCT p_name) AS n_names, CAST(0 AS BIGINT) AS n_with_two, true AS told_apart FROM part",
)
def _(spark, sf):
    """Equal names have one hash, and nearly all different names have different ones."""
    h = table(spark, sf, "part").select("p_name", fn.stable_hash("p_name").alias("h"))
    per_name = h.groupBy("p_name").agg(F.count_distinct("h").alias("n"), F.min("h").alias("h"))
    return per_name.agg(
        F.count("*").alias("n_names"),
        F.count_if(F.col("n") > 1).alias("n_with_two"),
        (F.count_distinct("h") >= 0.999 * F.count("*")).alias("told_apart"),
    )


@query(
    "fn_rand",
    "SELECT count(*) AS n_rows, true AS in_range, true AS differ, true AS centred FROM events",
)
def _(spark, sf):
    r = table(spark, sf, "events").select(F.rand(42).alias("r"))
    return r.agg(
        F.count("*").alias("n_rows"),
        F.min(F.col("r").between(0, 1)).alias("in_range"),
        (F.count_distinct("r") > 0.99 * F.count("*")).alias("differ"),
        F.avg("r").between(0.45, 0.55).alias("centred"),
    )


@query(
    "null_inject",
    "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed, true AS a_fifth FROM events",
)
def _(spark, sf):
    """A fifth of the values becomes NULL, the others stay as they are."""
    e = table(spark, sf, "events").select("value", fn.null_share("value", 0.2, 42).alias("holed"))
    gone = F.avg(F.col("holed").isNull().cast("int")) - F.avg(F.col("value").isNull().cast("int"))
    return e.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("holed") != F.col("value")).alias("n_changed"),
        gone.between(0.15, 0.25).alias("a_fifth"),
    )


@query(
    "fn_row_sum",
    """SELECT l_suppkey, round(coalesce(l_quantity, 0) + coalesce(CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END, 0)
              + coalesce(l_tax, 0), 6) AS total FROM lineitem""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumn(
        "l_discount", F.expr("CASE WHEN l_discount > 0.05 THEN NULL ELSE l_discount END")
    )
    total = fn.row_sum(["l_quantity", "l_discount", "l_tax"])
    return li.select("l_suppkey", r6(total).alias("total"))


@query(
    "fn_threshold_label",
    "SELECT event_id, CASE WHEN value > 100 THEN 'Expensive' ELSE 'Not Expensive' END AS label FROM events",
)
def _(spark, sf):
    label = fn.threshold_label("value", 100, "Expensive", "Not Expensive")
    return table(spark, sf, "events").select("event_id", label.alias("label"))


@query("fn_add_n", "SELECT s_suppkey + 5 AS s_suppkey, s_nationkey + 5 AS s_nationkey FROM supplier")
def _(spark, sf):
    return fn.add_to_all(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), 5)


@query(
    "fn_name_sanitize",
    "SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g') AS name FROM customer",
)
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", fn.name_sanitize("c_name").alias("name"))
