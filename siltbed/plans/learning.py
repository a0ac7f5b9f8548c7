"""Features, metrics, models, run log and registry on listings derived from the orders table."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from siltbed.functions import columns as fn
from siltbed.ml import features, models, monitor, registry, runlog, workflow
from siltbed.operators import ordering, versions
from siltbed.operators.schemas import SchemaMismatch
from siltbed.plans.registry import query, r6, table
from siltbed.scratch import fresh_dir, materialize

PRIORITY_RANKS = {"5-LOW": 0, "4-NOT SPECIFIED": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}
INPUTS = ["accommodates", "beds", "bathrooms", "review_scores_rating", "strictness", "bookable", "month"]


def listings(spark, sf):
    """Orders as listings: a price to predict, counts with gaps, flags and categories."""
    items = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("beds"), F.avg("l_quantity").alias("review_scores_rating"))
    )
    o = table(spark, sf, "orders").join(items, "o_orderkey", "left")
    return o.select(
        F.col("o_orderkey").alias("id"),
        fn.price_to_text("o_totalprice").alias("price"),
        (F.col("o_custkey") % 6 + 1).cast("int").alias("accommodates"),
        F.col("beds").cast("double").alias("beds"),
        F.when(F.col("o_custkey") % 5 > 0, (F.col("o_custkey") % 5).cast("double")).alias("bathrooms"),
        "review_scores_rating",
        F.when(F.col("o_orderstatus") == "F", "t").otherwise("f").alias("instant_bookable"),
        F.col("o_orderpriority").alias("priority"),
        F.month("o_orderdate").alias("month"),
    )


def numeric_listings(spark, sf):
    """Listings with every model input numeric; review scores filled, counts left with gaps."""
    out = listings(spark, sf).select(
        "id",
        fn.price_to_double("price").alias("price"),
        "accommodates",
        "beds",
        "bathrooms",
        "review_scores_rating",
        features.ordinal("priority", PRIORITY_RANKS).alias("strictness"),
        features.binary_flag("instant_bookable").alias("bookable"),
        "month",
    )
    return features.impute_constant(out, ["review_scores_rating"])


def split_and_filled(spark, sf):
    """Train and test rows, gaps in the counts filled with the train medians.

    The features are stored first: training reads its rows many times.
    """
    rows = materialize(numeric_listings(spark, sf), "features")
    train, test = features.split_train_test(rows, ["id"], 0.8)
    fill = features.medians(train, ["beds", "bathrooms"])
    return features.impute(train, fill), features.impute(test, fill)


# --- features -------------------------------------------------------------------------------------


@query(
    "split_train_test",
    "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN 'train' ELSE 'test' END AS side FROM events",
)
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id")
    train, test = features.split_by(e, F.col("event_id") % 4 < 3)
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query(
    "split_train_test_hash",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_on_both_sides, true AS share_near_80 FROM events",
)
def _(spark, sf):
    """Every row on exactly one side, however the input is partitioned."""
    e = table(spark, sf, "events").select("event_id")
    train, test = features.split_train_test(e, ["event_id"], 0.8)
    again, _test = features.split_train_test(e.repartition(13), ["event_id"], 0.8)
    sides = train.select("event_id", F.lit(1).alias("s")).unionAll(test.select("event_id", F.lit(2).alias("s")))
    sides = sides.unionAll(again.select("event_id", F.lit(1).alias("s")))
    per_row = sides.groupBy("event_id").agg(F.count_distinct("s").alias("n"), F.min("s").alias("s"))
    return per_row.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("n") > 1).alias("n_on_both_sides"),
        F.avg(F.when(F.col("s") == 1, 1.0).otherwise(0.0)).between(0.7, 0.9).alias("share_near_80"),
    )


@query("feat_price_clean", "SELECT o_orderkey AS id, o_totalprice AS price FROM orders")
def _(spark, sf):
    return listings(spark, sf).select("id", fn.price_to_double("price").alias("price"))


@query("feat_binary", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS done FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", features.binary_flag("o_orderstatus", "F").alias("done")
    )


@query(
    "feat_ordinal",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
              WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 END AS strictness FROM orders""",
)
def _(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", features.ordinal("o_orderpriority", PRIORITY_RANKS).alias("strictness")
    )


@query(
    "feat_one_hot",
    """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS BIGINT) AS "st_F", CAST(o_orderstatus = 'O' AS BIGINT) AS "st_O",
              CAST(o_orderstatus = 'P' AS BIGINT) AS "st_P" FROM orders""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return features.one_hot(o, "o_orderstatus", "st", ["F", "O", "P"])


@query(
    "feat_one_hot_sparse",
    """SELECT CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS place, count(*) AS n FROM part GROUP BY p_name""",
)
def _(spark, sf):
    """A category with thousands of levels: the places that the sparse vectors set, and how often."""
    coded = features.one_hot_sparse(table(spark, sf, "part").select("p_name"), {"p_name": "name"})
    total = coded.agg(Summarizer.sum(F.col("name")).alias("total"))
    places = total.select(F.posexplode(vector_to_array("total")).alias("place", "n"))
    return places.where("n > 0").select("place", F.col("n").cast("bigint").alias("n"))


@query("feat_drop", "SELECT o_orderkey, o_totalprice FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").drop("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


@query(
    "feat_round_geo",
    "SELECT p_partkey, round_even(p_size / 8, 2) AS trunc_lat, round_even(p_retailprice / 16, 2) AS trunc_long FROM part",
)
def _(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", (F.col("p_size") / 8).alias("latitude"), (F.col("p_retailprice") / 16).alias("longitude")
    )
    return features.rounded_place(p)


@query(
    "feat_row_sum",
    """SELECT l_suppkey, l_quantity, l_tax, round(coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END, 0) + l_tax, 6) AS review_scores_sum
       FROM lineitem""",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "l_quantity", "l_tax", "CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_quantity END AS q"
    )
    out = features.summed_reviews(li, ["q", "l_tax"]).drop("q")
    return out.withColumn("review_scores_sum", r6("review_scores_sum"))


@query(
    "impute_median",
    """SELECT c_custkey, round(coalesce(x, (SELECT median(c_acctbal) FROM customer WHERE c_acctbal >= 0)), 6) AS bal
       FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS x FROM customer) t""",
)
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal"
    )
    return features.impute(c, features.medians(c, ["bal"])).withColumn("bal", r6("bal"))


@query(
    "exact_quantiles",
    """SELECT 'l_quantity' AS "column", median(l_quantity) AS value FROM lineitem
       UNION ALL SELECT 'l_extendedprice', round(median(l_extendedprice), 6) FROM lineitem
       UNION ALL SELECT 'l_tax', round(median(l_tax), 6) FROM lineitem""",
)
def _(spark, sf):
    out = ordering.exact_quantiles(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_tax"])
    return out.withColumn("value", r6("value"))


@query(
    "impute_constant",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN -99 ELSE c_acctbal END AS score FROM customer",
)
def _(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS score"
    )
    return features.impute_constant(c, ["score"])


@query(
    "price_per_person",
    "SELECT p_partkey, CASE WHEN p_size % 7 = 0 THEN NULL ELSE round(p_retailprice / (p_size % 7), 6) END AS per_person FROM part",
)
def _(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_retailprice").alias("prediction"), (F.col("p_size") % 7).alias("accommodates")
    )
    return p.select("p_partkey", r6(models.price_per_person()).alias("per_person"))


# --- metrics ---------------------------------------------------------------------------------------


def _mean_model(spark, sf):
    """Order price in thousands, predicted by the mean of its priority."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("y"))
    mean = o.groupBy("o_orderpriority").agg(F.avg("y").alias("p"))
    return o.join(mean, "o_orderpriority")


@query(
    "eval_regression",
    """SELECT round(avg((y - p) * (y - p)), 4) AS mse, round(avg(abs(y - p)), 6) AS mae,
              round(1 - sum((y - p) * (y - p)) / sum((y - m) * (y - m)), 6) AS r2
       FROM (SELECT o_totalprice / 1000 AS y, avg(o_totalprice / 1000) OVER (PARTITION BY o_orderpriority) AS p,
                    avg(o_totalprice / 1000) OVER () AS m FROM orders) t""",
)
def _(spark, sf):
    out = models.eval_regression(_mean_model(spark, sf), "y", "p")
    return out.select(F.round("mse", 4).alias("mse"), r6("mae").alias("mae"), r6("r2").alias("r2"))


@query(
    "residuals",
    """SELECT round(p, 4) AS predicted, round(y - p, 4) AS residual FROM
         (SELECT o_totalprice / 1000 AS y, avg(o_totalprice / 1000) OVER (PARTITION BY o_orderpriority) AS p FROM orders) t""",
)
def _(spark, sf):
    out = models.residuals(_mean_model(spark, sf), "y", "p")
    return out.select(F.round("predicted", 4).alias("predicted"), F.round("residual", 4).alias("residual"))


# --- models (row checks: the library's trees have no SQL twin) --------------------------------------


def _known_price(rows):
    """A price that some inputs tell: what a model has to find."""
    told = 100.0 * F.col("accommodates") + 60.0 * F.col("strictness") + 10.0 * F.col("month")
    return rows.withColumn("price", told)


def _known_split(spark, sf):
    train, test = split_and_filled(spark, sf)
    return _known_price(train), _known_price(test)


def _beats_mean(scored, least=0.5):
    """(n_rows, beats_mean): the share of the price's variance that the predictions explain."""
    out = models.eval_regression(scored, "price", "prediction").select((F.col("r2") > least).alias("beats_mean"))
    return scored.agg(F.count("prediction").alias("n_rows")).withColumn("_one", F.lit(1)).join(out.withColumn("_one", F.lit(1)), "_one").drop("_one")


BEATS_SQL = "SELECT count(*) AS n_rows, true AS beats_mean FROM orders"


@query("preprocess_and_train", BEATS_SQL)
def _(spark, sf):
    """Imputation, assembly and forest; every input reaches the model, every row gets a price."""
    train, test = _known_split(spark, sf)
    model = models.train_random_forest(train, INPUTS, num_trees=10, max_depth=6)
    return _beats_mean(model.transform(train.unionByName(test)))


@query("train_random_forest", "SELECT true AS beats_mean")
def _(spark, sf):
    """On rows the forest has not seen."""
    train, test = _known_split(spark, sf)
    model = models.train_random_forest(train, INPUTS, num_trees=10, max_depth=6)
    return _beats_mean(model.transform(test)).drop("n_rows")


@query("train_gbt", "SELECT true AS beats_mean")
def _(spark, sf):
    train, test = _known_split(spark, sf)
    model = models.train_gbt(train, INPUTS, max_iter=10, max_depth=3)
    return _beats_mean(model.transform(test)).drop("n_rows")


@query(
    "grid_search",
    "SELECT CAST(4 AS BIGINT) AS n_tried, CAST(4 AS BIGINT) AS n_params, true AS deeper_is_better, true AS best_beats_mean",
)
def _(spark, sf):
    """Four parameter sets; three inputs tell the price, so one split cannot match five levels of them."""
    train, _test = _known_split(spark, sf)
    found = models.grid_search(train, INPUTS, ["id"], num_trees=[4, 8], max_depth=[1, 5])
    scores = models.grid_scores(spark, found)
    depth = F.get_json_object("params", "$.maxDepth").cast("int")
    best = lambda d: F.max(F.when(depth == d, F.col("r2")))
    return scores.agg(
        F.count("*").alias("n_tried"), F.count_distinct("params").alias("n_params"),
        (best(5) > best(1)).alias("deeper_is_better"), (F.max("r2") > 0.5).alias("best_beats_mean"),
    )


@query(
    "feature_importance",
    f"SELECT CAST({len(INPUTS)} AS BIGINT) AS n_features, true AS sums_to_one, true AS telling_first",
)
def _(spark, sf):
    """The inputs that make the price weigh more than all others together."""
    train, _test = _known_split(spark, sf)
    found = models.feature_importance(spark, models.train_random_forest(train, INPUTS, num_trees=10, max_depth=6))
    told = F.sum(F.when(F.col("feature").isin("accommodates", "strictness", "month"), F.col("importance")).otherwise(0.0))
    return found.agg(
        F.count("*").alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"), (told > 0.5).alias("telling_first")
    )


def _stored_model(spark, train):
    path = fresh_dir(spark, "model")
    model = models.train_random_forest(train, INPUTS, num_trees=5, max_depth=4)
    models.save_model(model, path, train.select(*INPUTS).schema)
    return model, path


@query("model_save_load", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differ FROM orders")
def _(spark, sf):
    """Rows where the reloaded model disagrees with the one in memory: none."""
    train, test = split_and_filled(spark, sf)
    model, path = _stored_model(spark, train)
    every = train.unionByName(test)
    mine = model.transform(every).select("id", "prediction")
    theirs = models.score_batch(every, path).select("id", F.col("prediction").alias("again"))
    differs = ~F.col("prediction").eqNullSafe(F.col("again"))
    return mine.join(theirs, "id").agg(F.count("*").alias("n_rows"), F.count_if(differs).alias("n_differ"))


@query("score_batch", BEATS_SQL)
def _(spark, sf):
    train, test = _known_split(spark, sf)
    _model, path = _stored_model(spark, train)
    return _beats_mean(models.score_batch(train.unionByName(test), path))


@query("score_contract", "SELECT count(*) AS n_rows, true AS refused FROM orders")
def _(spark, sf):
    """Raw rows without the engineered columns are refused; prepared rows are all scored."""
    train, test = split_and_filled(spark, sf)
    _model, path = _stored_model(spark, train)
    every = train.unionByName(test)
    try:
        models.score_batch(every.drop("strictness"), path)
        refused = False
    except SchemaMismatch as exc:
        refused = "strictness" in str(exc)
    scored = models.score_batch(every, path).where("prediction IS NOT NULL")
    return scored.agg(F.count("*").alias("n_rows"), F.lit(refused).alias("refused"))


@query("workflow_three_step", "SELECT count(*) AS n_predictions, 'OK,OK,OK' AS statuses FROM orders")
def _(spark, sf):
    rows = numeric_listings(spark, sf)
    filled = features.impute(rows, features.medians(rows, ["beds", "bathrooms"]))
    steps = workflow.run_workflow(
        spark, filled, fresh_dir(spark, "workflow"), INPUTS, ["id"], num_trees=5, max_depth=4
    )
    statuses = ",".join(s["status"] for s in steps)
    return spark.read.parquet(steps[-1]["predictions_path"]).agg(
        F.count("prediction").alias("n_predictions"), F.lit(statuses).alias("statuses")
    )


@query("score_custom", "SELECT p_partkey, p_size, CAST(p_size + 5 AS DOUBLE) AS prediction FROM part")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size")
    return models.score_custom(p, lambda batch: batch["p_size"] + 5, ["p_size"])


@query("score_pre_post", "SELECT count(*) AS n_rows, true AS mostly_right, true AS both_labels FROM orders")
def _(spark, sf):
    """Labels of predictions agree with labels of the true price for most rows."""
    train, test = _known_split(spark, sf)
    _model, path = _stored_model(spark, train)
    bound = 530
    label = lambda c: fn.threshold_label(c, bound, "Expensive", "Not Expensive")
    out = models.score_pre_post(
        train.unionByName(test).withColumnRenamed("month", "order_month"),
        path,
        lambda df: df.withColumnRenamed("order_month", "month"),
        lambda df: df.select("id", label("price").alias("true_label"), label("prediction").alias("label")),
    )
    right = F.avg((F.col("label") == F.col("true_label")).cast("int"))
    return out.agg(
        F.count("label").alias("n_rows"), (right > 0.75).alias("mostly_right"), (F.count_distinct("label") == 2).alias("both_labels")
    )


# --- run log, registry, monitoring -------------------------------------------------------------------


def _event_runs(spark, sf):
    """Events in run-log shape: a run per event, an experiment per user, value as metric."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("user_id").cast("string").alias("experiment_id"),
        F.col("event_type").alias("run_name"),
        F.col("ts").cast("timestamp").alias("start_time"),
        F.create_map(F.lit("mse"), F.col("value")).alias("metrics"),
    )


@query(
    "run_log_search",
    """SELECT CAST(event_id AS VARCHAR) AS run_id, 'mse' AS metric, value FROM
       (SELECT * FROM events WHERE user_id = 7 ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC LIMIT 5)""",
)
def _(spark, sf):
    return runlog.run_metrics(runlog.search_runs(_event_runs(spark, sf), "7", 5))


@query(
    "run_log_append",
    "SELECT 'baseline' AS run_name, CAST(count(*) AS DOUBLE) AS n, round(avg(o_totalprice), 4) AS mean, '3' AS depth FROM orders",
)
def _(spark, sf):
    path = fresh_dir(spark, "runs")
    row = table(spark, sf, "orders").agg(F.count("*").alias("n"), F.avg("o_totalprice").alias("mean")).first()
    runlog.log_run(spark, path, "exp", "baseline", {"depth": 3}, row.asDict())
    return runlog.read_runs(spark, path).select(
        "run_name", F.col("metrics")["n"].alias("n"), F.round(F.col("metrics")["mean"], 4).alias("mean"),
        F.col("params")["depth"].alias("depth"),
    )


@query(
    "run_log_experiments",
    "SELECT CAST(user_id AS VARCHAR) AS experiment_id, count(*) AS n_runs FROM events GROUP BY user_id",
)
def _(spark, sf):
    return runlog.experiments(_event_runs(spark, sf)).drop("last_start")


@query(
    "best_run",
    """SELECT CAST(user_id AS VARCHAR) AS experiment_id, CAST(event_id AS VARCHAR) AS run_id, value AS mse FROM
         (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, CAST(event_id AS VARCHAR)) AS rn FROM events) WHERE rn = 1""",
)
def _(spark, sf):
    return runlog.best_run(_event_runs(spark, sf), "mse", by=("experiment_id",))


@query(
    "data_version_log",
    """SELECT CAST(count(*) AS VARCHAR) AS train_rows, 'struct<o_orderkey:bigint,o_totalprice:double>' AS train_schema,
              CAST(count(DISTINCT year(CAST(o_orderdate AS DATE))) - 1 AS BIGINT) AS data_version FROM orders""",
)
def _(spark, sf):
    """The training table has a commit per year; the run logs the newest one's number."""
    path, home = fresh_dir(spark, "runs"), fresh_dir(spark, "training")
    orders = table(spark, sf, "orders")
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())
    for batch, year in enumerate(years):
        rows = orders.where(F.year("o_orderdate") == year).select("o_orderkey", "o_totalprice")
        versions.commit(rows, home, "load", batch)
    train = versions.read_as_of(spark, home)
    tags = runlog.data_tags(train, "train")
    runlog.log_run(spark, path, "exp", "versions", {}, {}, tags, data_version=versions.latest_version(spark, home))
    return runlog.read_runs(spark, path).select(
        F.col("tags")["train_rows"].alias("train_rows"), F.col("tags")["train_schema"].alias("train_schema"),
        "data_version",
    )


def _event_registry(spark, sf, event, version, stage=None, description=None):
    """Events in registry shape: a model per user, what happened in order of event id."""
    text = lambda c: F.lit(None).cast("string") if c is None else c
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("model_name"),
        version.cast("int").alias("version"),
        event.alias("event"),
        text(stage).alias("stage"),
        text(description).alias("description"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("seq"),
    )


K = "CAST(get_json_object(props, '$.k') AS INT)"


@query(
    "registry_transition",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, event_type AS stage FROM
         (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) t WHERE rn = 1""",
)
def _(spark, sf):
    """A model's newest event is its stage."""
    events = _event_registry(spark, sf, F.lit("transition"), F.lit(1), stage=F.col("event_type"))
    return registry.current_state(events).select("model_name", "stage")


@query(
    "registry_register",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, max(CAST(json_extract_string(props, '$.k') AS INTEGER)) + 1 AS next_version
       FROM events GROUP BY user_id""",
)
def _(spark, sf):
    events = _event_registry(spark, sf, F.lit("register"), F.expr(K))
    return registry.next_versions(events)


@query(
    "registry_describe",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, max_by(event_type || ' ' || value, event_id) AS description
       FROM events WHERE event_type <> 'error' GROUP BY user_id""",
)
def _(spark, sf):
    """Every event but errors describes its model; the newest text wins."""
    kind = F.when(F.col("event_type") == "error", "register").otherwise("describe")
    text = F.concat("event_type", F.lit(" "), F.col("value").cast("string"))
    events = _event_registry(spark, sf, kind, F.lit(None), description=text)
    return registry.model_descriptions(events)


@query(
    "registry_delete",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS version
       FROM events GROUP BY 1, 2 HAVING count(*) FILTER (WHERE event_type = 'error') = 0""",
)
def _(spark, sf):
    """A version (user and k) with an error event is deleted."""
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("register")
    events = _event_registry(spark, sf, kind, F.expr(K))
    return registry.current_state(events).select("model_name", "version")


@query(
    "registry_resolve",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, CAST(json_extract_string(props, '$.k') AS INTEGER) AS version,
              '/models/' || max(event_id) AS artifact_path FROM events GROUP BY 1, 2""",
)
def _(spark, sf):
    """Each version points at the artifact of its newest run."""
    events = _event_registry(spark, sf, F.lit("register"), F.expr(K))
    path = F.concat(F.lit("/models/"), "run_id")
    runs = _event_runs(spark, sf).select("run_id", path.alias("artifact_path"))
    return registry.version_paths(events, runs).drop("stage")


@query(
    "monitor_promote",
    """WITH m AS (SELECT user_id, max(value) FILTER (WHERE event_type = 'view') AS staged,
                         max(value) FILTER (WHERE event_type = 'click') AS production FROM events GROUP BY user_id)
       SELECT CAST(user_id AS VARCHAR) AS model_name, staged, production, production IS NULL OR staged < production * 0.9 AS promote
       FROM m WHERE staged IS NOT NULL""",
)
def _(spark, sf):
    """Views as the staged version's errors, clicks as the production version's."""
    stage = F.when(F.col("event_type") == "view", "Staging").when(F.col("event_type") == "click", "Production")
    metrics = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("model_name"), stage.alias("stage"))
        .agg(F.max("value").alias("mse"))
    )
    return monitor.promotions(metrics, min_gain=0.1)


@query(
    "registry_latest",
    """SELECT CAST(user_id AS VARCHAR) AS model_name, max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS version FROM
         (SELECT *, count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id, json_extract_string(props, '$.k')) AS e FROM events)
       WHERE e = 0 GROUP BY user_id""",
)
def _(spark, sf):
    """The newest living version of every model: one with an error event is deleted."""
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("register")
    return registry.latest_versions(_event_registry(spark, sf, kind, F.expr(K)))


@query("monitor_compare", "SELECT true AS both_compared, true AS larger_is_better")
def _(spark, sf):
    """A deep forest explains a price that three inputs make better than single splits do."""
    train, test = _known_split(spark, sf)
    small = models.train_random_forest(train, INPUTS, num_trees=3, max_depth=1)
    large = models.train_random_forest(train, INPUTS, num_trees=8, max_depth=6)
    out = monitor.compare_models(test, {"production": small, "staged": large})
    error = lambda m: F.max(F.when(F.col("model") == m, F.col("mse")))
    return out.agg((F.count_distinct("model") == 2).alias("both_compared"), (error("staged") < error("production")).alias("larger_is_better"))
