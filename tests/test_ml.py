import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from siltbed.ml import features, models, monitor, registry, runlog, workflow
from siltbed.operators.schemas import SchemaMismatch
from siltbed.sources import readers

INPUTS = ["accommodates", "beds", "bathrooms"]


def listings(spark, n=400):
    i = F.col("id")
    return spark.range(n).select(
        "id",
        F.concat(F.lit("$"), F.format_number(100 + 40 * (i % 7) + 3 * (i % 5), 2)).alias("price"),
        F.lit("94110").alias("zipcode"),
        F.when(i % 3 == 0, "t").otherwise("f").alias("host_is_superhost"),
        F.when(i % 4 == 0, "t").alias("instant_bookable"),
        F.element_at(F.array(*[F.lit(p) for p in features.CANCELLATION_RANKS]), (i % 5 + 1).cast("int")).alias("cancellation_policy"),
        F.when(i % 2 == 0, "Entire home").otherwise("Private room").alias("room_type"),
        (i % 7 + 1).cast("int").alias("accommodates"),
        F.when(i % 9 > 0, (i % 5).cast("double")).alias("beds"),
        F.when(i % 11 > 0, (i % 3).cast("double")).alias("bathrooms"),
    )


def prepared(spark):
    return features.prepare_listings(listings(spark), {"room_type": "room"})


def ready(spark):
    df = prepared(spark)
    return features.impute(df, features.medians(df, ["beds", "bathrooms"]))


def test_prepare_listings(spark):
    df = prepared(spark)
    assert {t for _, t in df.dtypes} <= {"double", "int", "bigint", "vector"}
    assert {"room", "cancellation_policy_strictness"} <= set(df.columns) and "room_type" not in df.columns
    rooms = {(r["id"] % 2, tuple(r["room"])) for r in df.select("id", vector_to_array("room").alias("room")).collect()}
    assert rooms == {(0, (1.0, 0.0, 0.0)), (1, (0.0, 1.0, 0.0))}
    assert df.where("instant_bookable_ = 1").count() == 100


def test_one_hot_of_any_number_of_levels(spark):
    df = spark.range(5000).select("id", F.format_string("level %05d", "id").alias("c"))
    df = df.unionAll(df.limit(1).select("id", F.lit(None).cast("string")))
    got = features.one_hot_sparse(df, {"c": "v"}).where("id > 4990 or id = 0").orderBy("id").collect()
    assert {(r["id"], r["v"].size, tuple(r["v"].indices)) for r in got if r["id"]} == {(i, 5001, (i,)) for i in range(4991, 5000)}
    assert sorted(tuple(r["v"].indices) for r in got if not r["id"]) == [(0,), (5000,)]
    wide = features.one_hot(df, "c", "c", ["level 00000", "level 00007"])
    assert wide.agg(F.sum("`c_level 00000`"), F.sum("`c_level 00007`")).first()[:] == (1, 1)


def test_medians_of_whole_numbers_and_of_nothing(spark):
    df = readers.rows(spark, [(1, None), (2, None), (None, None)], "n INT, nothing DOUBLE")
    filled = features.impute(df, features.medians(df, ["n"]))
    assert sorted(r["n"] for r in filled.collect()) == [1.0, 1.5, 2.0]
    with pytest.raises(ValueError, match="nothing"):
        features.medians(df, ["n", "nothing"])


def test_too_deep_a_tree_raises(spark):
    with pytest.raises(Exception, match="maxDepth|depth"):
        models.train_random_forest(ready(spark), INPUTS, num_trees=1, max_depth=45)


def test_unmapped_policies(spark):
    got = features.unmapped(readers.rows(spark, [("flexible",), ("odd",), (None,)], "p STRING"), "p", features.CANCELLATION_RANKS)
    assert got.first()[0] == 1


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(10_000)
    train, test = features.split_train_test(df, ["id"], 0.75)
    again, _ = features.split_train_test(df.repartition(9).orderBy(F.desc("id")), ["id"], 0.75)
    assert train.count() + test.count() == 10_000
    assert 7300 < train.count() < 7700
    assert train.exceptAll(again).isEmpty() and again.exceptAll(train).isEmpty()
    other, _ = features.split_train_test(df, ["id"], 0.75, seed=7)
    assert not train.exceptAll(other).isEmpty()


def test_metrics(spark):
    df = readers.rows(spark, [(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y DOUBLE, p DOUBLE")
    got = models.eval_regression(df, "y", "p").first()
    assert got["mse"] == pytest.approx(1.25 / 3)
    assert got["mae"] == pytest.approx(0.5)
    assert got["r2"] == pytest.approx(1 - 1.25 / (14 / 3))


def test_model_round_trip_and_contract(spark, home):
    df = ready(spark)
    train, test = features.split_train_test(df, ["id"], 0.8)
    model = models.train_random_forest(train, INPUTS, num_trees=5)
    r2 = models.eval_regression(model.transform(test), "price", "prediction").first()["r2"]
    assert r2 > 0.5
    models.save_model(model, f"{home}/m", train.select(*INPUTS).schema)
    again = models.score_batch(test, f"{home}/m").select("id", "prediction")
    assert again.exceptAll(model.transform(test).select("id", "prediction")).isEmpty()
    with pytest.raises(SchemaMismatch, match="missing: beds"):
        models.score_batch(test.drop("beds"), f"{home}/m")
    with pytest.raises(SchemaMismatch, match="accommodates"):
        models.score_batch(test.withColumn("accommodates", F.lit("2")), f"{home}/m")
    top = models.feature_importance(spark, model).first()
    assert top["feature"] == "accommodates"
    each = models.score_pre_post(
        test, f"{home}/m", lambda d: d, lambda d: d.select("id", "prediction", "accommodates", models.price_per_person().alias("pp"))
    )
    assert each.where("abs(pp - prediction / accommodates) > 1e-9").isEmpty()


def test_custom_model_adds_five(spark):
    df = readers.row_ids(spark, 10).withColumn("id", F.col("id").cast("double"))
    got = models.score_custom(df, lambda batch: batch["id"] + 5, ["id"])
    assert sorted(r["prediction"] for r in got.collect()) == [float(x) for x in range(5, 15)]


def test_grid_search_orders_parameters(spark):
    found = models.grid_search(ready(spark), INPUTS, ["id"], num_trees=[2, 4], max_depth=[1, 5])
    scores = {r["params"]: r["r2"] for r in models.grid_scores(spark, found).collect()}
    assert len(scores) == 4
    assert scores['{"maxDepth": 5, "numTrees": 4}'] > scores['{"maxDepth": 1, "numTrees": 4}']


def test_run_log(spark, home):
    path = f"{home}/runs"
    ids = [
        runlog.log_run(spark, path, "e1", f"run{i}", {"depth": i}, {"mse": mse}, {"k": "v"}, f"/models/{i}", i)
        for i, mse in enumerate([5.0, 2.0, 3.0])
    ]
    runlog.log_run(spark, path, "e2", "other", {}, {"mse": 1.0})
    runs = runlog.read_runs(spark, path)
    assert [r["run_id"] for r in runlog.search_runs(runs, "e1").collect()] == ids[::-1]
    newest = runlog.search_runs(runs, "e1", 1)
    assert runlog.run_metrics(newest).first()["value"] == 3.0
    best = runlog.best_run(runs.where("experiment_id = 'e1'"), "mse").first()
    assert (best["run_id"], best["mse"]) == (ids[1], 2.0)
    assert runlog.best_run(runs, "mse", smallest=False).first()["run_id"] == ids[0]
    assert runlog.experiments(runs).count() == 2


def test_registry_life_cycle(spark, home):
    runs_path = f"{home}/runs"
    r1 = runlog.log_run(spark, runs_path, "e", "a", {}, {}, artifact_path="/models/a")
    r2 = runlog.log_run(spark, runs_path, "e", "b", {}, {}, artifact_path="/models/b")
    runs = runlog.read_runs(spark, runs_path)
    reg = registry.Registry(spark, f"{home}/registry")
    assert reg.register("m", r1) == 1
    reg.describe_model("m", "prices")
    reg.describe_version("m", 1, "forest")
    reg.transition("m", 1, "Production")
    assert reg.register("m", r2) == 2
    assert reg.latest("m") == 2 and reg.description("m") == "prices"
    reg.transition("m", 2, "Staging")
    reg.transition("m", 2, "Production")
    assert reg.in_stage("m", "Production") == 2
    assert reg.resolve("models:/m/1", runs) == "/models/a"
    assert reg.resolve("models:/m/Production", runs) == "/models/b"
    assert reg.resolve(f"runs:/{r2}/forest", runs) == "/models/b/forest"
    with pytest.raises(ValueError, match="archive it first"):
        reg.delete_version("m", 1)
    with pytest.raises(ValueError, match="unknown stage"):
        reg.transition("m", 1, "Live")
    reg.transition("m", 1, "Archived")
    reg.delete_version("m", 1)
    assert [r["version"] for r in reg.versions("m").collect()] == [2]
    with pytest.raises(ValueError, match="no version 1"):
        reg.transition("m", 1, "Staging")
    with pytest.raises(ValueError, match="archive them first"):
        reg.delete_model("m")
    reg.transition("m", 2, "Archived")
    reg.delete_model("m")
    assert reg.versions("m").isEmpty() and reg.latest("m") is None
    assert reg.register("m", r1) == 3


def test_promotion(spark, home):
    reg = registry.Registry(spark, f"{home}/registry")
    for run in ("a", "b"):
        reg.register("m", run)
    reg.transition("m", 1, "Production")
    reg.transition("m", 2, "Staging")
    metric = lambda s, p: readers.rows(spark, [("staged", s), ("production", p)], "model STRING, mse DOUBLE")
    assert not monitor.promote_if_better(reg, "m", 2, 1, metric(9.5, 10.0), min_gain=0.1)
    assert reg.in_stage("m", "Production") == 1
    assert monitor.promote_if_better(reg, "m", 2, 1, metric(8.0, 10.0), min_gain=0.1)
    assert reg.in_stage("m", "Production") == 2
    assert reg.in_stage("m", "Archived") == 1


def test_three_steps(spark, home):
    steps = workflow.run_workflow(spark, ready(spark), f"{home}/flow", INPUTS, ["id"], num_trees=3)
    assert [s["status"] for s in steps] == ["OK", "OK", "OK"]
    assert spark.read.parquet(steps[-1]["predictions_path"]).where("prediction IS NULL").isEmpty()
    assert runlog.read_runs(spark, f"{home}/flow/runs").first()["run_id"] == steps[1]["run_id"]
