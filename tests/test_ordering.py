"""Skew-safe ordered operators against plain Python."""

import random
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siltbed.operators import ordering, repair

SLOW = settings(
    max_examples=8, deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def series(spark, data):
    df = spark.createDataFrame(data, "id INT, k STRING, s BIGINT, v DOUBLE")
    return df.select("id", "k", F.timestamp_seconds("s").alias("t"), "v")


@SLOW
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
            st.one_of(st.none(), st.integers(0, 400_000)),
            st.one_of(st.none(), st.floats(-100, 100)),
        ),
        max_size=60,
    )
)
def test_neighbours(spark, points):
    data = [(i, *p) for i, p in enumerate(points)]
    before, ordering._SAMPLED = ordering._SAMPLED, 3  # so that the hot key is cut
    try:
        sided = ordering.neighbours(series(spark, data), "k", "t", "v", tie=("id",)).collect()
    finally:
        ordering._SAMPLED = before
    got = {r["id"]: (r["prev_amt"], r["next_amt"]) for r in sided}
    want = {}
    for key in {d[1] for d in data} - {None}:
        own = sorted((d[2], d[0], d[3]) for d in data if d[1] == key and d[2] is not None)
        for i, (_t, row, _v) in enumerate(own):
            want[row] = (own[i - 1][2] if i else None, own[i + 1][2] if i + 1 < len(own) else None)
    assert got == want


def test_cuts_do_not_change_the_result(spark, monkeypatch):
    """A hot key of one day, with ties, is cut into many ranges or none."""
    rnd = random.Random(5)
    data = [(i, "hot" if i % 3 else f"k{i % 11}", rnd.randrange(5000), rnd.uniform(-20, 80)) for i in range(3000)]
    df = series(spark, data)
    results = []
    for sampled in (2, 20, 10**6):
        monkeypatch.setattr(ordering, "_SAMPLED", sampled)
        results.append(sorted(map(tuple, repair.interpolate_neighbors(df, "k", "t", "v", ("id",)).collect())))
    assert results[0] == results[1] == results[2]
    monkeypatch.setattr(ordering, "_SAMPLED", 2)
    whole = repair.repaired(df, "k", "t", "v", ("id",))
    fixes = {r["id"]: r["v"] for r in repair.interpolate_neighbors(df, "k", "t", "v", ("id",)).collect()}
    assert {r["id"]: r["v"] for r in whole.collect()} == {d[0]: fixes.get(d[0], d[3]) for d in data}


def test_one_device_and_day_spreads_over_tasks(spark):
    data = [(i, "hot", i, 1.0) for i in range(20_000)]
    cuts = ordering._hot_cuts(series(spark, data).repartition(6), "k", F.struct("t", "id"))
    assert 4 <= len(cuts["hot"]) < 8
    cells = ordering._cells(series(spark, data), "k", F.struct("t", "id"), cuts)
    sizes = [r["count"] for r in cells.groupBy("_cell").count().collect()]
    assert len(sizes) == len(cuts["hot"]) + 1 and max(sizes) < 8000


def test_values_of_any_type_and_nulls_in_the_tie(spark):
    rows = [(i % 2, 5, None if i % 3 else i, f"x{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k INT, t BIGINT, tie INT, v STRING")
    got = {r["v"]: (r["p"], r["n"]) for r in ordering.neighbours(df, "k", "t", "v", ("tie", "v"), "p", "n").collect()}
    for key in (0, 1):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
        for i, r in enumerate(own):
            assert got[r[3]] == (own[i - 1][3] if i else None, own[i + 1][3] if i + 1 < len(own) else None)


def test_row_numbers(spark):
    rnd = random.Random(1)
    data = [(i, rnd.choice(["hot", "hot", "x", None]), rnd.randrange(50)) for i in range(2000)]
    df = spark.createDataFrame(data, "id INT, g STRING, v INT")
    got = {r["id"]: r["row_num"] for r in ordering.row_number_global(df, [F.desc("v"), "id"]).collect()}
    order = sorted(data, key=lambda d: (-d[2], d[0]))
    assert got == {d[0]: i + 1 for i, d in enumerate(order)}

    got = {r["id"]: r["row_num"] for r in ordering.row_number_within(df, ["g"], ["v", "id"]).collect()}
    want = {}
    for g in {d[1] for d in data}:
        for i, d in enumerate(sorted((d for d in data if d[1] == g), key=lambda d: (d[2], d[0]))):
            want[d[0]] = i + 1
    assert got == want


def test_row_number_of_empty_table(spark):
    assert ordering.row_number_global(spark.range(0), ["id"]).count() == 0


@SLOW
@given(
    st.lists(st.one_of(st.none(), st.sampled_from([1.0, 1.0, 2.5]), st.floats(-1e6, 1e6)), min_size=1, max_size=80),
    st.lists(st.integers(-5, 5), min_size=1, max_size=80),
)
def test_exact_median(spark, a, b):
    n = max(len(a), len(b))
    data = [(a[i % len(a)], float(b[i % len(b)])) for i in range(n)]
    df = spark.createDataFrame(data, "a DOUBLE, b DOUBLE").repartition(4)
    got = {r["column"]: r["value"] for r in ordering.exact_quantiles(df, ["a", "b"]).collect()}
    known = [x for x, _ in data if x is not None]
    want = {"b": statistics.median(y for _, y in data)}
    if known:
        want["a"] = statistics.median(known)
    assert set(got) == set(want)
    for c in want:
        assert abs(got[c] - want[c]) <= 1e-9 * max(1.0, abs(want[c]))


def test_latest_by_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, "x"), ("b", 5, "y"), (None, 1, "z")], "k STRING, v INT, x STRING")
    got = {r["k"]: (r["v"], r["x"]) for r in ordering.latest_by_key(df, ["k"], ["v"]).collect()}
    assert got == {"a": (2, "x"), "b": (5, "y"), None: (1, "z")}


def test_quantiles_of_outliers_and_odd_numbers(spark):
    """Values over 600 orders of magnitude, infinities, NaN, one value held by most rows."""
    rnd = random.Random(8)
    spread = [rnd.choice([-1, 1]) * 10.0 ** rnd.randrange(-300, 300) for _ in range(9000)]
    cases = {
        "spread": spread,
        "outlier": [float(i) for i in range(20_000)] + [1e308, -1e308],
        "most": [5.0] * 9000 + [float(i) for i in range(5000)],
        "infinite": [float("inf")] * 5 + [float("-inf")] * 3 + [1.0, 2.0],
        "one": [7.0],
    }
    for name, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v DOUBLE").repartition(5)
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            own = sorted(values)
            r = q * (len(own) - 1)
            low, high = own[int(r)], own[min(int(r) + 1, len(own) - 1)]
            want = low if r == int(r) or low == high else low + (high - low) * (r - int(r))
            got = ordering.exact_quantiles(df, ["v"], q).collect()
            assert len(got) == 1 and (got[0]["value"] == want or want != want and got[0]["value"] != got[0]["value"]), (name, q)
    mixed = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v DOUBLE")
    assert ordering.exact_quantiles(mixed, ["v"]).first()["value"] == 2.0
    assert ordering.exact_quantiles(mixed.where("v is null"), ["v"]).collect() == []


def test_quantiles_leave_no_files(spark, monkeypatch):
    monkeypatch.setattr(ordering, "materialize", lambda *a: (_ for _ in ()).throw(AssertionError("written")))
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).cast("double").alias("v"))
    assert len(ordering.exact_quantiles(df, ["v"]).collect()) == 1


def test_a_hot_key_may_have_columns_of_any_name(spark, monkeypatch):
    """A series cut into ranges, in a column that the ranges' edges once had a name in common with."""
    rows = spark.range(4000).select((F.col("id") % 2).alias("key"), F.col("id").alias("_at"))
    monkeypatch.setattr(ordering, "_hot_cuts", lambda *a: {0: [(1000,), (3000,)]})
    got = ordering.neighbours(rows, "key", "_at", "_at").where("key = 0").collect()
    assert len(got) == 2000
    assert all(r["prev_amt"] == (r["_at"] - 2 if r["_at"] else None) and r["next_amt"] == (r["_at"] + 2 if r["_at"] < 3998 else None) for r in got)
