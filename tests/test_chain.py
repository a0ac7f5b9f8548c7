import os
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltbed.chain import eda, etl, project, recommend
from siltbed.ml import runlog
from siltbed.ml.registry import Registry
from siltbed.operators import versions
from siltbed.operators.schemas import SchemaMismatch
from siltbed.scratch import shared_dir
from siltbed.sources import readers

ETHER = 10**18


def transfers(spark):
    data = [
        ("A", "0", "x", 100, "t1", 5, "2020-01-01"),
        ("A", "x", "y", 40, "t2", 6, "2020-01-02"),
        ("A", "x", "y", 10, "t2", 6, "2020-01-02"),
        ("B", "0", "y", 7, "t3", 7, "2020-01-03"),  # y holds A already; for B it is new
        ("B", "0", "z", 1, "t3", 7, "2020-01-03"),
    ]
    text = "token_address STRING, from_address STRING, to_address STRING, value BIGINT, transaction_hash STRING, block_number BIGINT, date STRING"
    rows = readers.rows(spark, data, text)
    return rows.withColumns({"value": F.col("value").cast("decimal(38,0)"), "date": F.col("date").cast("date")})


def test_transfer_questions(spark):
    t = transfers(spark)
    assert eda.first_transfer(t).first()[0] == 5
    # single (token, receiver) transfers: A to x, B to y, B to z
    assert eda.new_address_fraction(t).first()[0] == pytest.approx(3 / 5)
    assert eda.max_transfers_in_transaction(t).first()[0] == 2
    symbols = readers.rows(spark, [("A", "AAA"), ("A", "AAB"), ("A", "AAA")], "address STRING, symbol STRING")
    top = [tuple(r) for r in eda.top_tokens(t, symbols, 2).collect()]
    assert top == [("A", "AAA", 3), ("B", None, 2)]


def test_balances(spark):
    t = transfers(spark)
    on = {(r["address"], r["token_address"]): int(r["balance"]) for r in eda.balance_on(t, "2020-01-02").collect()}
    assert on == {("0", "A"): -100, ("x", "A"): 50, ("y", "A"): 50}
    only = eda.balance_on(t, "2020-01-03", F.col("address") == "y").collect()
    assert {r["token_address"]: int(r["balance"]) for r in only} == {"A": 50, "B": 7}
    hist = eda.balance_history(t).where("address = 'x'").orderBy("date").collect()
    assert [int(r["balance"]) for r in hist] == [100, 50]
    prices = readers.rows(spark, [("A", "2020-01-02", 2.0), ("A", "2020-01-02", 1.0)], "token_address STRING, date STRING, price_usd DOUBLE")
    prices = prices.withColumn("date", F.col("date").cast("date"))
    listed = readers.rows(spark, [("A", 0), ("A", None), ("B", 3)], "address STRING, decimals INT")
    worth = eda.with_price(eda.balance_history(t), prices, listed)
    assert worth.count() == eda.balance_history(t).count()
    got = {(r["address"], r["token_address"], str(r["date"])): r["usd"] for r in worth.collect()}
    assert got["x", "A", "2020-01-02"] == 100.0 and got["y", "B", "2020-01-03"] is None


def test_worth_counts_whole_tokens(spark):
    held = readers.rows(spark, [("x", "T", "2020-01-01", Decimal(15 * 10**17))], "address STRING, token_address STRING, date STRING, balance DECIMAL(38,0)")
    price = readers.rows(spark, [("T", "2020-01-01", 2.0)], "token_address STRING, date STRING, price_usd DOUBLE")
    assert eda.with_price(held, price, readers.rows(spark, [("T", 18)], "address STRING, decimals INT")).first()["usd"] == pytest.approx(3.0)


@pytest.mark.parametrize("digits", [1, 18, 19, 35, 36, 37, 38])
def test_long_amounts_cancel(spark, digits):
    """What one side gains the other loses, to the last digit, also where a sum passes 38 digits."""
    amount = Decimal("12345678901234567890123456789012345678"[:digits])
    nines = Decimal("9" * digits)
    data = [("T", "a", "b", amount), ("T", "b", "c", nines), ("T", "a", "c", nines), ("T", "a", "c", nines)]
    t = readers.rows(spark, data, "token_address STRING, from_address STRING, to_address STRING, value DECIMAL(38,0)")
    t = t.withColumn("date", F.lit("2020-01-01").cast("date"))
    whole = 10**18
    got = {r["address"]: int(r["whole"]) * whole + int(r["rest"]) for r in eda.balance_on(t, "2020-01-02").collect()}
    a, n = int(amount), int(nines)
    assert got == {"a": -a - 2 * n, "b": a - n, "c": 3 * n} and sum(got.values()) == 0
    small = {r["address"]: r["balance"] for r in eda.balance_on(t, "2020-01-02").collect()}
    assert all(small[k] is None if abs(v) >= 10**38 else int(small[k]) == v for k, v in got.items())
    assert {r["address"]: r["balance"] for r in eda.balance_history(t).collect()} == small


def test_ether_volume_past_38_digits_of_wei(spark):
    huge = Decimal(9 * 10**37)
    df = spark.createDataFrame([(huge,), (huge,), (Decimal(ETHER + ETHER // 2),)], "value DECIMAL(38,0)")
    assert eda.ether_volume(df).first()[0] == pytest.approx(1.8e20, rel=1e-12)
    small = spark.createDataFrame([(Decimal(ETHER // 4),)] * 6, "value DECIMAL(38,0)")
    assert eda.ether_volume(small).first()[0] == 1.5


def test_gas_order(spark):
    ddl = "hash STRING, block_number BIGINT, transaction_index INT, gas_price BIGINT, to_address STRING"
    tx = readers.rows(
        spark,
        [("a", 1, 0, 90, "c"), ("b", 1, 1, 50, "c"), ("c", 1, 2, 70, "p"), ("d", 2, 0, 10, "p")],
        ddl,
    )
    got = {r["hash"]: (r["position"], r["gas_rank"]) for r in eda.gas_order(tx).collect()}
    assert got == {"a": (1, 1), "b": (2, 3), "c": (3, 2), "d": (1, 1)}
    corr = eda.gas_order_correlation(tx).collect()
    assert len(corr) == 1 and corr[0]["correlation"] < 0
    assert eda.max_throughput(tx).first()[0] == pytest.approx(3 / 15)
    known = readers.rows(spark, [("c",), ("c",)], "address STRING")
    assert eda.contract_call_pct(tx, known).first()[0] == pytest.approx(50.0)


def test_silver_transfers_types_and_migration(spark, home):
    bronze = readers.rows(
        spark, [("0xAB", "0xCD", str(5 * 10**30), "2020-01-01 10:00:00"), ("0xAB", "0xCD", "1.5x", None)],
        "token_address STRING, to_address STRING, value STRING, block_timestamp STRING",
    )
    got = etl.silver_transfers(bronze).collect()
    assert got[0]["token_address"] == "0xab" and got[0]["value"] == Decimal(5 * 10**30)
    assert got[0]["from_address"] is None and str(got[0]["p_month"]) == "2020-01-01"
    assert got[1]["value"] is None and got[1]["unread_value"] == "1.5x" and got[0]["unread_value"] is None
    odd = ["100.5", "-3", "00042", "0", "9" * 38, "9" * 39, "1e5", " 7 ", None]
    amounts = bronze.limit(1).select("token_address", "to_address", F.explode(F.array(*(F.lit(x) for x in odd))).alias("value"), "block_timestamp")
    read = etl.silver_transfers(amounts)
    assert sorted(int(r["value"]) for r in read.collect() if r["value"] is not None) == [0, 7, 42, 10**38 - 1]
    assert etl.unread(read).first()[0] == 3  # 39 nines are read as digits
    assert sorted(r['digits'] for r in read.where('value is null and digits is not null').collect()) == ['9' * 39]
    with pytest.raises(SchemaMismatch):
        etl.silver_transfers(bronze.withColumn("value", F.array("value")))

    # new bronze files are picked up once each
    for i in range(2):
        bronze.write.mode("append").parquet(f"{home}/bronze")
        for _ in range(2):
            etl.ingest_transfers(spark, f"{home}/bronze", bronze.schema, f"{home}/silver", f"{home}/c")
        assert versions.read_as_of(spark, f"{home}/silver").count() == 2 * (i + 1)


def pairs(spark):
    data = [("me", "A"), ("me", "B"), ("u", "A"), ("u", "B"), ("u", "C"), ("v", "B"), ("v", "D"), ("w", "E")]
    return readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1))


def test_similar_wallets_and_tokens(spark):
    near = {r["wallet"]: r["cosine"] for r in recommend.similar_wallets(pairs(spark), "me").collect()}
    assert near == {"u": pytest.approx(2 / 6**0.5), "v": pytest.approx(1 / 4**0.5)}
    top = recommend.top_tokens_for(pairs(spark), "me", 5).orderBy("rank").collect()
    assert [(r["rank"], r["token"]) for r in top] == [(1, "C"), (2, "D")]
    assert top[0]["link"].endswith("/C")
    assert recommend.similar_wallets(pairs(spark), "nobody").isEmpty()


def test_similarity_against_brute_force(spark):
    """All wallets of a small table, one wallet holding a third of all pairs."""
    data = {("hot", f"t{i}") for i in range(30)} | {(f"w{i % 9}", f"t{i * 7 % 40}") for i in range(60)}
    df = readers.rows(spark, sorted(data), "wallet STRING, token STRING")
    held = {}
    for w, t in data:
        held.setdefault(w, set()).add(t)
    for me in ("hot", "w0", "w5"):
        got = {r["wallet"]: r["cosine"] for r in recommend.similar_wallets(df, me).collect()}
        want = {
            w: len(ts & held[me]) / (len(ts) * len(held[me])) ** 0.5
            for w, ts in held.items()
            if w != me and ts & held[me]
        }
        assert got == {w: pytest.approx(c) for w, c in want.items()}


def test_ranking_quality(spark):
    rec = readers.rows(spark, [("a", "x", 1), ("a", "y", 2), ("b", "x", 1)], "wallet STRING, token STRING, rank INT")
    truth = readers.rows(spark, [("a", "y"), ("a", "z"), ("c", "x")], "wallet STRING, token STRING")
    got = {r["wallet"]: (r["precision"], r["recall"]) for r in recommend.ranking_quality(rec, truth, 2).collect()}
    assert got == {"a": (0.5, 0.5), "c": (0.0, 0.0)}


def test_als_recommends_unheld_tokens(spark):
    ids = recommend.with_integer_ids(pairs(spark))
    assert sorted({r["token_id"] for r in ids.collect()}) == [0, 1, 2, 3, 4]
    model = recommend.fit_als(ids, rank=2, max_iter=3)
    got = [r["token"] for r in recommend.recommend_als(model, ids, "me", 3).collect()]
    assert set(got) <= {"C", "D", "E"} and len(got) == 3
    # the product of the factors is the model's own prediction
    mine = ids.where("wallet = 'me'").first()["wallet_id"]
    asked = ids.select("token", "token_id").distinct().withColumn("wallet_id", F.lit(mine))
    own = {r["token"]: r["prediction"] for r in model.transform(asked).collect()}
    for r in recommend.recommend_als(model, ids, "me", 3).collect():
        assert r["score"] == pytest.approx(own[r["token"]], abs=1e-5)


def test_recall_counts_unknown_pairs_apart(spark):
    """Two groups with tokens of their own: a held-out token of the own group is ranked high."""
    data = [(f"w{w}", f"t{t}") for w in range(20) for t in range(40) if t % 2 == w % 2 and (w * 7 + t) % 9]
    rows = readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1))
    ids = recommend.with_integer_ids(rows)
    model = recommend.fit_als(ids, rank=4, max_iter=6)
    held = [(f"w{w}", f"t{t}") for w in range(20) for t in range(40) if t % 2 == w % 2 and not (w * 7 + t) % 9]
    strange = [("nobody", "t1"), ("w1", "nothing"), (None, "t1")]
    good = recommend.recall_at_k(model, ids, readers.rows(spark, held, "wallet STRING, token STRING")).first()
    assert (good["n_pairs"], good["n_unknown"]) == (len(held), 0) and good["recall"] > 0.6
    mixed = recommend.recall_at_k(model, ids, readers.rows(spark, held + strange, "wallet STRING, token STRING")).first()
    assert (mixed["n_pairs"], mixed["n_unknown"]) == (len(held) + 3, 3)
    none = recommend.recall_at_k(model, ids, readers.rows(spark, strange, "wallet STRING, token STRING")).first()
    assert (none["n_unknown"], none["recall"]) == (3, 0.0)


def test_ranking_leaves_no_tables(spark, home):
    """What a model's ranking writes on its way is gone once its number is known."""
    data = [(f"w{w}", f"t{t}") for w in range(12) for t in range(20) if (w + t) % 3]
    ids = recommend.with_integer_ids(readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1)))
    ids.write.parquet(f"{home}/ids")
    recommend.fit_als(ids, rank=2, max_iter=1).save(f"{home}/als")
    held = readers.rows(spark, [(f"w{w}", f"t{t}") for w in range(12) for t in range(20) if not (w + t) % 3], "wallet STRING, token STRING")
    before = set(os.listdir(shared_dir(spark)))
    assert 0 <= project.miss_rate(spark, f"{home}/als", held) < 1
    assert set(os.listdir(shared_dir(spark))) == before


def test_project_runs_again(spark, home):
    """Two rounds over a growing bronze: versions add up, one version serves, links are given."""
    wallet, token = F.col("id") % 17, (F.col("id") * 7 + F.col("id") % 5) % 23
    bronze = spark.range(600).select(
        F.concat(F.lit("0xT"), token).alias("token_address"),
        F.concat(F.lit("0xW"), wallet).alias("to_address"),
        F.lit("100").alias("value"),
        F.concat(F.lit("0xH"), F.col("id")).alias("transaction_hash"),
        F.timestamp_seconds(F.lit(1577836800) + F.col("id") * 3600).alias("block_timestamp"),
    )
    out = project.Project(f"{home}/out")
    for round_number in (1, 2):
        part = bronze.where(F.col("transaction_hash").substr(4, 9).cast("int") % 2 == round_number - 1)
        part.write.mode("append").parquet(f"{home}/bronze")
        got = project.run_project(
            spark, out.home, f"{home}/bronze", bronze.schema, "0xw3", "2020-01-05", [{"rank": 2}, {"rank": 4}], 3
        ).collect()
        assert len(got) == 3 and all(r["link"].endswith(r["token"]) for r in got)
        held = versions.read_as_of(spark, out.transfers)
        assert held.count() == 300 * round_number
        assert runlog.read_runs(spark, out.runs).count() == 2 * round_number
    registry = Registry(spark, out.registry)
    assert registry.latest(project.MODEL) == 2
    stages = sorted(r["stage"] for r in registry.versions(project.MODEL).collect())
    assert stages in (["Archived", "Production"], ["Production", "Staging"])
    stored = spark.read.parquet(f"{out.home}/explore/transfers_per_day")
    assert stored.agg(F.sum("n")).first()[0] == 600
    answers = project.explore(held)
    assert answers["max_transfers"].first()[0] == 1
    assert answers["transfers_per_day"].agg(F.sum("n")).first()[0] == 600


def test_recall_ranks_among_all_tokens(spark):
    """Against a ranking of every token by plain products, trained pairs left out."""
    data = [(f"w{w}", f"t{t}") for w in range(20) for t in range(40) if (w + t) % 3 and (w * 7 + t) % 9]
    rows = readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1))
    ids = recommend.with_integer_ids(rows)
    model = recommend.fit_als(ids, rank=3, max_iter=3)
    held = [(f"w{w}", f"t{t}") for w in range(20) for t in range(40) if (w + t) % 3 and not (w * 7 + t) % 9] + [("nobody", "t1"), ("w1", "nothing")]
    users, items = ({r["id"]: r["features"] for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    wallet, token = ({r[c]: r[f"{c}_id"] for r in ids.collect()} for c in ("wallet", "token"))
    total = []
    for w in {w for w, _ in held}:
        wanted = {t for x, t in held if x == w}
        free = [t for t in token if (w, t) not in set(data)] if w in wallet else []
        score = {t: sum(a * b for a, b in zip(users[wallet[w]], items[token[t]])) for t in free}
        total.append(len(wanted & set(sorted(free, key=lambda t: -score[t])[:4])) / len(wanted))
    got = recommend.recall_at_k(model, ids, readers.rows(spark, held, "wallet STRING, token STRING"), k=4).first()
    assert (got["n_pairs"], got["n_unknown"]) == (len(held), 2)
    assert got["recall"] == pytest.approx(sum(total) / len(total), abs=0.02)


def test_blocks_do_not_change_the_recall(spark, monkeypatch):
    """A wallet that holds most tokens among them; blocks of a few wallets and tokens or one block."""
    data = [(f"w{w}", f"t{t}") for w in range(30) for t in range(60) if w == 0 and t % 10 or (w * 5 + t) % 4 == 0]
    rows = readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1))
    ids = recommend.with_integer_ids(rows)
    model = recommend.fit_als(ids, rank=3, max_iter=3)
    held = readers.rows(spark, [(f"w{w}", f"t{t}") for w in range(30) for t in range(60) if (w + t) % 10 == 0], "wallet STRING, token STRING")
    got = []
    for wallets, tokens in ((1024, 4096), (4, 7)):
        monkeypatch.setattr(recommend, "WALLETS_AT_ONCE", wallets)
        monkeypatch.setattr(recommend, "TOKENS_AT_ONCE", tokens)
        got.append(recommend.recall_at_k(model, ids, held).first())
    assert got[0] == got[1] and 0 < got[0]["recall"] < 1


def test_counting_ends_when_a_pair_is_settled(spark, monkeypatch):
    """Rounds of a few tokens against plain products; numbers below the bar are exact, no other is below it."""
    data = [(f"w{w}", f"t{t}") for w in range(30) for t in range(60) if w == 0 and t % 10 or (w * 5 + t) % 4 == 0]
    ids = recommend.with_integer_ids(readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1)))
    model = recommend.fit_als(ids, rank=3, max_iter=3)
    names = {c: {r[c]: r[f"{c}_id"] for r in ids.collect()} for c in ("wallet", "token")}
    users, items = ({r["id"]: np.array(r["features"], dtype=float) for r in f.collect()} for f in (model.userFactors, model.itemFactors))
    known, pairs = set(data), [(w, t) for w in range(30) for t in range(60) if (w + t) % 10 == 0]
    want = {}
    for w, t in ((f"w{w}", f"t{t}") for w, t in pairs):
        score = {x: users[names["wallet"][w]] @ items[i] for x, i in names["token"].items()}
        near = recommend.TIE * abs(score[t])
        before = [x for x in score if (w, x) not in known and (score[x] > score[t] + near or abs(score[x] - score[t]) <= near and names["token"][x] < names["token"][t])]
        want[names["wallet"][w], names["token"][t]] = len(before)
    trained = ids.select("wallet_id", "token_id")
    held = spark.createDataFrame(list(want), "wallet_id int, token_id int")
    monkeypatch.setattr(recommend, "TOKENS_AT_ONCE", 4)
    for a_round in (9, 1000):
        monkeypatch.setattr(recommend, "TOKENS_A_ROUND", a_round)
        whole, cut = ({r[:2]: r[2] for r in recommend.tokens_ahead(model, trained, held, most).collect()} for most in (None, 5))
        assert whole == want
        assert cut.keys() == want.keys() and all(min(cut[k], 5) == min(want[k], 5) for k in want)


def test_amounts_of_78_digits_survive_to_the_worth(spark, home):
    """Silver, balance, history and worth of amounts near 2 ** 256; each token's balances add up to nothing."""
    most = 2**256 - 1
    data = [("0xA", "0xa", "0xb", str(most), "2020-01-01"), ("0xA", "0xB", "0xc", str(most - 7), "2020-01-02"), ("0xA", "0xC", "0xA", "00" + str(10**40), "2020-01-03"), ("0xB", "0xa", "0xb", "5", "2020-01-01"), ("0xB", "0xa", "0xb", "9" * 79, "2020-01-01")]
    bronze = readers.rows(spark, data, "token_address STRING, from_address STRING, to_address STRING, value STRING, block_timestamp STRING")
    silver = etl.silver_transfers(bronze)
    assert etl.unread(silver).first()[0] == 1 and silver.where(F.col("digits") == str(most)).first()["value"] is None
    held = {(r["address"], r["token_address"]): r for r in eda.balance_on(silver, "2020-02-01").collect()}
    exact = {k: int(r["balance_digits"]) for k, r in held.items() if r["balance_digits"] is not None}
    assert exact["0xb", "0xa"] == 7 and exact["0xc", "0xa"] == most - 7 - 10**40 and exact["0xa", "0xa"] == 10**40 - most
    assert sum(v for (_, t), v in exact.items() if t == "0xa") == 0
    assert held["0xa", "0xa"]["balance"] is None and held["0xa", "0xa"]["whole"] is None and int(held["0xb", "0xa"]["balance"]) == 7
    history = {(r["address"], str(r["date"])): (r["change_digits"], r["balance_digits"]) for r in eda.balance_history(silver.where("token_address = '0xa'")).collect()}
    assert history["0xb", "2020-01-02"] == (str(7 - most), "7") and history["0xa", "2020-01-01"] == (str(-most), str(-most))
    prices = readers.rows(spark, [("0xa", "2020-01-01", 2.0)], "token_address STRING, date STRING, price_usd DOUBLE").withColumn("date", F.col("date").cast("date"))
    listed = readers.rows(spark, [("0xa", 18)], "address STRING, decimals INT")
    worth = {(r["address"], str(r["date"])): r["usd"] for r in eda.with_price(eda.balance_history(silver), prices, listed).where("token_address = '0xa'").collect()}
    assert worth["0xb", "2020-01-01"] == pytest.approx(most / 10**18 * 2.0)


def test_limbs_against_whole_numbers(spark):
    import random

    from siltbed.functions import amounts

    rnd = random.Random(3)
    groups = {g: [rnd.choice([-1, 1]) * rnd.randrange(10 ** rnd.randrange(1, 78)) for _ in range(20)] for g in range(40)} | {40: [10**77, -(10**77)], 41: [-1], 42: [-(10**9), 1]}
    rows = readers.rows(spark, [(g, str(abs(v)), 1 if v >= 0 else -1) for g, vs in groups.items() for v in vs], "g INT, d STRING, sign BIGINT")
    cut = rows.select("g", "sign", *amounts.limbs(F.col("d")))
    sums = cut.groupBy("g").agg(*[F.sum(F.col(n) * F.col("sign")).alias(n) for n in amounts.NAMES])
    text = sums.select("g", amounts.text([F.col(n) for n in amounts.NAMES]).alias("t"))
    whole, rest = amounts.parts(F.col("t"))
    for r in text.select("g", "t", whole.alias("whole"), rest.alias("rest"), amounts.decimal(F.col("t")).alias("d")).collect():
        total = sum(groups[r["g"]])
        assert r["t"] == str(total)
        assert r["d"] is None if abs(total) >= 10**38 else int(r["d"]) == total
        if abs(total) < 10**56:
            assert int(r["whole"]) * 10**18 + int(r["rest"]) == total


def test_balances_spell_sums_of_any_size_and_sign(spark):
    """Digits carried by projections: no step of them runs a function per element, and every sum is exact."""
    from siltbed.functions import amounts

    r = np.random.default_rng(3)
    sums = [[int(x) for x in r.integers(-(10 ** r.integers(1, 18)), 10 ** r.integers(1, 18), 9) * (r.random(9) < 0.6)] for _ in range(300)]
    sums += [[0] * 9, [-1] + [0] * 8, [0] * 8 + [-1], [-1] + [0] * 7 + [1], [1] + [0] * 7 + [-1], [10**9] * 9, [-(10**9)] * 9, [None] * 9]
    rows = spark.createDataFrame([(i, *s) for i, s in enumerate(sums)], ", ".join(["g int", *(f"{n} bigint" for n in amounts.NAMES)]))
    out = amounts.totals(rows, amounts.NAMES, "x")
    assert "aggregate(" not in out._jdf.queryExecution().executedPlan().toString()
    for g, x, digits in out.select("g", "x", "x_digits").collect():
        total = None if sums[g][0] is None else sum(s * amounts.BASE**i for i, s in enumerate(sums[g]))
        assert digits == (None if total is None else str(total))
        assert x == (None if total is None or abs(total) >= 10**38 else total)


def test_silver_of_the_other_tables(spark, home):
    for name, rules in etl.TABLES.items():
        kinds = {"hash": "0xAB ", "amount": str(10**40), "moment": "1577836800", "bigint": "12", "int": "x", "boolean": "true", "double": "1.5", "string": "S"}
        bronze = readers.rows(spark, [tuple(kinds[k] for k in rules.values()), (None,) * len(rules)], ", ".join(f"{c} STRING" for c in rules))
        first = etl.silver_table(bronze.withColumn("extra", F.lit(1)), name).collect()[0].asDict()
        for c, kind in rules.items():
            want = {"hash": "0xab", "amount": None, "bigint": 12, "int": None, "boolean": True, "double": 1.5, "string": "S"}
            assert kind == "moment" and str(first["date"]) == "2020-01-01" or first[c] == want.get(kind, first[c])
        assert ("p_month" in first) is ("moment" in rules.values())
        for _run in range(2):
            bronze.write.mode("append").parquet(f"{home}/{name}/bronze") if _run == 0 else None
            etl.ingest_table(spark, name, f"{home}/{name}/bronze", bronze.schema, f"{home}/{name}/silver", f"{home}/{name}/c")
        assert versions.read_as_of(spark, f"{home}/{name}/silver").count() == 2
    with pytest.raises(SchemaMismatch):
        etl.silver_table(bronze.withColumn("asof", F.array("asof")), "prices")


def test_tokens_of_a_direction_against_all_products():
    """What settles a pair before the rounds: every likely token that ranks before it, trained ones left out."""
    rng = np.random.default_rng(5)
    factors, users = rng.normal(size=(300, 3)), rng.normal(size=(50, 3))
    users[0] = 0
    places, likely = recommend._likely_tokens(factors, users[:7])
    row, token = np.repeat(np.arange(50), 4), rng.integers(0, 300, 200)
    own = np.einsum("ij,ij->i", users[row], factors[token])
    trained = np.nonzero(rng.random((50, len(places))) < 0.3)
    got = recommend._likely_ahead(users, row, own, trained, likely)
    known, directions = set(zip(*(t.tolist() for t in trained))), likely[2]
    for i in range(200):
        mine = likely[1][int(np.argmax(directions @ users[row[i]]))]
        scores = {p: users[row[i]] @ factors[places[p]] for p in mine.tolist() if (row[i], p) not in known}
        assert got[i] == sum(s > own[i] + recommend.TIE * abs(own[i]) for s in scores.values())
    best = set(np.argsort(-(directions[1] @ factors.T))[: recommend._LIKELY].tolist())
    assert set(places[likely[1][1]].tolist()) == best


def test_rounds_read_open_wallets_only(spark, home, monkeypatch):
    """Two groups with tokens of their own: once most pairs are settled, later rounds meet the wallets of the
    others, and what they read is that of these wallets."""
    data = [(f"w{w}", f"t{t}") for w in range(80) for t in range(90) if t % 2 == w % 2 and (w * 7 + t) % 9]
    ids = recommend.with_integer_ids(readers.rows(spark, data, "wallet STRING, token STRING").withColumn("n_transfers", F.lit(1)))
    model = recommend.fit_als(ids, rank=4, max_iter=3)
    # Half of the tokens held out are of the other group: for such pairs many tokens rank before them.
    held = [(f"w{w}", f"t{t}") for w in range(80) for t in range(90) if t % 2 != w % 2 and (w + t) % 11 == 0 or w < 8 and t % 2 == w % 2 and not (w * 7 + t) % 9]
    pairs = readers.rows(spark, held, "wallet STRING, token STRING")
    whole = recommend.recall_at_k(model, ids, pairs, 3).first()
    written, plain = [], recommend.materialize
    monkeypatch.setattr(recommend, "materialize", lambda df, label: (written.append((label, out := plain(df, label))), out)[1])
    monkeypatch.setattr(recommend, "TOKENS_A_ROUND", 30)
    monkeypatch.setattr(recommend, "_FIRST_ROUND", 10, raising=False)
    assert recommend.recall_at_k(model, ids, pairs, 3).first() == whole
    counted = [t.count() for label, t in written if label == "counted"]
    users, trained = ([t for label, t in written if label == "open" and ("features" in t.columns) == f] for f in (True, False))
    assert counted[0] == whole["n_pairs"] and len(counted) > 1 and all(n < counted[0] // 2 for n in counted[1:])
    assert users and users[-1].count() <= 40 and trained[-1].count() <= len(data) // 2
