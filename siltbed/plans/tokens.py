"""Token analytics on stand-ins: orders are transactions, lineitems are token transfers."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.chain import eda, etl, project, recommend
from siltbed.operators import versions
from siltbed.plans.registry import query, r6, table
from siltbed.scratch import fresh_dir, materialize

FIRST_DAY = "1995-01-01"  # day of block 0
WALLET = 7  # the wallet asked about
SPLIT_DAY = "1998-07-01"  # history before, held-out after


def block_number(day):
    return F.datediff(F.col(day).cast("date"), F.lit(FIRST_DAY).cast("date")).cast("bigint")


def transactions(spark, sf):
    """to_address is left out: the contract question takes it from the line items."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("hash"),
        block_number("o_orderdate").alias("block_number"),
        F.col("o_orderkey").alias("transaction_index"),
        F.col("o_custkey").alias("from_address"),
        (F.round(F.col("o_totalprice") * 100).cast(eda.WEI) * F.lit(10**16).cast("DECIMAL(17,0)"))
        .cast(eda.WEI)
        .alias("value"),
        F.col("o_totalprice").alias("gas_price"),
        "o_orderdate",
    )


def transfers(spark, sf, sender=False):
    """Line items as transfers; the sender needs the order and is joined only on demand."""
    t = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("token_address"),
        F.col("l_suppkey").alias("to_address"),
        F.col("l_quantity").cast(eda.WEI).alias("value"),
        F.col("l_orderkey").alias("transaction_hash"),
        block_number("l_shipdate").alias("block_number"),
        F.col("l_shipdate").cast("date").alias("date"),
    )
    if sender:
        o = table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("transaction_hash"), F.col("o_custkey").alias("from_address")
        )
        t = t.join(o, "transaction_hash")
    return t


def contracts(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("address"), (F.col("p_size") > 25).alias("is_erc20")
    )


def purchases(spark, sf):
    """Wallet (customer) and token (part) pairs: the buyer is who receives the token."""
    return transfers(spark, sf, sender=True).withColumn("to_address", F.col("from_address"))


def pairs_table(spark, sf):
    """The wallet and token pairs as a stored table, as the recommender would find it."""
    return materialize(recommend.interactions(purchases(spark, sf)), "pairs")


def id_pairs(spark, sf):
    pairs = pairs_table(spark, sf).select("wallet", "token", "n_transfers")
    return materialize(recommend.with_integer_ids(pairs), "ids")


PAIRS_SQL = """SELECT o_custkey AS wallet, l_partkey AS token, count(*) AS n_transfers, sum(l_quantity) AS amount
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""


@query(
    "eda_max_block",
    f"""SELECT max(CAST(o_orderdate AS DATE) - DATE '{FIRST_DAY}') AS max_block, max(o_orderdate) AS block_time FROM orders""",
)
def _(spark, sf):
    blocks = table(spark, sf, "orders").select(
        block_number("o_orderdate").alias("number"), F.col("o_orderdate").alias("timestamp")
    )
    return eda.max_block(blocks)


@query("eda_first_transfer", f"SELECT min(CAST(l_shipdate AS DATE) - DATE '{FIRST_DAY}') AS first_block FROM lineitem")
def _(spark, sf):
    return eda.first_transfer(transfers(spark, sf))


@query("eda_token_contracts", "SELECT count(DISTINCT p_partkey) AS n_contracts FROM part WHERE p_size > 25")
def _(spark, sf):
    return eda.token_contracts(contracts(spark, sf))


@query(
    "eda_contract_call_pct",
    """SELECT round(avg(CASE WHEN c.k IS NULL THEN 0e0 ELSE 1e2 END), 6) AS pct FROM lineitem l
       LEFT JOIN (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size > 25) c ON l.l_partkey = c.k""",
)
def _(spark, sf):
    calls = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("to_address"))
    return eda.contract_call_pct(calls, contracts(spark, sf).where("is_erc20")).select(r6("pct").alias("pct"))


@query(
    "eda_top_tokens",
    """SELECT l_partkey AS token_address, p_name AS symbol, n AS n_transfers FROM
         (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 100)
       LEFT JOIN part ON p_partkey = l_partkey""",
)
def _(spark, sf):
    tokens = table(spark, sf, "part").select(F.col("p_partkey").alias("address"), F.col("p_name").alias("symbol"))
    return eda.top_tokens(transfers(spark, sf), tokens, 100)


@query(
    "eda_new_address_frac",
    """SELECT round(avg(CASE WHEN n = 1 THEN 1e0 ELSE 0e0 END), 6) AS fraction FROM
         (SELECT count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n FROM lineitem) t""",
)
def _(spark, sf):
    return eda.new_address_fraction(transfers(spark, sf)).select(r6("fraction").alias("fraction"))


@query(
    "eda_order_in_block",
    f"""SELECT CAST(o_orderdate AS DATE) - DATE '{FIRST_DAY}' AS block_number, count(*) AS n,
               round(corr(o_orderkey, o_totalprice), 6) AS correlation
        FROM orders GROUP BY 1 HAVING count(*) > 1""",
)
def _(spark, sf):
    out = eda.gas_order_correlation(transactions(spark, sf))
    return out.withColumn("correlation", r6("correlation"))


@query(
    "eda_gas_rank",
    f"""SELECT o_orderkey AS hash, row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) AS position,
               row_number() OVER (PARTITION BY o_orderdate ORDER BY o_totalprice DESC, o_orderkey) AS gas_rank
        FROM orders""",
)
def _(spark, sf):
    return eda.gas_order(transactions(spark, sf)).select("hash", "position", "gas_rank")


@query("eda_max_tps", "SELECT round(max(n) / 15e0, 6) AS tps FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderdate) t")
def _(spark, sf):
    return eda.max_throughput(transactions(spark, sf)).select(r6("tps").alias("tps"))


@query(
    "eda_ether_volume",
    """SELECT round(CAST(sum(CAST(round(o_totalprice * 100) AS HUGEINT)) AS DOUBLE) / 100, 2) AS ether FROM orders""",
)
def _(spark, sf):
    return eda.ether_volume(transactions(spark, sf)).select(F.round("ether", 2).alias("ether"))


@query("eda_gas_used", "SELECT CAST(sum(CAST(round(l_tax * 100) AS BIGINT)) AS BIGINT) AS gas_used FROM lineitem")
def _(spark, sf):
    receipts = table(spark, sf, "lineitem").select(F.round(F.col("l_tax") * 100).alias("gas_used"))
    return eda.gas_used(receipts)


@query(
    "eda_max_transfers_tx",
    "SELECT max(n) AS max_transfers FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey) t",
)
def _(spark, sf):
    return eda.max_transfers_in_transaction(transfers(spark, sf))


MOVES_SQL = """SELECT l_suppkey AS address, l_partkey AS token_address, l_quantity AS q, CAST(l_shipdate AS DATE) AS d FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT o_custkey, l_partkey, -l_quantity, CAST(l_shipdate AS DATE) FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


@query(
    "eda_balance_on_date",
    f"""SELECT address, token_address, CAST(sum(q) AS BIGINT) AS balance FROM ({MOVES_SQL})
        WHERE d <= DATE '1998-01-01' GROUP BY address, token_address""",
)
def _(spark, sf):
    out = eda.balance_on(transfers(spark, sf, sender=True), "1998-01-01")
    return out.select("address", "token_address", F.col("balance").cast("bigint").alias("balance"))


DAILY_SQL = f"""SELECT address, token_address, d AS date, change,
    sum(change) OVER (PARTITION BY address, token_address ORDER BY d) AS balance FROM
    (SELECT address, token_address, d, sum(q) AS change FROM ({MOVES_SQL}) GROUP BY 1, 2, 3)"""


@query(
    "eda_balance_history",
    f"SELECT address, token_address, date, CAST(change AS BIGINT) AS change, CAST(balance AS BIGINT) AS balance FROM ({DAILY_SQL})",
)
def _(spark, sf):
    out = eda.balance_history(transfers(spark, sf, sender=True))
    return out.select("address", "token_address", "date", *(F.col(c).cast("bigint").alias(c) for c in ["change", "balance"]))


@query("eda_tx_over_time", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1")
def _(spark, sf):
    return eda.per_day(table(spark, sf, "orders"), "o_orderdate")


@query("eda_transfers_over_time", "SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n FROM lineitem GROUP BY 1")
def _(spark, sf):
    return eda.per_day(table(spark, sf, "lineitem"), "l_shipdate")


@query(
    "etl_silver_transfers",
    """SELECT '0x' || lower(printf('%X', l_partkey)) AS token_address, CAST(l_quantity AS BIGINT) AS value,
              CAST(l_orderkey AS VARCHAR) AS transaction_hash, CAST(l_shipdate AS DATE) AS date FROM lineitem""",
)
def _(spark, sf):
    """Bronze transfers as they come (text amounts, mixed-case addresses), ingested twice."""
    home = fresh_dir(spark, "transfers")
    bronze = table(spark, sf, "lineitem").select(
        F.concat(F.lit("0x"), F.hex("l_partkey")).alias("token_address"),
        F.col("l_suppkey").cast("string").alias("to_address"),
        F.col("l_quantity").cast("bigint").cast("string").alias("value"),
        F.col("l_orderkey").cast("string").alias("transaction_hash"),
        F.col("l_shipdate").cast("timestamp").alias("block_timestamp"),
    )
    bronze.write.parquet(f"{home}/bronze")
    for _run in range(2):
        etl.ingest_transfers(spark, f"{home}/bronze", bronze.schema, f"{home}/silver", f"{home}/checkpoint")
    silver = versions.read_as_of(spark, f"{home}/silver")
    return silver.select(
        "token_address", F.col("value").cast("bigint").alias("value"), "transaction_hash", "date"
    )


@query(
    "etl_long_amounts",
    f"""SELECT CAST(address AS VARCHAR) AS address, CAST(token_address AS VARCHAR) AS token_address, balance IS NULL AS beyond,
               CASE WHEN q = 0 THEN '0' ELSE CAST(q AS VARCHAR) || repeat('0', 40) END AS balance_digits
        FROM (SELECT address, token_address, CAST(sum(q) AS BIGINT) AS q, CASE WHEN sum(q) = 0 THEN 0 END AS balance
              FROM ({MOVES_SQL}) GROUP BY address, token_address)""",
)
def _(spark, sf):
    """Amounts of 41 and 42 digits from bronze text to balances."""
    moves = transfers(spark, sf, sender=True)
    text = F.concat(F.col("value").cast("string"), F.lit("0" * 40))
    names = [F.col(c).cast("string").alias(c) for c in ("token_address", "from_address", "to_address", "transaction_hash")]
    silver = etl.silver_transfers(moves.select(*names, text.alias("value"), F.col("date").cast("timestamp").alias("block_timestamp")))
    out = eda.balance_on(silver, "2100-01-01")
    return out.select("address", "token_address", F.col("balance").isNull().alias("beyond"), "balance_digits")


@query(
    "etl_silver_transactions",
    """SELECT '0x' || lower(printf('%X', o_orderkey)) AS hash, CAST(o_custkey AS VARCHAR) AS from_address,
              CAST(round(o_totalprice * 100) AS BIGINT) AS value, CAST(round(o_totalprice * 100) AS BIGINT)::VARCHAR AS value_digits,
              CAST(NULL AS BIGINT) AS gas, CAST(o_orderdate AS DATE) AS date, CAST(date_trunc('month', o_orderdate) AS DATE) AS p_month FROM orders""",
)
def _(spark, sf):
    """Bronze transactions as text with an odd column, ingested twice into a table by month."""
    home = fresh_dir(spark, "transactions")
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit(" 0x"), F.hex("o_orderkey")).alias("hash"),
        F.col("o_custkey").cast("string").alias("from_address"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string").alias("value"),
        F.col("o_orderdate").cast("date").cast("string").alias("block_timestamp"),
        F.lit("none").alias("gas"),
        F.lit(1).alias("extra"),
    )
    orders.write.parquet(f"{home}/bronze")
    for _run in range(2):
        etl.ingest_table(spark, "transactions", f"{home}/bronze", orders.schema, f"{home}/silver", f"{home}/checkpoint")
    silver = versions.read_as_of(spark, f"{home}/silver")
    return silver.select("hash", "from_address", F.col("value").cast("bigint").alias("value"), F.col("digits").alias("value_digits"), "gas", "date", "p_month")


@query(
    "price_enrich",
    f"""WITH p AS (SELECT l_partkey AS token_address, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice) AS price_usd
                   FROM lineitem GROUP BY 1, 2)
        SELECT b.address, b.token_address, b.date, CAST(b.balance AS BIGINT) AS balance,
               round(b.balance / pow(10.0::DOUBLE, p_size % 4) * p.price_usd, 6) AS usd
        FROM ({DAILY_SQL}) b LEFT JOIN p ON b.token_address = p.token_address AND b.date = p.date
        LEFT JOIN part ON p_partkey = b.token_address""",
)
def _(spark, sf):
    """Line items are the price feed, several to a token and day; a part's size gives its decimals."""
    feed = table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("token_address"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_extendedprice").alias("price_usd")
    )
    tokens = table(spark, sf, "part").select(F.col("p_partkey").alias("address"), (F.col("p_size") % 4).alias("decimals"))
    out = eda.with_price(eda.balance_history(transfers(spark, sf, sender=True)), feed, tokens)
    return out.select(
        "address", "token_address", "date", F.col("balance").cast("bigint").alias("balance"),
        r6("usd").alias("usd"),
    )


@query(
    "rec_interactions",
    f"""SELECT o_custkey AS wallet, l_partkey AS token, count(*) AS n_transfers, CAST(sum(l_quantity) AS BIGINT) AS amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) >= DATE '1997-01-01' GROUP BY 1, 2""",
)
def _(spark, sf):
    out = recommend.interactions(purchases(spark, sf), "1997-01-01")
    return out.withColumn("amount", F.col("amount").cast("bigint"))


SIMILAR_SQL = f"""WITH h AS ({PAIRS_SQL}), me AS (SELECT token FROM h WHERE wallet = {WALLET}),
    s AS (SELECT wallet, count(*) AS held, count(me.token) AS shared FROM h LEFT JOIN me USING (token) WHERE wallet <> {WALLET} GROUP BY wallet),
    near AS (SELECT wallet, shared, shared / sqrt(held * CAST((SELECT count(*) FROM me) AS DOUBLE)) AS cosine FROM s WHERE shared > 0)"""


@query("rec_similar_wallets", f"{SIMILAR_SQL} SELECT wallet, shared, round(cosine, 6) AS cosine FROM near")
def _(spark, sf):
    out = recommend.similar_wallets(pairs_table(spark, sf), WALLET)
    return out.withColumn("cosine", r6("cosine"))


@query(
    "rec_top_tokens",
    f"""{SIMILAR_SQL},
        sc AS (SELECT token, round(sum(cosine), 9) AS score FROM h JOIN near USING (wallet)
               WHERE token NOT IN (SELECT token FROM me) GROUP BY token)
        SELECT CAST(row_number() OVER (ORDER BY score DESC, token) AS INTEGER) AS rank, token, round(score, 6) AS score,
               'https://etherscan.io/token/' || token AS link
        FROM (SELECT * FROM sc ORDER BY score DESC, token LIMIT 10)""",
)
def _(spark, sf):
    out = recommend.top_tokens_for(pairs_table(spark, sf), WALLET, 10)
    return out.withColumn("score", r6("score"))


PROPERTY_SQL = f"""WITH h AS ({PAIRS_SQL})
    SELECT least(10, count(DISTINCT token) FILTER (WHERE token NOT IN (SELECT token FROM h WHERE wallet = {WALLET}))) AS n_tokens,
           CAST(0 AS BIGINT) AS n_held FROM h"""


def _properties(best, pairs, wallet):
    """A recommendation: as many different tokens as asked for, none that the wallet holds."""
    held = pairs.where(F.col("wallet") == F.lit(wallet)).select("token", F.lit(1).alias("held"))
    return best.join(held, "token", "left").agg(F.count_distinct("token").alias("n_tokens"), F.count("held").alias("n_held"))


@query("rec_als", PROPERTY_SQL)
def _(spark, sf):
    ids = id_pairs(spark, sf)
    model = recommend.fit_als(ids.select("wallet_id", "token_id", "n_transfers"))
    return _properties(recommend.recommend_als(model, ids, WALLET, 10), ids, WALLET)


@query(
    "rec_eval",
    f"""WITH t AS (SELECT o_custkey AS wallet, l_partkey AS token, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
             past AS (SELECT wallet, token, count(*) AS n FROM t WHERE d < DATE '{SPLIT_DAY}' GROUP BY 1, 2),
             rec AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wallet ORDER BY n DESC, token) AS rank FROM past) WHERE rank <= 10),
             truth AS (SELECT DISTINCT wallet, token FROM t WHERE d >= DATE '{SPLIT_DAY}'),
             hits AS (SELECT wallet, count(*) AS hits FROM rec JOIN truth USING (wallet, token) GROUP BY wallet)
        SELECT wallet, round(coalesce(hits, 0) / 10e0, 6) AS precision, round(coalesce(hits, 0) / CAST(n AS DOUBLE), 6) AS recall
        FROM (SELECT wallet, count(*) AS n FROM truth GROUP BY wallet) LEFT JOIN hits USING (wallet)""",
)
def _(spark, sf):
    """How well a wallet's most frequent tokens so far foretell the tokens it gets later."""
    past, later = recommend.split_interactions(purchases(spark, sf), SPLIT_DAY)
    best = recommend.top_k_per_wallet(past, 10, "n_transfers")
    out = recommend.ranking_quality(best, later, 10)
    return out.withColumns({"precision": r6("precision"), "recall": r6("recall")})


@query(
    "rec_als_compare",
    f"""WITH h AS ({PAIRS_SQL}), n AS (SELECT count(*) AS n_pairs FROM h WHERE (31 * wallet + token) % 5 = 0)
        SELECT params, n_pairs, true AS a_share FROM n, (VALUES ('{{''rank'': 4}}'), ('{{''rank'': 8, ''reg'': 0.01}}')) p(params)""",
)
def _(spark, sf):
    """Two parameter sets, each asked to rank every held-out pair."""
    ids = id_pairs(spark, sf)
    held_out = F.pmod(31 * F.col("wallet") + F.col("token"), F.lit(5)) == 0
    out = recommend.compare_als(
        ids.where(~held_out), ids.where(held_out), [{"rank": 4}, {"rank": 8, "reg": 0.01}]
    )
    share = (F.col("recall") > 0) & (F.col("recall") <= 1) & (F.col("n_unknown") < F.col("n_pairs"))
    return out.select("params", "n_pairs", share.alias("a_share"))


@query("token_project", PROPERTY_SQL)
def _(spark, sf):
    """Ingest, train, promote, recommend over a bronze copy of the purchases."""
    home = fresh_dir(spark, "project")
    bronze = purchases(spark, sf).select(
        F.col("token_address").cast("string").alias("token_address"),
        F.col("to_address").cast("string").alias("to_address"),
        F.col("value").cast("string").alias("value"),
        F.col("transaction_hash").cast("string").alias("transaction_hash"),
        "block_number",
        F.col("date").cast("timestamp").alias("block_timestamp"),
    )
    bronze.write.parquet(f"{home}/bronze")
    best = project.run_project(
        spark, f"{home}/out", f"{home}/bronze", bronze.schema, str(WALLET), grid=[{"rank": 4}, {"rank": 8}]
    )
    pairs = spark.read.parquet(f"{home}/out/pairs").select("wallet", "token")
    return _properties(best, pairs, str(WALLET))
