"""Questions about blocks, transactions and token transfers.

Tables follow one naming: ``blocks(number, timestamp)``, ``transactions(hash, block_number,
transaction_index, from_address, to_address, value, gas_price)``, ``receipts(transaction_hash,
gas_used)``, ``token_transfers(token_address, from_address, to_address, value, transaction_hash,
block_number)``, ``tokens(address, symbol)``, ``contracts(address, is_erc20)``,
``prices(token_address, date, price_usd)``. Amounts are whole wei in DECIMAL(38,0), or text of digits where
they are longer. Balances are summed in limbs (``functions.amounts``), so none is rounded at any size.

Wherever a popular address or token could crowd one task, rows are counted per key first and only
the counts are joined or ranked.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltbed.functions import amounts
from siltbed.operators.ordering import row_number_within, top_k

BLOCK_SECONDS = 15
WEI = "DECIMAL(38,0)"
WEI_PER_ETHER = 10**18


def max_block(blocks: DataFrame) -> DataFrame:
    """Highest block number and when it was made."""
    return blocks.agg(
        F.max("number").alias("max_block"), F.max_by("timestamp", "number").alias("block_time")
    )


def first_transfer(transfers: DataFrame) -> DataFrame:
    return transfers.agg(F.min("block_number").alias("first_block"))


def token_contracts(contracts: DataFrame) -> DataFrame:
    return contracts.where("is_erc20").agg(F.count_distinct("address").alias("n_contracts"))


def contract_call_pct(transactions: DataFrame, contracts: DataFrame) -> DataFrame:
    """Share of transactions, in percent, whose target is a contract."""
    per_target = transactions.groupBy("to_address").agg(F.count("*").alias("n"))
    known = contracts.select(F.col("address").alias("to_address")).distinct()
    marked = per_target.join(known.withColumn("_called", F.lit(True)), "to_address", "left")
    calls = F.sum(F.when(F.col("_called"), F.col("n")).otherwise(0))
    return marked.agg((calls * 100.0 / F.sum("n")).cast("double").alias("pct"))


def top_tokens(transfers: DataFrame, tokens: DataFrame, k: int = 100) -> DataFrame:
    """The k tokens with most transfers, the most first; symbols are looked up for those k only, and a
    token that is listed several times has the least of its symbols."""
    n = transfers.groupBy("token_address").agg(F.count("*").alias("n_transfers"))
    best = top_k(n, [F.desc("n_transfers"), F.asc("token_address")], k)
    names = tokens.select(F.col("address").alias("token_address"), "symbol")
    named = names.join(F.broadcast(best.select("token_address")), "token_address", "left_semi")
    once = named.groupBy("token_address").agg(F.min("symbol").alias("symbol"))
    joined = best.join(once, "token_address", "left").select("token_address", "symbol", "n_transfers")
    return joined.orderBy(F.desc("n_transfers"), F.asc("token_address"))


def new_address_fraction(transfers: DataFrame) -> DataFrame:
    """Fraction of transfers that are the only one of their token to their receiver."""
    n = transfers.groupBy("token_address", "to_address").agg(F.count("*").alias("n"))
    return n.agg(
        (F.sum(F.when(F.col("n") == 1, 1).otherwise(0)) / F.sum("n")).alias("fraction")
    )


def gas_order(transactions: DataFrame) -> DataFrame:
    """Each transaction's place in its block next to its rank by gas price, highest first."""
    t = transactions.select("hash", "block_number", "transaction_index", "gas_price")
    placed = row_number_within(t, ["block_number"], ["transaction_index", "hash"], "position")
    return row_number_within(
        placed,
        ["block_number"],
        [F.desc("gas_price"), F.asc("transaction_index"), F.asc("hash")],
        "gas_rank",
    )


def gas_order_correlation(transactions: DataFrame) -> DataFrame:
    """Per block with several transactions: correlation of index and gas price (-1: strictly
    from the highest price down)."""
    per_block = transactions.groupBy("block_number").agg(
        F.count("*").alias("n"), F.corr("transaction_index", "gas_price").alias("correlation")
    )
    return per_block.where("n > 1")


def max_throughput(transactions: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """Transactions per second of the fullest block."""
    n = transactions.groupBy("block_number").agg(F.count("*").alias("n"))
    return n.agg((F.max("n") / F.lit(float(block_seconds))).alias("tps"))


def _unit() -> Column:
    return F.lit(WEI_PER_ETHER).cast("DECIMAL(19,0)")


def _parts(amount: str) -> tuple[Column, Column]:
    """Whole ether and the wei left over. Without its rest an amount divides evenly, so no digit is
    rounded away."""
    wei = F.col(amount).cast(WEI)
    rest = wei % _unit()
    return ((wei - rest).cast(WEI) / _unit()).cast("DECIMAL(20,0)"), rest.cast("DECIMAL(18,0)")


def ether_volume(transactions: DataFrame) -> DataFrame:
    """Total value in ether.

    Whole ether and the wei left over are summed apart: a sum of wei alone could pass 38 digits.
    """
    whole, rest = _parts("value")
    sums = transactions.agg(F.sum(whole).alias("whole"), F.sum(rest).alias("rest"))
    return sums.select(
        (F.col("whole").cast("double") + F.col("rest").cast("double") / float(WEI_PER_ETHER)).alias(
            "ether"
        )
    )


def gas_used(receipts: DataFrame) -> DataFrame:
    return receipts.agg(F.sum(F.col("gas_used").cast("bigint")).alias("gas_used"))


def max_transfers_in_transaction(transfers: DataFrame) -> DataFrame:
    n = transfers.groupBy("transaction_hash").agg(F.count("*").alias("n"))
    return n.agg(F.max("n").alias("max_transfers"))


def _digits(transfers: DataFrame) -> Column:
    """The amounts as digits: as the ETL keeps them, or those of a DECIMAL(38,0) ``value``."""
    value = F.col("value").cast(WEI).cast("string")
    return F.coalesce("digits", value) if "digits" in transfers.columns else value


def movements(transfers: DataFrame) -> DataFrame:
    """Each transfer as one gain and one loss: (address, token_address, date, signed limbs). One scan."""
    side = lambda address, sign: F.struct(F.col(address).alias("address"), F.lit(sign).cast("bigint").alias("sign"))
    cut = transfers.select("to_address", "from_address", "token_address", "date", *amounts.limbs(_digits(transfers)))
    both = cut.select("token_address", "date", *amounts.NAMES, F.inline(F.array(side("to_address", 1), side("from_address", -1))))
    return both.select("address", "token_address", "date", *((F.col(n) * F.col("sign")).alias(n) for n in amounts.NAMES))


def _summed(names: list[str]) -> list[Column]:
    return [F.sum(n).alias(n) for n in names]


def balance_on(transfers: DataFrame, day: date | str, address: Column | None = None) -> DataFrame:
    """Token balances at the end of a day; ``address`` is an optional predicate on it.

    ``balance_digits`` is exact at any size; ``whole`` and ``rest`` are its whole ether and the wei left over,
    ``balance`` is the number itself, NULL beyond 38 digits.
    """
    moves = movements(transfers).where(F.col("date") <= F.lit(str(day)).cast("date"))
    if address is not None:
        moves = moves.where(address)
    sums = amounts.totals(moves.groupBy("address", "token_address").agg(*_summed(amounts.NAMES)), amounts.NAMES, "balance")
    whole, rest = amounts.parts(F.col("balance_digits"))
    return sums.withColumns({"whole": whole, "rest": rest})


def balance_history(transfers: DataFrame) -> DataFrame:
    """Balance after each day on which it moved, with the day's change; amounts as in ``balance_on``.

    Moves are first summed per day, so one window holds at most one row per day.
    """
    daily = movements(transfers).groupBy("address", "token_address", "date").agg(*_summed(amounts.NAMES))
    upto = (
        Window.partitionBy("address", "token_address")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    so_far = [f"total_{n}" for n in amounts.NAMES]
    summed = daily.withColumns({t: F.sum(n).over(upto) for t, n in zip(so_far, amounts.NAMES)})
    return amounts.totals(amounts.totals(summed, amounts.NAMES, "change"), so_far, "balance")


def per_day(rows: DataFrame, time: str, name: str = "n") -> DataFrame:
    return rows.groupBy(F.to_date(time).alias("date")).agg(F.count("*").alias(name))


def with_price(balances: DataFrame, prices: DataFrame, tokens: DataFrame, amount: str = "balance") -> DataFrame:
    """Dated balances with that day's price and their worth in dollars; no price gives NULL.

    A balance counts the token's smallest unit, of which 10 ** decimals make one token. A token that is
    not listed, or without decimals, counts as it is. A day that the feed prices several times has the
    greatest of its prices; a token listed several times has the most of its decimals. A balance beyond 38
    digits counts by its ``balance_digits``. Worth is a DOUBLE: about 15 digits of it are exact.
    """
    feed = prices.groupBy("token_address", "date").agg(F.max("price_usd").alias("price_usd"))
    places = tokens.groupBy(F.col("address").alias("token_address")).agg(F.max("decimals").cast("int").alias("decimals"))
    joined = balances.join(feed, ["token_address", "date"], "left").join(places, "token_address", "left")
    units = F.pow(F.lit(10.0), F.coalesce("decimals", F.lit(0)))
    held = F.col(amount).cast("double")
    if f"{amount}_digits" in balances.columns:
        held = F.coalesce(held, F.col(f"{amount}_digits").cast("double"))
    return joined.withColumn("usd", held / units * F.col("price_usd"))
