"""Bronze to silver for token transfers and the chain's other tables: typed columns, incremental ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.functions import amounts
from siltbed.operators.schemas import SchemaMismatch, from_ddl
from siltbed.sources import readers
from siltbed.streaming.control import finish
from siltbed.streaming.sinks import append_writer

BRONZE_TRANSFERS = (
    "token_address STRING, from_address STRING, to_address STRING, value STRING, "
    "transaction_hash STRING, block_number BIGINT, block_timestamp TIMESTAMP"
)


def migrate(df: DataFrame, expected: StructType | str) -> DataFrame:
    """Columns of ``expected``: absent ones become NULL, others are cast; extra ones are dropped.

    A column whose type cannot be cast without changing its meaning (struct, array, map against a
    plain type) raises.
    """
    want = from_ddl(expected)
    have = {f.name: f.dataType for f in df.schema}
    for f in want:
        nested = {"struct", "array", "map"}
        if f.name in have and have[f.name] != f.dataType:
            if have[f.name].typeName() in nested or f.dataType.typeName() in nested:
                raise SchemaMismatch(f"{f.name}: {have[f.name].simpleString()} cannot become {f.dataType.simpleString()}")
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in want
        ]
    )


def _amount(name: str) -> dict[str, Column]:
    """A text amount as DECIMAL(38,0), as digits (at most 78 of them), and as text where it is neither."""
    digits = amounts.canonical(F.col(name).cast("string"))
    unread = "unread_value" if name == "value" else f"unread_{name}"
    exact = "digits" if name == "value" else f"{name}_digits"
    return {name: amounts.decimal(digits), exact: digits, unread: F.when(digits.isNull(), F.col(name).cast("string"))}


def silver_transfers(bronze: DataFrame) -> DataFrame:
    """Typed transfers: lower-case addresses, amounts as whole wei, the block's date.

    ``digits`` is the amount as text, exact up to 78 digits (256 bits); ``value`` is the same as a number,
    NULL beyond 38. What is not a whole number, a fraction for instance, has neither; its text is then kept
    as ``unread_value``, and ``unread`` counts such rows.
    """
    b = migrate(bronze, BRONZE_TRANSFERS)
    return b.select(
        F.lower("token_address").alias("token_address"),
        F.lower("from_address").alias("from_address"),
        F.lower("to_address").alias("to_address"),
        *(c.alias(n) for n, c in _amount("value").items()),
        F.lower("transaction_hash").alias("transaction_hash"),
        "block_number",
        F.to_date("block_timestamp").alias("date"),
        F.trunc("block_timestamp", "month").alias("p_month"),
    )


#: Bronze columns of the chain's other tables and what each becomes: a hash or address in lower case, an
#: amount (as in transfers), a number, a moment (also as ``date`` and month, where a table has one), or the
#: type as it is named. Names as the raw exports have them.
TABLES = {
    "blocks": {"number": "bigint", "hash": "hash", "miner": "hash", "gas_used": "bigint", "transaction_count": "bigint", "timestamp": "moment"},
    "transactions": {
        "hash": "hash", "block_number": "bigint", "transaction_index": "bigint", "from_address": "hash", "to_address": "hash",
        "value": "amount", "gas": "bigint", "gas_price": "bigint", "block_timestamp": "moment",
    },
    "receipts": {"transaction_hash": "hash", "gas_used": "bigint", "contract_address": "hash", "status": "int"},
    "tokens": {"address": "hash", "symbol": "string", "name": "string", "decimals": "int", "total_supply": "amount"},
    "contracts": {"address": "hash", "is_erc20": "boolean", "is_erc721": "boolean", "block_timestamp": "moment"},
    "prices": {"token_address": "hash", "price_usd": "double", "asof": "moment"},
}
MONTH = "p_month"


def silver_table(bronze: DataFrame, name: str) -> DataFrame:
    """Bronze rows of one of ``TABLES`` with typed columns. Absent columns are NULL, extra ones go; text that
    does not fit its type becomes NULL. Numbers of seconds are moments, too."""
    rules = TABLES[name]
    have = {f.name: f.dataType for f in bronze.schema}
    nested = [c for c in rules if c in have and have[c].typeName() in {"struct", "array", "map"}]
    if nested:
        raise SchemaMismatch(f"{', '.join(nested)} cannot become a plain column of {name}")
    b = bronze.select(*[(F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in rules])
    out: dict[str, Column] = {}
    for c, kind in rules.items():
        if kind == "hash":
            out[c] = F.lower(F.trim(F.col(c).cast("string")))
        elif kind == "amount":
            out |= _amount(c)
        elif kind == "moment":
            text = F.col(c).cast("string")
            moment = F.coalesce(F.timestamp_seconds(F.when(text.rlike("^[0-9]{1,12}$"), text).cast("bigint")), text.try_cast("timestamp"))
            out |= {c: moment, "date": moment.cast("date"), MONTH: F.trunc(moment, "month")}
        else:
            out[c] = F.col(c).cast("string").try_cast(kind)
    last = [MONTH] if MONTH in out else []
    return b.select(*[v.alias(n) for n, v in out.items() if n not in last], *[out[n].alias(n) for n in last])


def unread(silver: DataFrame) -> DataFrame:
    """Number of transfers whose amount could not be read."""
    return silver.agg(F.count("unread_value").alias("n_unread"))


def _ingest(
    spark: SparkSession, bronze_path: str, schema: StructType | str, table: str, checkpoint: str,
    to_silver: Callable[[DataFrame], DataFrame], name: str, limit: float | None,
) -> None:
    silver = to_silver(readers.table_stream(spark, bronze_path, schema))
    writer = append_writer(silver, table, checkpoint, name, partition_by=[MONTH] if MONTH in silver.columns else [])
    finish(writer.trigger(availableNow=True).start(), limit)


def ingest_transfers(
    spark: SparkSession, bronze_path: str, schema: StructType | str, table: str, checkpoint: str,
    limit: float | None = None,
) -> None:
    """Add what is new in bronze to the silver table; running it again adds nothing twice.

    Years of history make a few hundred months but thousands of days, so the table is partitioned
    by month.
    """
    _ingest(spark, bronze_path, schema, table, checkpoint, silver_transfers, "silver_transfers", limit)


def ingest_table(
    spark: SparkSession, name: str, bronze_path: str, schema: StructType | str, table: str, checkpoint: str,
    limit: float | None = None,
) -> None:
    """The same for one of ``TABLES``."""
    _ingest(spark, bronze_path, schema, table, checkpoint, lambda b: silver_table(b, name), f"silver_{name}", limit)
