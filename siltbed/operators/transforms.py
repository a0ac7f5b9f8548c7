"""Row-wise steps between the layers: ingest metadata, JSON parsing, filters."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.functions.columns import epoch_to_date, epoch_to_timestamp

BRONZE_SCHEMA = (
    "datasource STRING NOT NULL, ingesttime TIMESTAMP NOT NULL, "
    "value STRING, p_ingestdate DATE NOT NULL"
)
SILVER_V1_SCHEMA = (
    "device_id INT, heartrate DOUBLE, eventtime TIMESTAMP, name STRING, p_eventdate DATE"
)
SILVER_V2_SCHEMA = (
    "device_id INT, device_type STRING, heartrate DOUBLE, eventtime TIMESTAMP, "
    "name STRING, p_eventdate DATE"
)


def ingest_metadata(raw: DataFrame, datasource: str = "device-drop") -> DataFrame:
    """Raw lines plus where and when they came in."""
    now = F.current_timestamp()
    return raw.select(
        F.lit(datasource).alias("datasource"),
        now.alias("ingesttime"),
        "value",
        now.cast("date").alias("p_ingestdate"),
    )


def reading_ddl(with_type: bool, time_type: str) -> str:
    extra = "device_type STRING, " if with_type else ""
    return f"device_id INT, heartrate DOUBLE, {extra}name STRING, time {time_type}"


def parse_readings(
    bronze: DataFrame, with_type: bool = False, time_type: str = "DOUBLE"
) -> DataFrame:
    """JSON text in ``value`` to typed readings.

    A line that does not parse stays as a row of NULLs, so ingestion never stops on bad text.
    ``time_type="FLOAT"`` reads epoch seconds in single precision, whose step at present-day
    epochs is 128 seconds; the default keeps them exact.
    """
    parsed = F.from_json("value", reading_ddl(with_type, time_type))
    names = ["device_id"] + (["device_type"] if with_type else []) + ["heartrate"]
    return (
        bronze.select(parsed.alias("reading"))
        .select("reading.*")
        .select(
            *names,
            epoch_to_timestamp("time").alias("eventtime"),
            "name",
            epoch_to_date("time").alias("p_eventdate"),
        )
    )


def bad_rows(bronze: DataFrame, with_type: bool = False) -> DataFrame:
    """Bronze lines that do not parse into a reading with a device and a time."""
    parsed = F.from_json("value", reading_ddl(with_type, "DOUBLE"))
    return bronze.where(
        parsed.isNull() | parsed["device_id"].isNull() | parsed["time"].isNull()
    )


def negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def last_n_days(df: DataFrame, column: str | Column, end: date | str, n: int) -> DataFrame:
    """Rows dated strictly after ``end`` minus ``n`` days."""
    day = F.col(column) if isinstance(column, str) else column
    return df.where(day > F.date_sub(F.lit(str(end)).cast("date"), n))


def with_params(
    spark: SparkSession, sql: str, params: Mapping[str, Any], **tables: DataFrame
) -> DataFrame:
    """A SQL text with named parameters (``:wallet``) and DataFrames (``{transfers}``)."""
    return spark.sql(sql, args=dict(params), **tables)
