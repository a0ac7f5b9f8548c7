"""Feature columns, encodings, imputation and stable splits for tabular regression."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.functions.columns import binary_flag, ordinal, price_to_double, row_sum
from siltbed.operators.ordering import exact_quantiles

# Strictness of a listing's cancellation policy, and the fill for missing reviews.
CANCELLATION_RANKS = {
    "flexible": 0,
    "moderate": 1,
    "strict": 2,
    "super_strict_30": 3,
    "super_strict_60": 4,
}
NO_REVIEW = -99.0
REVIEW_SCORES = [
    "review_scores_accuracy",
    "review_scores_cleanliness",
    "review_scores_checkin",
    "review_scores_communication",
    "review_scores_location",
    "review_scores_value",
]

def split_bucket(keys: Sequence[str], seed: int = 42, buckets: int = 100) -> Column:
    """A bucket that depends only on the row's key and the seed, not on how rows are spread."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(buckets)).cast("int")


def split_by(df: DataFrame, in_train: Column) -> tuple[DataFrame, DataFrame]:
    return df.where(in_train), df.where(~in_train)


def split_train_test(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.75, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Reproducible train and test rows: the same key always lands on the same side."""
    in_train = split_bucket(keys, seed, 10_000) < int(round(train_share * 10_000))
    return split_by(df, in_train)


def one_hot(df: DataFrame, column: str, prefix: str, values: Sequence) -> DataFrame:
    """One 0/1 BIGINT column for each of the given levels, the original column dropped."""
    flags = [
        F.when(F.col(column) == F.lit(v), 1).otherwise(0).cast("bigint").alias(f"{prefix}_{v}")
        for v in values
    ]
    return df.select("*", *flags).drop(column)


def one_hot_encoder(columns: Mapping[str, str]) -> Pipeline:
    """Encoder of categories with any number of levels: ``columns`` maps a column to the name of its
    sparse 0/1 vector, which has one place per level and one more for NULL and unseen values.

    Levels are placed by their order as text, so equal tables give equal vectors.
    """
    stages = []
    for column, vector in columns.items():
        index = f"_{vector}_index"
        stages.append(StringIndexer(inputCol=column, outputCol=index, stringOrderType="alphabetAsc", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=index, outputCol=vector, dropLast=False))
    return Pipeline(stages=stages)


def one_hot_sparse(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``df`` with the sparse vectors of ``one_hot_encoder`` in place of the columns."""
    coded = one_hot_encoder(columns).fit(df).transform(df)
    return coded.drop(*columns, *(f"_{v}_index" for v in columns.values()))


def unmapped(df: DataFrame, column: str, ranks: Mapping[str, int]) -> DataFrame:
    """How many values an ordinal encoding does not know."""
    strange = F.col(column).isNotNull() & ordinal(column, ranks).isNull()
    return df.agg(F.count_if(strange).alias("n_unmapped"))


def summed_reviews(
    df: DataFrame, scores: Sequence[str] = REVIEW_SCORES, name: str = "review_scores_sum"
) -> DataFrame:
    return df.withColumn(name, row_sum(scores))


def rounded_place(df: DataFrame, digits: int = 2) -> DataFrame:
    """Coordinates rounded half-even as ``trunc_lat`` and ``trunc_long``; originals dropped."""
    return df.select(
        "*",
        F.bround("latitude", digits).alias("trunc_lat"),
        F.bround("longitude", digits).alias("trunc_long"),
    ).drop("latitude", "longitude")


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact train medians, one number per column. A column without any value has none and raises."""
    found = {r["column"]: r["value"] for r in exact_quantiles(df, columns, 0.5).collect()}
    if absent := [c for c in columns if c not in found]:
        raise ValueError(f"no value to take a median of: {', '.join(absent)}")
    return found


def impute(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """NULLs filled. A column of whole numbers becomes DOUBLE, so that a median of 1.5 stays 1.5."""
    whole = {"tinyint", "smallint", "int", "bigint"}
    wide = {c: F.col(c).cast("double") for c, t in df.dtypes if c in values and t in whole}
    return df.withColumns(wide).fillna(dict(values))


def impute_constant(df: DataFrame, columns: Sequence[str], value: float = NO_REVIEW) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def prepare_listings(df: DataFrame, categories: Mapping[str, str]) -> DataFrame:
    """Raw listings to numeric columns: price, flags, policy rank, a sparse 0/1 vector per category.

    ``categories`` maps a column to the name of its vector.
    """
    out = df.withColumns(
        {
            "price": price_to_double("price"),
            # The names of the two flags.
            "host_is_superhost_": binary_flag("host_is_superhost"),
            "instant_bookable_": binary_flag("instant_bookable"),
            "cancellation_policy_strictness": ordinal("cancellation_policy", CANCELLATION_RANKS),
        }
    ).drop("zipcode", "cancellation_policy", "host_is_superhost", "instant_bookable")
    return one_hot_sparse(out, categories)
