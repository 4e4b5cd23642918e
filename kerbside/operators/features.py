"""Feature engineering and label encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.functions import columns as C
from kerbside.schema import FEATURES, LEAKAGE, SPLIT_COLUMNS


def add_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "speed_bin": C.speed_bin(),
        "density_bin": C.density_bin(),
        "is_stationary": C.is_stationary(),
        "is_high_density": C.is_high_density(),
        "is_rush_hour": C.is_rush_hour(),
        "is_rainy": C.is_rainy(),
        "speed_x_density": C.speed_x_density(),
        "is_braking": C.is_braking(),
        "town_code": C.town_code(),
    })


def encode_labels(df: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Add ``label`` (0, 1, 2); rows with another label are dropped unless kept as -1."""
    coded = df.withColumn("label", C.label_code())
    return coded if keep_unknown else coded.where("label <> -1")


def label_counts(df: DataFrame) -> DataFrame:
    return (df.groupBy("congestion_label", "label").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("label"))


def feature_table(df: DataFrame) -> DataFrame:
    """Features, label and identifiers of cleaned observations (22 columns)."""
    return df.transform(add_features).transform(encode_labels).select(*SPLIT_COLUMNS)


def drop_leakage(df: DataFrame, columns: list[str] = LEAKAGE) -> DataFrame:
    """Remove the features computed from the label's own input."""
    return df.drop(*columns)


def project_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Features as doubles plus the integer label, in the order of the list."""
    return df.select(*[F.col(f).cast("double").alias(f) for f in features],
                     F.col("label").cast("int").alias("label"))


def coerce_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast to double with unreadable text becoming null."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})
