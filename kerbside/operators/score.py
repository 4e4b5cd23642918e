"""Scoring with class probabilities: predicted class, confidence, severity, reasons."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from kerbside.functions import columns as C


def add_probability(df: DataFrame, model) -> DataFrame:
    """``probability`` as a plain array from any fitted classification pipeline."""
    raw = model.transform(df)
    if dict(raw.dtypes)["probability"].startswith("array"):
        return raw
    return raw.withColumn("probability", vector_to_array("probability"))


def add_score(df: DataFrame) -> DataFrame:
    """Class, label, confidence, severity and bands from the ``probability`` array."""
    scored = df.withColumn("prediction", C.best_class("probability"))
    scored = scored.withColumn("severity", C.severity("probability"))
    return scored.withColumns({
        "predicted_label": C.label_name("prediction"),
        "confidence_pct": 100.0 * F.array_max("probability"),
        "severity_band": C.severity_band("severity"),
        "severity_colour": C.severity_colour("severity")})


def add_reasons(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", C.signal_reasons())
