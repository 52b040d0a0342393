"""Models of one brand each, fitted and applied in grouped maps, and kept as a table of (brand, kind, rows, params, error).

A group is one brand's series: its size is bounded by the hours of the period (8,784 a year), whatever the number of
events. Only the key and the columns of the model go through Python; what it says is joined back by brand and window.

A brand whose task raises ends no run: it has no model, or scores as brands without one, and the reason stands beside it
(``error`` of a model, ``<kind>_error`` of a scored row); ``failures`` lists them.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODELS = "brand string, kind string, rows long, params binary, error string"
FAILURES = ("brand", "kind", "stage", "reason")


def packed(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez_compressed(out, **arrays)
    return out.getvalue()


def unpacked(params: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(params), allow_pickle=False) as found:
        return {k: found[k] for k in found.files}


def numbers(pdf: pd.DataFrame, columns: tuple[str, ...]) -> np.ndarray:
    """The columns as a matrix; what is missing or not finite is 0."""
    return np.nan_to_num(pdf[list(columns)].astype(float).to_numpy(), nan=0.0, posinf=0.0, neginf=0.0)


def reason(error: Exception) -> str:
    return f"{type(error).__name__}: {error}"[:500]


def fit(df: DataFrame, kind: str, columns: tuple[str, ...], learn: Callable[[pd.DataFrame], dict | None]) -> DataFrame:
    """A model for each brand of which learn(its series in order of time) makes one."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        brand = pdf["brand"].iloc[0]
        try:
            made = learn(pdf.sort_values("window_start").reset_index(drop=True))
            rows = [(brand, kind, len(pdf), packed(made), None)] if made else []
        except Exception as error:  # any model's, of this brand alone
            rows = [(brand, kind, len(pdf), None, reason(error))]
        return pd.DataFrame(rows, columns=["brand", "kind", "rows", "params", "error"])

    return df.select("brand", "window_start", *columns).filter("brand IS NOT NULL").groupBy("brand").applyInPandas(run, MODELS)


def score(df: DataFrame, models: DataFrame, kind: str, columns: tuple[str, ...], fields: str, say: Callable[[pd.DataFrame, dict], dict], otherwise: dict) -> DataFrame:
    """df with the fields that say(series, parameters) gives and <kind>_error; brands without a model, or whose model fails, get `otherwise`."""

    names, failed = list(otherwise), f"{kind}_error"

    def run(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("window_start").reset_index(drop=True)
        out = pdf[["brand", "window_start"]]
        if not len(pdf) or not len(model):
            return out.iloc[:0].assign(**{k: [] for k in names}, **{failed: pd.Series([], dtype=object)})
        try:
            return out.assign(**say(pdf, unpacked(model["params"].iloc[0])), **{failed: None})
        except Exception as error:  # any model's, of this brand alone
            return out.assign(**{k: None for k in names}, **{failed: reason(error)})

    time = df.schema["window_start"].dataType.simpleString()
    asked = df.select("brand", "window_start", *columns).filter("brand IS NOT NULL")
    known = fitted(models).filter(F.col("kind") == kind)
    said = asked.groupBy("brand").cogroup(known.groupBy("brand")).applyInPandas(run, f"brand string, window_start {time}, {fields}, {failed} string")
    found = df.drop(*otherwise, failed).join(said, ["brand", "window_start"], "left")
    return found.withColumns({k: F.coalesce(k, v if not isinstance(v, (bool, float)) else F.lit(v)) for k, v in otherwise.items()})


def fitted(models: DataFrame) -> DataFrame:
    """Those that were fitted; a table of before errors were kept has no others."""
    return models.filter(F.col("params").isNotNull())


def failures(models: DataFrame, scored: DataFrame | None = None) -> DataFrame:
    """brand, kind, stage and reason of each model that could not be fitted, and of each that could not score its brand."""
    out = models.filter(F.col("error").isNotNull()).select("brand", "kind", F.lit("fit").alias("stage"), F.col("error").alias("reason"))
    for column in [c for c in scored.columns if c.endswith("_error") and c != "lstm_reconstruction_error"] if scored is not None else ():
        failed = scored.filter(F.col(column).isNotNull()).groupBy("brand").agg(F.min(column).alias("reason"))
        out = out.unionByName(failed.select("brand", F.lit(column.removesuffix("_error")).alias("kind"), F.lit("score").alias("stage"), "reason"))
    return out


def update(models: DataFrame, fresh: DataFrame) -> DataFrame:
    """models, with those of fresh in place of the same brand and kind."""
    return models.join(fresh.select("brand", "kind"), ["brand", "kind"], "left_anti").select(*models.columns).unionByName(fresh)  # a brand that could not be fitted again has no model


def write(models: DataFrame, path: str) -> None:
    """By kind, so that a kind is read alone; another run replaces the kinds that it holds."""
    models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("kind").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("brand", "kind", "rows", "params", "error")
