"""Raw files to bronze, silver and gold tables, and gold to scored anomalies; each table is written once and read back for the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import anomaly, changepoints, ensemble, features, forest, funnel, seasonal, sequences, stored
from ..settings import Ensemble, Features, ZScore
from ..sources import events, manifest, scratch, sinks

GOLD = {"hourly_brand": (funnel.hourly_brand, "window_date"), "daily_brand": (funnel.daily_brand, "date"), "daily_category": (funnel.daily_category, "date"), "hourly_price_band": (funnel.hourly_price_band, "window_date")}


BY = {"bronze": "event_date", "silver": "event_date", "anomalies": "window_date"} | {name: by for name, (_, by) in GOLD.items()}


def raw_or_none(spark: SparkSession, glob: str) -> DataFrame | None:
    """Raw files, or None where there are none: then bronze is the source, and is not written onto itself."""
    try:
        return events.read_csv(spark, glob)
    except AnalysisException:
        return None


def build(spark: SparkSession, raw_glob: str, root: str, gate: ZScore = ZScore(), whole: bool = True) -> dict[str, str]:
    """Brings all tables below root up to the raw files, and touches only the days that differ; returns their paths.

    whole: the raw files are all there is, so days that they lack go from every table; else they are added to what is
    there, and replace the days that they hold. Bronze, silver and gold depend on their own day only; anomalies are measured against
    all days, so that table is written anew each time.

    A first build has nothing to compare: its raw files are read once, into bronze, and the marks are made of that.

    Before a table is touched the days to be changed leave the manifest, and they come back when all tables are written: a run that
    dies leaves them marked, and the next one builds them again from bronze, even if its raw files hold other days.
    """
    paths = {name: f"{root}/{name}" for name in ("bronze", "silver", "anomalies", *GOLD)}
    book = manifest.Manifest(spark, f"{root}/manifest")
    raw, known = raw_or_none(spark, raw_glob), book.read()
    there = manifest.days_of(spark, paths["bronze"], "event_date")
    if raw is None and not there:
        raise ValueError(f"neither raw files at {raw_glob} nor a bronze table below {root}")
    first = raw is not None and not there and not known
    if first:
        sinks.ingest(raw, paths["bronze"])
    marked = raw if raw is not None and not first else events.safe_parquet(spark, paths["bronze"])
    now = manifest.fingerprints(marked, "event_date") if marked is not None else {}
    changed = {d for d, mark in now.items() if known.get(d) != mark}
    gone = (there | set(known)) - set(now) if whole and raw is not None else set()
    unfinished = there.union(*(manifest.days_of(spark, paths[n], BY[n]) for n in ("silver", *GOLD))) - set(known)
    touched = changed | gone | unfinished
    if touched:
        clean = {d: mark for d, mark in known.items() if d not in touched}
        book.write(clean)
        if raw is not None:
            manifest.drop_days(spark, paths["bronze"], "event_date", gone)
            if changed and not first:
                sinks.ingest(manifest.within(raw, "event_date", changed), paths["bronze"])
        bronze = events.safe_parquet(spark, paths["bronze"])
        refresh(spark, paths, "silver", touched, bronze, "bronze", silver_of, sinks.write_placed)
        silver = events.safe_parquet(spark, paths["silver"])
        for name, (make, _) in GOLD.items():
            refresh(spark, paths, name, touched, silver, "silver", make)
        # Days that are built from bronze alone stay marked until their raw files are seen again.
        book.write(clean | {d: now[d] for d in touched & set(now)})
    hourly = events.safe_parquet(spark, paths["hourly_brand"])
    if hourly is None:
        manifest.delete(spark, paths["anomalies"])
    else:
        sinks.write_partitioned(anomaly.zscore_anomalies(hourly, gate), paths["anomalies"], BY["anomalies"], whole=True)
    return paths


def silver_of(bronze: DataFrame) -> DataFrame:
    """Events of one key are of one time, so of one day and salt: they meet where their file is written, and move once."""
    return funnel.dedup(sinks.placed(funnel.clean(bronze), "event_date", "event_time"), ("event_date", "_salt"))


def refresh(spark: SparkSession, paths: dict[str, str], name: str, days: set, source: DataFrame | None, of: str, make: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str, str], None] = sinks.write_partitioned) -> None:
    """Builds these days of a table anew from the same days of its source; those without rows there go."""
    manifest.drop_days(spark, paths[name], BY[name], days)
    if source is not None:
        write(make(manifest.within(source, BY[of], days)), paths[name], BY[name])


def train(rows: DataFrame, share: float = 0.8, plan: sequences.Plan = sequences.Plan(), forest_rows: int = 100) -> DataFrame:
    """Models of all kinds from the earliest share of the rows, by position; rows of one window and brand are one."""
    part = scratch.save(features.train_rows(rows, share).filter("is_train"), "train")  # read once for each kind
    return forest.fit(part, forest_rows).unionByName(seasonal.fit(part)).unionByName(sequences.fit(part, plan))


def detect(rows: DataFrame, models: DataFrame, points: DataFrame, cfg: Ensemble = Ensemble(), plan: sequences.Plan = sequences.Plan()) -> DataFrame:
    """Scores of the four models, their ensemble and the money. A brand that a model fails on is scored by the others (see ``stored``)."""
    scored = sequences.score(seasonal.score(forest.score(rows, models), models), models, plan)
    scored = changepoints.flag_changepoints(scored, points)
    return ensemble.kind(ensemble.severity(ensemble.impact(ensemble.combine(scored, cfg)), cfg))


def advanced(gold: DataFrame, root: str, cfg: Ensemble = Ensemble(), gate: ZScore = ZScore(), wanted: Features = Features(), plan: sequences.Plan = sequences.Plan(), forest_rows: int = 100, search: dict | None = None) -> DataFrame:
    """Features, models and points are written below root (the models once more replace those of another run), then read to score all rows.

    Scored rows are written, too, and with them failures: brand, model, stage and reason of whatever raised.
    """
    spark = gold.sparkSession
    features.all_features(anomaly.reliable(gold, gate), wanted).write.mode("overwrite").parquet(f"{root}/features")
    rows = spark.read.parquet(f"{root}/features")
    stored.write(train(rows, plan=plan, forest_rows=forest_rows), f"{root}/models")
    changepoints.changepoints(rows, **(search or {})).write.mode("overwrite").parquet(f"{root}/changepoints")
    models, points = stored.read(spark, f"{root}/models"), spark.read.parquet(f"{root}/changepoints")
    detect(rows, models, points, cfg, plan).write.mode("overwrite").parquet(f"{root}/scored")
    scored = spark.read.parquet(f"{root}/scored")
    lost = points.filter("error IS NOT NULL").select("brand", F.lit("changepoint").alias("kind"), F.lit("search").alias("stage"), F.col("error").alias("reason"))
    stored.failures(models, scored).unionByName(lost).write.mode("overwrite").parquet(f"{root}/failures")
    return scored
