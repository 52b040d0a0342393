"""What streams remember, what rebuilds touch, and how failures are told."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import DATA, same
from pyspark.sql import Window
from pyspark.sql import functions as F

from clickloom.operators import changepoints, forest, moments, ranks, seasonal, stored, summary
from clickloom.plans import lakehouse, rebuilds
from clickloom.settings import Adaptive, Streaming
from clickloom.sources import events, manifest, scratch
from clickloom.streaming import funnel as streaming
from clickloom.streaming import stateful

RNG = np.random.default_rng(5)
T0 = dt.datetime(2024, 1, 1)
RAW = "event_time timestamp, event_type string, product_id long, category_id long, category_code string, brand string, price double, user_id long, user_session string"


def event(hours, brand="b", kind="view", price=5.0, user=1):
    return (T0 + dt.timedelta(hours=hours), kind, 1, 1, "a.b", brand, price, user, "s")


def parts(spark, at, *rows):
    """A stream of one file a list."""
    for part in rows:
        spark.createDataFrame(part, RAW).coalesce(1).write.mode("append").parquet(f"{at}/in")
    return events.file_stream(spark, f"{at}/in", spark.createDataFrame([], RAW).schema, 1)


def test_moments_merge_in_any_split(spark):
    rows = [(g, k, float(v) if v is not None else None) for g, k, v in [("a", 1, 3), ("a", 1, None), ("a", 2, 5), ("a", 4, -7), ("b", 1, None), ("b", 3, 2), (None, 2, 1), ("c", 1, None)]]
    df = spark.createDataFrame(rows, "g string, k int, v double")
    merged = moments.merged(df.groupBy("g", "k").agg(*moments.of("v")), "g", order="k").select("g", "n", "mean", moments.deviation(F.col("n"), F.col("m2")).alias("s"), "least", "most")
    whole = df.groupBy("g").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("s"), F.min("v").alias("least"), F.max("v").alias("most"))
    plain = lambda d: sorted(str([None if x is None else round(x, 9) if isinstance(x, float) else x for x in r]) for r in d.collect())
    assert plain(merged) == plain(whole)


def test_silent_brands_are_forgotten(spark):
    """After more than the period without a row, thresholds begin anew; rows in between still count."""
    at = scratch.path(spark, "t")
    early = [event(h) for h in range(5)] + [event(h, "c") for h in range(5)]
    kept_up = [event(h, "c") for h in (20, 30, 40, 50, 60, 70)]
    late = [event(h, b) for h in (80, 81) for b in ("b", "c")]
    stream = parts(spark, at, early, kept_up, late, [event(200, "z")])
    with stateful.keyed_state(spark):
        out = stateful.adaptive_stream(stateful.closed_hours(stream), cfg=Adaptive(lookback_hours=24, min_history=1))
        streaming.run_available(out, f"{at}/out", f"{at}/checkpoint")
    found = {(r.brand, int((r.window_start - T0).total_seconds() // 3600)): r.history for r in spark.read.parquet(f"{at}/out").collect()}
    assert [found["b", h] for h in (0, 4, 80, 81)] == [0, 4, 0, 1]
    assert [found["c", h] for h in (20, 30, 80, 81)] == [5, 1, 2, 3]


def test_quantiles_are_checked():
    with pytest.raises(ValueError):
        Adaptive(low=0.9, high=0.1)


def test_a_batch_counts_once(spark):
    at = scratch.path(spark, "t")
    batch = lambda *rows: spark.createDataFrame(rows, "brand string, views long")
    stateful.add_batch(batch(("a", 1), ("a", 2), (None, 4)), 0, at)
    for _ in range(3):  # run again after failures
        stateful.add_batch(batch(("a", 3), ("b", 9)), 1, at)
    stateful.add_batch(batch(("a", 1000), ("b", 9)), 2, at, 1.0)
    state = {r.brand: (r.n, r.mean) for r in spark.read.parquet(f"{at}/moments/batch=2").collect()}
    assert state == {"a": (4, 251.5), "b": (2, 9.0), None: (1, 4.0)}
    scores = spark.read.parquet(f"{at}/scores/batch=2").collect()
    assert [(r.brand, r.views, r.seen) for r in scores] == [("a", 1000, 4)]
    assert events.safe_parquet(spark, f"{at}/moments/batch=0") is None  # older state goes


def test_late_rows_are_split_by_closed_windows(spark):
    at = scratch.path(spark, "t")
    first = [event(10.5), event(3)]
    second = [event(7.99), event(8.0), event(8.6), event(40)]  # the hour to 8:00 closes at 10:30 less 2 hours
    third = [event(8.6), event(39), (None, "view", 1, 1, "a.b", "b", 5.0, 1, "s")]
    stream = parts(spark, at, first, second, third)
    stateful.start_split(stream, f"{at}/out", f"{at}/checkpoint", Streaming(), {"availableNow": True}).awaitTermination()
    told = {side: sorted((r.batch, None if r.event_time is None else (r.event_time - T0).total_seconds() / 3600) for r in spark.read.parquet(f"{at}/out/{side}").collect() if r.event_time) for side in ("late", "on_time")}
    assert told["late"] == [(1, 7.99), (2, 8.6)]
    assert told["on_time"] == [(0, 3.0), (0, 10.5), (1, 8.0), (1, 8.6), (1, 40.0), (2, 39.0)]
    assert spark.read.parquet(f"{at}/out/on_time").filter("event_time IS NULL").count() == 1
    stateful.split_batch(spark.createDataFrame(third, RAW), 2, f"{at}/out")  # again
    assert spark.read.parquet(f"{at}/out/late").count() == 2


def test_the_log_stops_after_n_batches(spark):
    at = scratch.path(spark, "t")
    stream = parts(spark, at, *[[event(24 * k)] * (k + 1) for k in range(5)])
    log = stateful.ProgressLog(f"{at}/log", 2, "logged")
    start = lambda: stream.writeStream.queryName("logged").format("noop").option("checkpointLocation", f"{at}/c").trigger(processingTime="0 seconds").start()
    rows = stateful.watch(spark, start, log, 60)
    assert [(r[1], r[2]) for r in rows] == [(0, 1), (1, 2)] and spark.read.parquet(f"{at}/log").count() == 2
    assert not [q for q in spark.streams.active if q.name == "logged"]


def test_a_first_build_reads_raw_files_once(spark, tmp_path, monkeypatch):
    """They are written by many tasks and taken into bronze, of which the marks are made; a second build finds the same marks in the raw files."""
    from clickloom.plans import routes

    monkeypatch.setattr(routes, "RAW_EVENTS", 200, raising=False)
    marked, fingerprints = [], manifest.fingerprints
    monkeypatch.setattr(manifest, "fingerprints", lambda df, by: marked.append((df.inputFiles(), fingerprints(df, by))) or marked[-1][1])
    found = {}
    monkeypatch.setattr(lakehouse, "build", lambda s, glob, root, *rest, build=lakehouse.build: found.update(glob=glob, root=root) or build(s, glob, root, *rest))
    one = routes.lakehouse_tables(spark, DATA).collect()
    raw = spark.read.option("header", True).csv(found["glob"])
    assert len(raw.inputFiles()) >= 5 and raw.count() == 30 * spark.read.parquet(f"{DATA}/events.parquet").count()
    assert all(f.endswith(".parquet") for f in marked[0][0])
    lakehouse.build(spark, found["glob"], found["root"])
    assert not any(f.endswith(".parquet") for f in marked[1][0]) and marked[0][1] == marked[1][1] and one


def test_raw_files_without_rows_make_no_table(spark, tmp_path):
    (tmp_path / "raw.csv").write_text(",".join(f.name for f in events.EVENT_SCHEMA) + "\n")
    paths = lakehouse.build(spark, f"file://{tmp_path}/raw.csv", f"file://{tmp_path}/lake")
    assert not manifest.days_of(spark, paths["bronze"], "event_date")


def test_ranks_against_one_window(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("string")).alias("g"), F.when(F.col("id") % 13 != 0, F.pmod(F.xxhash64("id"), F.lit(50)) / 7).alias("v"), "id")
    found = ranks.percent_ranks(df, "g", "v", "p")
    usual = df.filter("v IS NOT NULL").withColumn("q", F.percent_rank().over(Window.partitionBy("g").orderBy("v"))).select("id", "q")
    both = found.join(usual, "id", "left")
    assert both.count() == 2000 and both.filter("NOT p <=> q").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window [" not in plan.replace("_range", "") or "partitionBy(g)" not in plan  # no window by whole group
    numbered = ranks.row_numbers(df, [F.col("v"), F.col("id")]).join(df.withColumn("k", F.row_number().over(Window.orderBy("v", "id"))).select("id", "k"), "id")
    assert numbered.count() == 2000 and numbered.filter("k <> row_number").count() == 0
    for n, share in ((0, 0.8), (1, 0.8), (7, 0.5), (10, 0.8)):
        assert ranks.first_share(df.limit(n), [F.col("id")], share).filter("is_train").count() == int(n * share)


def test_sketches_hold_their_rank_error(spark):
    values = RNG.lognormal(size=20_000)
    df = spark.createDataFrame(pd.DataFrame({"window_date": [T0.date() + dt.timedelta(days=int(k)) for k in RNG.integers(0, 20, 20_000)], "v": values}))
    asked = (0.01, 0.25, 0.5, 0.75, 0.99)
    row = summary.described(summary.daily(df, ("v",)), quantiles=asked).first()
    exact = np.sort(values)
    for q in asked:
        assert abs(np.searchsorted(exact, row[f"p{round(q * 100):02d}"]) / len(exact) - q) < 0.0165
    assert row.n == 20_000 and abs(row.stddev - values.std(ddof=1)) < 1e-9 * row.stddev and row.least == exact[0] and row.greatest == exact[-1]
    none = summary.described(summary.daily(df.select("window_date", F.lit(None).cast("double").alias("v")), ("v",))).first()
    assert none.n == 0 and none.mean is None and none.p50 is None


def test_an_unchanged_day_is_not_written_again(spark, tmp_path):
    root = f"file://{tmp_path}/lake"
    rows = spark.createDataFrame([event(h, user=h) for h in range(72)], RAW).withColumn("event_date", F.to_date("event_time"))
    files = lambda name: {p: p.stat().st_mtime_ns for p in (tmp_path / "lake" / name).rglob("part-*.parquet")}
    lakehouse.build(spark, rebuilds.csv(spark, rows, "a"), root, rebuilds.LOOSE)
    before = {n: files(n) for n in ("bronze", "silver", "hourly_brand")}
    lakehouse.build(spark, rebuilds.csv(spark, rows, "b"), root, rebuilds.LOOSE)
    assert before == {n: files(n) for n in before}
    moved = rows.withColumn("price", F.when(F.dayofmonth("event_time") == 2, 9.0).otherwise(F.col("price")))
    lakehouse.build(spark, rebuilds.csv(spark, moved, "c"), root, rebuilds.LOOSE)
    for name, old in before.items():
        now = files(name)
        changed = {str(p) for p in set(old) ^ set(now)} | {str(p) for p in set(old) & set(now) if old[p] != now[p]}
        assert changed and all("2024-01-02" in p for p in changed), name
    assert set(manifest.Manifest(spark, f"{root}/manifest").read()) == {dt.date(2024, 1, d) for d in (1, 2, 3)}
    with pytest.raises(ValueError):
        lakehouse.build(spark, f"{root}/none/*.csv", f"file://{tmp_path}/nothing")


def series(spark):
    hours = pd.date_range("2024-01-01", periods=140, freq="h")
    return spark.createDataFrame(pd.concat([pd.DataFrame({"brand": b, "window_start": hours, "views": RNG.integers(50, 99, 140), "carts": 9, "purchases": RNG.integers(1, 9, 140), "revenue": RNG.random(140) * 50, "conversion_rate": RNG.random(140)}) for b in ("good", "poisoned")]))


def test_a_poisoned_brand_ends_no_run(spark):
    rows = series(spark)

    def learn(pdf):
        if pdf["views"].iloc[0] == poison:
            raise ArithmeticError("no fit")
        return {"x": np.ones(1)}

    poison = rows.filter("brand = 'poisoned'").orderBy("window_start").first().views
    rows = rows.filter(~((F.col("brand") == "good") & (F.col("views") == poison)))
    models = stored.fit(rows, "any", ("views",), learn)
    assert {(r.brand, r.params is None, r.error) for r in models.collect()} == {("good", False, None), ("poisoned", True, "ArithmeticError: no fit")}
    assert [tuple(r) for r in stored.failures(models).collect()] == [("poisoned", "any", "fit", "ArithmeticError: no fit")]

    made = forest.fit(rows).unionByName(seasonal.fit(rows)).withColumn("params", F.when((F.col("brand") == "poisoned") & (F.col("kind") == "prophet"), F.lit(b"torn")).otherwise(F.col("params")))
    points = changepoints.changepoints(rows)
    scored = lakehouse.detect(rows.withColumn("brand_avg_conversion", F.lit(0.5)), made, points)
    lost = stored.failures(made, scored).collect()
    assert [(r.brand, r.kind, r.stage) for r in lost] == [("poisoned", "prophet", "score")] and lost[0].reason
    assert scored.count() == rows.count()
    assert scored.filter("brand = 'good' AND prophet_error IS NULL AND prophet_upper > prophet_lower").count() == scored.filter("brand = 'good'").count()
    assert scored.filter("brand = 'poisoned' AND isolation_forest_error IS NULL AND isolation_forest_decision_score IS NOT NULL").count() == 140


def test_a_failed_search_is_one_row(spark, monkeypatch):
    rows = series(spark).withColumn("conversion_rate", F.when(F.col("brand") == "good", F.col("conversion_rate")).otherwise(F.lit(float("inf"))))
    found = changepoints.changepoints(rows, cost="l2").collect()
    assert all(r.brand == "good" or (r.error and r.changepoint_time is None) for r in found)


def test_routes_of_the_starter(spark, capfd):
    """A file stream to the console, and names that are refused. Routes through a broker need its connector."""
    at = scratch.path(spark, "t")
    spark.createDataFrame([event(k) for k in range(5)], RAW).select("event_time", "event_type", "brand", "user_session", "price").coalesce(1).write.parquet(f"{at}/in")
    query = streaming.start_pipeline(spark, "file", "console", path=f"{at}/in")
    try:
        query.processAllAvailable()
        assert query.isActive and streaming.progress(query)["batch"] >= 0
    finally:
        streaming.stop_all(spark)
    assert not spark.streams.active
    for source, sink in (("tape", "console"), ("file", "printer")):
        with pytest.raises(ValueError):
            streaming.start_pipeline(spark, source, sink, path=f"{at}/in")


def test_clear_drops_names_of_tables_in_scratch(spark, tmp_path):
    """Tables of other folders stay, as those of other sessions would."""
    rows = spark.range(5)
    for name, path in (("clickloom_inside", scratch.path(spark, "t")), ("clickloom_outside", f"file://{tmp_path}/t")):
        rows.write.option("path", path).bucketBy(2, "id").sortBy("id").saveAsTable(name)
    scratch.clear(spark)
    left = {t.name for t in spark.catalog.listTables()}
    assert "clickloom_outside" in left and "clickloom_inside" not in left
    spark.sql("DROP TABLE clickloom_outside")
    scratch.clear(spark)  # nothing there any more


def test_a_part_is_one_batch_of_many_files(spark, tmp_path):
    """Whatever a part holds: more rows than files, fewer, or none."""
    from clickloom.plans import stateful as plans

    at, sizes, seen = str(tmp_path / "parts"), [50, 2, 0, 9], {}
    parts = [spark.range(k * 100, k * 100 + n) for k, n in enumerate(sizes)]
    stream = plans.in_parts(spark, at, parts, 4)
    assert len(list((tmp_path / "parts" / "in").glob("*.parquet"))) == 16
    query = stream.writeStream.foreachBatch(lambda batch, number: seen.update({number: sorted(r.id for r in batch.collect())})).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [seen[k] for k in range(4)] == [list(range(k * 100, k * 100 + n)) for k, n in enumerate(sizes)]


@pytest.mark.parametrize("name", ["stream_late_table", "stream_views_without_purchase", "stream_progress", "stream_baselines"])
def test_streams_of_many_files_against_sql(spark, duck, monkeypatch, name):
    from clickloom.plans import registry
    from clickloom.plans import stateful as plans

    n_files, in_parts = [], plans.in_parts
    monkeypatch.setattr(plans, "FILE_ROWS", 300)  # of a thousand events: four files a part
    monkeypatch.setattr(plans, "in_parts", lambda s, at, parts, n: n_files.append(n) or in_parts(s, at, parts, n))
    same(registry.QUERIES[name](spark, DATA).toPandas(), duck.execute(registry.ORACLES[name]).df())
    assert n_files and n_files[0] > 1


def test_events_are_one_before_they_are_copied(spark, tmp_path):
    """What is sorted and sent to find copies is not thirty-fold, and finds the same."""
    from clickloom.operators import funnel
    from clickloom.plans import registry, routes

    for name in ("anomalies_production", "underperforming_production"):
        plan = routes.dense_silver(spark, DATA) if name.startswith("anom") else registry.QUERIES[name](spark, DATA)
        lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert next(k for k, x in enumerate(lines) if "Generate explode" in x) < next(k for k, x in enumerate(lines) if " AS least#" in x), name
    spark.read.parquet(f"{DATA}/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    some = spark.read.parquet(f"{DATA}/events.parquet").limit(40)
    twice = some.union(some).union(some.withColumn("user_id", F.lit(None).cast("long"))).union(some.withColumn("user_id", F.lit(None).cast("long")))
    twice.write.parquet(f"{tmp_path}/events.parquet")
    want = funnel.dedup(funnel.clean(routes.dense(spark, str(tmp_path))))
    got = routes.dense_silver(spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 1000


def test_late_rows_come_by_many_tasks(spark, monkeypatch):
    from pathlib import Path

    from clickloom.plans import registry

    read, file_stream = [], events.file_stream
    monkeypatch.setattr(events, "file_stream", lambda s, path, *rest: read.append(path) or file_stream(s, path, *rest))
    for name, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
        spark.conf.set(name, value)
    try:
        assert registry.QUERIES["stream_late_rows"](spark, DATA).first().late_rows == 10
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(name)
    assert len(list(Path(read[0].removeprefix("file://")).glob("*.parquet"))) > 2


def test_a_lake_takes_little_room(spark, tmp_path):
    """Raw files and tables are compressed, rows that are alike lie side by side, and silver moves and sorts its rows once."""
    from clickloom.plans import routes

    raw = routes.as_csv(spark, routes.dense(spark, DATA).filter("event_date < DATE '2024-01-08'"), "csv", "gzip")
    paths = lakehouse.build(spark, f"{raw}/month=*/*.csv.gz", f"file://{tmp_path}/lake")
    files = sorted((tmp_path / "lake" / "bronze").rglob("*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
    for file in files[:5]:
        times = pd.read_parquet(file, columns=["event_time"]).event_time
        assert times.is_monotonic_increasing
    found = lakehouse.silver_of(spark.read.parquet(paths["bronze"]))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
