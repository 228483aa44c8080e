"""History files, idempotent appends, the leads sink, and the streamed fold."""

import json

import pytest

from pyspark.sql import functions as F

from dwellspark.operators import history, leads
from dwellspark.plans.adapters import event_snapshots
from dwellspark.sources import tables
from dwellspark.streaming.fold import fold


def test_history_files(spark, tmp_path):
    latest = {"id": "x1", "url": "u", "photo": None, "price_eur": 90, "sqm": 9, "area": "A", "title": "т", "portal": "p"}
    snaps = [{"seen_at": "2026-01-01T00:00:00+00:00", "price_eur": 100}, {"seen_at": "2026-01-02T00:00:00+00:00", "price_eur": 90}]
    (tmp_path / "h.json").write_text(json.dumps({"x1": {"first_seen": snaps[0]["seen_at"], "snapshots": snaps, "latest": latest}, "a0": {"first_seen": snaps[1]["seen_at"], "snapshots": snaps[1:], "latest": latest | {"id": "a0"}}}))
    (tmp_path / "bad.json").write_text("{nonsense")
    rows = tables.history_files(spark, str(tmp_path)).collect()
    good = [(r["id"], r["ordinal"], r["seq"], r["price_eur"], r["title"]) for r in rows if r["id"]]
    assert sorted(good) == [("a0", 1, 0, 90, "т"), ("x1", 0, 0, 100, "т"), ("x1", 0, 1, 90, "т")]
    assert [r["bad_record"].split("/")[-1] for r in rows if not r["id"]] == ["bad.json"]


def test_a_run_that_is_repeated_changes_nothing(spark, data, tmp_path):
    snaps, path = event_snapshots(spark, data), str(tmp_path / "snapshots")
    for run in ("run-1", "run-2", "run-2"):
        half = snaps.where((F.col("seq") % 2 == 0) == (run == "run-1"))
        tables.append_run(half.withColumn("run_id", F.lit(run)), path)
    assert spark.read.parquet(path).count() == snaps.count()


def test_stream_equals_batch(spark, data, tmp_path):
    snaps, landed, path = event_snapshots(spark, data), str(tmp_path / "landed"), str(tmp_path / "table")
    snaps.repartition(5).write.parquet(landed)
    for _ in range(2):  # started again, it has nothing to do
        stream = spark.readStream.schema(snaps.schema).option("maxFilesPerTrigger", 2).parquet(landed)
        fold(stream, path, str(tmp_path / "checkpoint")).awaitTermination()
    assert spark.read.parquet(path).count() == snaps.count()
    as_of = F.lit("2024-02-01").cast("timestamp")
    want = {tuple(r) for r in leads.leads(snaps, as_of).drop("entered", "first_seen").collect()}
    got = {tuple(r) for r in leads.leads(spark.read.parquet(path), as_of).drop("entered", "first_seen").collect()}
    assert got == want and len(want) > 10


def test_streams_do_not_overwrite_each_other(spark, data, tmp_path):
    snaps, path = event_snapshots(spark, data), str(tmp_path / "table")
    for n in range(2):
        landed = str(tmp_path / f"landed-{n}")
        snaps.where(F.col("seq") % 2 == n).write.parquet(landed)
        fold(spark.readStream.schema(snaps.schema).parquet(landed), path, str(tmp_path / f"checkpoint-{n}")).awaitTermination()
    assert spark.read.parquet(path).count() == snaps.count()


def test_shared_folder(spark):
    from types import SimpleNamespace

    from dwellspark.session import shared_folder

    told = []
    def session(master, settings):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: told[-1] if told else None, setCheckpointDir=told.append)
        return SimpleNamespace(sparkContext=context, conf=settings)

    with pytest.raises(ValueError):
        shared_folder(session("spark://host:7077", {}))
    with pytest.raises(ValueError):
        shared_folder(session("local-cluster[2,1,1024]", {}))
    assert shared_folder(session("spark://host:7077", {"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"


def test_leads_sink(spark, data, tmp_path):
    tables.write_leads(leads.leads(event_snapshots(spark, data), F.lit("2024-02-01").cast("timestamp")), str(tmp_path / "leads"))
    ranks = sorted(r["rank"] for r in spark.read.json(str(tmp_path / "leads")).collect())
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_run_snapshots(spark):
    listed = spark.createDataFrame([("p", "a", 5, 1)], "portal string, id string, price_eur bigint, ordinal bigint")
    assert history.snapshots_of(listed, F.lit("2026-01-01").cast("timestamp")).columns == ["portal", "id", "price_eur", "seq", "seen_at"]


def test_counted_rows(spark):
    rows, seen = tables.counted(spark.range(7).toDF("x"), "listings")
    assert rows.where("x > 2").count() == 4 and seen.get["rows"] == 7
