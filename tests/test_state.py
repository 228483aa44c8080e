"""Histories and area means as the state of a stream, against the batch operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dwellspark.operators import history, leads
from dwellspark.streaming import state

SCHEMA = "portal string, id string, seen_at timestamp, seq bigint, price_eur bigint, area string, sqm bigint"
AS_OF = "2030-01-01"


def snapshots(spark, n, seed=1):
    """Few listings with prices of null and 0, areas and sizes that change, equal times, and times that arrive late."""
    rng = random.Random(seed)
    rows = [
        (rng.choice("pq"), rng.choice(["a", "b", "c", "d", None]), datetime(2026, 1, 1) + timedelta(hours=rng.randrange(40)), k, rng.choice([None, 0, *range(1000, 1600, 100)]), rng.choice(["X", "Y", None]), rng.choice([None, 0, 10, 25]))
        for k in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def same_as_batch(spark, snaps, path):
    columns = ("portal", "id", "first_seen", "first_price", "last_price", "area", "sqm")
    batch = history.histories(snaps, ("area", "sqm")).select("portal", "id", "first_seen", "first_price", "last_price", "latest.*")
    assert rows_of(state.current_listings(spark, path), *columns) == rows_of(batch, *columns)
    means = leads.area_baseline(leads.lead_rows(snaps, F.lit(AS_OF).cast("timestamp")))
    got = state.baseline_of(spark.read.parquet(f"{path}/areas"))
    assert rows_of(got, "portal", "area", "baseline", "n_listings") == rows_of(means, "portal", "area", "baseline", "n_listings")


def followed(spark, landed, tmp_path, **kwargs):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
    return state.follow(stream, str(tmp_path / "told"), str(tmp_path / "progress"), **kwargs)


def test_equals_the_batch_fold_after_a_kill_between_two_batches(spark, tmp_path):
    snaps, landed = snapshots(spark, 120).cache(), str(tmp_path / "landed")
    snaps.repartition(4).write.parquet(landed)

    def die(batch_id):
        if batch_id == 2:
            raise RuntimeError("killed after its writing, before its commit")

    with pytest.raises(Exception, match="killed"):
        followed(spark, landed, tmp_path, then=die).awaitTermination()
    before = rows_of(spark.read.parquet(str(tmp_path / "told/areas")).groupBy("batch").count(), "batch", "count")
    assert len(before) == 3  # the third is written and not committed
    followed(spark, landed, tmp_path).awaitTermination()
    same_as_batch(spark, snaps, str(tmp_path / "told"))
    kept = state.snapshots_in_state(spark, str(tmp_path / "progress"))
    assert rows_of(kept, "portal", "id", "seen_at", "seq", "price_eur") == rows_of(snaps, "portal", "id", "seen_at", "seq", "price_eur")
    followed(spark, landed, tmp_path).awaitTermination()  # nothing new: nothing changes
    same_as_batch(spark, snaps, str(tmp_path / "told"))


def test_means_hold_after_every_run_and_only_changed_listings_are_told(spark, tmp_path):
    landed, told = str(tmp_path / "landed"), str(tmp_path / "told")
    for run in range(3):
        part = snapshots(spark, 12, seed=run).withColumn("seq", F.col("seq") + 100 * run)
        part.coalesce(1).write.mode("append").parquet(landed)
        followed(spark, landed, tmp_path).awaitTermination()
        same_as_batch(spark, spark.read.schema(SCHEMA).parquet(landed), told)
        batches = spark.read.parquet(f"{told}/listings")
        last = batches.where(F.col("batch").endswith(f"-{run:012d}"))
        assert rows_of(last, "portal", "id") == rows_of(part.select("portal", "id").distinct(), "portal", "id")


def test_unpriced_listings_and_times_beside_the_clock(spark, tmp_path):
    rows = [("p", "a", None, 1, 500, "X", 10), ("p", "a", datetime(2026, 1, 2), None, 700, "X", 10), ("p", "a", datetime(2026, 1, 2), 3, 0, "Y", None), ("p", "n", datetime(2026, 1, 1), 1, None, None, None)]
    snaps, landed = spark.createDataFrame(rows, SCHEMA), str(tmp_path / "landed")
    snaps.repartition(3).write.parquet(landed)
    followed(spark, landed, tmp_path).awaitTermination()
    got = {r["id"]: tuple(r) for r in state.current_listings(spark, str(tmp_path / "told")).select("id", "n", "first_seen", "first_price", "last_price", "area", "sqm").collect()}
    assert got == {"a": ("a", 3, datetime(2026, 1, 2), 500, 700, "Y", None), "n": ("n", 1, datetime(2026, 1, 1), None, None, None, None)}
    assert state.baseline_of(spark.read.parquet(str(tmp_path / "told/areas"))).collect() == []


def test_a_batch_is_one_entry_of_a_listing(spark, tmp_path, monkeypatch):
    """What a batch brings of a listing crosses to the store at once, in entries of at most CHUNK snapshots."""
    monkeypatch.setattr(state, "CHUNK", 50)
    snaps = snapshots(spark, 130).withColumns({"portal": F.lit("p"), "id": F.lit("a")}).cache()
    snaps.coalesce(1).write.parquet(str(tmp_path / "landed"))
    followed(spark, str(tmp_path / "landed"), tmp_path).awaitTermination()
    entries = spark.read.format("statestore").option("path", str(tmp_path / "progress")).option("stateVarName", "snapshots").load()
    assert sorted(r[0] for r in entries.select(F.size("list_element.seq")).collect()) == [30, 50, 50]
    kept = state.snapshots_in_state(spark, str(tmp_path / "progress"))
    assert rows_of(kept, "portal", "id", "seen_at", "seq", "price_eur") == rows_of(snaps, "portal", "id", "seen_at", "seq", "price_eur")


def test_the_session_keeps_its_state_store(spark, tmp_path):
    snapshots(spark, 5).write.parquet(str(tmp_path / "landed"))
    before = spark.conf.get(state.PROVIDER)
    followed(spark, str(tmp_path / "landed"), tmp_path).awaitTermination()
    assert spark.conf.get(state.PROVIDER) == before


def test_pages_that_arrive_in_any_order(spark, tmp_path):
    from dwellspark.operators import dedup
    from dwellspark.streaming import pages

    rng = random.Random(8)
    rows = [(p, r, n, rng.random() < 0.08) for p in "ab" for r in ("r1", "r2", None) for n in rng.sample(range(1, 31), 25)]
    rows += rng.sample(rows, 20) + [("a", "r1", None, True), ("c", "only", 1, True), ("c", "none", 2, None)]
    rng.shuffle(rows)
    schema, landed = "portal string, run_id string, page_num int, stops boolean", str(tmp_path / "landed")
    withdrawn = 0
    for batch in range(0, len(rows), 40):
        spark.createDataFrame(rows[batch : batch + 40], schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        pages.follow_pages(stream, F.col("stops"), str(tmp_path / "told"), str(tmp_path / "progress")).awaitTermination()
        want = dedup.until_stop(spark.read.schema(schema).parquet(landed).where("page_num is not null"), F.coalesce("stops", F.lit(False))).select("portal", "run_id", "page_num").distinct()
        assert rows_of(pages.counting_pages(spark, str(tmp_path / "told")), "portal", "run_id", "page_num") == rows_of(want, "portal", "run_id", "page_num")
        withdrawn = spark.read.parquet(str(tmp_path / "told")).where("change < 0").count()
    assert withdrawn > 5


def test_workers_need_no_package_on_their_path(data, tmp_path):
    """As on a cluster: the workers have what is shipped, and nothing of the driver's folders."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
import __spark_entry__
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
for name in ("history_state", "pagination_prefix_state", "landed_crawl_links", "history_import"):
    print("ROWS", name, __spark_entry__.queries()[name](spark, {data!r}).count())
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=300)
    assert [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ROWS")] == ["history_state", "pagination_prefix_state", "landed_crawl_links", "history_import"], done.stderr[-2000:]
