"""The bucketed snapshot table and published leads."""

import pytest
from pyspark.sql import functions as F

from dwellspark.operators import history, leads
from dwellspark.plans.adapters import event_snapshots
from dwellspark.plans.queries import QUERIES
from dwellspark.sources import snapshots as bucketed
from dwellspark.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_histories_need_no_exchange(spark, data, tmp_path):
    snaps = event_snapshots(spark, data).cache()
    for n, run in enumerate(("run-1", "run-2", "run-2", "run-3")):
        bucketed.append_run(snaps.where(F.col("seq") % 3 == int(run[-1]) - 1).withColumn("run_id", F.lit(run)), "kept", 4, str(tmp_path))
        if n == 2:
            bucketed.compact(spark, "kept", 4, str(tmp_path))
            assert len(list((tmp_path / "kept_g1").rglob("*.parquet"))) <= 4
    table = bucketed.snapshots(spark, "kept")
    assert table.count() == snaps.count() and {r[0] for r in table.select("run_id").distinct().collect()} == {"compacted-run-2", "run-3"}
    priced = lambda s: history.price_histories(s).select("portal", "id", F.array_join(F.col("price_history").cast("array<string>"), ",").alias("p"))
    for make in (history.first_seen, lambda s: history.latest(s, ("price_eur", "area")), priced, lambda s: history.histories(s, ("area",)).select("portal", "id", "first_price", "last_price")):
        assert "Exchange" not in plan_of(make(table)) and "Bucketed: true" in plan_of(make(table))
        assert "Exchange" in plan_of(make(snaps)) and sorted(map(str, make(table).collect())) == sorted(map(str, make(snaps).collect()))
    assert "Exchange" not in plan_of(QUERIES["history_bucketed"](spark, data))


def test_a_compaction_that_fails_changes_nothing(spark, data, tmp_path, monkeypatch):
    snaps = event_snapshots(spark, data).withColumn("run_id", F.lit("run-1"))
    bucketed.append_run(snaps, "safe", 2, str(tmp_path))

    def fail(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(bucketed, "_show", fail)
    with pytest.raises(RuntimeError):
        bucketed.compact(spark, "safe", 2, str(tmp_path))
    assert bucketed.snapshots(spark, "safe").count() == snaps.count()
    monkeypatch.undo()
    spark.sql("DROP TABLE safe_g1")
    with pytest.raises(ValueError):
        bucketed.compact(spark, "nothing")


def test_a_reader_sees_the_last_whole_set_of_leads(spark, data, tmp_path):
    path, as_of = str(tmp_path), F.lit("2024-02-01").cast("timestamp")
    snaps = event_snapshots(spark, data)
    with pytest.raises(ValueError):
        tables.published_leads(spark, path)
    tables.publish_leads(leads.leads(snaps.where("id % 2 = 0"), as_of), path)
    first = rows_of(tables.published_leads(spark, path).select("id", "rank"))
    reader = tables.published_leads(spark, path)  # begins to read before the next version
    broken = leads.leads(snaps, as_of).withColumn("score", F.when(F.col("id") % 5 == 0, F.raise_error(F.lit("broken"))).otherwise(F.col("score")))
    with pytest.raises(Exception, match="broken"):
        tables.publish_leads(broken, path)
    assert rows_of(tables.published_leads(spark, path).select("id", "rank")) == first
    tables.publish_leads(leads.leads(snaps, as_of), path, "json")
    assert rows_of(reader.select("id", "rank")) == first and tables.published_leads(spark, path).count() == leads.leads(snaps, as_of).count()
