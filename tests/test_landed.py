"""Crawls as a data source: pages come back as they were landed, and filters prune splits."""

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from dwellspark.sources import landed

PAGES = [(p, r, n, None if n == 3 else f"<html>{p} {r} {n} é</html>") for p in ("imot.bg", "alo.bg") for r in ("2026-01-01 a/b", "r=2", None) for n in range(1, 6)]
SCHEMA = "portal string, run_id string, page_num int, html string"


def rows_of(df):
    return sorted(map(tuple, df.select("portal", "run_id", "page_num", "html").collect()), key=str)


def test_pages_come_back(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, SCHEMA)
    landed.land(pages.where("page_num > 2"), str(tmp_path))
    landed.land(pages, str(tmp_path))  # again, with those that lacked
    (tmp_path / "portal=imot.bg/notes.txt").write_text("no page")
    (tmp_path / "portal=imot.bg/run_id=r%3D2/page=x.html").write_text("no page")
    (tmp_path / "portal=imot.bg/run_id=r%3D2/page=9.html").write_bytes(b"a\xffb")
    read = landed.landed_crawl(spark, f"file://{tmp_path}")
    assert rows_of(read) == sorted([*PAGES, ("imot.bg", "r=2", 9, "a�b")], key=str)
    assert read.where("fetched_at is null").count() == 0
    for where in (F.col("portal") == "alo.bg", F.col("run_id").isNull(), (F.col("portal") == "imot.bg") & (F.col("page_num") > 4), F.col("run_id").isin("r=2", "none"), F.col("portal") != "alo.bg"):
        assert rows_of(read.where(where)) == rows_of(pages.unionByName(read.where("page_num = 9").select(pages.columns)).where(where))
    assert landed.landed_crawl(spark, str(tmp_path / "nothing")).count() == 0


def test_filters_prune_splits(spark, tmp_path):
    landed.land(spark.createDataFrame(PAGES, SCHEMA), str(tmp_path))
    read = landed.landed_crawl(spark, str(tmp_path), 10**6)
    parts = lambda df: df.rdd.getNumPartitions()
    assert parts(read) == 6 and parts(read.where("portal = 'alo.bg'")) == 3 and parts(read.where("portal = 'alo.bg' and run_id = 'r=2'")) == 1
    assert parts(landed.landed_crawl(spark, str(tmp_path), 1)) == len(PAGES)
    (tmp_path / "portal=alo.bg").chmod(0o755)
    reader = landed.CrawlReader(str(tmp_path), 10**6)
    left = list(reader.pushFilters([EqualTo(("portal",), "alo.bg"), In(("portal",), ("alo.bg", "x")), GreaterThan(("page_num",), 2), EqualTo(("run_id", "x"), 1)]))
    assert left == [GreaterThan(("page_num",), 2), EqualTo(("run_id", "x"), 1)]
    splits = reader.partitions()
    assert {s.portal for s in splits} == {"alo.bg"} and len(splits) == 3 and {n for s in splits for n, _, _ in s.files} == set(range(1, 6))


def test_many_small_runs_share_splits(spark, tmp_path):
    """Splits grow with the files' cost, not with the runs; a portal has its own, and all pages come back."""
    many = spark.range(2 * 150 * 2).selectExpr("concat('p', id % 2) portal", "concat('r', id div 4) run_id", "cast(id div 2 % 2 as int) page_num", "concat('<html>', id) html")
    landed.land(many, str(tmp_path))
    read = landed.landed_crawl(spark, str(tmp_path))
    assert rows_of(read) == rows_of(many) and read.rdd.getNumPartitions() == 2
    splits = landed.CrawlReader(str(tmp_path), 50 * landed.OPEN_BYTES).partitions()
    assert len(splits) == 12 and all(len(s.files) == 50 for s in splits) and {s.portal for s in splits} == {"p0", "p1"}


def test_listings_of_a_crawl(spark, data, tmp_path):
    from dwellspark.operators.listings import listings
    from dwellspark.plans.adapters import part_pages

    pages = part_pages(spark, data)
    landed.land(pages, str(tmp_path))
    own = landed.landed_crawl(spark, str(tmp_path)).where("portal = 'imot.bg'")
    columns = ("portal", "run_id", "id", "price_eur", "area", "sqm", "title", "ordinal")
    want = listings(pages.where("portal = 'imot.bg'")).select(*columns)
    assert sorted(map(tuple, listings(own).select(*columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() > 5
