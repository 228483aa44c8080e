"""Pages to listings: the tree, cards, dedup and stop rules."""

import portal_pages as fixtures
from pyspark.sql import functions as F

from dwellspark.functions.text import whole
from dwellspark.operators import dedup, history, leads
from dwellspark.operators.cards import Page, anchors
from dwellspark.operators.listings import listings


def test_tree():
    page = Page('<div>a<b>c<i>d</div><p>e<br>f<!-- no --><script>g</script></b><a href="/x"> h <img src="1"></a>&amp;i')
    assert page.texts == ["a", "c", "d", "e", "f", "h", "&i"]
    assert [href for _, href in page.links] == ["/x"]
    element, _ = page.links[0]
    assert page.text(element) == "h" and page.elements[element][3:] == [0, 1]
    assert page.text(0, "|") == "a|c|d|e|f|h|&i"
    assert Page("").texts == [] and Page("</p></div>x").texts == ["x"]


def test_listings_of_all_portals(spark):
    got = {r["id"]: r for r in listings(fixtures.pages(spark)).collect()}
    assert set(got) == {"alo_1234567", "bazar_7001", "homes_11", "homes_12", "homes_13", "imot_1a1234567890", "imot_1d1234567890", "imotibg_54321", "123456", "olx_a1B2", "olx_zz9", "olx_zz8"}
    pick = lambda i, *c: tuple(got[i][x] for x in c)
    assert pick("alo_1234567", "price_eur", "sqm", "area", "photo") == (125000, 90, "Люлин 7", "https://www.alo.bg/photo.jpg")
    assert pick("imot_1a1234567890", "price_eur", "sqm", "area", "page_num") == (125000, 86, "Лозенец", 1)  # first page wins; 85.5 to even
    assert pick("imot_1d1234567890", "price_eur", "sqm", "area", "photo") == (1000, None, "Sofia", "https://cdn.example/y.jpg")
    assert pick("imotibg_54321", "price_eur", "page_num", "ordinal") == (205000, 2, 1_000_000)  # last page wins, place of the first
    assert pick("bazar_7001", "price_eur", "sqm", "area") == (87000, None, "Надежда")
    assert pick("123456", "price_eur", "sqm", "title", "url") == (100000, 80, "Two-bedroom flat, Sofia, Lozenets", "https://www.imoti.net/en/obiava/prodava-apartament/123456/")
    assert pick("homes_11", "price_eur", "sqm", "area", "photos", "description") == (125000, 70, "Изток", ["https://g1.homes.bg/a/bb.jpg"], None)
    assert pick("homes_12", "price_eur", "area", "photos", "description") == (500, "Sofia", ["https://g1.homes.bg/c/db.jpg"], "светло")
    assert got["olx_a1B2"]["site_updated_at"].isoformat() == "2026-08-20T00:00:00" and got["olx_zz8"]["site_updated_at"] is None
    assert got["olx_zz9"]["site_updated_at"] == fixtures.NOW and got["olx_zz9"]["photo"] is None


def test_a_null_run_is_a_run(spark):
    pages = fixtures.pages(spark)
    named = {r["id"]: r["price_eur"] for r in listings(pages).collect()}
    unnamed = {r["id"]: r["price_eur"] for r in listings(pages.withColumn("run_id", F.lit(None).cast("string"))).collect()}
    assert unnamed == named


def test_dedup_rules(spark):
    rows = spark.createDataFrame([("p", "r", "a", 1, 5, "x"), ("p", "r", "a", 1, 2, "y"), ("p", "r", "a", 3, 9, "z"), ("p", "r", "a", 3, 4, "w"), ("p", "r", None, 1, 1, "n")], "portal string, run_id string, id string, page_num int, pos int, title string")
    first = {r["id"]: (r["title"], r["first_at"]["pos"]) for r in dedup.first_wins(rows).collect()}
    last = {r["id"]: (r["title"], r["first_at"]["pos"]) for r in dedup.last_page_wins(rows).collect()}
    assert first == {"a": ("y", 2), None: ("n", 1)} and last == {"a": ("w", 2), None: ("n", 1)}
    assert dedup.first_wins(rows.limit(0)).count() == 0


def test_stop_rule(spark):
    pages = spark.createDataFrame([("p", r, n, links) for r, n, links in (("a", 1, 3), ("a", 2, 0), ("a", 3, 5), ("b", 1, 1), ("b", 2, 1), ("c", 1, 0))], "portal string, run_id string, page_num int, links int")
    kept = sorted((r["run_id"], r["page_num"]) for r in dedup.until_stop(pages, F.col("links") == 0).collect())
    assert kept == [("a", 1), ("b", 1), ("b", 2)]


def test_anchors_of_null_and_empty_pages(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, '<a href="/x">t</a>')], "page_id bigint, html string")
    assert [tuple(r) for r in anchors(pages, ["page_id"]).collect()] == [(3, 0, "/x", "t")]


def test_pages_beyond_a_portals_last_do_not_count(spark):
    pages = fixtures.pages(spark).where("portal = 'imoti.bg'").withColumn("page_num", F.col("page_num") + 11)
    assert {(r["id"], r["page_num"]) for r in listings(pages).collect()} == {("imotibg_54321", 12)}


def test_pages_to_leads(spark):
    found, at = listings(fixtures.pages(spark)), lambda text: F.lit(text).cast("timestamp")
    second = history.snapshots_of(found.withColumn("price_eur", whole(F.col("price_eur") * 0.9)), at("2026-09-21 09:30:00"))
    runs = history.snapshots_of(found, at("2026-08-21 09:30:00")).unionByName(second)
    rows = leads.in_rank_order(leads.portal_leads(runs, at("2026-11-29 09:30:00")))
    got = {r["id"]: r for r in rows.withColumn("price_history", F.array_join(F.col("price_history").cast("array<string>"), ",")).collect()}
    assert len(got) == 12 and sorted(r["rank"] for r in got.values()) == list(range(1, 13))
    net, olx, imot = got["123456"], got["olx_a1B2"], got["imot_1a1234567890"]
    assert (net["area"], net["price_history"], net["price_per_sqm"], net["area_avg_price_per_sqm"]) == ("Lozenets", "100000,90000", 1125, 1125)
    assert (olx["days_on_market"], olx["drop_pct"], olx["price_history"]) == (101, 10.0, None)
    assert (imot["days_on_market"], imot["score"], imot["title"]) == (100, round(25 + 100 / 180 * 50), "Тристаен в центъра, Лозенец")


def test_states_end_outside_strings(spark):
    from dwellspark.operators.listings import embedded_state

    start, hard = "<script>window.__PRELOADED_STATE__ = ", ['{"a":"};"}', '{"a":"\\\\"}', '{"a":"\\"};"}', '{}', '{"a":{"b":"x"}}', '{"a":"' + '};' * 500 + '"}']
    rows = [start + x + ";</script> };" for x in hard] + ["<html>};</html>", start + "[1];", start + '{"a":"};', start + "{};" + start + '{"b":1};', "", None]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(rows)), "i int, html string").orderBy("i").select(embedded_state(F.col("html"))).collect()]
    assert got == [*hard, None, None, '{"a":"};', "{}", None, None]


def test_a_state_is_read_once(spark):
    """Offers, whether more follow and unreadable states come from one scan and one parse of a page."""
    from dwellspark.operators.listings import embedded_state, offers_of_pages, with_embedded_state

    pages = spark.range(3).select("id", F.concat(F.lit("window.__PRELOADED_STATE__ = {"), F.col("id").cast("string"), F.lit('"};" };</script>')).alias("html"))
    plan = offers_of_pages(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("__PRELOADED_STATE__\\s*") == 1 and plan.count("aggregate(") == 1 and plan.count("from_json") == 1
    assert with_embedded_state(pages).where(~F.col("state").eqNullSafe(embedded_state(F.col("html")))).count() == 0


def _logged(rows, path):
    """The rows, each of which adds a line to a file when it is read."""

    def run(batches):
        for batch in batches:
            with open(path, "a") as log:
                log.write("x\n" * batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema)


def _lines(path):
    with open(path) as log:
        return sum(1 for _ in log)


def test_pages_are_read_once_for_links_and_once_for_offers(spark, tmp_path):
    pages, log = fixtures.pages(spark), str(tmp_path / "read")
    assert listings(_logged(pages, log)).count() == 12
    assert _lines(log) == 2 * len(fixtures.PAGES)


def test_snapshots_are_read_once(spark, tmp_path):
    at, log = lambda text: F.lit(text).cast("timestamp"), str(tmp_path / "read")
    snapshots = history.snapshots_of(listings(fixtures.pages(spark)), at("2026-08-21 09:30:00"))
    rows = leads.portal_leads(_logged(snapshots, log), at("2026-11-29 09:30:00")).collect()
    assert {r["portal"] for r in rows if r["price_history"] is not None} == {"imoti.net"} and len(rows) == 12
    assert _lines(log) == 12


def test_part_pages_deal_out_parts_and_not_texts(spark, data):
    """Texts are made behind the exchange, in as many tasks as it has partitions, and not in the few splits of a small table."""
    from dwellspark.plans.adapters import part_offers, part_pages

    for rows in (part_pages(spark, data), part_offers(spark, data)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        _, dealt, below = plan.partition("RepartitionByExpression")
        assert dealt and "/offer/" not in below and "/obiava" not in below
        assert rows.rdd.getNumPartitions() == 4


def test_pages_without_links(spark):
    from dwellspark.operators.cards import cards
    from dwellspark.schema import PAGE

    rows = [("imot.bg", "r", 1, "u", None, None), ("imot.bg", "r", 2, "u", "<a href='/x'>x</a>", None), ("imot.bg", None, 3, "u", '<a href="/obiava-1a1234567890-x">x</a>', None)]
    pages = spark.createDataFrame(rows, PAGE)
    got = sorted((r["page_num"], r["pos"], r["has_card"]) for r in cards(pages, every_page=True).collect())
    assert got == [(1, None, None), (2, None, False), (3, 0, False)]
    assert [r["page_num"] for r in cards(pages).collect()] == [3]


def test_a_failed_page_stops_its_run(spark):
    from dwellspark.schema import PAGE

    rows = [tuple(r) for r in fixtures.pages(spark).where("portal = 'imot.bg' and page_num <= 2 or portal = 'bazar.bg'").collect()]
    failed = [(*r[:4], None, r[5]) for r in rows if r[2] == 2]  # the second page was fetched, and fetched again in vain
    got = {(r["portal"], r["page_num"]) for r in listings(spark.createDataFrame(rows + failed, PAGE)).collect()}
    assert got == {("imot.bg", 1), ("bazar.bg", 1)}


def test_both_dedup_rules_in_one_aggregate(spark):
    rows = spark.createDataFrame([(p, "r", "a", n, pos, t) for p in "pq" for n, pos, t in ((1, 5, "x"), (1, 2, "y"), (3, 9, "z"), (3, 4, "w"))], "portal string, run_id string, id string, page_num int, pos int, title string")
    got = {r["portal"]: (r["title"], r["first_at"]["pos"]) for r in dedup.by_rule(rows, F.col("portal") == "q").collect()}
    assert got == {"p": ("y", 2), "q": ("w", 2)}


def test_plain_tags_are_read_as_the_parser_does():
    import random
    from html.parser import HTMLParser

    class Slow(Page):
        parse_starttag, parse_endtag = HTMLParser.parse_starttag, HTMLParser.parse_endtag

    some, pick = '<div>|</div>|<p a="b>c">|</p>|<a href="/x">|<a href="/1" href="/2">|<a href="/a&amp;b">|<A HREF=q>|</a>|<img src="1" data-src="2">|<img data-src>|<br>|<br/>|</br>|<script>|</script>|<script-x>|<title>|</title>|<textarea>|</textarea>|<style a="b">|</style>|<!-- <p> -->|<!doctype html>|<|&amp;|&|text|  |\n|<a href="/u|<a href="/d"  >|</p x>|</>|<x:y>|<template>|</template>|<a href="/c"b="d">'.split("|"), random.Random(1)
    for _ in range(3000):
        html = "".join(pick.choice(some) for _ in range(pick.randrange(1, 14)))
        fast, slow = Page(html), Slow(html)
        assert (fast.texts, fast.images, fast.elements, fast.links) == (slow.texts, slow.images, slow.elements, slow.links), html
