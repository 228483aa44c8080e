"""The engine's queries over the test tables.  Each has the columns, with the same names, of its SQL in ``oracles``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import updated_at
from ..functions.links import absolute
from ..functions.money import to_eur
from ..functions.places import area_of_location, area_of_title, without_repeated_head
from ..functions.text import captured, lines_of, stripped, truthy, whole
from ..operators import dedup, history, leads, ranking
from ..operators.cards import anchors, cards
from ..operators.listings import listings, offers_of_pages
from ..session import shared_folder
from ..sources import snapshots as bucketed
from ..sources import tables
from ..sources.landed import land, landed_crawl
from ..sources.tables import table
from ..streaming import pages as page_stream
from ..streaming import state
from .adapters import event_snapshots, line_snapshots, order_snapshots, part_offers, part_pages, told_date

LINES_AS_OF, EVENTS_AS_OF, ORDERS_AS_OF = "1995-06-01", "2024-02-01", "2001-09-01"
METRICS = ("portal", "id", "price_eur", "area", "sqm", "drop_pct", "days_on_market", "score", "price_per_sqm", "area_avg_price_per_sqm", "pct_vs_area_avg")


def _time(text: str):
    return F.lit(text).cast("timestamp")


def _line_rows(spark, folder, by_type=False):
    return leads.lead_rows(history.as_known_at(line_snapshots(spark, folder, by_type), _time(LINES_AS_OF)), _time(LINES_AS_OF))


def _line_leads(spark, folder, by_type=False):
    return leads.with_baseline(_line_rows(spark, folder, by_type))


def _event_rows(spark, folder):
    return leads.lead_rows(event_snapshots(spark, folder), _time(EVENTS_AS_OF))


def _event_leads(spark, folder):
    return leads.with_baseline(_event_rows(spark, folder))


def lead_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return leads.leads(line_snapshots(spark, folder), _time("2002-01-01"), keys=("area",)).select(*METRICS)


def leads_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return _line_leads(spark, folder).select(*METRICS)


def lead_metrics_events(spark: SparkSession, folder: str) -> DataFrame:
    return _event_leads(spark, folder).select(*METRICS)


def lead_rank(spark: SparkSession, folder: str) -> DataFrame:
    return leads.in_rank_order(_event_rows(spark, folder)).select("id", "score", "rank")


def lead_topk(spark: SparkSession, folder: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("entered").asc(), F.col("id").asc()]
    return ranking.top(_event_rows(spark, folder), order, 100).select("id", "score", "rank")


def price_drop(spark: SparkSession, folder: str) -> DataFrame:
    return _event_rows(spark, folder).select("id", "first_price", "price_eur", "drop_pct")


def days_on_market(spark: SparkSession, folder: str) -> DataFrame:
    return _event_rows(spark, folder).select("id", "first_seen", "days_on_market")


def motivation_score(spark: SparkSession, folder: str) -> DataFrame:
    return _line_rows(spark, folder).select("id", "drop_pct", "days_on_market", "score")


def days_on_market_site_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = leads.lead_rows(order_snapshots(spark, folder), _time(ORDERS_AS_OF), ("area", "sqm", "site_updated_at"), "site_updated_at")
    return rows.select("id", "site_updated_at", "days_on_market", "score")


def price_per_unit(spark: SparkSession, folder: str) -> DataFrame:
    return _line_rows(spark, folder).select("id", "price_eur", "sqm", "price_per_sqm")


def area_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return leads.area_baseline(_line_rows(spark, folder), ("area",)).select("area", F.round("baseline", 6).alias("baseline"), "n_listings")


def area_baseline_by_portal(spark: SparkSession, folder: str) -> DataFrame:
    return leads.area_baseline(_line_rows(spark, folder, True)).select("portal", "area", F.round("baseline", 6).alias("baseline"), "n_listings")


def pct_vs_area(spark: SparkSession, folder: str) -> DataFrame:
    return _line_leads(spark, folder, True).select("portal", "id", "area", "price_per_sqm", "area_avg_price_per_sqm", "pct_vs_area_avg")


def price_history_array(spark: SparkSession, folder: str) -> DataFrame:
    rows = history.price_histories(event_snapshots(spark, folder))
    return rows.select("id", F.size("price_history").cast("bigint").alias("n_prices"), F.array_join(F.col("price_history").cast("array<string>"), ",").alias("price_history"))


def history_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    return history.first_seen(event_snapshots(spark, folder))


def history_latest(spark: SparkSession, folder: str) -> DataFrame:
    return history.latest(event_snapshots(spark, folder), ("price_eur", "area", "sqm", "seen_at"))


def snapshot_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs of landed events, appended: every listing of every run adds a snapshot, at an unchanged price too."""
    snaps = event_snapshots(spark, folder)
    early, late = (snaps.where(F.col("seen_at") < "2024-01-16"), snaps.where(F.col("seen_at") >= "2024-01-16"))
    both = early.withColumn("run_id", F.lit("run-1")).unionByName(late.withColumn("run_id", F.lit("run-2")))
    return both.groupBy("run_id", "id").agg(F.count("*").alias("n_snapshots"), F.min("seen_at").alias("first_seen"), F.max_by("price_eur", F.struct("seen_at", "seq")).alias("price_eur"))


def run_counters(spark: SparkSession, folder: str) -> DataFrame:
    snaps = event_snapshots(spark, folder)
    return snaps.agg(F.count("*").alias("n_snapshots"), F.countDistinct("id").alias("n_listings"), F.countDistinct(F.when(truthy(F.col("price_eur")), F.col("id"))).alias("n_leads"))


def min_price_filter(spark: SparkSession, folder: str) -> DataFrame:
    return event_snapshots(spark, folder).where(F.col("price_eur") >= 1000).select("id", "seq", "price_eur")


def currency_convert(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 2 == 0, "BGN").otherwise("EUR").alias("currency"))
    return orders.select("o_orderkey", "currency", to_eur(F.col("o_totalprice"), F.col("currency")).alias("price_eur"))


def _event_listings(spark, folder):
    events = table(spark, folder, "events")
    rows = events.select(
        F.lit("events").alias("portal"), F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.col("user_id").alias("id"), F.hour("ts").cast("bigint").alias("page_num"),
        F.col("event_id").alias("pos"), whole(F.col("value") * 1000).alias("price_eur"), F.col("event_type").alias("title"),
    )
    return rows.where(F.col("price_eur") >= 1000)


def _placed(rows):
    return rows.select("run_id", "id", "page_num", "pos", "price_eur", "title", F.col("first_at.page_num").alias("first_page"), F.col("first_at.pos").alias("first_pos"))


def dedup_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(dedup.first_wins(_event_listings(spark, folder)))


def dedup_last_page_wins(spark: SparkSession, folder: str) -> DataFrame:
    return _placed(dedup.last_page_wins(_event_listings(spark, folder)))


def _numbered_pages(spark, folder):
    links = F.regexp_count("html", F.lit('<a href="/[A-F]')).cast("bigint")
    return table(spark, folder, "pages").select(F.lit("pages").alias("portal"), F.floor(F.col("page_id") / 25).alias("run_id"), (F.col("page_id") % 25 + 1).alias("page_num"), links.alias("links"))


def pagination_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.until_stop(_numbered_pages(spark, folder), F.col("links") == 0).select("run_id", "page_num", "links")


def pagination_prefix_state(spark: SparkSession, folder: str) -> DataFrame:
    """As pagination_prefix, told by a stream to which the later pages of every run arrive before the earlier ones."""
    base, pages = f"{shared_folder(spark)}/{uuid.uuid4()}", _numbered_pages(spark, folder)
    for part in (F.col("page_num") > 12, F.col("page_num") <= 12):
        pages.where(part).write.mode("append").parquet(f"{base}/landed")
        stream = spark.readStream.schema(pages.schema).parquet(f"{base}/landed")
        page_stream.follow_pages(stream, F.col("links") == 0, f"{base}/told", f"{base}/progress").awaitTermination()
    return page_stream.counting_pages(spark, f"{base}/told").join(pages, ["portal", "run_id", "page_num"]).select("run_id", "page_num", "links")


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), 1)).alias("pos", "href"))
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


def page_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """As page_links, but read from the document tree."""
    found = anchors(table(spark, folder, "pages").select("page_id", "html"), ["page_id"])
    return found.select("page_id", F.col("pos").cast("bigint").alias("pos"), "href")


def listing_key_extract(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    key = captured(url, r"/([a-z]{2})/(\d+)", 2)
    return table(spark, folder, "pages").where(key.isNotNull()).select("page_id", F.concat(F.lit("demo_"), key).alias("listing_id"), captured(url, r"/([a-z]{2})/(\d+)", 1).alias("lang"))


def url_absolutize(spark: SparkSession, folder: str) -> DataFrame:
    rows = page_links(spark, folder)
    href = F.when(F.col("pos") % 3 == 0, F.concat(F.lit("/"), F.col("href"))).when(F.col("pos") % 3 == 1, F.expr("substring(href, 2)")).otherwise(F.col("href"))
    return rows.select("page_id", "pos", href.alias("href")).select("page_id", "pos", "href", absolute(F.col("href"), "https://site.example", relative=True).alias("address"))


def card_lines(spark: SparkSession, folder: str) -> DataFrame:
    found = table(spark, folder, "documents").select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    return found.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "line")


def unicode_strip(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit(" \t "), F.col("text"), F.lit(" \n "))
    return table(spark, folder, "documents").select("doc_id", stripped(padded).alias("text"))


def unicode_strip_whole(spark: SparkSession, folder: str) -> DataFrame:
    """As unicode_strip, between spaces that are not ASCII."""
    padded = F.concat(F.lit("\u00a0\u3000"), F.col("text"), F.lit("\u2003 \u2028"))
    return table(spark, folder, "documents").select("doc_id", stripped(padded).alias("text"))


def embedded_json_scan(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k")).where(F.col("k").isNotNull())


def dedup_area_words(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    name = F.concat_ws(" ", F.concat(F.lit("w"), F.col("p_partkey") % 3), F.concat(F.lit("w"), F.col("p_size") % 4), F.concat(F.lit("w"), F.col("p_partkey") % 5), F.concat(F.lit("w"), F.col("p_size") % 3))
    return parts.select("p_partkey", name.alias("area")).select("p_partkey", "area", without_repeated_head(F.col("area")).alias("short_area"))


def area_from_title(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    title = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("flat, SOFIA,  "), F.col("p_brand"), F.lit(" "))).when(F.col("p_size") % 3 == 1, F.concat(F.lit("flat Sofia, "), F.col("p_brand"), F.lit(" sofia, x"))).otherwise(F.col("p_name"))
    return parts.select("p_partkey", area_of_title(title).alias("area"))


def area_from_location(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    place = F.when(F.col("p_size") % 3 == 0, F.concat(F.col("p_brand"), F.lit(",  София"))).when(F.col("p_size") % 3 == 1, F.lit(", София")).otherwise(F.col("p_type"))
    return parts.select("p_partkey", area_of_location(place).alias("area"))


def localized_date_parse(spark: SparkSession, folder: str) -> DataFrame:
    """A card's line for every order, its date told in seven ways, and what is read from it."""
    order, now = F.col("o_orderkey"), _time("2026-08-21 09:30:00")
    rows = table(spark, folder, "orders").select("o_orderkey", F.concat(F.lit("гр. София, x - "), told_date(order % 7, order)).alias("line"))
    return rows.select("o_orderkey", F.date_format(updated_at(F.col("line"), now), "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


def multi_portal_union(spark: SparkSession, folder: str) -> DataFrame:
    every = line_snapshots(spark, folder).unionByName(event_snapshots(spark, folder)).unionByName(order_snapshots(spark, folder), allowMissingColumns=True)
    counts = every.groupBy("portal").agg(F.count("*").alias("n_snapshots"), F.countDistinct("id").alias("n_listings"), F.count("sqm").alias("n_sized"), F.count("site_updated_at").alias("n_dated"))
    return counts


def container_climb(spark: SparkSession, folder: str) -> DataFrame:
    """The cards of all links on the parts' pages, those without one too."""
    return cards(part_pages(spark, folder)).select("portal", "run_id", "page_num", "pos", "key", "has_card", "card_text")


def _shown(rows: DataFrame) -> DataFrame:
    """Arrays and timestamps as texts."""
    if "photos" in rows.columns:
        rows = rows.withColumn("photos", F.array_join("photos", " "))
    return rows.withColumn("site_updated_at", F.date_format("site_updated_at", "yyyy-MM-dd HH:mm:ss"))


def portal_leads(spark: SparkSession, folder: str) -> DataFrame:
    """From pages to leads: two runs over the parts' pages of all portals, the second cheaper by a tenth, asked for 100 days later."""
    found = listings(part_pages(spark, folder).unionByName(part_offers(spark, folder)))
    first = F.struct(_time("2026-08-21 09:30:00").alias("seen_at"), F.col("price_eur").alias("price_eur"))
    second = F.struct(_time("2026-09-21 09:30:00").alias("seen_at"), whole(F.col("price_eur") * 0.9).alias("price_eur"))
    both = found.withColumn("run", F.explode(F.array(first, second))).withColumn("price_eur", F.col("run.price_eur"))
    snapshots = history.snapshots_of(both, F.col("run.seen_at")).drop("run")
    ranked = leads.in_rank_order(leads.portal_leads(snapshots, _time("2026-11-29 09:30:00")))
    ranked = ranked.drop("entered").withColumn("first_seen", F.date_format("first_seen", "yyyy-MM-dd HH:mm:ss"))
    return _shown(ranked.withColumn("price_history", F.array_join(F.col("price_history").cast("array<string>"), ",")))


def landed_crawl_links(spark: SparkSession, folder: str) -> DataFrame:
    """The parts' pages landed as files of a crawl; the links of two portals' pages, read without the others' folders."""
    path = f"{shared_folder(spark)}/{uuid.uuid4()}"
    land(part_pages(spark, folder), path)
    pages = landed_crawl(spark, path).where(F.col("portal").isin("alo.bg", "imot.bg"))
    return pages.select("portal", "run_id", "page_num", F.regexp_count("html", F.lit('<a href="')).cast("bigint").alias("links"))


def table_listings(spark: SparkSession, folder: str) -> DataFrame:
    """All parts as cards on pages of six portals: links, categories, cards, fields, minimum prices, stop rules, dedup."""
    return _shown(listings(part_pages(spark, folder)))


def embedded_offers(spark: SparkSession, folder: str) -> DataFrame:
    """All parts as offers in the embedded state of pages: scan, nested photos, currencies, the page that says it is the last."""
    return _shown(listings(part_offers(spark, folder))).drop("site_updated_at")


def embedded_bad_records(spark: SparkSession, folder: str) -> DataFrame:
    return offers_of_pages(part_offers(spark, folder)).where("bad_record is not null").select("run_id", "page_num")


def snapshot_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to a table, the second twice; read back, ranked, written as leads, and read again."""
    base, snaps = f"{shared_folder(spark)}/{uuid.uuid4()}", event_snapshots(spark, folder)
    for run, half in (("run-1", F.col("seen_at") < "2024-01-16"), ("run-2", F.col("seen_at") >= "2024-01-16"), ("run-2", F.col("seen_at") >= "2024-01-16")):
        tables.append_run(snaps.where(half).withColumn("run_id", F.lit(run)), f"{base}/snapshots")
    tables.write_leads(leads.leads(spark.read.parquet(f"{base}/snapshots"), _time(EVENTS_AS_OF)), f"{base}/leads")
    return spark.read.schema("id bigint, score bigint, rank bigint").json(f"{base}/leads")


def run_report(spark: SparkSession, folder: str) -> DataFrame:
    """How many rows a run's steps gave, counted while they are written and not by passes of their own."""
    base, told = f"{shared_folder(spark)}/{uuid.uuid4()}", []
    for name, rows in (("snapshots", event_snapshots(spark, folder)), ("listings", listings(part_pages(spark, folder))), ("offers", listings(part_offers(spark, folder)))):
        rows, seen = tables.counted(rows, name)
        rows.write.parquet(f"{base}/{name}")
        told.append((name, seen.get["rows"]))
    return spark.createDataFrame(told, "step string, n_rows bigint")


def history_import(spark: SparkSession, folder: str) -> DataFrame:
    """History files of a hundred listings each written from events, and one that can't be read; back as snapshots."""
    seen = F.date_format(F.col("seen_at").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    snaps = event_snapshots(spark, folder).select(F.col("id").cast("string").alias("id"), F.struct("seen_at", "seq", seen.alias("text"), "price_eur", "area").alias("s"))
    each = snaps.groupBy("id").agg(F.array_sort(F.collect_list("s")).alias("s"))
    past = F.transform("s", lambda x: F.struct(x["text"].alias("seen_at"), x["price_eur"].alias("price_eur")))
    latest = F.struct("id", F.element_at("s", -1)["area"].alias("area"), F.lit("events").alias("portal"))
    record = F.struct(F.get("s", F.lit(0))["text"].alias("first_seen"), past.alias("snapshots"), latest.alias("latest"))
    files = each.groupBy(F.floor(F.col("id").cast("bigint") / 100).alias("file")).agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("id", record)))).alias("value"))
    base = f"{shared_folder(spark)}/{uuid.uuid4()}"
    files.union(spark.range(1).select(F.lit(-1).cast("bigint"), F.lit('{"1": {'))).repartition("file").write.partitionBy("file").text(base)
    found = tables.history_files(spark, base)
    return found.select("portal", "id", "seq", "price_eur", "area", F.date_format("seen_at", "yyyy-MM-dd HH:mm:ss").alias("seen_at"), F.col("bad_record").isNotNull().alias("unreadable"))


def history_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """First sight, prices and latest columns from a bucketed table of two runs, the first compacted: no exchange."""
    name, snaps = f"snapshots_{uuid.uuid4().hex}", event_snapshots(spark, folder)
    early, buckets, path = F.col("seen_at") < "2024-01-16", int(spark.conf.get("spark.sql.shuffle.partitions")), shared_folder(spark)
    bucketed.append_run(snaps.where(early).withColumn("run_id", F.lit("run-1")), name, buckets, path)
    bucketed.compact(spark, name, buckets, path)
    for _ in range(2):  # a run that is appended again replaces itself
        bucketed.append_run(snaps.where(~early).withColumn("run_id", F.lit("run-2")), name)
    rows = history.histories(bucketed.snapshots(spark, name), ("area", "sqm"))
    return rows.select("portal", "id", "first_seen", "first_price", "last_price", "latest.area", "latest.sqm")


def leads_published(spark: SparkSession, folder: str) -> DataFrame:
    """Leads of the first days, then of all, published in one place; what a reader gets last."""
    path, snaps = f"{shared_folder(spark)}/{uuid.uuid4()}", event_snapshots(spark, folder)
    for known in (snaps.where(F.col("seen_at") < "2024-01-16"), snaps):
        tables.publish_leads(leads.leads(known, _time(EVENTS_AS_OF)), path)
    return tables.published_leads(spark, path).select("id", "score", "rank")


def _followed(spark: SparkSession, folder: str) -> str:
    """Events landed in two parts and followed by a query that ends after the first and is started again for the second."""
    base, snaps = f"{shared_folder(spark)}/{uuid.uuid4()}", event_snapshots(spark, folder)
    for part in (F.col("seen_at") >= "2024-01-16", F.col("seen_at") < "2024-01-16"):  # the later days arrive first
        snaps.where(part).write.mode("append").parquet(f"{base}/landed")
        stream = spark.readStream.schema(snaps.schema).option("maxBytesPerTrigger", 256 << 20).parquet(f"{base}/landed")
        state.follow(stream, f"{base}/told", f"{base}/progress").awaitTermination()
    return base


def history_state(spark: SparkSession, folder: str) -> DataFrame:
    """First sight, prices and latest columns of every listing as the state of a stream holds them."""
    return state.current_listings(spark, f"{_followed(spark, folder)}/told")


def price_history_state(spark: SparkSession, folder: str) -> DataFrame:
    """As price_history_array, from the snapshots in the state store."""
    rows = history.price_histories(state.snapshots_in_state(spark, f"{_followed(spark, folder)}/progress"))
    return rows.select("id", F.size("price_history").cast("bigint").alias("n_prices"), F.array_join(F.col("price_history").cast("array<string>"), ",").alias("price_history"))


def area_baseline_state(spark: SparkSession, folder: str) -> DataFrame:
    """Area means kept up by what changed in each batch."""
    rows = state.baseline_of(spark.read.parquet(f"{_followed(spark, folder)}/told/areas"))
    return rows.select("area", F.round("baseline", 6).alias("baseline"), "n_listings")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        lead_metrics, lead_metrics_events, leads_as_of, lead_rank, lead_topk, price_drop, days_on_market, motivation_score, days_on_market_site_date, price_per_unit,
        area_baseline, area_baseline_by_portal, pct_vs_area, price_history_array, history_first_seen, history_latest, snapshot_append, run_counters, min_price_filter,
        currency_convert, dedup_first_wins, dedup_last_page_wins, pagination_prefix, page_links, page_anchors, listing_key_extract, url_absolutize, card_lines, unicode_strip, unicode_strip_whole,
        embedded_json_scan, dedup_area_words, area_from_title, area_from_location, localized_date_parse, multi_portal_union, container_climb, portal_leads,
        landed_crawl_links, table_listings, embedded_offers, embedded_bad_records, run_report, snapshot_round_trip, history_import, history_bucketed, leads_published, pagination_prefix_state, history_state, price_history_state, area_baseline_state,
    )
}
