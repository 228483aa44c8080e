"""The test tables as snapshots of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MONTHS
from ..functions.text import whole
from ..schema import PAGE
from ..sources.tables import table


def line_snapshots(spark: SparkSession, folder: str, by_type: bool = False) -> DataFrame:
    """Parts as listings, their order lines as sightings; one portal, or one for each type of part."""
    lines, parts = table(spark, folder, "lineitem"), table(spark, folder, "part")
    portal = F.col("p_type") if by_type else F.lit("parts")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        portal.alias("portal"), F.col("l_partkey").alias("id"), F.col("l_shipdate").alias("seen_at"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).cast("bigint").alias("seq"),
        whole(F.col("l_extendedprice")).alias("price_eur"), F.col("p_brand").alias("area"), F.col("p_size").cast("bigint").alias("sqm"),
    )


def event_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Users as listings, their events as sightings, placed and sized by the customer and part of the same number."""
    events, customers, parts, nations = (table(spark, folder, t) for t in ("events", "customer", "part", "nation"))
    placed = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name")
    rows = events.join(placed, F.col("user_id") == F.col("c_custkey"), "left").join(parts.select("p_partkey", "p_size"), F.col("user_id") == F.col("p_partkey"), "left")
    return rows.select(
        F.lit("events").alias("portal"), F.col("user_id").alias("id"), F.col("ts").alias("seen_at"), F.col("event_id").alias("seq"),
        whole(F.col("value") * 1000).alias("price_eur"), F.col("n_name").alias("area"), F.col("p_size").cast("bigint").alias("sqm"),
    )


def order_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as listings, their orders as sightings; the date of an urgent last order stands for the site's date."""
    orders, customers, nations = (table(spark, folder, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.lit("orders").alias("portal"), F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("seen_at"), F.col("o_orderkey").alias("seq"),
        whole(F.col("o_totalprice")).alias("price_eur"), F.col("n_name").alias("area"), F.lit(None).cast("bigint").alias("sqm"),
        F.when(F.col("o_orderpriority").startswith("1"), F.col("o_orderdate")).alias("site_updated_at"),
    )


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _part_places(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a run (their brand and thousands), a page of four (by their size) and a price from 900 to 5899.

    A run takes 3,000 neighbouring keys, so pages stay as small as they are however many parts there are.
    """
    parts = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    run = F.concat_ws("-", "p_brand", F.floor(F.col("p_partkey") / 3000))
    return parts.withColumns({"run_id": run, "page_num": (F.col("p_size") % 4 + 1).cast("int"), "price": 900 + F.col("p_partkey") * 37 % 5000})


def _by_page(rows: DataFrame) -> DataFrame:
    """The parts dealt out by page before any text is made of them: the table is small, with few splits, and its pages are large.

    The session's number of partitions is named, since Spark would choose one by the parts' few bytes.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "run_id", "page_num")


def _landed(rows: DataFrame, html) -> DataFrame:
    pages = rows.groupBy("portal", "run_id", "page_num").agg(html.alias("html"))
    url, fetched = F.concat_ws("/", F.lit("https:/"), "portal", "page_num"), F.lit("2026-08-21 09:30:00").cast("timestamp")
    return pages.withColumns({"url": url, "fetched_at": fetched}).select(*[c.split()[0] for c in PAGE.split(", ")])


def told_date(way: Column, number: Column) -> Column:
    """A date as a card tells it, in one of seven ways: today, yesterday, two spellings of a day of 2025, one that isn't, an unknown month, nothing."""
    day, month = _text(number % 28 + 1), F.element_at(F.array(*map(F.lit, MONTHS)), (number % 12 + 1).cast("int"))
    return (
        F.when(way == 0, "ДНЕС").when(way == 1, "вчера").when(way == 2, _text("Обновено на ", day, " ", month, " 2025 г.")).when(way == 3, _text("обновено на  ", day, " ", F.upper(month), " 2025г"))
        .when(way == 4, "Обновено на 30 февруари 2025 г.").when(way == 5, _text("Обновено на ", day, " brumaire 2025 г.")).otherwise("нищо")
    )


def part_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as cards on landed pages of the six portals that have cards, in the order of their keys.

    Of eleven cards of imot.bg one has two prices, one is too long, and the link of one lies deeper than its price; of
    those of imoti.bg one is too long but for an inner part, and one is nested.  Dates of olx.bg are told in six ways.
    """
    key, name, brand, size, price = (F.col(c) for c in ("p_partkey", "p_name", "p_brand", "p_size", "price"))
    kind, nth, long = F.when(size % 3 == 0, "гараж").otherwise("мезонет"), key % 11, _text("<p>", F.repeat(F.lit("дълъг текст "), 80), "</p>")
    only = lambda n, text: F.when(nth == n, text).otherwise("")
    cards = (
        ("imot.bg", _text('<div><img src="/icons/f.png"><img data-src="//cdn.example/', key, '.jpg">', only(7, "<div><div>"), '<a href="/obiava-1a', F.lpad(key.cast("string"), 10, "0"), '-x">', name, "</a>", only(7, "</div></div>"), "<p>", price, "\u00a0€</p>", only(3, "<p>1 000 €</p>"), "<p>град София, ", brand, "</p><p>", size, ",5 кв.м</p>", only(5, long), "</div>")),
        ("imoti.bg", _text("<div>", F.when(nth.isin(5, 7), "<div>").otherwise(""), '<a href="/продажби/', kind, "/софия/обява-", 100_000 + key, '.htm">', name, "</a><p>", price, " EUR</p>", F.when(nth.isin(5, 7), "</div>").otherwise(""), "<p>София, ", brand, "</p><p>", size, " кв.м.</p>", only(5, long), "</div>")),
        ("olx.bg", _text('<div><img src="https://cdn.example/', key, '.jpg"><a href="/d/ad/x-ID', key, '.html">', name, "</a><p>", price, " €</p><p>гр. София, ", brand, " - ", told_date(key % 7, key), "</p><p>", size, " кв.м - 9</p></div>")),
        ("bazar.bg", _text('<div><img src="/i/', key, '.jpg"><a href="/obiava-', key, '">', name, "</a><b>", price, "</b><b>€</b><p>гр. София, ", brand, "</p></div>")),
        ("alo.bg", _text('<div><img src="i/', key, '.jpg"><a href="/ap-', 1_000_000 + key, '">', name, "</a><p>Цена : ", price, " € Квадратура: ", size, ".5 кв.м Люлин ", size % 3, " Люлин ", size % 9, ", София</p></div>")),
        ("imoti.net", _text('<div><a href="/en/obiava/prodava-x/', key, '/"></a>for sale ', name, ", Sofia, ", brand, " ", price, " € / ", 2 * price, " BGN, ", size, " м 2</div>")),
    )
    rows = _part_places(spark, folder).withColumn("portal", F.element_at(F.array(*[F.lit(c[0]) for c in cards]), (key % 6 + 1).cast("int")))
    card = F.lit(None).cast("string")
    for name_of_portal, text in cards:
        card = F.when(F.col("portal") == name_of_portal, text).otherwise(card)
    in_order = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda c: c["card"]), "")
    return _landed(_by_page(rows).withColumn("card", card), _text("<html><section>", in_order, "</section></html>"))


HARD = ' "}; \\" {\\'


def part_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as embedded offers of homes.bg; the state of a brand's second page breaks off if the brand ends in 3.

    Of five titles one holds what ends a state, and the quotes and backslashes that JSON escapes.
    """
    key, tens = F.col("p_partkey"), F.floor(F.col("p_retailprice") * 10)
    photo = F.when(key % 3 == 1, F.struct(F.lit("a/").alias("path"), key.cast("string").alias("name")))
    more = F.array(F.struct(F.lit("p/").alias("path"), key.cast("string").alias("name")), F.struct(F.lit("").alias("path"), F.lit("x").alias("name")))
    price = F.struct(_text(F.floor(tens / 1000), ",", F.lpad((tens % 1000).cast("string"), 3, "0")).alias("value"), F.when(key % 2 == 0, "BGN").otherwise("EUR").alias("currency"))
    offer = F.struct(
        key.alias("id"), _text(F.when(key % 5 == 2, _text(F.col("p_name"), HARD)).otherwise(F.col("p_name")), ", ", F.col("p_size"), "m²").alias("title"), _text(F.col("p_brand"), ", София").alias("location"), photo.alias("photo"),
        F.when(key % 3 == 0, more).otherwise(F.slice(more, 1, 0)).alias("photos"), _text("/offer/", key).alias("viewHref"), F.when(key % 5 == 0, "").otherwise(F.col("p_type")).alias("description"), price.alias("price"),
    )
    rows = _by_page(_part_places(spark, folder)).select(F.lit("homes.bg").alias("portal"), "run_id", "page_num", F.struct("p_partkey", offer.alias("offer")).alias("one"))
    result = F.transform(F.array_sort(F.collect_list("one")), lambda o: o["offer"])
    state = F.to_json(F.struct(F.struct(F.struct((F.col("page_num") < 4).alias("hasMoreItems"), result.alias("result")).alias("offers")).alias("data")))
    state = F.when((F.col("page_num") == 2) & F.col("run_id").rlike(r"3-\d+$"), F.concat(F.substring(state, 1, 40), F.lit("}"))).otherwise(state)
    return _landed(rows, _text("<script>window.__PRELOADED_STATE__ = ", state, ";</script>"))
