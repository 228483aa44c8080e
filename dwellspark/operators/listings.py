"""From cards and embedded offers to listings: column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import updated_at
from ..functions.links import absolute
from ..functions.money import to_eur
from ..functions.places import DEFAULT_AREA, area_of_location, without_repeated_head
from ..functions.text import captured, decimal_number, digits, first_line, lines_of, not_empty, stripped, unicode_pattern, whole
from ..schema import OFFERS_JSON
from ..session import stored
from .cards import cards
from .dedup import by_rule, until_stop
from .portals import BY_NAME, PORTALS, Portal

# How the portals' cards write prices, sizes, areas and titles.
PRICE_IN_TEXT = {"imoti.net": r"([\d\s]{3,12})\s?BGN", "alo.bg": r"Цена\s*:\s*([\d\s]+)\s?€"}
PRICE_LINE = {"imot.bg": r"^([\d\s]{3,10})\s?€$", "imoti.bg": r"^([\d\s]{3,10})\s?EUR$", "olx.bg": r"^([\d\s]{3,10})\s?€$"}
SIZE_LINE = {"imot.bg": r"([\d.,]+)\s?кв\.?м", "imoti.bg": r"([\d.,]+)\s?кв\.?м\.?", "olx.bg": r"([\d.,]+)\s?кв\.?м"}
AREA_LINE = {"bazar.bg": r"^гр\.\s*София,\s*(.+)$", "imot.bg": r"^град София,\s*(.+)$", "imoti.bg": r"^София,\s*(.+)$", "olx.bg": r"^гр\.\s*София,\s*(.+?)\s-\s"}
NET_SIZE, NET_TITLE = r"(\d+)\s?м\s?2", r"for sale (.{5,90}?)\s+[\d\s]{2,10}\s?€"
ALO_SIZE, ALO_AREA = r"Квадратура:\s*([\d.,]+)\s?кв\.?м", r"((?:[А-Я][а-я]*\s+){0,3}[А-Я][а-я]*(?:\s+\d+)?),\s*София"
HOMES_STATE, HOMES_SIZE, HOMES_PHOTOS = r"window\.__PRELOADED_STATE__\s*=\s*(?=\{)", r"(\d+)\s?m²", "https://g1.homes.bg/"

FIELDS = ("id", "url", "photo", "photos", "description", "price_eur", "sqm", "area", "title", "site_updated_at")


def _found(p: Portal, patterns: dict[str, str], lines: Column) -> Column:
    return first_line(lines, patterns[p.name]) if p.name in patterns else F.lit(None)


def _amount(p: Portal, text: Column, lines: Column) -> Column:
    """The price in the portal's currency."""
    if p.name in PRICE_IN_TEXT:
        return digits(captured(text, PRICE_IN_TEXT[p.name]))
    if p.name == "bazar.bg":  # the line before the first that is only the sign, the first line apart
        at = F.array_position(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), "€")
        return F.when(at > 0, digits(F.get(lines, (at - 1).cast("int"))))
    return digits(captured(F.col("price_line"), PRICE_LINE[p.name]))


def _size(p: Portal, text: Column) -> Column:
    if p.name == "imoti.net":
        return captured(text, NET_SIZE).try_cast("bigint")
    if p.name == "alo.bg":
        return whole(decimal_number(captured(text, ALO_SIZE)))
    if p.name in SIZE_LINE:
        return whole(decimal_number(captured(F.col("size_line"), SIZE_LINE[p.name])))
    return F.lit(None).cast("bigint")


def _place(p: Portal, text: Column) -> Column:
    if p.name == "imoti.net":  # known only from the title, when leads are made
        return F.lit(None).cast("string")
    return stripped(captured(text, ALO_AREA) if p.name == "alo.bg" else captured(F.col("area_line"), AREA_LINE[p.name]))


def _area(p: Portal) -> Column:
    if p.name == "imoti.net":
        return F.lit(None).cast("string")
    place = F.col("place")
    return F.coalesce(without_repeated_head(place) if p.name == "alo.bg" else place, F.lit(DEFAULT_AREA))


def _title(p: Portal, text: Column, lines: Column, area: Column) -> Column:
    if p.name == "imoti.net":
        return not_empty(stripped(captured(text, NET_TITLE)))
    if p.name == "alo.bg":
        title = F.coalesce(not_empty(F.col("anchor_text")), F.substring(text, 1, 100))
    elif p.name == "bazar.bg":
        title = F.get(lines, F.lit(0))
    elif p.name == "imoti.bg":
        title = F.concat_ws(", ", F.coalesce(F.get(lines, F.lit(1)), area), area)
    else:
        title = F.concat_ws(", ", F.get(lines, F.lit(0)), area)
    return F.substring(title, 1, p.title_chars)


def _source(p: Portal) -> Column:
    """The address of the card's photo as the page has it."""
    order = ("data_src", "src") if p.name == "imot.bg" else ("src",) if p.name == "alo.bg" else ("src", "data_src")
    sources = F.transform("images", lambda i: F.coalesce(*[not_empty(i[k]) for k in order]))
    if p.name in ("imoti.net", "alo.bg"):  # the first image, whatever it shows
        return F.get(sources, F.lit(0))
    if p.name == "olx.bg":
        return F.get(F.filter(sources, lambda s: s.startswith("http") & ~F.lower(s).contains("icon")), F.lit(0))
    fold = (lambda s: s) if p.name == "imot.bg" else F.lower
    return F.get(F.filter(sources, lambda s: s.isNotNull() & ~fold(s).contains("icons/")), F.lit(0))


def _photo(p: Portal) -> Column:
    if p.name == "imoti.net":
        return absolute(F.col("source"), p.base, scheme_relative=False)
    return absolute(F.col("source"), p.base, relative=p.name in ("alo.bg", "imoti.bg"))


def _url(p: Portal) -> Column:
    if p.name == "alo.bg":
        return F.concat(F.lit(p.base), "href")
    if p.name in ("imot.bg", "imoti.bg"):
        return absolute(F.col("href"), p.base, relative=p.name == "imoti.bg")
    return F.when(F.col("href").startswith("http"), F.col("href")).otherwise(F.concat(F.lit(p.base), "href"))


def _each(rows: DataFrame, name: str, make, type_: str, where: Column | None = None) -> DataFrame:
    """A column that every portal makes in its own way, null outside ``where``; one pass over the rows."""
    out = F.lit(None).cast(type_)
    for p in PORTALS:
        if p.link:
            out = F.when(F.col("portal") == p.name, make(p)).otherwise(out)
    return rows.withColumn(name, out if where is None else F.when(where, out))


def _told_by_cards(cards: DataFrame) -> DataFrame:
    """The cards with ``valid`` and, where that is true, the listing's fields.

    What is read more than once, such as the line of a price, is a column of its own and found once for each card.
    """
    text, lines, good = F.col("card_text"), F.col("lines"), F.col("good")
    rows = cards.withColumn("lines", F.when(F.col("has_card"), lines_of(F.col("card_lines"))))
    rows = _each(rows, "price_line", lambda p: _found(p, PRICE_LINE, lines), "string")
    rows = _each(rows, "amount", lambda p: _amount(p, text, lines), "bigint", F.col("has_card"))
    rows = _each(rows, "least", lambda p: F.lit(p.min_price), "bigint")
    priced = (F.col("amount") >= F.col("least")) & ((F.size("lines") > 0) | F.col("portal").isin("imoti.net", "alo.bg"))
    rows = rows.withColumn("good", F.coalesce(F.col("has_card") & priced, F.lit(False)))
    rows = _each(rows, "size_line", lambda p: _found(p, SIZE_LINE, lines), "string", good)
    rows = _each(rows, "area_line", lambda p: _found(p, AREA_LINE, lines), "string", good)
    rows = _each(rows, "place", lambda p: _place(p, text), "string", good)
    rows = _each(rows, "area", _area, "string", good)
    rows = _each(rows, "title", lambda p: _title(p, text, lines, F.col("area")), "string", good)
    rows, valid = rows.withColumn("valid", good & F.col("title").isNotNull()), F.col("valid")
    rows = _each(rows, "source", _source, "string", valid)
    rows = _each(rows, "price_eur", lambda p: to_eur(F.col("amount"), p.currency), "bigint", valid)
    rows = _each(rows, "sqm", lambda p: _size(p, text), "bigint", valid)
    rows = _each(rows, "photo", _photo, "string", valid)
    rows = _each(rows, "url", _url, "string", valid)
    rows = _each(rows, "id", lambda p: F.concat(F.lit(p.prefix), "key"), "string", valid)
    dated = F.when(valid & (F.col("portal") == "olx.bg"), updated_at(F.col("area_line"), F.col("fetched_at")))
    rows = rows.withColumns({"site_updated_at": dated, "photos": F.lit(None).cast("array<string>"), "description": F.lit(None).cast("string")})
    return rows.select("portal", "run_id", "page_num", "pos", "has_card", "valid", *FIELDS)


def listings_of_cards(cards: DataFrame) -> DataFrame:
    """The valid listings of cards, not yet deduplicated, with page_num and pos."""
    return _told_by_cards(cards).where("valid").drop("has_card", "valid")


def _after(html: Column) -> Column:
    return F.get(F.split(html, unicode_pattern(HOMES_STATE), 2), F.lit(1))


def _ended(parts: Column) -> Column:
    """How many parts an object has, and whether it ends with them."""
    before = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))
    odd = F.transform(before, lambda p: F.length(F.regexp_replace(p, r'\\.|[^"\\]+', "")) % 2)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("inside"), F.lit(False).alias("done"))
    step = lambda acc, x: F.struct((acc["n"] + 1).alias("n"), ((acc["inside"] + x) % 2).alias("inside"), ((acc["inside"] + x) % 2 == 0).alias("done"))
    return F.aggregate(odd, start, lambda acc, x: F.when(acc["done"], acc).otherwise(step(acc, x)))


def _state(after: Column, parts: Column, ended: Column) -> Column:
    return F.when(ended["done"], F.concat(F.array_join(F.slice(parts, F.lit(1), ended["n"]), "};"), F.lit("}"))).otherwise(after)


def embedded_state(html: Column) -> Column:
    """The object assigned in a page's script: up to the first ``};`` that is outside its strings; null without one.

    What follows the assignment is cut at every ``};``.  A cut counts if an even number of quotes, escaped ones apart,
    stands before it.  An object that doesn't end is all that follows.
    """
    parts = F.split(_after(html), r"\};")
    return _state(_after(html), parts, _ended(parts))


def with_embedded_state(pages: DataFrame) -> DataFrame:
    """Adds ``state``, as ``embedded_state`` tells it; each step is a column that later ones read, so none is computed again."""
    rows = pages.withColumn("_after", _after(F.col("html"))).withColumn("_parts", F.split("_after", r"\};")).withColumn("_ended", _ended(F.col("_parts")))
    return rows.withColumn("state", _state(F.col("_after"), F.col("_parts"), F.col("_ended"))).drop("_after", "_parts", "_ended")


def offers_of_pages(pages: DataFrame) -> DataFrame:
    """The pages with the offers embedded in them and whether more follow; a state without readable offers is in ``bad_record``."""
    rows = with_embedded_state(pages).withColumn("_read", F.from_json("state", OFFERS_JSON)["data"]["offers"])
    return rows.withColumns({
        "has_state": F.col("state").isNotNull(), "offers": F.col("_read.result"), "has_more": F.coalesce("_read.hasMoreItems", F.lit(False)),
        "bad_record": F.when(F.col("_read.result").isNull(), F.col("state")),
    }).drop("state", "_read")


def listings_of_offers(pages: DataFrame) -> DataFrame:
    """The listings of embedded offers; no tree, no Python.  Offers without id, address or readable price are dropped."""
    p = BY_NAME["homes.bg"]
    rows = pages.select("portal", "run_id", "page_num", F.posexplode("offers").alias("pos", "offer")).select("portal", "run_id", "page_num", "pos", "offer.*")
    address = lambda x: F.concat(F.lit(HOMES_PHOTOS), x["path"], x["name"], F.lit("b.jpg"))
    photo = address(F.col("photo"))
    photos = F.transform(F.filter(F.coalesce("photos", F.array()), lambda x: (x["path"] != "") & (x["name"] != "")), address)
    title, place = F.coalesce("title", F.lit("")), F.coalesce("location", F.lit(""))
    amount = F.replace(F.col("price.value"), F.lit(","), F.lit("")).try_cast("double")
    rows = rows.select(
        "portal", "run_id", "page_num", "pos",
        F.concat(F.lit(p.prefix), "id").alias("id"),
        F.concat(F.lit(p.base), "viewHref").alias("url"),
        photo.alias("photo"),
        F.when((F.size(photos) == 0) & photo.isNotNull(), F.array(photo)).otherwise(photos).alias("photos"),
        not_empty(F.col("description")).alias("description"),
        to_eur(amount, F.coalesce(F.col("price.currency"), F.lit("EUR"))).alias("price_eur"),
        captured(title, HOMES_SIZE).try_cast("bigint").alias("sqm"),
        area_of_location(place).alias("area"),
        F.btrim(F.concat(title, F.lit(", "), place), F.lit(", ")).alias("title"),
        F.lit(None).cast("timestamp").alias("site_updated_at"),
    )
    return rows.where("id is not null and url is not null and price_eur is not null")


def listings(pages: DataFrame) -> DataFrame:
    """All portals' listings of landed pages: pages up to each run's stop, one row for each id, in ``ordinal`` order.

    Pages are narrowed before the tree is built, and what is told by them, the fields of each card and the offers, is
    written once: stop rules, counts and deduplication read that, so no page is made, parsed or read twice.
    """
    cap = F.lit(None).cast("int")
    for p in PORTALS:
        cap = F.when(F.col("portal") == p.name, p.max_pages).otherwise(cap)
    pages, by_link = pages.where(F.col("page_num") <= cap), [p for p in PORTALS if p.link]
    told = stored(_told_by_cards(cards(pages.where(F.col("portal").isin(*[p.name for p in by_link])), every_page=True)))
    seen = told.groupBy("portal", "run_id", "page_num").agg(F.count("pos").alias("links"), F.count_if("valid").alias("listings"), F.bool_or(F.col("has_card").isNull()).alias("failed"))
    by_listings = F.col("portal").isin(*[p.name for p in by_link if p.stop == "listings"])
    empty = F.when(by_listings, F.col("listings") == 0).otherwise(F.col("links") == 0)
    alive = until_stop(seen, F.col("failed") | empty).select("portal", "run_id", "page_num")
    offers = offers_of_pages(pages.where(F.col("portal") == "homes.bg")).withColumn("failed", F.col("html").isNull())
    offers = stored(offers.select("portal", "run_id", "page_num", "failed", "has_state", "has_more", "offers"))
    last = F.col("failed") | (F.col("has_state") & ~F.col("has_more"))
    ends = _until_flag(offers, last)
    rows = _of_page(told.where("valid").drop("has_card", "valid"), alive, "left_semi").unionByName(listings_of_offers(ends))
    one = by_rule(rows, F.col("portal").isin(*[p.name for p in PORTALS if p.dedup == "last_page"]))
    return one.withColumn("ordinal", F.col("first_at.page_num").cast("bigint") * F.lit(1_000_000) + F.col("first_at.pos")).drop("first_at", "pos")


def _of_page(rows: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """Rows with what is known of their page; a null run is a run like any other."""
    page = ("portal", "run_id", "page_num")
    named = facts.select(*[F.col(k).alias(f"_{k}") for k in page], *[c for c in facts.columns if c not in page])
    joined = rows.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in page], how)
    return joined.drop(*[f"_{k}" for k in page])


def _until_flag(offers: DataFrame, last: Column) -> DataFrame:
    """Embedded offers up to the page that says it is the last (itself included) or the first that failed."""
    ends = offers.groupBy(F.col("portal").alias("p"), F.col("run_id").alias("r")).agg(F.min(F.when(last, F.col("page_num"))).alias("end"))
    same = (F.col("portal") == F.col("p")) & F.col("run_id").eqNullSafe(F.col("r"))
    return offers.join(ends, same).where(F.col("end").isNull() | (F.col("page_num") <= F.col("end"))).drop("p", "r", "end")
