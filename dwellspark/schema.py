"""Schemas of the engine's tables."""

from __future__ import annotations

#: A landed page: what a crawl of a portal leaves.  html is null where the fetch failed.
PAGE = "portal string, run_id string, page_num int, url string, html string, fetched_at timestamp"
#: A listing as extracted from a page.
LISTING = (
    "portal string, run_id string, id string, url string, photo string, photos array<string>, description string, "
    "price_eur bigint, sqm bigint, area string, title string, site_updated_at timestamp"
)
#: One observation of a listing in a run; the listing's other columns follow.
SNAPSHOT = "portal string, id string, seen_at timestamp, seq bigint, price_eur bigint"
#: The history file of one portal: a map by listing id.
HISTORY_JSON = (
    "map<string, struct<first_seen: string, snapshots: array<struct<seen_at: string, price_eur: bigint>>, latest: struct<"
    "id: string, url: string, photo: string, photos: array<string>, description: string, price_eur: bigint, sqm: bigint, "
    "area: string, title: string, portal: string, site_updated_at: string>>>"
)
#: The offers that homes.bg embeds in its pages.
OFFERS_JSON = (
    "struct<data: struct<offers: struct<hasMoreItems: boolean, result: array<struct<id: string, title: string, location: string, "
    "photo: struct<path: string, name: string>, photos: array<struct<path: string, name: string>>, viewHref: string, "
    "description: string, price: struct<value: string, currency: string>>>>>>"
)
