"""What differs between portals, as data: one spec each, read by the same operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Portal:
    """How a portal's result pages are read.

    A listing's card is an ancestor of its link with 1 to ``max_mentions`` prices and at most ``max_text`` characters,
    among the ``max_levels`` nearest: the smallest, or with ``largest`` the last before one with too many prices.
    ``dedup`` is ``first`` (first success of a run) or ``last_page``; ``stop`` is what an empty page lacks: ``links``,
    ``listings``, or ``flag`` (the page itself says that no more follow).  Pages beyond ``max_pages`` don't count.
    """

    name: str
    prefix: str
    base: str
    link: str = ""
    key_group: int = 1
    mention: str = ""
    max_mentions: int = 1
    max_text: int = 500
    max_levels: int = 6
    largest: bool = False
    currency: str = "EUR"
    min_price: int | None = 1000
    title_chars: int | None = 150
    dedup: str = "first"
    stop: str = "links"
    max_pages: int = 100


# The kinds of apartments that imoti.bg's addresses name.
APARTMENTS = ("едностаен-апартамент", "двустаен-апартамент", "тристаен-апартамент", "четиристаен-апартамент", "многостаен", "мезонет")

# Link patterns, price mentions and card limits of the portals, as their pages are built.
PORTALS = (
    Portal("imoti.net", "", "https://www.imoti.net", r"^/en/obiava/prodava[^\"'#]*?/(\d+)/", 1, r"([\d\s]{3,12})\s?BGN", 2, 400, 6, currency="BGN", title_chars=None, max_pages=420),
    Portal("alo.bg", "alo_", "https://www.alo.bg", r"^/[a-z0-9\-]+-(\d{6,9})$", 1, r"Цена\s*:\s*([\d\s]+)\s?€", 1, 1500, 6, title_chars=120, max_pages=350),
    Portal("bazar.bg", "bazar_", "https://bazar.bg", r"obiava-(\d+)", 1, r"[\d\s]{3,10}\s?€", 1, 500, 9, dedup="last_page", stop="listings", max_pages=60),
    Portal("homes.bg", "homes_", "https://www.homes.bg", min_price=None, title_chars=None, stop="flag"),
    Portal("imot.bg", "imot_", "https://www.imot.bg", r"/obiava-(\d[a-z]\d{10,})-", 1, r"[\d\s]{3,10}\s?€", 1, 800, 8, max_pages=30),
    Portal("imoti.bg", "imotibg_", "https://imoti.bg", "/продажби/(?:" + "|".join(APARTMENTS) + r")/софия/([^/]+)-(\d{5,})\.htm", 2, r"[\d\s]{3,10}\s?EUR", 1, 500, 9, True, dedup="last_page", stop="listings", max_pages=12),
    Portal("olx.bg", "olx_", "https://www.olx.bg", r"/d/ad/[^\"'#]*-ID(\w+)\.html", 1, r"[\d\s]{3,10}\s?€", 1, 500, 8, max_pages=40),
)
BY_NAME = {p.name: p for p in PORTALS}
