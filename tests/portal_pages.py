"""Small invented pages in the portals' layouts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from dwellspark.schema import PAGE

NOW = datetime(2026, 8, 21, 9, 30)


def _card(link: str, *parts: str, img: str = "/img/x.jpg") -> str:
    return f'<div class="card"><img src="/icons/fav.png"><img src="{img}"><a href="{link}">Тристаен в центъра</a>' + "".join(f"<div>{p}</div>" for p in parts) + "</div>"


def _page(*cards: str) -> str:
    return "<html><body><h1>Обяви</h1><section>" + "".join(cards) + "</section><script>var a = '9 999 €';</script></body></html>"


IMOT = "/obiava-{}-tristaen"
PAGES = (
    ("imot.bg", 1, _page(_card(IMOT.format("1a1234567890"), "125 000 €", "град София, Лозенец", "85,5 кв.м"), _card(IMOT.format("1b1234567890"), "90 000 €", "80 000 €"), _card(IMOT.format("1c1234567890"), "999 €", "50 кв.м"))),
    ("imot.bg", 2, _page(_card(IMOT.format("1a1234567890"), "120 000 €", "град София, Лозенец"), _card(IMOT.format("1d1234567890"), "1 000 €", "1.234,5 кв.м", img="//cdn.example/y.jpg"))),
    ("imot.bg", 3, _page("<p>няма обяви</p>")),
    ("imot.bg", 4, _page(_card(IMOT.format("1e1234567890"), "77 000 €"))),
    ("imoti.bg", 1, _page('<div><div><a href="/продажби/мезонет/софия/мезонет-център-54321.htm">виж</a><p>210 000 EUR</p></div><p>Мезонет</p><p>София, Център</p><p>140 кв.м.</p></div>', '<div><a href="/продажби/гараж/софия/гараж-99999.htm">виж</a><p>20 000 EUR</p></div>')),
    ("imoti.bg", 2, _page('<div><div><a href="/продажби/мезонет/софия/мезонет-център-54321.htm">виж</a><p>205 000 EUR</p></div><p>Мезонет</p><p>София, Център</p></div>')),
    ("olx.bg", 1, _page(_card("/d/ad/apartament-CID1-IDa1B2.html", "99 000 €", "гр. София, Люлин - Обновено на 20 август 2026 г.", "60 кв.м - 1650", img="https://cdn.example/z.jpg"), _card("/d/ad/studio-CID1-IDzz9.html", "55 000 €", "гр. София, Младост - ДНЕС"), _card("/d/ad/studio-CID1-IDzz8.html", "56 000 €", "гр. София, Дружба - Обновено на 30 февруари 2026 г."))),
    ("bazar.bg", 1, _page('<li><a href="/obiava-7001/dvustaen">Двустаен</a><span>88 500</span><span>€</span><p>гр. София, Надежда</p></li>')),
    ("bazar.bg", 2, _page('<li><a href="/obiava-7001/dvustaen">Двустаен</a><span>87 000</span><span>€</span><p>гр. София, Надежда</p></li>')),
    ("alo.bg", 1, _page('<div><img src="photo.jpg"><a href="/tristaen-apartament-1234567"></a><p>Цена : 125 000 € Квадратура: 90,4 кв.м Люлин 5 Люлин 7, София</p></div>', '<div><a href="/dvustaen-7654321">Двустаен</a><p>Цена:   €</p></div>')),
    ("imoti.net", 1, _page('<div><a href="/en/obiava/prodava-apartament/123456/"><img data-src="/p/1.jpg"></a> for sale Two-bedroom flat, Sofia, Lozenets 100 000 € / 195 583 BGN, 80 м 2</div>', '<div><a href="/en/obiava/prodava-apartament/123457/">x</a> 250 000 BGN</div>')),
    ("homes.bg", 1, '<script>window.__PRELOADED_STATE__ = {"data":{"offers":{"hasMoreItems":true,"result":[{"id":11,"title":"Апартамент, 70m²","location":"Изток, София","photo":{"path":"a/","name":"b"},"photos":[],"viewHref":"/offer/11","description":"","price":{"value":"244,479","currency":"BGN"}},{"id":12,"title":"Ателие","location":", София","photo":null,"photos":[{"path":"c/","name":"d"},{"path":"","name":"e"}],"viewHref":"/offer/12","description":"светло","price":{"value":"500","currency":"USD"}}]}}};</script>'),
    ("homes.bg", 2, "<html>без данни</html>"),
    ("homes.bg", 3, '<script>window.__PRELOADED_STATE__ = {"data":{"offers":{"hasMoreItems":false,"result":[{"id":13,"title":"Къща","location":"Бояна, София","viewHref":"/offer/13","price":{"value":"1","currency":"EUR"}}]}}};</script>'),
    ("homes.bg", 4, '<script>window.__PRELOADED_STATE__ = {"data":{"offers":{"hasMoreItems":false,"result":[{"id":14,"title":"Къща","location":"Бояна, София","viewHref":"/offer/14","price":{"value":"2","currency":"EUR"}}]}}};</script>'),
)


def pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(portal, "run-1", n, f"https://{portal}/?page={n}", html, NOW) for portal, n, html in PAGES], PAGE)
