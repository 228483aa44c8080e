"""The queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from .adapters import HARD
from .queries import EVENTS_AS_OF, LINES_AS_OF, ORDERS_AS_OF

LINES = """SELECT {portal} AS portal, l_partkey AS id, l_shipdate AS seen_at, l_orderkey * 100 + l_linenumber AS seq,
  CAST(round_even(l_extendedprice, 0) AS BIGINT) AS price_eur, p_brand AS area, CAST(p_size AS BIGINT) AS sqm, CAST(NULL AS TIMESTAMP) AS site_updated_at
  FROM lineitem JOIN part ON l_partkey = p_partkey"""
EVENTS = """SELECT 'events' AS portal, user_id AS id, ts AS seen_at, event_id AS seq, CAST(round_even(value * 1000, 0) AS BIGINT) AS price_eur,
  n_name AS area, CAST(p_size AS BIGINT) AS sqm, CAST(NULL AS TIMESTAMP) AS site_updated_at
  FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN part ON user_id = p_partkey"""
ORDERS = """SELECT 'orders' AS portal, o_custkey AS id, o_orderdate AS seen_at, o_orderkey AS seq, CAST(round_even(o_totalprice, 0) AS BIGINT) AS price_eur,
  n_name AS area, CAST(NULL AS BIGINT) AS sqm, CASE WHEN o_orderpriority LIKE '1%' THEN o_orderdate END AS site_updated_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
PARTS, TYPES = LINES.format(portal="'parts'"), LINES.format(portal="p_type")
DAYS = "CAST(floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us({since})) / 86400000000) AS BIGINT)"


def _leads(snapshots: str, as_of: str, select: str, keys: str = "portal, area", known: bool = False, site: bool = False) -> str:
    """``select`` over the relations snaps, rows_ (row-local metrics), base (area means) and leads."""
    days = f"greatest({DAYS.format(as_of=as_of, since='coalesce(site_updated_at, first_seen)')}, 0)" if site else DAYS.format(as_of=as_of, since="first_seen")
    return f"""WITH snaps AS (SELECT * FROM ({snapshots}){f" WHERE seen_at <= TIMESTAMP '{as_of}'" if known else ""}),
hist AS (SELECT portal, id, min(seen_at) AS first_seen,
    first(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS first_price, last(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS price_eur,
    first(seq ORDER BY seen_at, seq) AS first_seq, last(area ORDER BY seen_at, seq) AS area, last(sqm ORDER BY seen_at, seq) AS sqm, last(site_updated_at ORDER BY seen_at, seq) AS site_updated_at
  FROM snaps GROUP BY portal, id),
dropped AS (SELECT *, round_even((CAST(first_price AS DOUBLE) - price_eur) / first_price * 100e0, 1) + 0e0 AS drop_pct, {days} AS days_on_market FROM hist WHERE price_eur IS NOT NULL),
rows_ AS (SELECT *, CAST(round_even(least(greatest(drop_pct, 0e0) / 20e0, 1e0) * 50e0 + least(days_on_market / 180e0, 1e0) * 50e0, 0) AS BIGINT) AS score,
    CASE WHEN sqm <> 0 THEN CAST(round_even(CAST(price_eur AS DOUBLE) / sqm, 0) AS BIGINT) END AS price_per_sqm FROM dropped),
base AS (SELECT {keys}, avg(price_per_sqm) AS baseline, count(*) AS n_listings FROM rows_ WHERE price_per_sqm <> 0 GROUP BY {keys}),
leads AS (SELECT rows_.*, CAST(round_even(baseline, 0) AS BIGINT) AS area_avg_price_per_sqm, round_even((price_per_sqm - baseline) / baseline * 100e0, 1) + 0e0 AS pct_vs_area_avg
  FROM rows_ LEFT JOIN base ON {" AND ".join(f"rows_.{k} IS NOT DISTINCT FROM base.{k}" for k in keys.split(", "))} AND price_per_sqm <> 0)
{select}"""


METRICS = "SELECT portal, id, price_eur, area, sqm, drop_pct, days_on_market, score, price_per_sqm, area_avg_price_per_sqm, pct_vs_area_avg FROM leads"
RANKED = "SELECT id, score, row_number() OVER (ORDER BY score DESC, first_seen, first_seq, id) AS rank FROM leads"
LISTED = """SELECT strftime(ts, '%Y-%m-%d') AS run_id, user_id AS id, CAST(hour(ts) AS BIGINT) AS page_num, event_id AS pos,
  CAST(round_even(value * 1000, 0) AS BIGINT) AS price_eur, event_type AS title FROM events WHERE round_even(value * 1000, 0) >= 1000"""
LINKS = "SELECT page_id, CAST(p - 1 AS BIGINT) AS pos, hrefs[p] AS href FROM (SELECT page_id, hrefs, unnest(range(1, len(hrefs) + 1)) AS p FROM (SELECT page_id, regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1) AS hrefs FROM pages))"
PREFIX = """WITH p AS (SELECT page_id // 25 AS run_id, page_id % 25 + 1 AS page_num, CAST(len(regexp_extract_all(html, '<a href="/[A-F]')) AS BIGINT) AS links FROM pages),
e AS (SELECT run_id, min(page_num) FILTER (WHERE links = 0) AS last FROM p GROUP BY run_id)
SELECT p.run_id, page_num, links FROM p JOIN e USING (run_id) WHERE last IS NULL OR page_num < last"""
MONTHS = "['януари','февруари','март','април','май','юни','юли','август','септември','октомври','ноември','декември']"
SPACES = " || ".join(f"chr({c})" for c in (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288))


def _deduped(order: str) -> str:
    return f"""WITH l AS ({LISTED}), r AS (SELECT *, row_number() OVER (PARTITION BY run_id, id ORDER BY {order}) AS n,
  first_value(page_num) OVER w AS first_page, first_value(pos) OVER w AS first_pos FROM l WINDOW w AS (PARTITION BY run_id, id ORDER BY page_num, pos))
SELECT run_id, id, page_num, pos, price_eur, title, first_page, first_pos FROM r WHERE n = 1"""


PLACES = "SELECT *, p_brand || '-' || p_partkey // 3000 AS run_id, CAST(p_size % 4 + 1 AS INTEGER) AS page_num, 900 + p_partkey * 37 % 5000 AS price FROM part"
#: What the date of a card tells that is told in one of seven ways.
TOLD = """CASE {n} % 7 WHEN 0 THEN '2026-08-21 09:30:00' WHEN 1 THEN '2026-08-20 09:30:00' WHEN 2 THEN strftime(make_date(2025, {n} % 12 + 1, {n} % 28 + 1), '%Y-%m-%d 00:00:00') WHEN 3 THEN strftime(make_date(2025, {n} % 12 + 1, {n} % 28 + 1), '%Y-%m-%d 00:00:00') END"""
CARDS = f"""WITH p AS ({PLACES}), c AS (SELECT *, ['imot.bg', 'imoti.bg', 'olx.bg', 'bazar.bg', 'alo.bg', 'imoti.net'][p_partkey % 6 + 1] AS portal FROM p),
pos AS (SELECT *, row_number() OVER (PARTITION BY portal, run_id, page_num ORDER BY p_partkey) - 1 AS pos FROM c),
good AS (SELECT *, portal = 'imoti.net' OR price >= 1000 AND NOT (portal = 'imoti.bg' AND p_size % 3 = 0) AND NOT (portal = 'imot.bg' AND p_partkey % 11 IN (3, 5)) AS valid,
  portal = 'imoti.bg' AND p_partkey % 11 = 5 AS inner_only FROM pos),
stops AS (SELECT portal, run_id, min(page_num) AS stop FROM (SELECT portal, run_id, page_num, count(*) FILTER (WHERE valid) AS n, count(*) FILTER (WHERE NOT (portal = 'imoti.bg' AND p_size % 3 = 0)) AS links FROM good GROUP BY ALL)
  WHERE CASE WHEN portal IN ('bazar.bg', 'imoti.bg') THEN n ELSE links END = 0 GROUP BY portal, run_id)
SELECT g.portal, g.run_id, CASE portal WHEN 'imot.bg' THEN 'imot_1a' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') WHEN 'imoti.bg' THEN 'imotibg_' || (100000 + p_partkey) WHEN 'olx.bg' THEN 'olx_' || p_partkey
    WHEN 'bazar.bg' THEN 'bazar_' || p_partkey WHEN 'alo.bg' THEN 'alo_' || (1000000 + p_partkey) ELSE CAST(p_partkey AS VARCHAR) END AS id, page_num,
  CASE portal WHEN 'imot.bg' THEN 'https://www.imot.bg/obiava-1a' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '-x' WHEN 'imoti.bg' THEN 'https://imoti.bg/продажби/мезонет/софия/обява-' || (100000 + p_partkey) || '.htm'
    WHEN 'olx.bg' THEN 'https://www.olx.bg/d/ad/x-ID' || p_partkey || '.html' WHEN 'bazar.bg' THEN 'https://bazar.bg/obiava-' || p_partkey WHEN 'alo.bg' THEN 'https://www.alo.bg/ap-' || (1000000 + p_partkey)
    ELSE 'https://www.imoti.net/en/obiava/prodava-x/' || p_partkey || '/' END AS url,
  CASE portal WHEN 'imot.bg' THEN 'https://cdn.example/' || p_partkey || '.jpg' WHEN 'olx.bg' THEN 'https://cdn.example/' || p_partkey || '.jpg' WHEN 'bazar.bg' THEN 'https://bazar.bg/i/' || p_partkey || '.jpg'
    WHEN 'alo.bg' THEN 'https://www.alo.bg/i/' || p_partkey || '.jpg' END AS photo,
  CAST(NULL AS VARCHAR) AS photos, CAST(NULL AS VARCHAR) AS description, CAST(CASE portal WHEN 'imoti.net' THEN round_even(2 * price / 1.95583e0, 0) ELSE price END AS BIGINT) AS price_eur,
  CAST(CASE WHEN inner_only THEN NULL WHEN portal = 'bazar.bg' THEN NULL WHEN portal = 'imot.bg' THEN round_even(p_size + 0.5e0, 0) WHEN portal = 'alo.bg' THEN round_even(p_size + 0.5e0, 0) ELSE p_size END AS BIGINT) AS sqm,
  CASE WHEN inner_only THEN 'Sofia' WHEN portal = 'imoti.net' THEN NULL WHEN portal = 'alo.bg' THEN 'Люлин ' || (p_size % 9) ELSE p_brand END AS area,
  CASE portal WHEN 'imoti.bg' THEN price || ' EUR, ' || CASE WHEN inner_only THEN 'Sofia' ELSE p_brand END WHEN 'bazar.bg' THEN p_name WHEN 'alo.bg' THEN p_name WHEN 'imoti.net' THEN p_name || ', Sofia, ' || p_brand ELSE p_name || ', ' || p_brand END AS title,
  CASE WHEN portal = 'olx.bg' THEN {TOLD.format(n="p_partkey")} END AS site_updated_at, CAST(page_num * 1000000 + pos AS BIGINT) AS ordinal
FROM good g LEFT JOIN stops USING (portal, run_id) WHERE valid AND (stop IS NULL OR page_num < stop)"""
OFFERS = f"""WITH p AS ({PLACES}), broken AS (SELECT DISTINCT run_id, page_num FROM p WHERE page_num = 2 AND regexp_matches(run_id, '3-[0-9]+$')),
pos AS (SELECT *, row_number() OVER (PARTITION BY run_id, page_num ORDER BY p_partkey) - 1 AS pos, CAST(floor(p_retailprice * 10) AS BIGINT) AS amount, 'https://g1.homes.bg/' AS base FROM p)
SELECT 'homes.bg' AS portal, pos.run_id, 'homes_' || p_partkey AS id, pos.page_num, 'https://www.homes.bg/offer/' || p_partkey AS url, CASE WHEN p_partkey % 3 = 1 THEN base || 'a/' || p_partkey || 'b.jpg' END AS photo,
  CASE p_partkey % 3 WHEN 0 THEN base || 'p/' || p_partkey || 'b.jpg' WHEN 1 THEN base || 'a/' || p_partkey || 'b.jpg' ELSE '' END AS photos, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS description,
  CAST(CASE WHEN p_partkey % 2 = 0 THEN round_even(amount / 1.95583e0, 0) ELSE amount END AS BIGINT) AS price_eur, CAST(p_size AS BIGINT) AS sqm, p_brand AS area, p_name || CASE WHEN p_partkey % 5 = 2 THEN '{HARD}' ELSE '' END || ', ' || p_size || 'm², ' || p_brand || ', София' AS title,
  CAST(pos.page_num * 1000000 + pos AS BIGINT) AS ordinal FROM pos LEFT JOIN broken USING (run_id) WHERE broken.run_id IS NULL OR pos.page_num < broken.page_num"""

LISTED_COLUMNS = "portal, id, page_num, url, photo, photos, description, price_eur, sqm, area, title, site_updated_at, ordinal"
LISTED_ROWS = f"listed AS (SELECT {LISTED_COLUMNS} FROM ({CARDS}) UNION ALL SELECT {LISTED_COLUMNS.replace('site_updated_at', 'NULL')} FROM ({OFFERS}))"
RUNS = f"""WITH {LISTED_ROWS}, runs AS (SELECT TIMESTAMP '2026-08-21 09:30:00' AS seen_at, price_eur AS price, * FROM listed UNION ALL SELECT TIMESTAMP '2026-09-21 09:30:00', CAST(round_even(price_eur * 0.9e0, 0) AS BIGINT), * FROM listed)
SELECT portal, id, seen_at, ordinal AS seq, price AS price_eur, CASE WHEN portal = 'imoti.net' THEN string_split(title, ', ')[3] ELSE area END AS area, sqm, CAST(site_updated_at AS TIMESTAMP) AS site_updated_at FROM runs"""
LEADS = f"""SELECT leads.portal, leads.id, strftime(first_seen, '%Y-%m-%d %H:%M:%S') AS first_seen, first_price, leads.price_eur, url, photo, photos, description, leads.sqm, leads.area, title, more.site_updated_at, drop_pct, days_on_market, score,
  price_per_sqm, area_avg_price_per_sqm, pct_vs_area_avg, CASE WHEN leads.portal = 'imoti.net' THEN first_price || ',' || leads.price_eur END AS price_history,
  row_number() OVER (ORDER BY score DESC, first_seq, leads.portal, leads.id) AS rank FROM leads JOIN (WITH {LISTED_ROWS} SELECT * FROM listed) more ON leads.portal = more.portal AND leads.id = more.id"""
SAID = """CASE p_partkey % 7 WHEN 0 THEN 'ДНЕС' WHEN 1 THEN 'вчера' WHEN 2 THEN 'Обновено на ' || (p_partkey % 28 + 1) || ' ' || MONTHS[p_partkey % 12 + 1] || ' 2025 г.' WHEN 3 THEN 'обновено на  ' || (p_partkey % 28 + 1) || ' ' || upper(MONTHS[p_partkey % 12 + 1]) || ' 2025г'
  WHEN 4 THEN 'Обновено на 30 февруари 2025 г.' WHEN 5 THEN 'Обновено на ' || (p_partkey % 28 + 1) || ' brumaire 2025 г.' ELSE 'нищо' END""".replace("MONTHS", MONTHS)
CLIMBED = f"""WITH p AS ({PLACES}), c AS (SELECT *, ['imot.bg', 'imoti.bg', 'olx.bg', 'bazar.bg', 'alo.bg', 'imoti.net'][p_partkey % 6 + 1] AS portal, p_partkey % 11 AS nth FROM p),
pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY portal, run_id, page_num ORDER BY p_partkey) - 1 AS INTEGER) AS pos FROM c)
SELECT portal, run_id, page_num, pos, CASE portal WHEN 'imot.bg' THEN '1a' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') WHEN 'imoti.bg' THEN CAST(100000 + p_partkey AS VARCHAR) WHEN 'alo.bg' THEN CAST(1000000 + p_partkey AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS key,
  NOT (portal = 'imot.bg' AND nth IN (3, 5)) AS has_card,
  CASE portal WHEN 'imot.bg' THEN CASE WHEN nth NOT IN (3, 5) THEN p_name || ' ' || price || chr(160) || '€ град София, ' || p_brand || ' ' || p_size || ',5 кв.м' END
    WHEN 'imoti.bg' THEN p_name || ' ' || price || ' EUR' || CASE WHEN nth = 5 THEN '' ELSE ' София, ' || p_brand || ' ' || p_size || ' кв.м.' END
    WHEN 'olx.bg' THEN p_name || ' ' || price || ' € гр. София, ' || p_brand || ' - ' || {SAID} || ' ' || p_size || ' кв.м - 9' WHEN 'bazar.bg' THEN p_name || ' ' || price || ' € гр. София, ' || p_brand
    WHEN 'alo.bg' THEN p_name || ' Цена : ' || price || ' € Квадратура: ' || p_size || '.5 кв.м Люлин ' || (p_size % 3) || ' Люлин ' || (p_size % 9) || ', София'
    ELSE 'for sale ' || p_name || ', Sofia, ' || p_brand || ' ' || price || ' € / ' || 2 * price || ' BGN, ' || p_size || ' м 2' END AS card_text
FROM pos WHERE NOT (portal = 'imoti.bg' AND p_size % 3 = 0)"""


ORACLES: dict[str, str] = {
    "lead_metrics": _leads(PARTS, "2002-01-01", METRICS, "area"),
    "leads_as_of": _leads(PARTS, LINES_AS_OF, METRICS, known=True),
    "lead_metrics_events": _leads(EVENTS, EVENTS_AS_OF, METRICS),
    "lead_rank": _leads(EVENTS, EVENTS_AS_OF, RANKED),
    "lead_topk": _leads(EVENTS, EVENTS_AS_OF, f"SELECT * FROM ({RANKED}) WHERE rank <= 100"),
    "price_drop": _leads(EVENTS, EVENTS_AS_OF, "SELECT id, first_price, price_eur, drop_pct FROM leads"),
    "days_on_market": _leads(EVENTS, EVENTS_AS_OF, "SELECT id, first_seen, days_on_market FROM leads"),
    "motivation_score": _leads(PARTS, LINES_AS_OF, "SELECT id, drop_pct, days_on_market, score FROM leads", known=True),
    "days_on_market_site_date": _leads(ORDERS, ORDERS_AS_OF, "SELECT id, site_updated_at, days_on_market, score FROM leads", site=True),
    "price_per_unit": _leads(PARTS, LINES_AS_OF, "SELECT id, price_eur, sqm, price_per_sqm FROM leads", known=True),
    "area_baseline": _leads(PARTS, LINES_AS_OF, "SELECT area, round(baseline, 6) AS baseline, n_listings FROM base", "area", known=True),
    "area_baseline_by_portal": _leads(TYPES, LINES_AS_OF, "SELECT portal, area, round(baseline, 6) AS baseline, n_listings FROM base", known=True),
    "pct_vs_area": _leads(TYPES, LINES_AS_OF, "SELECT portal, id, area, price_per_sqm, area_avg_price_per_sqm, pct_vs_area_avg FROM leads", known=True),
    "price_history_array": f"SELECT id, count(*) AS n_prices, string_agg(CAST(price_eur AS VARCHAR), ',' ORDER BY seen_at, seq) AS price_history FROM ({EVENTS}) WHERE price_eur <> 0 GROUP BY id",
    "history_first_seen": f"SELECT portal, id, min(seen_at) AS first_seen FROM ({EVENTS}) GROUP BY portal, id",
    "history_latest": f"SELECT portal, id, price_eur, area, sqm, seen_at FROM ({EVENTS}) QUALIFY row_number() OVER (PARTITION BY portal, id ORDER BY seen_at DESC, seq DESC) = 1",
    "snapshot_append": f"SELECT CASE WHEN seen_at < TIMESTAMP '2024-01-16' THEN 'run-1' ELSE 'run-2' END AS run_id, id, count(*) AS n_snapshots, min(seen_at) AS first_seen, last(price_eur ORDER BY seen_at, seq) AS price_eur FROM ({EVENTS}) GROUP BY 1, 2",
    "run_counters": f"SELECT count(*) AS n_snapshots, count(DISTINCT id) AS n_listings, count(DISTINCT id) FILTER (WHERE price_eur <> 0) AS n_leads FROM ({EVENTS})",
    "min_price_filter": f"SELECT id, seq, price_eur FROM ({EVENTS}) WHERE price_eur >= 1000",
    "currency_convert": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'BGN' ELSE 'EUR' END AS currency, CAST(round_even(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice / 1.95583e0 ELSE o_totalprice END, 0) AS BIGINT) AS price_eur FROM orders",
    "dedup_first_wins": _deduped("page_num, pos"),
    "dedup_last_page_wins": _deduped("page_num DESC, pos"),
    "pagination_prefix": PREFIX,
    "pagination_prefix_state": PREFIX,
    "page_links": LINKS,
    "page_anchors": LINKS,
    "listing_key_extract": "SELECT page_id, 'demo_' || regexp_extract(url, '/([a-z]{2})/([0-9]+)', 2) AS listing_id, regexp_extract(url, '/([a-z]{2})/([0-9]+)', 1) AS lang FROM pages WHERE regexp_matches(url, '/([a-z]{2})/([0-9]+)')",
    "url_absolutize": f"""WITH l AS (SELECT page_id, pos, CASE pos % 3 WHEN 0 THEN '/' || href WHEN 1 THEN substr(href, 2) ELSE href END AS href FROM ({LINKS}))
SELECT page_id, pos, href, CASE WHEN href LIKE '//%' THEN 'https:' || href WHEN href LIKE '/%' THEN 'https://site.example' || href WHEN href NOT LIKE 'http%' THEN 'https://site.example/' || href ELSE href END AS address FROM l""",
    "card_lines": """WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(13) || chr(160))), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, CAST(p - 1 AS BIGINT) AS pos, ls[p] AS line FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM l)""",
    "unicode_strip": f"SELECT doc_id, trim(text, {SPACES}) AS text FROM documents",
    "unicode_strip_whole": f"SELECT doc_id, trim(text, {SPACES}) AS text FROM documents",
    "embedded_json_scan": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract(props, '$.k') IS NOT NULL",
    "dedup_area_words": """WITH a AS (SELECT p_partkey, concat('w', p_partkey % 3, ' w', p_size % 4, ' w', p_partkey % 5, ' w', p_size % 3) AS area FROM part), w AS (SELECT *, string_split(area, ' ') AS ws FROM a),
l AS (SELECT *, list_max(list_filter(range(1, 5), lambda i: ws[i] = ws[1])) AS last FROM w)
SELECT p_partkey, area, array_to_string(ws[last:], ' ') AS short_area FROM l""",
    "area_from_title": """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_brand ELSE 'Sofia' END AS area FROM part""",
    "area_from_location": "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_brand WHEN 1 THEN 'Sofia' ELSE p_type END AS area FROM part",
    "localized_date_parse": f"SELECT o_orderkey, {TOLD.format(n='o_orderkey')} AS updated_at FROM orders",
    "multi_portal_union": f"SELECT portal, count(*) AS n_snapshots, count(DISTINCT id) AS n_listings, count(sqm) AS n_sized, count(site_updated_at) AS n_dated FROM ({PARTS} UNION ALL {EVENTS} UNION ALL {ORDERS}) GROUP BY portal",
    "container_climb": CLIMBED,
    "portal_leads": _leads(RUNS, "2026-11-29 09:30:00", LEADS, site=True),
    "table_listings": CARDS,
    "embedded_offers": OFFERS,
    "embedded_bad_records": f"SELECT DISTINCT run_id, page_num FROM ({PLACES}) WHERE page_num = 2 AND regexp_matches(run_id, '3-[0-9]+$')",
    "snapshot_round_trip": _leads(EVENTS, EVENTS_AS_OF, RANKED),
    "history_import": f"""SELECT portal, CAST(id AS VARCHAR) AS id, row_number() OVER (PARTITION BY id ORDER BY seen_at, seq) - 1 AS seq, price_eur, last_value(area) OVER (PARTITION BY id ORDER BY seen_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS area,
  strftime(seen_at, '%Y-%m-%d %H:%M:%S') AS seen_at, false AS unreadable FROM ({EVENTS}) UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, true""",
    "history_state": f"""SELECT portal, id, count(*) AS n, min(seen_at) AS first_seen, first(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS first_price,
  last(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS last_price, last(area ORDER BY seen_at, seq) AS area, last(sqm ORDER BY seen_at, seq) AS sqm FROM ({EVENTS}) GROUP BY portal, id""",
    "price_history_state": f"SELECT id, count(*) AS n_prices, string_agg(CAST(price_eur AS VARCHAR), ',' ORDER BY seen_at, seq) AS price_history FROM ({EVENTS}) WHERE price_eur <> 0 GROUP BY id",
    "area_baseline_state": _leads(EVENTS, EVENTS_AS_OF, "SELECT area, round(baseline, 6) AS baseline, n_listings FROM base"),
    "history_bucketed": f"""SELECT portal, id, min(seen_at) AS first_seen, first(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS first_price,
  last(price_eur ORDER BY seen_at, seq) FILTER (WHERE price_eur <> 0) AS last_price, last(area ORDER BY seen_at, seq) AS area, last(sqm ORDER BY seen_at, seq) AS sqm FROM ({EVENTS}) GROUP BY portal, id""",
    "leads_published": _leads(EVENTS, EVENTS_AS_OF, RANKED),
    "landed_crawl_links": f"""SELECT portal, run_id, page_num, count(*) AS links FROM (SELECT *, ['imot.bg', 'imoti.bg', 'olx.bg', 'bazar.bg', 'alo.bg', 'imoti.net'][p_partkey % 6 + 1] AS portal FROM ({PLACES}))
WHERE portal IN ('alo.bg', 'imot.bg') GROUP BY portal, run_id, page_num""",
    "run_report": f"SELECT 'snapshots' AS step, count(*) AS n_rows FROM ({EVENTS}) UNION ALL SELECT 'listings', count(*) FROM ({CARDS}) UNION ALL SELECT 'offers', count(*) FROM ({OFFERS})",
}
