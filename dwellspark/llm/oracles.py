"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from .quality import BASE, PUNCTUATION, RULES as QUALITY_RULES, STOP_WORDS
from .urlfilter import MIN_PAGES, PURITY, RULES, WEIGHT, Z

CHAT = r"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, CASE role WHEN 'user' THEN '[INST] ' WHEN 'assistant' THEN '<s> ' ELSE '<<' || regexp_replace(role, '([\\<>\[])', '\\\1', 'g') || '>> ' END AS opening,
    CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN ' </s>' ELSE ' <</>>' END AS closing FROM t),
f AS (SELECT *, opening || CASE WHEN contains(text, closing) OR regexp_matches(text, '\\[\\\[<>]') THEN replace(replace(text, '\', '\\'), closing, ' \' || substr(closing, 2)) ELSE text END || closing AS formatted FROM m)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, formatted)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, formatted) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(formatted)) AS BIGINT) AS formatted_chars FROM f GROUP BY conv_id"""

TOP_K = """WITH v AS (SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64e0 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.id AS query_id, c.id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.id <> c.id WHERE q.id % 20 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 20"""

NEAR = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) < 2 THEN ws ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS items FROM w),
u AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM u a JOIN u b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)), both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles, coalesce(least(b, doc_id), doc_id) AS component_id, coalesce(least(b, doc_id), doc_id) = doc_id AS kept FROM s LEFT JOIN low ON doc_id = a"""


def _url_filter() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits.format(h=h, p=p)} THEN '{h}{p}'" for _, h, p in rules)
    verdict = " ".join(f"WHEN {fits.format(h=h, p=p)} THEN '{v}'" for v, h, p in rules)
    out = [
        """p AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)""",
        """h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p)""",
        """n AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h)""",
        f"""r AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM n)""",
        """c AS (SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (WHERE ruled = 'block') AS blocked FROM r GROUP BY host, path)""",
        r"""t0 AS (SELECT *, list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(s, '^([*\\])', '\\\1')) AS segs FROM c)""",
        f"""t(k, host, path, n, labelled, blocked, segs, parts, node, rest) AS (SELECT 0, host, path, n, labelled, blocked, segs, CAST([] AS VARCHAR[]), host, false FROM t0 UNION ALL
  SELECT k + 1, host, path, n, labelled, blocked, segs, CASE WHEN pages >= {MIN_PAGES} THEN list_append(parts, segs[k + 1]) WHEN wide >= {MIN_PAGES} THEN list_append(parts, '*')
    ELSE list_concat(parts, list_transform(range(len(segs) - k), lambda x: '*')) END, CASE WHEN pages >= {MIN_PAGES} THEN child ELSE node || '/*' END, pages < {MIN_PAGES} AND wide < {MIN_PAGES}
  FROM (SELECT *, coalesce(sum(n) FILTER (WHERE pages < {MIN_PAGES}) OVER (PARTITION BY node), 0) AS wide
    FROM (SELECT *, node || '/' || segs[k + 1] AS child, sum(n) OVER (PARTITION BY node || '/' || segs[k + 1]) AS pages FROM t WHERE len(segs) > k AND NOT rest)))""",
    ]
    name = "host || '/' || array_to_string({}, '/')".format
    wild = "list_transform(parts, lambda s, i: CASE WHEN i = k THEN '*' ELSE s END)"
    out += [
        f"nodes AS (SELECT host, path, parts, labelled, blocked, {name('parts')} AS node FROM t WHERE rest OR len(segs) = k)",
        "o AS (SELECT host, parts, node, sum(labelled) AS labelled, sum(blocked) AS blocked FROM nodes GROUP BY host, parts, node)",
        "total AS (SELECT (CAST(coalesce(sum(blocked), 0) AS DOUBLE) + 1) / (coalesce(sum(labelled), 0) + 2) AS overall FROM o)",
        f"hs AS (SELECT host, (CAST(sum(blocked) AS DOUBLE) + {WEIGHT} * any_value(overall)) / (sum(labelled) + {WEIGHT}) AS host_share FROM o, total GROUP BY host)",
        f"""m(k, host, parts, node, labelled, blocked, host_share) AS (SELECT (SELECT max(len(parts)) FROM o), host, parts, node, labelled, blocked, host_share FROM o JOIN hs USING (host) UNION ALL
  SELECT k - 1, host, CASE WHEN wild IS NOT NULL AND l > 0 AND gl > l AND abs(b - l * share) <= {Z} * sqrt(l * share * (1 - share)) THEN {wild} ELSE parts END, node, labelled, blocked, host_share
  FROM (SELECT *, (gb + {WEIGHT} * host_share) / (gl + {WEIGHT}) AS share
    FROM (SELECT *, CAST(sum(labelled) OVER (PARTITION BY tmpl) AS DOUBLE) AS l, CAST(sum(blocked) OVER (PARTITION BY tmpl) AS DOUBLE) AS b, CAST(sum(labelled) OVER (PARTITION BY wild) AS DOUBLE) AS gl, CAST(sum(blocked) OVER (PARTITION BY wild) AS DOUBLE) AS gb
      FROM (SELECT *, {name('parts')} AS tmpl, CASE WHEN len(parts) >= k THEN {name(wild)} END AS wild FROM m WHERE k > 0))))""",
    ]
    out += [
        f"tp AS (SELECT *, {name('parts')} AS template FROM m WHERE k = 0)",
        "mg AS (SELECT template, sum(labelled) AS tl, CAST(sum(blocked) AS DOUBLE) AS tb FROM tp GROUP BY template)",
        f"pu AS (SELECT node, template, tl, (tb + {WEIGHT} * host_share) / (tl + {WEIGHT}) AS purity FROM tp JOIN mg USING (template))",
    ]
    out = [cte if "UNION ALL" in cte else cte.replace(" AS (", " AS MATERIALIZED (", 1) for cte in out]
    return "WITH RECURSIVE " + ",\n".join(out) + f"\nSELECT page_id, r.host, r.path, rule, coalesce(ruled, CASE WHEN tl > 0 AND purity >= {PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 9) AS purity FROM r JOIN nodes USING (host, path) JOIN pu USING (node)"


#: CRC-32 of a decimal number, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
  lambda acc, b: list_reduce(range(8), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(acc, b)), CAST(4294967295 AS BIGINT)))"""

RUNS = rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, {CRC32.format("doc_id")} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
e AS (SELECT *, len(ws) AS n, CASE WHEN h % 10 = 0 AND len(ws) > 0 THEN (h // 10) % len(ws) END AS a, h // 10 AS g FROM d),
f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
w AS (SELECT k, n, i, CASE WHEN i >= a THEN ws[1 + a + (i - a) % p] ELSE ws[1 + i] END AS word FROM (SELECT *, unnest(range(n)) AS i FROM f)),
s AS (SELECT x.k, y.i - x.i AS q, x.i AS i FROM w x JOIN w y ON x.k = y.k AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
t AS (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM s),
u AS (SELECT k, q, min(i) AS start, count(*) + q AS length FROM t GROUP BY k, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT k, start, length, min(q) AS period FROM u GROUP BY k, start, length),
b AS (SELECT k, count(*) AS n_runs, min([-length, start, period]) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY k),
g AS (SELECT DISTINCT k, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT k, string_agg(word, ' ' ORDER BY i) AS kept FROM (SELECT * FROM w ANTI JOIN g USING (k, i)) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best[2] AS start, -best[1] AS length, best[3] AS period, -1000 * best[1] // best[3] AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM d LEFT JOIN b USING (k) LEFT JOIN c USING (k)"""


DIVERGENCE = r"""WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT k, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 30),
c AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (SELECT DISTINCT lang, source FROM d), v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY lang, source), nl AS (SELECT lang, CAST(sum(n) AS BIGINT) AS nl FROM n GROUP BY lang),
p AS (SELECT grp.lang, grp.source, kept.term, coalesce(c, 0) AS c, 1 + 1000000000 * (coalesce(c, 0) + 5) // (coalesce(n, 0) + 5 * v) AS p
  FROM grp JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN n ON grp.lang = n.lang AND grp.source = n.source LEFT JOIN c ON c.lang = grp.lang AND c.source = grp.source AND c.term = kept.term),
q AS (SELECT lang, term, 1 + 1000000000 * (sum(c) + 5) // (any_value(nl) + 5 * any_value(v)) AS q FROM c JOIN nl USING (lang) JOIN v USING (lang) GROUP BY lang, term),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
own AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM own))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""


def _quality() -> str:
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    stops = ", ".join(sorted({quoted(w) for group in STOP_WORDS for w in group.split()}))
    fails = lambda r: f"1000 * {r.over} {'<' if r.least else '>'} {r.limit} * {r.under}"
    any_of = lambda rules: " OR ".join(map(fails, rules))
    names = ", ".join(f"CASE WHEN {fails(r)} THEN '{r.name}' END" for r in (*BASE, *QUALITY_RULES))
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return rf"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT k, unnest(range(1, len(ws) - 1)) AS i, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS words FROM w WHERE len(ws) > 2),
t AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, words) AS n FROM g) WHERE n > 1),
c AS (SELECT k, count(DISTINCT place) AS covered FROM (SELECT k, unnest([i, i + 1, i + 2]) AS place FROM t) GROUP BY k),
m AS (SELECT doc_id, 1 AS one, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered, 0) AS n_repeat_words, len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered,
  length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS n_letters, length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS n_capitals,
  len(list_filter(ws, lambda x: lower(trim(x, {quoted(PUNCTUATION)})) IN ({stops}))) AS n_stop_words, len(list_filter(ls, lambda x: regexp_matches(trim(x, {spaces}), '^[*•\-]'))) AS n_bullets,
  len(list_filter(ls, lambda x: regexp_matches(rtrim(x, {spaces}), '(\.\.\.|…)$'))) AS n_ellipses FROM w LEFT JOIN c USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {any_of(BASE)} AS base_failed, NOT ({any_of((*BASE, *QUALITY_RULES))}) AS kept, array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ',') AS failed FROM m"""


ORACLES = {"op11_periodic_runs": RUNS, "op12_source_divergence": DIVERGENCE, "op13_quality_rules": _quality(), "op1_chat_format": CHAT, "op2_maxscore": TOP_K, "op6_minhash": NEAR, "op10_url_filter": _url_filter()}
