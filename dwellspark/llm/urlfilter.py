"""URL filtering by path templates: fixed rules first, then a path-template tree learned from the rules' own verdicts.

Pages are counted by host and path first; all that follows works on these counts and is joined back to the pages once.

Each host has a tree of path segments, grown from the host down as deep as its paths go.  A segment that at least
MIN_PAGES pages share is a branch of its own; the others of a node are taken for values of a variable and become the
wildcard ``*``, below which the tree goes on.  What lies below a node of fewer than MIN_PAGES pages is all variable: a
wildcard for each segment.
Then branches are merged from the deepest segment up: templates that differ in that segment alone become one, with a
wildcard there, if both they and the others have pages that a rule labels and their rate of blocked pages lies within Z
standard deviations of the group's.  A template's purity is the smoothed share of blocked pages among those that a rule
labels, drawn towards its host's share and that towards the share of all; a template with labelled pages is rejected
from PURITY on.  One without any has its host's share for a purity, but nothing speaks against it and it is allowed.

Only DataFrame functions are used.  Tables meet by plain equi-joins on one string, so a host with most pages is split
by adaptive execution, and counts are aggregated before every exchange.  A round goes down
all branches to the next variable, however deep: pages are counted by every beginning of what is left of their paths,
named by its digest, since a beginning that MIN_PAGES pages share has shorter ones that they share.  So rounds grow with
the variables of a path and not with its segments, and each reads only the paths that still go on.  Merging looks only
at levels where labelled templates differ; levels at which nothing merges write nothing.  Rounds are cut by written tables, not checkpoints: a checkpoint keeps
the constraints of its plan, and those double with every level.

Defined cases: a null url, or one without ``://``, has empty host and path (and so the template of the empty host);
segments of no characters don't count; a segment that begins with ``*`` or a backslash is told from the wildcard by a
backslash before it; repeated pages count each; null ids are kept; without any labelled page the shares are one half
and what no rule fits is allowed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: (verdict, host, path): the rule holds for the host, its subdomains, and paths that start with the path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_PAGES, Z, WEIGHT, PURITY = 5, 2.0, 4.0, 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)
    known = F.coalesce(at, F.lit(0)) > 0
    return F.when(known, F.translate(raw, _UPPER, _LOWER)).otherwise(F.lit("")), F.when(known, path).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def with_templates(paths: DataFrame) -> DataFrame:
    """host, path, n, labelled, blocked and ``parts``, the segments with wildcards for variables, of counted paths."""
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, r"^([*\\])", r"\\$1"))
    rows, done = stored(paths.withColumns({"segments": segments, "parts": F.array().cast("array<string>"), "node": F.col("host")})), []
    while True:
        going = rows.where(F.size("segments") > 0)
        done.append(rows.where(F.size("segments") == 0).drop("segments", "node"))
        if going.isEmpty():
            return reduce(DataFrame.unionByName, done)
        prefixes = F.transform(F.sequence(F.lit(1), F.size("segments")), lambda i: _digest(F.concat_ws("/", "node", F.array_join(F.slice("segments", F.lit(1), i), "/"))))
        each = going.select("n", prefixes.alias("prefixes")).select("n", F.element_at("prefixes", -1).alias("_path"), F.posexplode("prefixes").alias("at", "prefix"))
        fixed = each.groupBy(F.col("prefix").alias("_fixed")).agg(F.sum("n").alias("pages")).where(F.col("pages") >= MIN_PAGES).select("_fixed")
        shared = each.join(fixed, F.col("prefix") == F.col("_fixed")).groupBy("_path").agg((F.max("at") + 1).alias("_shared"))
        whole = _digest(F.concat_ws("/", "node", F.array_join("segments", "/")))
        step = going.join(shared, whole == F.col("_path"), "left").withColumn("_shared", F.coalesce("_shared", F.lit(0)))
        own = F.slice("segments", F.lit(1), F.col("_shared"))
        step = step.withColumns({
            "parts": F.concat("parts", own), "node": F.concat_ws("/", "node", F.when(F.col("_shared") > 0, F.array_join(own, "/"))),
            "segments": F.slice("segments", F.col("_shared") + 1, F.size("segments")),
        }).select(*rows.columns)
        wide = step.where(F.size("segments") > 0).groupBy(F.col("node").alias("_wide")).agg(F.sum("n").alias("pages")).where(F.col("pages") >= MIN_PAGES).select("_wide")
        step = stored(step.join(wide, (F.col("node") == F.col("_wide")) & (F.size("segments") > 0), "left"))
        rest = F.concat("parts", F.array_repeat(F.lit("*"), F.size("segments")))
        done.append(step.where("_wide is null").withColumn("parts", rest).drop("segments", "node", "_wide"))
        variable = {"parts": F.array_append("parts", F.lit("*")), "node": F.concat("node", F.lit("/*")), "segments": F.slice("segments", F.lit(2), F.size("segments"))}
        rows = step.where("_wide is not null").withColumns(variable).drop("_wide")


def _smoothed(blocked: Column, labelled: Column, towards: Column) -> Column:
    return (blocked + WEIGHT * towards) / (labelled + WEIGHT)


def _template(parts: Column) -> Column:
    return F.concat_ws("/", "host", F.array_join(parts, "/"))


def _wild(level: int) -> Column:
    return F.transform("parts", lambda s, i: F.when(i == level - 1, F.lit("*")).otherwise(s))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _levels(own: DataFrame) -> list[int]:
    """The levels, deepest first, at which labelled templates of one length and one beginning differ; nothing merges at others."""
    before = F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.struct(i.alias("level"), _digest(F.array_join(F.slice("parts", F.lit(1), i - 1), "/")).alias("before"), F.get("parts", i - 1).alias("part")))
    each = own.where((F.col("labelled") > 0) & (F.size("parts") > 0)).select("host", F.size("parts").alias("size"), F.inline(before))
    several = each.groupBy("host", "size", "level", "before").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return sorted((r["level"] for r in several.select("level").distinct().collect()), reverse=True)


def merged_templates(nodes: DataFrame) -> DataFrame:
    """(node, parts, host_share) of every node of (host, parts, labelled, blocked), with the parts of its merged template."""
    own = stored(nodes.groupBy("host", "parts").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")))
    total = own.agg(F.coalesce(F.sum("labelled"), F.lit(0)).alias("l"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("b")).first()
    overall = F.lit((total["b"] + 1) / (total["l"] + 2))
    hosts = own.groupBy(F.col("host").alias("_host")).agg(_smoothed(F.sum("blocked"), F.sum("labelled"), overall).alias("host_share"))
    own = stored(own.join(hosts, F.col("host") == F.col("_host")).select("host", _template(F.col("parts")).alias("node"), "parts", "labelled", "blocked", "host_share"))
    for level in _levels(own):
        wild = _wild(level)
        named = own.withColumns({"_template": _template(F.col("parts")), "_wild": F.when(F.size("parts") >= level, _template(wild))})
        each = named.where("_wild is not null and labelled > 0").groupBy("_template", "_wild").agg(F.sum("labelled").alias("l"), F.sum("blocked").alias("b"), F.max("host_share").alias("host_share"))
        group = each.groupBy(F.col("_wild").alias("_of")).agg(F.sum("l").alias("gl"), F.sum("b").alias("gb"))
        share = _smoothed(F.col("gb"), F.col("gl"), F.col("host_share"))
        near = F.abs(F.col("b") - F.col("l") * share) <= Z * F.sqrt(F.col("l") * share * (1 - share))
        joining = each.join(group, F.col("_wild") == F.col("_of")).where((F.col("gl") > F.col("l")) & near).select(F.col("_template").alias("_joining"))
        if joining.isEmpty():
            continue
        changed = named.join(joining, F.col("_template") == F.col("_joining"), "left")
        own = stored(changed.withColumn("parts", F.when(F.col("_joining").isNotNull(), wild).otherwise(F.col("parts"))).select(*own.columns))
    return own


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity of every page."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict}).withColumn("block", (F.col("ruled") == "block").cast("int"))
    counts = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.count("block").alias("labelled"), F.coalesce(F.sum("block"), F.lit(0)).alias("blocked"))
    nodes = stored(with_templates(counts).withColumn("node", _template(F.col("parts"))))
    own = merged_templates(nodes).withColumn("template", _template(F.col("parts")))
    merged = own.groupBy(F.col("template").alias("_of")).agg(F.sum("labelled").alias("tl"), F.sum("blocked").alias("tb"))
    purity = _smoothed(F.col("tb"), F.col("tl"), F.col("host_share"))
    told = own.join(merged, F.col("template") == F.col("_of")).select(F.col("node").alias("_node"), "template", purity.alias("purity"), ((F.col("tl") > 0) & (purity >= PURITY)).alias("reject"))
    of_path = nodes.join(told, F.col("node") == F.col("_node")).select(F.concat("host", "path").alias("_url"), "template", "purity", "reject")
    judged = rows.join(of_path, F.concat("host", "path") == F.col("_url"))
    by_method = F.when(F.col("reject"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"), "template", "purity")
