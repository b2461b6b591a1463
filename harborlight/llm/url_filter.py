"""URL filter: rules first, then a path-template tree per host, judged by smoothed labelled purity.

Rules (host, path, verdict) decide the urls they fit and, by that, label them. For the others, the urls of each host form a
tree of path templates, as deep as their paths. A segment with a digit, or longer than `LONG` characters, is a wildcard. A labelled child is
merged with its siblings into the wildcard unless the labels speak against it: unless one share of blocked labels for each is likelier than
one share for all by a ratio above `RATIO` (twice its logarithm). A child without labels joins the wildcard only on evidence of its own, as one
of more than `FANOUT` siblings with less than `SHARE` of their urls, which marks a variable segment; else it stays a branch of its own.

A branch expects what its siblings say, each labelled one with one vote, whatever its number of urls (those of a variable segment with one
vote a labelled url, for each stands for a sibling), smoothed with `VOTES` votes at
what its parent expects; a host expects the overall share. A template is rejected if its share of blocked labels, smoothed with
`PRIOR` labels at what it expects, reaches `REJECT`. So a branch without labels below a rejected one is rejected, and one beside
two rejected ones is not. All steps group and join counts of (host, template), never lists of urls.

`PRIOR` and `REJECT` are set by `held_out`: the labels of one part of the labelled urls, or of whole first segments of hosts, are
hidden, and their templates judge them.

Defined results: null urls and urls without '://' have empty host and path, fit no rule and form one template; without
labels all templates are allowed; equal rows count each; columns besides page_id and url are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborlight.session import stored

#: Fixed rules: host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Levels that the query's SQL writes out; it tells the templates of paths up to that long.
DEPTH = 3
LONG, FANOUT, SHARE = 32, 50, 0.05
#: Twice the logarithm of the likelihood ratio above which a child is a branch of its own (two standard errors).
RATIO = 4.0
PRIOR, VOTES, REJECT = 2.0, 6.0, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    given = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(given, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(given, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Longest fitting rule as host and path, and its verdict; both null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def general_path(path: Column) -> Column:
    """'/' and segment for each segment of the path, with '*' for variable ones; '' without any."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    general = F.transform(parts, lambda s: F.when(s.rlike("[0-9]") | (F.length(s) > LONG), F.lit("*")).otherwise(s))
    return F.when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(general, "/"))).otherwise(F.lit(""))


def log_likelihood(blocked: Column, labels: Column) -> Column:
    """Logarithm of the likelihood of the labels at their own share; 0 without any."""

    def part(n: Column) -> Column:
        return F.when(n > 0, n * F.ln(n / labels)).otherwise(0.0)

    return part(blocked) + part(labels - blocked)


def grow(open_: DataFrame, level: int) -> DataFrame:
    """Rows (host, way, n, labels, blocked, template of `level` segments, expected) with the template grown by a segment, what it expects, and whether it is final.

    A path alone in its node has nothing to merge with, so the rest of its template is its own.
    """
    node, sums = ["host", "template", "expected"], ("n", "labels", "blocked", "ways")
    parts = F.split("way", "/")
    rows = open_.withColumns({"s": F.get(parts, F.lit(level + 1)), "ways": F.lit(1)})
    child = rows.groupBy(*node, "s").agg(*[F.sum(c).alias(c) for c in sums])
    vote = F.when(2 * F.col("blocked") > F.col("labels"), 1.0).when(2 * F.col("blocked") == F.col("labels"), 0.5).otherwise(0.0)
    labelled, variable = F.col("labels") > 0, F.col("s").eqNullSafe("*")  # each url of a variable segment is a sibling of its own
    voters = F.when(variable, F.col("labels")).otherwise(labelled.cast("long"))
    votes = F.when(variable, F.col("blocked").cast("double")).when(labelled, vote).otherwise(0.0)
    parent = child.groupBy(*node).agg(F.count("s").alias("kids"), F.sum(voters).alias("voters"), F.sum(votes).alias("votes"), *[F.sum(c).alias("p_" + c) for c in sums])
    met = child.join(parent, node)
    rare = (F.col("labels") == 0) & (F.col("kids") > FANOUT) & (F.col("n") < SHARE * F.col("p_n"))
    left, blocked = F.col("p_labels") - F.col("labels"), F.col("p_blocked") - F.col("blocked")
    ratio = 2 * (log_likelihood(F.col("blocked"), F.col("labels")) + log_likelihood(blocked, left) - log_likelihood(F.col("p_blocked"), F.col("p_labels")))
    alike = (F.col("labels") > 0) & (F.col("kids") > 1) & (ratio <= RATIO)
    expects = F.when(F.col("kids") > 1, (F.col("votes") + VOTES * F.col("expected")) / (F.col("voters") + VOTES)).otherwise(F.col("expected"))
    names = met.select("host", "template", "s", F.when(rare | alike, F.lit("*")).otherwise(F.col("s")).alias("t"), expects.alias("e"), (F.col("p_ways") == 1).alias("alone"))
    keys = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("host", "template", "s")]
    rest = F.slice(parts, F.lit(level + 2), F.size(parts))
    grown = F.when(F.col("b.s").isNull(), F.lit("")).when(F.col("alone"), F.concat(F.lit("/"), F.array_join(rest, "/"))).otherwise(F.concat(F.lit("/"), F.col("t")))
    both = rows.alias("a").join(names.alias("b"), keys)
    return both.select("a.host", "way", "n", "labels", "blocked", F.concat("a.template", grown).alias("template"), F.col("b.e").alias("expected"), (F.col("b.s").isNull() | F.col("alone")).alias("final"))


def templates(counts: DataFrame, share: float) -> DataFrame:
    """counts (host, way, n, labels, blocked) with the template each way belongs to and the share it expects, grown level by level while any open way has a further segment."""
    columns = ["host", "way", "n", "labels", "blocked", "template", "expected"]
    open_, done, level = counts.withColumns({"template": F.lit(""), "expected": F.lit(float(share))}).select(columns), [], 0
    while (open_.agg(F.max(F.size(F.split("way", "/")) - 1)).first()[0] or 0) > level:
        grown = stored(grow(open_, level), "url-level")
        done.append(grown.filter("final").select(columns))
        open_, level = grown.filter("not final").select(columns), level + 1
    for part in done:
        open_ = open_.unionAll(part)
    return open_


def read_rules(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple = RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, _verdict (the rule's, else null), way (the path with wildcards for variable segments)."""
    host, path = parse(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": name, "_verdict": verdict, "way": general_path(F.col("path"))})


def judge_ways(rows: DataFrame, label: Column) -> DataFrame:
    """host, way, template, purity for rows (host, way) labelled 'block', 'allow' or null."""
    counts = rows.groupBy("host", "way").agg(F.count("*").alias("n"), F.count(label).alias("labels"), F.count_if(label == "block").alias("blocked"))
    counts = stored(counts, "url-counts")
    total = counts.agg(F.sum("labels").alias("l"), F.sum("blocked").alias("b")).first()
    named = templates(counts, (total["b"] or 0) / total["l"] if total["l"] else 0.0)
    purity = (F.sum("blocked") + PRIOR * F.max("expected")) / (F.sum("labels") + PRIOR)  # all ways of a template expect the same
    by_template = named.groupBy("host", "template").agg(purity.alias("purity"))
    return named.select("host", "way", "template").join(by_template, ["host", "template"])


def _said(purity: str) -> Column:
    return F.when(F.col(purity) >= REJECT, F.lit("block")).otherwise(F.lit("allow"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple = RULES) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, template (the host's path template) and purity (its smoothed blocked share)."""
    rows = read_rules(pages, page_id, url, rules)
    both = rows.alias("r").join(judge_ways(rows, F.col("_verdict")).alias("j"), ["host", "way"], "left")
    return both.select("r.page_id", "host", "r.path", "r.rule", F.coalesce("r._verdict", _said("j.purity")).alias("verdict"), "j.template", "j.purity")


def held_out(pages: DataFrame, part: int = 0, parts: int = 5, whole_branches: bool = False, url: str = "url", rules: tuple = RULES) -> DataFrame:
    """truth, judged, urls: labelled urls of one part, their labels hidden, against the verdict of their templates.

    Urls are dealt to parts by hash; with whole_branches by that of host and first segment, so that no url of the branch is known.
    """
    rows = read_rules(pages, url, url, rules)
    own = F.xxhash64("host", F.get(F.split("way", "/"), F.lit(1))) if whole_branches else F.xxhash64("page_id")
    rows = rows.withColumn("_hidden", F.pmod(own, F.lit(parts)) == part)
    judged = judge_ways(rows, F.when(~F.col("_hidden"), F.col("_verdict")))
    both = rows.filter(F.col("_hidden") & F.col("_verdict").isNotNull()).join(judged, ["host", "way"])
    return both.groupBy(F.col("_verdict").alias("truth"), _said("purity").alias("judged")).agg(F.count("*").alias("urls"))
