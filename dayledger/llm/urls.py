"""Operator 8: URL filters by rules and, beside them, a tree of path templates.

A rule names a host, with all its subdomains, and the beginning of a path; the longest that fits
decides. What the rules decide serves as labels for the rest. Per host a tree of path templates is
grown level by level: segments that look like numbers, hashes or dates become wildcards at once;
where a place has many different segments, the rare ones become one wildcard, but for those whose
labels differ from the other rare ones'; branches of one place whose labels agree within chance, and
below which paths look alike, are merged. Below ``DEPTH`` levels a place is only looked into where it
has labels of both kinds. A URL is rejected if its template's share of blocked labels, smoothed
towards the shares of the templates above it, is ``REJECT`` or more.

Counts come from one aggregation by host and path form; hot hosts are only sums there, and no
step brings a host's URLs into one task. Null URLs and those without ``://`` have an empty host and
path, and are judged like a host of that name; so are empty ones. Very long URLs are read whole; what
is deeper than ``DEEPEST`` segments is one wildcard. Of rows with equal keys each is judged on its own;
of rules of equal length the one that sorts last holds. An empty table gives an empty result. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import lower_ascii, table, written

ALLOW, BLOCK = "allow", "block"
#: Levels of the tree, the host not counted, and those that it may have where labels still differ.
DEPTH, DEEPEST = 5, 32
#: Different segments of a place from which rare ones (less than 1 / WIDE of it) are merged.
WIDE = 40
#: Labels that the share above counts for; share from which a template is rejected.
STRENGTH, REJECT = 4.0, 0.7
#: Deviations that a branch's share may be from that of its like.
DEVIATIONS = 2.0


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


# ---------------------------------------------------------------- URLs and rules


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Of the text after the first ``://``, up to ``/``, ``?`` or ``#``, and from there on."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return lower_ascii(host), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The rule that fits, as a struct whose ``rule`` is null if none does."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    # From the shortest to the longest, so that the longest is asked first in the end.
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(
            path, F.lit(r.path)
        )
        found = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        best = F.when(fits, found).otherwise(best)
    return best


# ---------------------------------------------------------------- the tree


def _form(segment: Column) -> Column:
    """A segment with what varies by its look replaced; the ending of a file name stays."""
    name = F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z0-9]{1,5})?$", 1)
    ending = F.regexp_extract(segment, r"^(.*?)(\.[A-Za-z0-9]{1,5})?$", 2)
    look = (
        F.when(name.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), "<date>")
        .when(name.rlike(r"^[0-9]+$"), "<number>")
        .when(name.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{8,}$"), "<hash>")
        .when(name.rlike(r"[0-9]{3,}"), F.regexp_replace(name, "[0-9]+", "<n>"))
        .otherwise(name)
    )
    return F.concat(look, ending)


def path_form(path: Column, depth: int = DEEPEST) -> Column:
    """Segments with their look; what lies deeper is one segment."""
    parts = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), _form)
    cut = F.concat(F.slice(parts, 1, depth), F.array(F.lit("<rest>")))
    return F.when(F.size(parts) > depth, cut).otherwise(parts)


def _generalised(forms: DataFrame, level: int, wide: int) -> DataFrame:
    """``forms`` with the segment of this level kept, or a wildcard where it is one of many."""
    here = F.get("form", F.lit(level))
    each = forms.where(here.isNotNull()).groupBy("host", "prefix", here.alias("segment"))
    counts = ("n", "allowed", "blocked")
    children = each.agg(*(F.sum(c).alias(c) for c in counts))
    places = children.groupBy("host", "prefix").agg(
        F.count(F.lit(1)).alias("width"), F.sum("n").alias("all")
    )
    few = children.join(places, ["host", "prefix"]).where(
        (F.col("width") > wide) & (F.col("n") * wide < F.col("all"))
    )
    pools = few.groupBy("host", "prefix").agg(
        *(F.sum(c).alias(f"all_{c}") for c in ("allowed", "blocked"))
    )
    rare = (
        few.join(pools, ["host", "prefix"])
        .where(_agrees())
        .select("host", "prefix", "segment", F.lit("<any>").alias("wild"))
    )
    return forms.withColumn("segment", here).join(
        rare, ["host", "prefix", "segment"], "left"
    ).withColumn("segment", F.coalesce("wild", "segment")).drop("wild")


def _agrees() -> Column:
    """Whether a branch's labels are those of its like, within chance; without labels they are."""
    labels = F.col("allowed") + F.col("blocked")
    share = (F.col("all_blocked") + 0.5) / (F.col("all_allowed") + F.col("all_blocked") + 1)
    gap = F.abs(F.col("blocked") - labels * share)
    return gap <= DEVIATIONS * F.sqrt(labels * share * (1 - share)) + 0.5


def _merged(forms: DataFrame, level: int) -> DataFrame:
    """``forms`` with branches of one place merged, if they look alike and their labels agree."""
    below = F.array_join(F.slice("form", level + 2, F.size("form")), "/")
    branch = ["host", "prefix", "segment"]
    known = forms.where(F.col("segment").isNotNull()).withColumn("below", below)
    shapes = known.groupBy(*branch, "below").agg(
        *(F.sum(c).alias(c) for c in ("n", "allowed", "blocked"))
    )
    branches = shapes.groupBy(*branch).agg(
        F.max_by("below", F.struct("n", "below")).alias("like"),
        *(F.sum(c).alias(c) for c in ("n", "allowed", "blocked")),
    )
    kinds = branches.groupBy("host", "prefix", "like").agg(
        F.count(F.lit(1)).alias("members"),
        *(F.sum(c).alias(f"all_{c}") for c in ("allowed", "blocked")),
    )
    labels = F.col("allowed") + F.col("blocked")
    same = (
        branches.join(kinds, ["host", "prefix", "like"])
        .where((F.col("members") > 1) & _agrees() & (labels > 0))
        .select(*branch, F.concat(F.lit("<like "), "like", F.lit(">")).alias("group"))
    )
    return (
        forms.join(same, branch, "left")
        .withColumn("segment", F.coalesce("group", "segment"))
        .drop("group")
    )


def templates(
    judged: DataFrame, depth: int = DEPTH, wide: int = WIDE, deepest: int = DEEPEST
) -> DataFrame:
    """``host, form, template, blocked_share`` from ``host, form, verdict`` (null: no label)."""
    one = F.lit(1).cast("long")
    forms = written(
        judged.groupBy("host", "form").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("verdict") == ALLOW, one).otherwise(0)).alias("allowed"),
            F.sum(F.when(F.col("verdict") == BLOCK, one).otherwise(0)).alias("blocked"),
        )
    )
    forms = forms.withColumn("prefix", F.lit(""))
    totals = forms.agg(F.sum("allowed"), F.sum("blocked")).first()
    allowed, blocked = totals[0] or 0, totals[1] or 0
    prior = (blocked + 0.5) / (allowed + blocked + 1)
    shares = forms.groupBy("host").agg(_smoothed(F.lit(prior)).alias("share"), _mixed().alias("open"))
    forms = written(forms.join(shares, "host"))
    leaves = []
    for level in range(deepest + 1):
        # A path that has ended keeps its prefix, and so its share; so does a deep place of one kind.
        open_ = (F.col("open") | F.lit(level < depth)) & (F.size("form") > level)
        leaves.append(forms.where(~open_))
        forms = forms.where(open_)
        if forms.isEmpty():
            break
        forms = _merged(_generalised(forms, level, wide), level)
        longer = F.concat_ws("/", F.col("prefix"), F.col("segment"))
        forms = forms.withColumn("prefix", longer).drop("segment")
        own = forms.groupBy("host", "prefix").agg(
            _smoothed(F.max("share")).alias("share"), _mixed().alias("open")
        )
        forms = written(forms.drop("share", "open").join(own, ["host", "prefix"]))
    leaves.append(forms)
    names = ["host", "form", F.col("prefix").alias("template"), F.col("share").alias("blocked_share")]
    return reduce(DataFrame.union, [leaf.select(*names) for leaf in leaves])


def _mixed() -> Column:
    return (F.sum("allowed") > 0) & (F.sum("blocked") > 0)


def _smoothed(above: Column) -> Column:
    labels = F.sum("allowed") + F.sum("blocked")
    return (F.sum("blocked") + STRENGTH * above) / (labels + STRENGTH)


# ---------------------------------------------------------------- judging


def judge(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    reject: float = REJECT,
    depth: int = DEPTH,
    wide: int = WIDE,
    deepest: int = DEEPEST,
) -> DataFrame:
    """``key, host, path, rule, verdict, template, blocked_share`` for each row."""
    host, path = host_and_path(F.col(url))
    parsed = df.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    decided = longest_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.select("*", decided.alias("decided"), path_form(F.col("path"), deepest).alias("form"))
    judged = judged.select(
        "key", "host", "path", "form",
        F.col("decided.rule").alias("rule"), F.col("decided.verdict").alias("verdict"),
    )
    known = templates(judged.select("host", "form", "verdict"), depth, wide, deepest)
    # One form may hold a third of the rows; adaptive execution splits it.
    learnt = F.when(F.col("blocked_share") >= reject, BLOCK).otherwise(ALLOW)
    return judged.join(known, ["host", "form"]).select(
        F.col("key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", learnt).alias("verdict"),
        "template",
        "blocked_share",
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))
