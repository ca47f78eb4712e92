"""URL verdicts from rules, and for the rest from a tree of path templates per host that the rules' pages label.

1. A url is split into host and path. A rule fits its host and all subdomains, where the path starts with the
   rule's; the longest rule that fits decides.
2. The paths of a host form a tree by segment (runs of digits read as ``#``). A node whose children are many and even, by
   the inverse of the chance that two pages go on alike, varies there: its rare children become one wildcard ``*``.
3. Sibling templates, equal but for one segment, are merged into a wildcard when their labelled pages do not tell them
   apart: the chi-square statistic of their shares of blocked pages stays within two standard deviations of its mean.
   That goes from the deepest segment to the first, but only to those in which labelled siblings still differ. Only
   templates of as many segments can become siblings, so of a host those of a depth that has a single labelled one take no part.
4. A template's purity is its share of blocked pages among the labelled ones, smoothed with that of the same
   template on all hosts, which is smoothed with the share of all pages. Pages of templates above ``reject`` are blocked.

Pages are labelled by the rules that fit them. Everything is aggregated to distinct urls, then to nodes and templates, before
anything is joined; all of it is DataFrame expressions.

* Null urls and urls without ``://`` have an empty host and path and are judged by the template of an empty path.
* Two rules of equal length that both fit: the first in the list. Without labelled pages every share is one half,
  which is not above ``reject``. Repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehist.llm.common import checkpointed, quoted

#: A node varies with more than this many effective children; those with a smaller share than 1 / this are rare.
VARIED, RARE = 16, 20
#: Weight of what a purity is smoothed with, in pages.
SMOOTHING = 4


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null and for what has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    shortest_first = sorted(reversed(rules), key=lambda r: len(r.text))  # and of equal ones the first comes last
    for rule in shortest_first:
        own_host = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = own_host & F.startswith(path, F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _templates(urls: DataFrame) -> DataFrame:
    """``host, path`` of distinct urls with their ``template``, an array of segments."""
    segments = F.transform(
        F.filter(F.split("path", "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, "[0-9]+", "#")
    )
    split = urls.select("host", "path", "pages", segments.alias("own"))
    steps = split.select("host", "path", "pages", "own", F.posexplode("own").alias("nth", "child"))
    steps = steps.withColumn("parent", F.array_join(F.slice("own", F.lit(1), F.col("nth")), "/")).drop("own")
    children = steps.groupBy("host", "nth", "parent", "child").agg(F.sum("pages").cast("double").alias("n"))
    nodes = children.groupBy("host", "nth", "parent").agg(F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("even"))
    varied = nodes.where(F.col("all") * F.col("all") > VARIED * F.col("even"))
    wild = children.join(varied, ["host", "nth", "parent"]).where(RARE * F.col("n") < F.col("all"))
    wild = wild.select("host", "nth", "parent", "child", F.lit("*").alias("wild"))
    read = steps.join(wild, ["host", "nth", "parent", "child"], "left").select(
        "host", "path", "nth", F.coalesce("wild", "child").alias("segment")
    )
    told = read.groupBy("host", "path").agg(F.array_sort(F.collect_list(F.struct("nth", "segment"))).alias("parts"))
    told = told.select("host", "path", F.col("parts.segment").alias("template"))
    none = split.where(F.size("own") == 0).select("host", "path", F.array().cast("array<string>").alias("template"))
    return told.unionByName(none)


def _merged(counts: DataFrame, level: int) -> DataFrame:
    """``counts`` (``template, host, now, labelled, blocked``) with segment ``level`` made a wildcard where siblings are alike."""
    now = F.col("now")
    before, after = F.slice(now, 1, level - 1), F.slice(now, level + 1, F.greatest(F.size(now), F.lit(1)))
    deep = F.size(now) >= level
    keyed = counts.where(deep).withColumns({"before": before, "after": after, "segment": F.element_at(now, level)})
    merged = keyed.groupBy("host", "before", "after", "segment").agg(
        F.sum("labelled").alias("n"), F.sum("blocked").alias("b")
    )
    key = ["host", "before", "after"]
    families = merged.groupBy(*key).agg(
        F.sum("n").alias("fn"),
        F.sum("b").alias("fb"),
        F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("kinds"),
        F.sum(F.when(F.col("n") > 0, F.col("b") * F.col("b") / F.col("n")).otherwise(F.lit(0.0))).alias("squares"),
    )
    # The statistic, in terms of the sums: (sum of b^2/n - B^2/N) / (p (1 - p)).
    p = F.col("fb") / F.col("fn")
    spread = F.col("squares") - F.col("fb") * F.col("fb") / F.col("fn")
    freedom = F.col("kinds") - 1
    pure = (F.col("fb") == 0) | (F.col("fb") == F.col("fn"))
    alike = pure | (spread <= p * (1 - p) * (freedom + 2 * F.sqrt(2.0 * freedom)))
    families = families.where((F.col("kinds") >= 2) & alike).select(*key, F.lit("*").alias("wild"))
    joined = keyed.join(families, key, "left")
    segment = F.array(F.coalesce("wild", "segment"))
    out = joined.withColumn("now", F.concat("before", segment, "after")).select(*counts.columns)
    return out.unionByName(counts.where(~deep))


def _deepest(counts: DataFrame, above: int | None) -> int:
    """The deepest segment, above the one given, in which labelled siblings differ; 0 if there is none."""
    now = F.col("now")
    each = counts.where("labelled > 0").select("host", "now", F.explode(F.sequence(F.lit(1), F.size(now))).alias("level"))
    each = each.where(F.lit(True) if above is None else F.col("level") < above)
    around = [F.slice(now, F.lit(1), F.col("level") - 1), F.slice(now, F.col("level") + 1, F.size(now))]
    siblings = each.groupBy("host", "level", F.xxhash64(*around).alias("around")).agg(
        (F.min(F.element_at(now, F.col("level"))) != F.max(F.element_at(now, F.col("level")))).alias("differ")
    )
    return siblings.where("differ").agg(F.max("level")).first()[0] or 0


def _all_merged(counts: DataFrame) -> DataFrame:
    """``counts`` with the wildcards of all levels; a round for each level that has anything to merge."""
    depth = F.size("now")
    shared = counts.where("labelled > 0").groupBy("host", depth.alias("depth")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = counts.withColumn("depth", F.when(depth > 0, depth)).join(shared, ["host", "depth"], "left")
    keyed = checkpointed(keyed.select(*counts.columns, F.col("n").isNotNull().alias("live")))
    live, rest = (keyed.where(c).drop("live") for c in ("live", "NOT live"))
    level = _deepest(live, None)
    while level:
        live = checkpointed(_merged(live, level))
        level = _deepest(live, level)
    return live.unionByName(rest)


def judged(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    reject: float = 0.5,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity``; ``purity`` is rounded to 9 places."""
    host, path = split_url(F.col(quoted(url_column)).cast("string"))
    pages = pages.select(F.col(quoted(id_column)).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    urls = pages.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
    urls = checkpointed(urls.select("*", rule.alias("rule"), verdict.alias("label")))
    told = checkpointed(urls.join(_templates(urls), ["host", "path"]))

    labelled = F.when(F.col("label").isNotNull(), F.col("pages")).otherwise(0)
    blocked = F.when(F.col("label") == "block", F.col("pages")).otherwise(0)
    counts = told.groupBy("host", "template").agg(F.sum(labelled).cast("double").alias("labelled"), F.sum(blocked).cast("double").alias("blocked"))
    counts = _all_merged(counts.withColumn("now", F.col("template")))

    everything = counts.agg(F.sum("labelled"), F.sum("blocked")).first()
    share = ((everything[1] or 0.0) + 1) / ((everything[0] or 0.0) + 2)
    own = counts.groupBy("host", "now").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b"))
    anywhere = own.groupBy("now").agg(F.sum("n").alias("an"), F.sum("b").alias("ab"))
    wide = (F.col("ab") + SMOOTHING * share) / (F.col("an") + SMOOTHING)
    pure = own.join(anywhere, "now").select(
        "host", "now", ((F.col("b") + SMOOTHING * wide) / (F.col("n") + SMOOTHING)).alias("purity")
    )
    named = counts.join(pure, ["host", "now"]).select(
        "host", "template", F.concat(F.lit("/"), F.array_join("now", "/")).alias("merged"), F.round("purity", 9).alias("purity")
    )
    verdicts = told.join(named, ["host", "template"]).select(
        "host",
        "path",
        "rule",
        F.coalesce("label", F.when(F.col("purity") > reject, "block").otherwise("allow")).alias("verdict"),
        F.col("merged").alias("template"),
        "purity",
    )
    return pages.join(verdicts, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template", "purity")
