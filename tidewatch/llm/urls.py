"""URL filters by a path-template tree.

Hosts and paths come from the URL text; rules (host, path, verdict) decide where they fit. All
other URLs are judged by a tree that each host grows from its own paths, to their full depth:

* Segments are generalised: runs of digits, hexadecimal ids and slugs of several words become
  wildcards. A path's end is a segment of its own, $.
* Of the labelled branches below one prefix those whose share of blocked URLs does not differ
  significantly from that of all labelled URLs there (two-proportion test) merge, <~>. Branches
  without labels merge apart from them, <?>. How many branches there are plays no part.
* Purity, the share of blocked among the labelled URLs of a template, is smoothed along the tree
  from the host down: the parent's purity counts as ``weight`` more labels, and each URL without a
  label as a ``doubt`` of one at the ``base`` rate. So a few unlabelled pages beside many blocked
  ones are rejected with them, and a large section about which the labels say nothing is not.
  Templates above ``threshold`` are blocked.

The labels are the rules' own verdicts. Distinct templates with their counts are the only thing
the tree is built of: URLs are aggregated to them before the first shuffle, and a host of a
third of all URLs is few rows. Built of column expressions only.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii, shielded, sized


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules in force.
RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)
WEIGHT, BASE, DOUBT, Z, THRESHOLD = 2.0, 0.2, 0.05, 1.96, 0.75


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r)):  # later ones go before
        inside = (host == rule.host) | host.endswith("." + rule.host)
        fits = inside & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """The segments, generalised, as an array; empty ones are none."""
    parts = F.array_remove(F.split(path, "/", -1), "")

    def shape(part: Column) -> Column:
        plain = lower_ascii(part)
        hexadecimal = plain.rlike("^[0-9a-f-]{8,}$") & plain.rlike("[0-9]")
        numbered = F.regexp_replace(plain, "[0-9]+", "<n>")
        slug = plain.rlike("^[^-_]+([-_][^-_]+){2,}$")
        return F.when(hexadecimal, "<id>").when(slug, "<slug>").otherwise(numbered)

    return F.transform(parts, shape)


class Smoothing(NamedTuple):
    weight: float = WEIGHT
    base: float = BASE
    doubt: float = DOUBT

    def purity(self, blocked, labelled, unlabelled, parent) -> Column:
        return (blocked + self.weight * parent + unlabelled * F.lit(self.doubt * self.base)) / (
            labelled + self.weight + unlabelled * F.lit(self.doubt)
        )


def grow(shapes: DataFrame, *, z: float = Z, **smoothing: float) -> DataFrame:
    """Shapes (host, segs, labelled, blocked, unlabelled) with ``template`` and ``purity``.

    From branching to branching: what all shapes below a merged prefix have in common is one branch
    at each level, so there is nothing to compare and purity follows from their counts. Where they
    part, segments are merged within the prefix. Shapes whose path has ended leave. So there are
    as many rounds as a path has places at which others of its host turn off.
    """
    given = Smoothing(**smoothing)
    counts = {"blocked": "b", "labelled": "l", "unlabelled": "u"}
    roots = shapes.groupBy("host").agg(*[F.sum(c).alias(n) for c, n in counts.items()]).select(
        F.col("host"), given.purity(F.col("b"), F.col("l"), F.col("u"), F.lit(given.base)).alias("purity")
    )
    tree = cut(shapes.join(roots, "host").withColumns({"prefix": F.lit(""), "at": F.lit(0)}))
    done = []
    while not tree.isEmpty():
        sums = [F.sum(c).alias(f"p{n}") for c, n in counts.items()]
        rest = F.slice("segs", F.col("at") + 1, F.greatest(F.size("segs") - F.col("at"), F.lit(0)))
        groups = tree.groupBy("host", "prefix", "at").agg(
            *sums, F.min(rest).alias("low"), F.max(rest).alias("high")
        )
        # The first place at which the least and the greatest rest differ: all agree before it.
        shorter = F.least(F.size("low"), F.size("high"))
        differ = F.filter(
            F.sequence(F.lit(0), shorter), lambda k: ~F.get("low", k).eqNullSafe(F.get("high", k))
        )
        steps = F.coalesce(F.get(differ, F.lit(0)), F.size("low"))
        groups = groups.select("host", "prefix", "pb", "pl", "pu", steps.alias("steps"))
        steps, parts = F.col("steps"), F.col("at") + F.col("steps")
        common = F.when(F.col("pl") > 0, "/<~>").otherwise("/<?>")
        through = F.aggregate(
            F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
            F.col("purity"),
            lambda p, _: given.purity(F.col("pb"), F.col("pl"), F.col("pu"), p),
        )
        placed = tree.join(groups, ["host", "prefix"]).select(
            "host", "segs", *counts, "pb", "pl", parts.alias("parts"), through.alias("above"),
            F.concat("prefix", F.repeat(common, steps)).alias("stem"),
            F.coalesce(F.get("segs", parts), F.lit("$")).alias("level"),
        )
        child = placed.groupBy("host", "stem", "level", "above", "pb", "pl").agg(
            *[F.sum(c).alias(f"c{n}") for c, n in counts.items()]
        )
        rate = F.col("pb") / F.nullif("pl", F.lit(0.0))
        spread = F.sqrt(rate * (1 - rate) / F.nullif("cl", F.lit(0.0)))
        differs = F.abs(F.col("cb") / F.nullif("cl", F.lit(0.0)) - rate) > z * spread
        # Where all labels agree there is no difference to be found.
        own = F.coalesce(differs & (rate > 0) & (rate < 1), F.lit(False))
        node = (
            F.when(F.col("level") == "$", F.lit("$")).when(own, F.col("level"))
            .when(F.col("cl") > 0, F.lit("<~>")).otherwise(F.lit("<?>"))
        )
        named = child.withColumn("node", node)
        merged = named.groupBy("host", "stem", "node").agg(
            *[F.sum(f"c{n}").alias(f"n{n}") for n in counts.values()]
        )
        here = given.purity(F.col("nb"), F.col("nl"), F.col("nu"), F.col("above"))
        nodes = named.join(merged, ["host", "stem", "node"]).select(
            "host", "stem", "level", "node", here.alias("purity")
        )
        # Every round reads the one before several times.
        now = cut(placed.join(nodes, ["host", "stem", "level"]).select(
            "host", "segs", *counts, "purity", F.concat("stem", F.lit("/"), "node").alias("prefix"),
            (F.col("parts") + 1).alias("at"),
        ))
        ended = F.endswith("prefix", F.lit("/$"))
        done.append(now.where(ended).select("host", "segs", F.col("prefix").alias("template"), "purity"))
        tree = now.where(~ended)
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole


def judge(
    pages: DataFrame, *, url: str = "url", rules=RULES, threshold: float = THRESHOLD, **growth
) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule``, ``template``, ``purity`` and ``verdict``.

    A null URL, or one without ``://``, has empty host and path and is judged as such: no rule
    fits it, and its template has no labels. Paths count to their end, however long. Repeated rows
    are judged alike and each count. Input columns with the names above, in any case, are replaced,
    all others kept. An empty table has no rows.
    """
    inner, at = shielded(pages)
    text = F.col(at[url])
    placed = inner.withColumns({"host": host_of(text), "path": path_of(text)})
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    shaped = placed.withColumns({"rule": name, "by_rule": verdict, "segs": segments(F.col("path"))})
    labelled = F.count("by_rule").cast("double")
    shapes = cut(
        shaped.groupBy("host", "segs").agg(
            labelled.alias("labelled"),
            F.count_if(F.col("by_rule") == "block").cast("double").alias("blocked"),
            (F.count("*") - labelled).alias("unlabelled"),
        )
    )
    if shapes.isEmpty():
        tree = shapes.selectExpr("host", "segs", "'' AS template", "0.0D AS purity")
    else:
        tree = cut(grow(shapes, **growth))
    tree = sized(tree.withColumnRenamed("host", "_host").withColumnRenamed("segs", "_segs"))
    joined = shaped.join(
        tree, (F.col("host") == F.col("_host")) & (F.col("segs") == F.col("_segs"))
    )
    found = F.when(F.col("purity") > threshold, "block").otherwise("allow")
    judged = {n: F.col(n) for n in ("host", "path", "rule", "template", "purity")}
    judged["verdict"] = F.coalesce("by_rule", found)
    kept = [F.col(c).alias(n) for n, c in at.items() if n.lower() not in judged]
    return joined.select(*kept, *[value.alias(n) for n, value in judged.items()])
