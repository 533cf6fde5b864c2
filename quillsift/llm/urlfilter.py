"""URL filter: a path-template tree per host, with DataFrame functions only.

Method: a path is cut into its segments, and the tree grows level by level: three levels everywhere, and below
them under each template of which some path goes on, until none does. Segments with a digit are
variable and become the wildcard ``*``; so does any segment under a parent that has many children with
few addresses each. Addresses that fit a rule are the labelled ones. Sibling templates with labels are
ordered by their share of blocked addresses, and neighbours that a two-proportion test can't tell apart
are merged. A template is rejected if its purity, the blocked share of its merged branch smoothed towards
its parent, host, the whole table and one half, reaches ``REJECT``.

Pages are first counted by (host, template), which collapses the variable segments before the shuffle;
all tree work is on these counts, written between its steps, and the verdicts come back by a join on them.

Defined results: a null address, or one without ``://``, has an empty host and path and falls under no
rule; empty segments are skipped; repeated rows count each; without labelled addresses nothing is
rejected; other columns of ``pages`` pass through ``judged``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsift.session import written

RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MANY_CHILDREN = 20
FEW_ADDRESSES = 5.0
PRIOR_WEIGHT = 4.0
Z = 1.96
REJECT = 0.7
LEAST_LEVELS = 3


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]], part: int) -> Column:
    """Text (part 0) or verdict (part 1) of the longest rule that fits; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = rule[0].partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(rule[part])) if out is None else out.when(fits, F.lit(rule[part]))
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None).cast("string"))


def _variable(segment: Column) -> Column:
    return F.when(segment.rlike("[0-9]"), F.lit("*")).otherwise(segment)


def segments(path: Column) -> Column:
    """All segments; digits make a segment a wildcard."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _variable)


def generalised(shapes: DataFrame) -> DataFrame:
    """``shapes`` with ``template``: the segments of each level, those after parents with many small children as wildcard.

    A path that ends where others of its template go on has an empty segment there. Written after each level
    below the first ones.
    """
    deepest = shapes.agg(F.max(F.size("segs"))).first()[0] or 0
    out = shapes.withColumn("template", F.array().cast("array<string>"))
    for level in range(1, max(LEAST_LEVELS, deepest) + 1):
        segment = F.coalesce(F.try_element_at("segs", F.lit(level)), F.lit(""))
        grows = F.size("template") == level - 1
        parents = ["host", "template"]
        children = out.where(grows).groupBy(*parents, segment.alias("segment")).agg(
            F.sum("pages").alias("n"), F.max(F.size("segs")).alias("deepest")
        )
        wide = children.groupBy(*parents).agg(F.count("*").alias("children"), F.sum("n").alias("n"), F.max("deepest").alias("deepest"))
        many = (F.col("children") > MANY_CHILDREN) & (F.col("n") / F.col("children") < FEW_ADDRESSES)
        wide = wide.where(many if level <= LEAST_LEVELS else many | (F.col("deepest") >= level)).select(*parents, many.alias("wide"), (F.col("deepest") >= level).alias("further"))
        own = F.when(F.col("wide") & (segment != ""), F.lit("*")).otherwise(segment)
        more = grows if level <= LEAST_LEVELS else grows & F.col("further")
        template = F.when(more, F.concat("template", F.array(own))).otherwise(F.col("template"))
        out = out.join(wide, parents, "left").withColumn("template", template).drop("wide", "further")
        if level > LEAST_LEVELS:
            out = written(out, "level")
    return out


def _smoothed(blocked: str, labelled: str, prior: Column) -> Column:
    return (F.col(blocked) + PRIOR_WEIGHT * prior) / (F.col(labelled) + PRIOR_WEIGHT)


def _branches(nodes: DataFrame, parents: list[str], own: str) -> DataFrame:
    """(parents, own, branch_n, branch_b): siblings with labels, merged with neighbours of like share."""
    rate = F.col("blocked") / F.col("labelled")
    order = Window.partitionBy(*parents).orderBy(rate, own)
    pooled = (F.col("blocked") + F.col("b0")) / (F.col("labelled") + F.col("n0"))
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / F.col("n0")))
    apart = F.when(F.col("n0").isNull(), 0).when(rate - F.col("b0") / F.col("n0") > Z * spread, 1).otherwise(0)
    known = nodes.where("labelled > 0").withColumn("n0", F.lag("labelled").over(order)).withColumn("b0", F.lag("blocked").over(order))
    known = known.withColumn("apart", apart).withColumn("branch", F.sum("apart").over(order))
    pools = known.groupBy(*parents, "branch").agg(F.sum("labelled").alias("branch_n"), F.sum("blocked").alias("branch_b"))
    return known.select(*parents, own, "branch").join(pools, [*parents, "branch"]).drop("branch")


def purities(shapes: DataFrame) -> DataFrame:
    """(host, template, purity) from counts of labelled and blocked addresses, from the root of the tree down."""
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    trees = shapes.groupBy("host", "template").agg(*sums)
    whole = trees.agg(F.sum("labelled").alias("all_n"), F.sum("blocked").alias("all_b"))
    prior = _smoothed("all_b", "all_n", F.lit(0.5))
    hosts = trees.groupBy("host").agg(*sums).join(F.broadcast(whole))
    known = hosts.select("host", F.array().cast("array<string>").alias("above"), _smoothed("blocked", "labelled", prior).alias("purity"))
    deepest = shapes.agg(F.max(F.size("template"))).first()[0] or 0
    found = None
    for level in range(1, max(LEAST_LEVELS, deepest) + 1):
        parents, own = ["host", "above"], "own"
        above, segment = F.slice("template", 1, level - 1).alias("above"), F.try_element_at("template", F.lit(level)).alias(own)
        nodes = trees.where(F.size("template") >= level).groupBy("host", above, segment).agg(*sums)
        merged = nodes.select(*parents, own).join(_branches(nodes, parents, own), [*parents, own], "left")
        merged = merged.fillna(0, ["branch_n", "branch_b"]).join(known, parents)
        known = merged.select("host", F.concat("above", F.array(own)).alias("above"), _smoothed("branch_b", "branch_n", F.col("purity")).alias("purity"))
        if level >= LEAST_LEVELS:
            if deepest > LEAST_LEVELS:
                known = written(known, "purity")
            found = known if found is None else found.unionByName(known)
    return trees.select("host", "template").join(found.withColumnRenamed("above", "template"), ["host", "template"])


def judged(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """``pages`` in a struct ``page``, with host, path, rule, template, purity and verdict."""
    named = pages.select(F.struct(*pages.columns).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    named = named.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules, 0))
    named = named.withColumn("label", rule_for(F.col("host"), F.col("path"), rules, 1))
    named = named.withColumn("segs", segments(F.col("path")))
    shapes = named.groupBy("host", "segs").agg(
        F.count("*").alias("pages"), F.count("label").alias("labelled"), F.count(F.when(F.col("label") == "block", 1)).alias("blocked")
    )
    shaped = written(generalised(written(shapes, "shapes")), "templates")
    verdicts = shaped.select("host", "segs", "template").join(purities(shaped), ["host", "template"])
    shown = F.concat_ws("/", "host", F.filter("template", lambda t: t != ""))
    verdicts = written(verdicts.select("host", "segs", shown.alias("template"), "purity"), "verdicts")
    own = F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return named.join(verdicts, ["host", "segs"]).select(
        "page", "host", "path", "rule", F.coalesce("label", own).alias("verdict"), "template", "purity"
    )


def allowed(pages: DataFrame, rules: list[tuple[str, str]] = RULES, url: str = "url") -> DataFrame:
    """``pages`` without those whose verdict is block."""
    return judged(pages, rules, url).where("verdict = 'allow'").select("page.*")
