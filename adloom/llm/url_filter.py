"""URL verdicts: host and path rules first, then a tree of path templates with labelled purity."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import LOWER, UPPER, stored

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits `host` and its subdomains where the path starts with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeParams:
    """`fan_out` distinct values make a segment variable, unless one holds `heavy` of its siblings' rows. Branches are similar if their
    children overlap by `overlap` and their labels differ by less than `z` standard errors. `smoothing` is the weight of the prior in rows.
    Templates with a bad share over `reject` are rejected."""

    fan_out: int = 20
    heavy: float = 0.05
    overlap: float = 0.8
    z: float = 2.0
    smoothing: float = 10.0
    reject: float = 0.5


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The fitting rule of the greatest length as struct(size, text, verdict), or null. The list is configuration, so it is a literal."""
    if not rules:
        return F.lit(None).cast("struct<size:int,text:string,verdict:string>")

    def fit(r: Rule) -> Column:
        ok = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        return F.when(ok, F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict")))

    return F.array_max(F.array(*[fit(r) for r in rules]))


def shape_of(path: Column) -> Column:
    """The path with what is variable by its looks replaced: UUIDs, long hexadecimal strings with a digit, numbers."""
    uuid = F.regexp_replace(path, r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", "{id}")
    hexa = F.regexp_replace(uuid, r"(?i)\b(?=[a-f]{0,31}[0-9])[0-9a-f]{16,}\b", "{id}")
    return F.regexp_replace(hexa, r"[0-9]+", "{n}")


def _shared(lo: Column, hi: Column) -> Column:
    """How many segments the least and the greatest of some paths have in common: as many as all of them."""
    m = F.least(F.size(lo), F.size(hi))
    differs = F.array_position(F.zip_with(F.slice(lo, F.lit(1), m), F.slice(hi, F.lit(1), m), lambda x, y: x == y), False).cast("int")
    return F.when(differs == 0, m).otherwise(differs - 1)


def _merged(branches: DataFrame, params: TreeParams) -> DataFrame:
    """host, node, value, merge for the branches (host, node, value, child, n, labelled, bad) of one level.

    A branch becomes a wildcard if its segment is variable, or if it is like its siblings taken together: what comes next is distributed alike, and its
    labels are as bad as theirs. Branches that end here have nothing next to compare; those merge by their labels or not at all. Everything
    is compared with the pooled siblings, never branch by branch.
    """
    level, node = ["host", "node"], ["host", "node", "value"]
    sums = (F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    by_child = stored(branches.groupBy(*node, "child").agg(*sums), "url-children")
    by_value = by_child.groupBy(*node).agg(*sums, F.max(F.col("child") != "").alias("inner"))
    pooled = by_value.groupBy(*level).agg(F.sum("n").alias("all_n"), F.sum("labelled").alias("all_labelled"), F.sum("bad").alias("all_bad"), F.count("value").alias("values"))
    pooled_child = by_child.groupBy(*level, "child").agg(F.sum("n").alias("child_n"))
    overlap = (
        by_child.select(*node, "child", "n").join(pooled_child, [*level, "child"])
        .join(by_value.select(*node, F.col("n").alias("value_n")), node).join(pooled.select(*level, "all_n"), level)
        .groupBy(*node).agg(F.sum(F.least(F.col("n") / F.col("value_n"), F.col("child_n") / F.col("all_n"))).alias("overlap"))
    )
    rate = F.try_divide(F.col("all_bad"), F.col("all_labelled"))
    error = F.sqrt(F.col("labelled") * rate * (1 - rate))
    alike = F.coalesce(F.abs(F.col("bad") - F.col("labelled") * rate) <= params.z * error, F.lit(True))
    told = F.col("inner") | ((F.col("labelled") > 0) & (F.col("all_labelled") > F.col("labelled")))
    variable = (F.col("values") >= params.fan_out) & (F.col("n") < params.heavy * F.col("all_n"))
    merge = (F.col("values") > 1) & (variable | (told & alike & (F.col("overlap") >= params.overlap)))
    return by_value.join(pooled, level).join(overlap, node).select(*node, merge.alias("merge"))


def _grown(shapes: DataFrame, params: TreeParams) -> DataFrame:
    """`shapes` with their templates, grown from the root: what was merged is one node on the next level, so wildcards go on below wildcards.

    Each round first takes all that the shapes of a node have in common at once, then one segment in which they differ. Shapes that are alone in their
    node, or equal from there on, are done. So there are as many rounds as branchings on a path, not as many as segments.
    """
    live = shapes.select("*", F.xxhash64("host").alias("node"), F.split("shape", "/").alias("rest"), F.array().cast("array<string>").alias("made"))
    done = []
    while True:
        span = live.groupBy("host", "node").agg(F.min("rest").alias("lo"), F.max("rest").alias("hi"))
        # both sides of this join are exchanged, so that adaptive execution can split a hot host
        met = live.join(span, ["host", "node"]).withColumn("k", _shared(F.col("lo"), F.col("hi")))
        whole = F.col("k") >= F.size("rest")
        met = met.withColumns({"made": F.concat("made", F.slice("rest", F.lit(1), F.col("k"))), "rest": F.slice("rest", F.col("k") + 1, F.size("rest")), "whole": whole}).drop("lo", "hi", "k")
        met = stored(met, "url-level")
        done.append(met.where("whole").select(*shapes.columns, F.array_join("made", "/").alias("template")))
        branches = met.where("NOT whole").withColumns({"value": F.get("rest", F.lit(0)), "child": F.coalesce(F.get("rest", F.lit(1)), F.lit(""))})
        if branches.isEmpty():
            break
        decided = _merged(branches, params)
        text = F.when(F.col("merge"), "*").otherwise(F.col("value"))
        moved = branches.join(decided, ["host", "node", "value"]).withColumn("text", text)
        live = stored(moved.select(
            *shapes.columns, F.xxhash64("node", "text").alias("node"), F.slice("rest", F.lit(2), F.size("rest")).alias("rest"), F.array_append("made", F.col("text")).alias("made")
        ), "url-live")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def templates(shapes: DataFrame, params: TreeParams = TreeParams()) -> DataFrame:
    """host, shape, template, bad_share: `shapes` has host, shape, n, labelled, bad, one row per host and shape. The share of bad labels of a template is
    smoothed by that of its host, and this by that of all."""
    named = stored(_grown(shapes, params), "url-templates")

    def smooth(prior: Column, a: str, b: str) -> Column:
        return (F.col(a) + params.smoothing * prior) / (F.col(b) + params.smoothing)

    total = named.agg(F.try_divide(F.sum("bad"), F.sum("labelled")).alias("rate")).first()["rate"] or 0.0
    hosts = named.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("labelled").alias("host_labelled"))
    scored = named.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled")).join(hosts, "host")
    purity = smooth(smooth(F.lit(float(total)), "host_bad", "host_labelled"), "bad", "labelled")
    return named.select("host", "shape", "template").join(scored.select("host", "template", purity.alias("bad_share")), ["host", "template"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule], params: TreeParams = TreeParams()) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share for every row of `pages` (page_id, url, bad: 1, 0 or null for unlabelled).

    Pages are first counted by host and path shape, which combines within tasks, so a hot host is a few shapes; only these enter the
    tree. Paths of any length are judged whole. Null urls and those without `://` have empty host and path. Without labels every template is allowed. Other columns are ignored;
    repeated rows are judged alike; an empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"), F.col("bad").cast("long").alias("bad"))
    rows = parts.withColumn("shape", shape_of(F.col("path")))
    shapes = stored(rows.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "url-shapes")
    found = stored(templates(shapes, params), "url-verdicts")
    # both sides of this join are exchanged, so that adaptive execution can split a hot host
    judged = rows.drop("bad").join(found, ["host", "shape"], "left").withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    method = F.when(F.col("bad_share") > params.reject, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", F.col("fit.text").alias("rule"), F.coalesce("fit.verdict", method).alias("verdict"), "template", "bad_share")
