"""URL verdicts by rules and, where none fits, by a tree of path templates.

Each host has a tree of path segments. Where the urls of a node rarely share a child, the children vary by page: they
become a wildcard that keeps only a file ending, as do numbers and keys anywhere. Sibling branches whose labelled shares
do not differ statistically are merged. A template is blocked if its purity, the smoothed share of blocked urls, is
high. The urls that a rule decides are the labelled ones.

A branch with few labels, or none, falls back along the tree: what the merged branch has on its host, then the same
template on other hosts, then the parent branch in the same way, up to the host, other hosts and the share of all hosts.
Other hosts count once each, whatever their number of urls.

Everything is grouped and joined by Spark; no host or template is gathered in one task. There is one pass for each
level at which two urls still meet, whatever the depth.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from powerflow.operators.grouping import fact_join
from powerflow.session import shared_table, written

# (host, path, verdict); a rule fits its host and all subdomains
Rule = tuple[str, str, str]

MIN_VARIETY = 0.2  # children vary if there are so many of them for each url,
COMMON_URLS = 32.0  # with as many more urls that add no child, so a few urls do not make a wildcard
PRIOR_WEIGHT = 10.0  # urls that the share a branch falls back to counts as, and hosts that the parent counts as
BLOCK_PURITY = 0.9
SAME_Z = 1.96  # two shares closer than so many standard errors are one
SHARE_UNIT = 1 << 20  # shares are summed in whole parts of it, so that the order of rows does not show
# numbers and long hexadecimal keys vary by page even where a host shows few of them
NUMBERED = r"^/([0-9]+|[0-9a-fA-F-]{16,})(\.[A-Za-z][A-Za-z0-9]{0,4})?$"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased and path; both empty without ``://``, NULL urls among them."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or NULL. Rules are configuration."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        found = F.when(
            fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _wildcard(segment: Column) -> Column:
    """What a varying segment keeps: its file ending. The end of a folder's own path stays."""
    ending = F.regexp_extract(segment, r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", 1)
    return F.when(segment == "/", segment).otherwise(F.concat(F.lit("/*"), ending))


def _numbered(segment: Column) -> Column:
    return F.when(F.rlike(segment, F.lit(NUMBERED)), _wildcard(segment)).otherwise(segment)


def path_templates(urls: DataFrame) -> DataFrame:
    """Add ``steps``, the template's segments, to rows of (host, path, allowed, blocked): distinct urls.

    A url that is alone at its node keeps the rest of its path but for numbers and keys: nothing tells whether
    it varies.
    """
    rows = urls.select(
        "host", "path", "allowed", "blocked", F.lit("").alias("node"),
        F.array().cast("array<string>").alias("steps"),
        F.regexp_extract_all("path", F.lit("(/[^/]*)"), F.lit(1)).alias("rest"),
    )
    ended = []
    with ExitStack() as levels:
        while True:
            rows = written(rows, "url-level") if not ended else levels.enter_context(shared_table(rows, "url-level"))
            ended.append(rows.filter(F.size("rest") == 0).select("host", "path", "allowed", "blocked", "steps"))
            rows = rows.filter(F.size("rest") > 0)
            if rows.isEmpty():
                break
            segment = F.get("rest", F.lit(0))
            children = rows.groupBy("host", "node", segment.alias("segment")).agg(F.count("*").alias("urls"))
            n_urls = F.sum("urls")
            nodes = children.groupBy("host", "node").agg(
                (F.count("*") >= MIN_VARIETY * (n_urls + COMMON_URLS)).alias("varies"), (n_urls == 1).alias("alone")
            )
            step = F.when(F.col("varies"), _wildcard(segment)).otherwise(_numbered(segment))
            rows = fact_join(rows, nodes, ["host", "node"], "inner").select(
                "host", "path", "allowed", "blocked", F.concat("node", step).alias("node"),
                F.concat("steps", F.when(F.col("alone"), F.transform("rest", _numbered)).otherwise(F.array(step))).alias("steps"),
                F.when(F.col("alone"), F.array().cast("array<string>")).otherwise(F.expr("slice(rest, 2, size(rest))")).alias("rest"),
            )
        found = reduce(DataFrame.union, ended)
        return written(found.withColumn("template", F.array_join("steps", "")), "url-templates")


def tree_nodes(templates: DataFrame) -> DataFrame:
    """A row for each branch of each host: its path from the root, its parent's, and labels below it.

    ``shares`` and ``hosts`` are what other hosts have at the same path: the sum of their shares of blocked urls, each
    host counted once, and the number of hosts with labels.
    """
    leaves = templates.groupBy("host", "steps").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    at = F.explode(F.sequence(F.lit(0), F.size("steps"))).alias("depth")
    branches = leaves.select("host", "steps", "allowed", "blocked", at).select(
        "host", F.expr("array_join(slice(steps, 1, depth), '')").alias("branch"),
        F.when(F.col("depth") > 0, F.expr("array_join(slice(steps, 1, depth - 1), '')")).alias("parent"),
        "allowed", "blocked",
    )
    nodes = branches.groupBy("host", "branch", "parent").agg(
        F.sum("blocked").alias("blocked"), F.sum(F.col("allowed") + F.col("blocked")).alias("labelled")
    )
    share = F.round(F.col("blocked") / F.when(F.col("labelled") > 0, F.col("labelled")) * SHARE_UNIT).cast("long")
    nodes = written(nodes.withColumn("share", share), "url-nodes")
    others = nodes.groupBy("branch").agg(F.sum("share").alias("all_shares"), F.count("share").alias("all_hosts"))
    own = F.coalesce("share", F.lit(0))
    return fact_join(nodes, others, "branch", "inner").select(
        "host", "branch", "parent", "blocked", "labelled",
        ((F.coalesce("all_shares", F.lit(0)) - own) / SHARE_UNIT).alias("shares"),
        (F.col("all_hosts") - F.col("share").isNotNull().cast("long")).alias("hosts"),
    )


def merge_siblings(nodes: DataFrame) -> DataFrame:
    """Labels of each branch pooled over the siblings it is merged with, as ``pool_blocked`` and ``pool_labelled``.

    Siblings begin as one class, that is cut where a member's share differs from the rest of its class by more than chance,
    into those above, those below and the others, until none differs. For the test the same branch of another host counts
    as a url, so a branch without own labels is compared as well; without both it stays with the others.
    """
    marked = nodes.withColumns({
        "class": F.lit(""), "a": F.col("blocked") + F.col("shares"), "b": F.col("labelled") + F.col("hosts")
    })
    key = ["host", "parent", "class"]
    with ExitStack() as rounds:
        while True:
            marked = rounds.enter_context(shared_table(marked, "url-classes"))
            # sums of whole parts, as the order of rows must not show
            parts = F.sum(F.round(F.col("a") * SHARE_UNIT).cast("long")) / SHARE_UNIT
            sums = marked.filter("parent IS NOT NULL").groupBy(*key).agg(
                parts.alias("all_a"), F.sum("b").alias("all_b"),
                F.sum("blocked").alias("pool_blocked"), F.sum("labelled").alias("pool_labelled"),
            )
            joined = fact_join(marked.filter("parent IS NOT NULL"), sums, key, "inner")
            rest_a, rest_b = F.col("all_a") - F.col("a"), F.col("all_b") - F.col("b")
            both = (F.col("b") > 0) & (rest_b > 0)
            joint = F.col("all_a") / F.col("all_b")
            apart = F.when(both, F.col("a") / F.col("b") - rest_a / rest_b)
            error = F.when(both, F.sqrt(F.greatest(joint * (1 - joint), F.lit(0.0)) * (1 / F.col("b") + 1 / rest_b)))
            side = F.when(apart > SAME_Z * error + 1e-6, "+").when(apart < -SAME_Z * error - 1e-6, "-").otherwise("=")
            joined = joined.withColumn("side", side)
            if joined.filter("side <> '='").isEmpty():
                break
            roots = marked.filter("parent IS NULL")
            moved = joined.withColumn("class", F.concat("class", "side")).select(*marked.columns)
            marked = moved.union(roots)
        own = ["host", "branch", "shares", "hosts"]
        pooled = joined.select(*own, "pool_blocked", "pool_labelled")
        roots = marked.filter("parent IS NULL").select(*own, "blocked", "labelled")
        return written(pooled.union(roots), "url-branches")


def template_purities(templates: DataFrame) -> DataFrame:
    """``purity`` and ``verdict`` of each (host, template) and of ``evidence``, where its labels come from.

    From the root on, a branch's purity smooths its pooled labels by what it falls back to: the share of other hosts
    that have the branch, smoothed in turn by the parent's purity. The root falls back to the mean share of all
    hosts with labels. Without any label the purity is 0.
    """
    branches = merge_siblings(tree_nodes(templates))
    leaves = templates.select("host", "template", "steps").distinct()
    depth = F.explode(F.sequence(F.lit(0), F.size("steps"))).alias("depth")
    ancestors = leaves.select("host", "template", "steps", depth).select(
        "host", "template", "depth", F.expr("array_join(slice(steps, 1, depth), '')").alias("branch")
    )
    share = F.round(F.col("pool_blocked") / F.when(F.col("pool_labelled") > 0, F.col("pool_labelled")) * SHARE_UNIT).cast("long")
    start = branches.filter("branch = ''").agg((F.sum(share) / F.count(share) / SHARE_UNIT).alias("share")).first()["share"] or 0.0
    line = F.struct("depth", "pool_blocked", "pool_labelled", "shares", "hosts")
    way = fact_join(ancestors, branches, ["host", "branch"], "inner").groupBy("host", "template").agg(
        F.array_sort(F.collect_list(line)).alias("way")
    )

    def smoothed(above: Column, at: Column) -> Column:
        prior = (at["shares"] + PRIOR_WEIGHT * above) / (at["hosts"] + PRIOR_WEIGHT)
        return (at["pool_blocked"] + PRIOR_WEIGHT * prior) / (at["pool_labelled"] + PRIOR_WEIGHT)

    last = F.element_at("way", -1)
    evidence = (
        F.when(last["pool_labelled"] > 0, "branch").when(last["hosts"] > 0, "other hosts")
        .when(F.exists("way", lambda at: at["pool_labelled"] > 0), "ancestor").otherwise("all hosts")
    )
    return way.select(
        "host", "template", F.aggregate("way", F.lit(float(start)), smoothed).alias("purity"), evidence.alias("evidence")
    ).withColumn("verdict", F.when(F.col("purity") >= BLOCK_PURITY, "block").otherwise("allow"))


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id``, ``host``, ``path``, ``rule``, ``template``, ``purity``, ``evidence`` and ``verdict`` of every row.

    A rule's verdict goes before the template's. Urls without a host are urls of one nameless host. Rows may repeat, which
    counts once for a template; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    found = rule_for(F.col("host"), F.col("path"), rules)
    urls = rows.select("host", "path").distinct().withColumn("found", found).select(
        "host", "path",
        F.coalesce(F.col("found.verdict") == "allow", F.lit(False)).cast("long").alias("allowed"),
        F.coalesce(F.col("found.verdict") == "block", F.lit(False)).cast("long").alias("blocked"),
    )
    templates = path_templates(urls)
    purities = template_purities(templates).withColumnRenamed("verdict", "by_template")
    by_url = fact_join(templates.select("host", "path", "template"), purities, ["host", "template"], "inner")
    judged = fact_join(rows, by_url, ["host", "path"], "inner").withColumn("found", found)
    return judged.select(
        "id", "host", "path", F.col("found.rule").alias("rule"), "template", "purity", "evidence",
        F.coalesce("found.verdict", "by_template").alias("verdict"),
    )
