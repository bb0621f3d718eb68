"""URL filter: rules first, then a path-template tree per host.

Paths become templates level by level. A segment that is a number, a hash, or a
number with an ending is variable by its form; a segment of a host is variable by
statistics when its parent has many children that are nearly all rare. Variable
segments become wildcards. Pages a rule judges are the labelled ones. Siblings
whose share of blocked pages does not differ significantly from their parent's are
merged into one branch. A template is blocked when its purity, smoothed by parent,
host and corpus, reaches the threshold.

The tree is a table with one row per node; hosts never meet in one task, and counts
are pre-aggregated, so a hot host is only a few rows after the map side.

Defined results: a null url, or one without `://`, has empty host and path and gets
the verdict of the empty template. Path segments beyond `TreeSettings.levels` (8) are
one tail: sections that differ only deeper share a verdict. Repeated rows are judged alike and all count.
Extra columns are ignored; nulls in them do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import kept

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class TreeSettings:
    levels: int = 8  # segments told apart; deeper ones are one wildcard tail
    many: int = 24  # children from which a parent may have a variable segment
    rare: float = 4.0  # mean pages per child up to which they are variable
    weight: float = 8.0  # pages that a prior counts as
    z: float = 1.96  # significance of a sibling that is not merged
    block: float = 0.5  # purity from which a template is blocked


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, UPPER.lower()), path


def by_rules(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.text)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _form(segment: Column) -> Column:
    """The segment, or a wildcard if its form says that it is variable."""
    number = F.regexp_replace(segment, r"^[0-9]+(?=\.[A-Za-z0-9]{1,5}$|$)", "{n}")
    hashed = segment.rlike(r"^[0-9a-fA-F-]{8,}$") & segment.rlike(r"[0-9]")
    return F.when(hashed & ~segment.rlike(r"^[0-9]+$"), F.lit("{h}")).otherwise(number)


def _shaped(pages: DataFrame, settings: TreeSettings) -> DataFrame:
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    head = F.transform(F.slice(segments, 1, settings.levels), _form)
    tail = F.when(F.size(segments) > settings.levels, F.array(F.lit("{tail}"))).otherwise(
        F.array().cast("array<string>")
    )
    return pages.withColumn("parts", F.concat(head, tail))


def paths_of_hosts(judged: DataFrame, settings: TreeSettings) -> DataFrame:
    """Distinct shaped paths with counts and their template, variable segments as `{*}`."""
    paths = (
        _shaped(judged, settings)
        .groupBy("host", "parts")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.count("label").alias("labelled"),
            F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"),
        )
        .withColumn("template", F.lit(""))
        .withColumn("parent", F.lit(""))
    )
    paths = kept(paths)
    deepest = paths.agg(F.max(F.size("parts"))).first()[0] or 0
    for level in range(deepest):
        has = F.size("parts") > level
        part = F.get(F.col("parts"), level)
        here = paths.filter(has)
        children = here.groupBy("host", "template", part.alias("part")).agg(
            F.sum("pages").alias("n")
        )
        variable = (
            children.filter(~F.startswith("part", F.lit("{")))
            .groupBy("host", "template")
            .agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"))
            .filter((F.col("kinds") >= settings.many) & (F.col("n") <= settings.rare * F.col("kinds")))
            .select("host", "template", F.lit(True).alias("variable"))
        )
        joined = paths.join(variable, ["host", "template"], "left")
        wild = F.col("variable").isNotNull() & ~F.startswith(part, F.lit("{"))
        step = F.concat("template", F.lit("/"), F.when(wild, F.lit("{*}")).otherwise(part))
        paths = kept(
            joined.select(
                "host",
                "parts",
                "pages",
                "labelled",
                "blocked",
                F.when(has, step).otherwise(F.col("template")).alias("template"),
                F.when(has, F.col("template")).otherwise(F.col("parent")).alias("parent"),
            )
        )
    return paths


def template_verdicts(paths: DataFrame, settings: TreeSettings) -> DataFrame:
    """One row per host and template: its branch after merging, purity, verdict."""
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "blocked")]
    nodes = paths.groupBy("host", "parent", "template").agg(*sums)

    def total(keys: list[str], prefix: str) -> DataFrame:
        return nodes.groupBy(*keys).agg(
            F.sum("labelled").alias(prefix + "_labelled"), F.sum("blocked").alias(prefix + "_blocked")
        )

    corpus = total([], "corpus")  # one row
    hosts = total(["host"], "host")
    parents = total(["host", "parent"], "parent")
    w = F.lit(settings.weight)

    def smooth(blocked: Column, labelled: Column, prior: Column) -> Column:
        return (blocked + w * prior) / (labelled + w)

    base = F.coalesce(F.col("corpus_blocked") / F.nullif("corpus_labelled", F.lit(0)), F.lit(0.0))
    rows = (
        nodes.join(hosts, "host")
        .join(parents, ["host", "parent"])
        .join(F.broadcast(corpus))
        .withColumn("host_purity", smooth(F.col("host_blocked"), F.col("host_labelled"), base))
        .withColumn(
            "parent_purity",
            smooth(F.col("parent_blocked"), F.col("parent_labelled"), F.col("host_purity")),
        )
    )
    p = F.col("parent_purity")
    spread = F.sqrt(p * (1 - p) / F.greatest(F.col("labelled"), F.lit(1)))
    own_share = F.col("blocked") / F.greatest(F.col("labelled"), F.lit(1))
    alike = (F.col("labelled") == 0) | (F.abs(own_share - p) <= settings.z * spread)
    rows = rows.withColumn(
        "branch", F.when(alike, F.concat("parent", F.lit("/{merged}"))).otherwise(F.col("template"))
    )
    branches = rows.groupBy("host", "parent", "branch").agg(
        F.sum("labelled").alias("branch_labelled"), F.sum("blocked").alias("branch_blocked")
    )
    rows = rows.join(branches, ["host", "parent", "branch"])
    purity = smooth(F.col("branch_blocked"), F.col("branch_labelled"), p)
    return rows.select(
        "host",
        "template",
        "branch",
        "pages",
        "labelled",
        purity.alias("purity"),
        F.when(purity >= settings.block, "block").otherwise("allow").alias("method"),
    )


def filter_urls(
    pages: DataFrame,
    rules: list[Rule],
    settings: TreeSettings = TreeSettings(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """`id, host, path, rule, verdict, template, branch, purity` for every page."""
    host, path = host_and_path(F.col(url_col))
    pages = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    name, verdict = by_rules(F.col("host"), F.col("path"), rules)
    judged = pages.withColumns({"rule": name, "by_rule": verdict})
    judged = judged.withColumn("label", (F.col("by_rule") == "block").cast("int"))
    paths = paths_of_hosts(judged, settings)
    verdicts = template_verdicts(paths, settings)
    tree = paths.select("host", "parts", "template").join(verdicts, ["host", "template"])
    return (
        _shaped(judged, settings)
        .join(tree.drop("pages", "labelled"), ["host", "parts"], "left")
        .select(
            "id",
            "host",
            "path",
            "rule",
            F.coalesce("by_rule", "method", F.lit("allow")).alias("verdict"),
            "template",
            "branch",
            "purity",
        )
    )
