"""URL filters: rules first, and for all other pages propagation over the host graph.

A rule is a host and a path; it fits that host and its subdomains where the
path of the URL begins with the rule's, and the longest fitting rule decides.

Hosts are linked by the absolute links of their pages, and to the host that
they are a subdomain of, both ways. Trust is a personalised PageRank whose
walks restart at hosts in the measure of their allowed pages; distrust walks the reversed
links from hosts in the measure of their blocked pages. Both are shares of
one. A host is blocked when its distrust exceeds its trust and its share of
all pages together; so a host that nothing is known of is allowed.

Defined cases: a null URL, or one without ``://``, has an empty host and path; a rule
does not fit an empty path unless its own is empty; repeated rows count as pages of
their own and each get a result; null HTML has no links; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.shared import stored

DAMPING = 0.85
ROUNDS = 12
_STORE_EVERY = 4
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# An absolute link, or one that only leaves out the scheme.
_LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    text: str  # host and path, as in "example.net/en/"
    verdict: str  # "allow" or "block"

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def with_host_and_path(pages: DataFrame) -> DataFrame:
    mark = F.instr("url", "://")
    rest = F.when(mark > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return pages.withColumns(
        {
            "host": lowered(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def _suffixes(host: Column) -> Column:
    """The host and all it is a subdomain of."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."),
    )


def host_rules(spark: SparkSession, hosts: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """(host, rules): the rules for each host, longest first."""
    listed = spark.createDataFrame(
        [(r.host, r.path, r.text, r.verdict) for r in rules],
        "suffix string, path string, text string, verdict string",
    )
    rule = F.struct(
        F.length("text").alias("size"), F.col("path"), F.col("text"), F.col("verdict")
    )
    return (
        hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("suffix"))
        .join(listed, "suffix")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(rule), asc=False).alias("rules"))
    )


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight) from links between hosts and from subdomains, without loops."""
    links = pages.select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"),
    ).select("src", lowered(F.col("dst")).alias("dst"))
    # At least two labels, so that hosts are not linked by their top domain alone.
    above = hosts.where(F.size(F.split("host", r"\.")) > 2).select(
        F.col("host").alias("src"),
        F.explode(F.slice(_suffixes(F.col("host")), 1, F.size(F.split("host", r"\.")) - 1)).alias("low"),
    )
    step = above.select(
        F.col("low").alias("src"), F.expr("substring(low, instr(low, '.') + 1)").alias("dst")
    ).where(F.instr("dst", ".") > 0).distinct()
    both = step.unionByName(step.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return (
        links.where("src <> '' AND dst <> '' AND src <> dst")
        .unionByName(both)
        .groupBy("src", "dst")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """(host, trust, distrust) from edges (src, dst, weight) and seeds (host, trust, distrust).

    Both walks are one table, told apart by ``kind``, so a round is one job for both.
    """
    way = F.explode(
        F.array(
            F.struct(F.lit("trust").alias("kind"), F.col("src").alias("a"), F.col("dst").alias("b")),
            F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("a"), F.col("src").alias("b")),
        )
    )
    walks = edges.select(way.alias("w"), "weight").select("w.kind", "w.a", "w.b", "weight")
    out = walks.groupBy("kind", "a").agg(F.sum("weight").alias("all"))
    walks = stored(
        walks.join(out, ["kind", "a"]).select(
            "kind", "a", "b", (F.col("weight") / F.col("all")).alias("share")
        )
    )
    begin = stored(
        seeds.select(
            "host",
            F.explode(
                F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")
            ).alias("kind", "seed"),
        ).where("seed > 0")
    )
    total = begin.groupBy("kind").agg(F.sum("seed").alias("total"))
    begin = begin.join(total, "kind").select(
        "kind", "host", (F.col("seed") / F.col("total")).alias("rank")
    )
    begin = stored(begin)
    ranks = begin
    for number in range(1, rounds + 1):
        moved = (
            ranks.withColumnRenamed("host", "a")
            .join(walks, ["kind", "a"])
            .select("kind", F.col("b").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
        )
        again = begin.select("kind", "host", (F.col("rank") * (1 - damping)).alias("rank"))
        ranks = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if number % _STORE_EVERY == 0:
            ranks = stored(ranks)
    # What ended at hosts without links is shared out again in proportion.
    whole = ranks.groupBy("kind").agg(F.sum("rank").alias("whole"))
    share = ranks.join(whole, "kind").withColumn("rank", F.col("rank") / F.col("whole"))

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0))

    return share.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))


def judge(pages: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, trust, distrust), one per page."""
    spark = pages.sparkSession
    split = with_host_and_path(pages.select("page_id", "url", "html"))
    hosts = split.select("host").distinct()
    known = stored(host_rules(spark, hosts, rules))
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    ruled = stored(
        split.select("page_id", "host", "path")
        .join(known, "host", "left")
        .withColumn("fit", F.get(F.coalesce(fitting, F.array()), F.lit(0)))
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.text").alias("rule"),
            F.col("fit.verdict").alias("ruled"),
        )
    )
    counts = stored(
        ruled.groupBy("host").agg(
            F.count("*").alias("pages"),
            F.count(F.when(F.col("ruled") == "allow", 1)).alias("trust"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("distrust"),
        )
    )
    edges = host_edges(split, counts.select("host"))
    scores = propagate(edges, counts)
    everything = counts.agg(F.sum("pages")).first()[0] or 1
    judged = (
        counts.select("host", "pages")
        .join(scores, "host", "left")
        .fillna(0.0, ["trust", "distrust"])
        .withColumn("share", F.col("pages") / F.lit(everything))
        .select(
            "host",
            "trust",
            "distrust",
            F.when(F.col("distrust") > F.col("trust") + F.col("share"), "block")
            .otherwise("allow")
            .alias("found"),
        )
    )
    return ruled.join(judged, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", "found").alias("verdict"),
        "trust",
        "distrust",
    )
