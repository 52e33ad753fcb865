"""URL verdicts: host rules first, else trust and distrust spread over the graph of links.

Personalised PageRank runs from the trusted hosts along the links (a page vouches for what it
links to) and from the blocked hosts against them (a page that links to a blocked
host shares in the blame). Both are plain joins and aggregates over host edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallylake.llm.tables import written

DAMPING = 0.85
ROUNDS = 10
# A host without a rule is blocked if it gets more distrust than trust, and at least this
# part of what a blocked host starts with on average.
MIN_DISTRUST = 0.05


@dataclass(frozen=True)
class Rule:
    """A host suffix with a path prefix, as ``host/path``, and what it decides."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith(f".{self.host}")) & path.startswith(self.path)


RULES = (
    Rule("org/", True),
    Rule("example.org/es/", False),
    Rule("example.org/en/1", False),
    Rule("com/fr/", True),
    Rule("com/de/", False),
)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, NULL if none does; of equally long ones the first."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    return F.coalesce(*[F.when(r.fits(host, path), F.lit(r.text)) for r in longest], F.lit(None))


def host_links(pages: DataFrame, html: str) -> DataFrame:
    """(src, dst, n): links from host to host, counted before they are shuffled.

    Targets are the absolute and the protocol-relative ``href`` values; a relative one stays on
    its host and carries no judgement.
    """
    hrefs = F.regexp_extract_all(
        F.coalesce(F.col(html), F.lit("")), F.lit(r"(?i)\shref\s*=\s*[\"']?((?:https?:)?//[^\"'\s>]+)"), F.lit(1)
    )
    links = pages.select(F.col("host").alias("src"), F.explode(hrefs).alias("url"))
    target = F.when(F.col("url").startswith("//"), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", host_of(target).alias("dst"))
    links = links.filter("src <> '' and dst <> '' and src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float) -> DataFrame:
    """(host, rank): personalised PageRank of ``seeds`` (host, seed) along ``edges`` (src, dst, n).

    Seeds sum to 1. What a host without links has goes back to the seeds by way of their
    constant share only, so ranks sum to 1 at most.
    """
    out = edges.groupBy("src").agg(F.sum("n").alias("total"))
    shares = edges.join(out, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share"))
    shares = written(shares, "links-shares")
    start = written(seeds, "links-seeds")
    rank = start.select("host", F.col("seed").alias("rank"))
    for _ in range(rounds):
        sent = shares.join(rank, shares["src"] == rank["host"]).groupBy(F.col("dst").alias("host"))
        sent = sent.agg((F.sum(F.col("rank") * F.col("share")) * damping).alias("got"))
        kept = start.select("host", (F.col("seed") * (1 - damping)).alias("got"))
        rank = sent.union(kept).groupBy("host").agg(F.sum("got").alias("rank"))
        rank = written(rank, "links-rank")
    return rank


def judged(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    rules: Sequence[Rule] = RULES,
    rounds: int = ROUNDS,
    damping: float = DAMPING,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page.

    Trusted and blocked seeds are the hosts of the pages that a rule allows or blocks, weighted by those
    pages. A page without a rule gets its host's verdict: block if distrust exceeds trust and
    ``MIN_DISTRUST`` of the average blocked seed, else allow; hosts no link reaches have neither and
    are allowed. NULL urls have an
    empty host and path; NULL html has no links. Repeated pages come out once each and
    count once each. Other columns are ignored.
    """
    own = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(html).alias("html"),
    )
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allowed = [r.text for r in rules if r.allow]
    edges = written(host_links(own, "html"), "links-edges")
    by_host = own.filter("rule is not null and host <> ''").groupBy("host")
    allow = F.col("rule").isin(allowed)
    by_host = by_host.agg(
        F.count_if(allow).alias("allowed"), F.count_if(~allow).alias("blocked")
    )
    by_host = written(by_host, "links-hosts")

    totals = by_host.agg(
        F.sum("allowed").alias("allowed"),
        F.sum("blocked").alias("blocked"),
        F.count_if(F.col("blocked") > 0).alias("hosts"),
    ).first()
    least = MIN_DISTRUST / (totals["hosts"] or 1)

    def seeds(column: str) -> DataFrame:
        seed = (F.col(column) / F.lit(totals[column] or 1)).alias("seed")
        return by_host.filter(F.col(column) > 0).select("host", seed)

    trust = spread(edges, seeds("allowed"), rounds, damping)
    reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = spread(reverse, seeds("blocked"), rounds, damping)
    ranks = trust.select("host", F.col("rank").alias("trust")).join(
        distrust.select("host", F.col("rank").alias("distrust")), "host", "full"
    )
    nothing = F.lit(0.0)
    rows = own.drop("html").join(ranks, "host", "left")
    rows = rows.withColumns(
        {"trust": F.coalesce("trust", nothing), "distrust": F.coalesce("distrust", nothing)}
    )
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least)
    verdict = (
        F.when(F.col("rule").isin(allowed), "allow")
        .when(F.col("rule").isNotNull() | blocked, "block")
        .otherwise("allow")
    )
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "trust", "distrust")


def oracle(rules: Sequence[Rule] = RULES, rounds: int = ROUNDS, damping: float = DAMPING) -> str:
    """DuckDB SQL for (page_id, host, path, rule, verdict), the rounds written out."""
    fits = "\n".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{r.text}'"
        for r in sorted(rules, key=lambda r: -len(r.text))
    )
    allowed = ", ".join(f"'{r.text}'" for r in rules if r.allow)
    host = r"translate(regexp_extract({}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def walk(name: str, src: str, dst: str, column: str) -> str:
        parts = [
            f"{name}_s AS (SELECT host, {column} / (SELECT sum({column}) FROM h) AS seed FROM h WHERE {column} > 0)",
            f"{name}_e AS (SELECT {src} AS src, {dst} AS dst, n / sum(n) OVER (PARTITION BY {src}) AS share FROM e)",
            f"{name}_0 AS (SELECT host, seed AS rank FROM {name}_s)",
        ]
        for k in range(rounds):
            parts.append(
                f"{name}_{k + 1} AS (SELECT host, sum(got) AS rank FROM (SELECT dst AS host, {damping} * sum(rank * share) AS got"
                f" FROM {name}_e JOIN {name}_{k} ON src = host GROUP BY dst"
                f" UNION ALL SELECT host, {1 - damping} * seed FROM {name}_s) GROUP BY host)"
            )
        return ",\n".join(parts)

    return rf"""
WITH u AS (SELECT page_id, {host.format("coalesce(url, '')")} AS host,
                  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, html FROM pages),
p AS (SELECT *, CASE {fits} END AS rule FROM u),
l AS (SELECT host AS src, unnest(regexp_extract_all(coalesce(html, ''),
             '(?i)\shref\s*=\s*["'']?((?:https?:)?//[^"''\s>]+)', 1)) AS url FROM p),
t AS (SELECT src, {host.format("CASE WHEN starts_with(url, '//') THEN 'http:' || url ELSE url END")} AS dst FROM l),
e AS (SELECT src, dst, count(*) AS n FROM t WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
h AS (SELECT host, count(*) FILTER (WHERE rule IN ({allowed})) AS allowed,
             count(*) FILTER (WHERE rule NOT IN ({allowed})) AS blocked
      FROM p WHERE rule IS NOT NULL AND host <> '' GROUP BY host),
{walk("good", "src", "dst", "allowed")},
{walk("bad", "dst", "src", "blocked")}
SELECT page_id, p.host, path, rule,
       CASE WHEN rule IN ({allowed}) THEN 'allow'
            WHEN rule IS NOT NULL OR (coalesce(b.rank, 0) > coalesce(g.rank, 0) AND coalesce(b.rank, 0) >= {MIN_DISTRUST} / (SELECT count(*) FROM bad_s))
            THEN 'block' ELSE 'allow' END AS verdict
FROM p LEFT JOIN good_{rounds} g ON g.host = p.host LEFT JOIN bad_{rounds} b ON b.host = p.host
"""
