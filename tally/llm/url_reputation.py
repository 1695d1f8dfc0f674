"""URL filter: empirical-Bayes host reputation with beta-binomial shrinkage.

Labelled page outcomes (bad or not) are counted per host and rolled up to the
registered domain and the suffix. Each level is shrunk towards its parent:
all pages -> suffix -> registered domain -> host. A group with ``bad`` of
``n`` and the parent's mean ``m`` has the posterior
``Beta(m*s + bad, (1-m)*s + n - bad)``; the strength ``s = 1/rho - 1`` of a
level comes from the data (moment estimate of the intra-group correlation
``rho`` over all groups of the level). A host is blocked when the lower
posterior bound of its bad rate, ``mean - z * sd``, exceeds ``max_bad``; a
host without labels has its domain's mean, and is judged no surer than its domain
(the strength is at most the parent's ``a + b``). Explicit
rules come first; the longest that fits wins.

The registered domain comes from a table of public suffixes (an argument; by
default the few in this module): the tails of each host, as many labels as the
longest rule has, are joined with it. Users, ports and a closing dot are no
part of a domain; IP addresses are domains of their own under one suffix.

Plan: outcomes and pages meet on the page id with two narrow columns each;
everything after that works on one row per host, pre-aggregated before its
shuffle. The reputation table is staged, so the last join broadcasts it only
if it is measured small, and else is a sort-merge join whose hot keys
adaptive execution splits. The strengths are single numbers, used as scalar
subqueries.

Defined results: a null url or one without ``://`` has empty host and path,
and is judged like any host (the empty one); null ids and labels with no
outcome count nowhere; repeated label rows of a page count once (bad wins);
repeated pages each get a row; with no labels at all everything is allowed;
other columns pass through, except ones named as a result column, which the
result replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import staged
from .line_dedup import LOWER, UPPER

# (verdict, host, path prefix)
DEFAULT_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MAX_BAD = 0.3
Z = 1.645
RHO_MIN, RHO_MAX = 1e-4, 0.5

ADDRESSES = "[]"  # no host name has this suffix

# Public suffixes of two labels that are common on the web; pass the whole list as ``suffixes``.
TWO_LABEL_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp",
    "ne.jp", "co.kr", "com.br", "org.br", "gov.br", "com.mx", "com.ar", "com.tr", "com.cn", "com.tw",
    "co.in", "co.za", "com.sg", "com.hk",
)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def host_site(host: Column) -> Column:
    """The host without user, port and closing dot."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@|:[0-9]*$", ""), r"\.$", "")


def is_address(site: Column) -> Column:
    return site.rlike(r"(?s)^(\[.*\]|[0-9]{1,3}(\.[0-9]{1,3}){3})$")


def registered_domains(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """``host, domain, suffix`` of the distinct ``hosts(host)``, by the public suffixes in ``suffixes(suffix)``.

    The longest rule that fits counts; ``*.x`` stands for any label below ``x``
    and ``!y.x`` is an exception to it, under which ``x`` is the suffix. Without
    a rule the last label is the suffix. The domain has one label more. An IP
    address is its own domain, and all of them share the suffix ``ADDRESSES``.
    """
    rules = suffixes.select(F.col("suffix").alias("key")).distinct()
    longest = F.coalesce(rules.agg(F.max(F.size(F.split("key", r"\."))).alias("n")).scalar(), F.lit(0))
    sites = hosts.select("host", host_site(F.col("host")).alias("site")).withColumn("labels", F.split("site", r"\."))
    last = lambda n: F.array_join(F.slice("labels", -n, n), ".")
    n = F.col("n")
    tails = (
        sites.filter(~is_address(F.col("site")))
        .select("host", "labels", F.size("labels").alias("all"))
        .select("host", "labels", "all", F.explode(F.sequence(F.lit(1), F.least("all", longest))).alias("n"))
        .filter("n <= all")  # sequence(1, 0) counts down
        .filter("n > 0")
        .withColumn("tail", last(n))
    )
    tries = F.array(
        F.struct(F.col("tail").alias("key"), F.lit(0).alias("exception"), n.alias("n")),
        F.struct(F.concat(F.lit("*."), F.col("tail")).alias("key"), F.lit(0).alias("exception"), (n + 1).alias("n")),
        F.struct(F.concat(F.lit("!"), F.col("tail")).alias("key"), F.lit(1).alias("exception"), (n - 1).alias("n")),
    )
    found = (
        tails.select("host", "all", F.inline(tries))
        .filter("n <= all")
        .join(rules, "key")
        .groupBy("host")
        .agg(F.max(F.struct("exception", "n")).alias("best"))
    )
    size = F.coalesce(F.col("best.n"), F.lit(1))
    address = is_address(F.col("site"))
    return (
        sites.join(found, "host", "left")
        .withColumn("n", size)
        .withColumn("m", F.least(n + 1, F.size("labels")))
        .select(
            "host",
            F.when(address, F.col("site")).otherwise(last(F.col("m"))).alias("domain"),
            F.when(address, F.lit(ADDRESSES)).otherwise(last(n)).alias("suffix"),
        )
    )


def default_suffixes(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in TWO_LABEL_SUFFIXES])).alias("suffix"))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]], value: str) -> Column:
    """The longest rule that fits: its text (``value='rule'``) or its verdict."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    cases = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.lit(h + p if value == "rule" else verdict),
        )
        for verdict, h, p in longest_first
    ]
    return F.coalesce(*cases, F.lit(None).cast("string"))


def _posterior(groups: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Adds posterior ``a``, ``b`` and ``mean`` to ``groups(…, n, bad)``; ``parents(key, m, k)`` has the prior means and how much they rest on."""
    g = staged(groups.join(parents, key, "left"), f"level-{key}")
    v = F.col("m") * (1 - F.col("m"))
    miss = F.col("bad") / F.col("n") - F.col("m")
    over = F.sum(F.col("n") * miss * miss) - F.sum(v)
    room = F.sum((F.col("n") - 1) * v)
    rho = g.filter(F.col("n") > 0).agg(
        F.coalesce(F.when(room > 0, F.least(F.greatest(over / room, F.lit(RHO_MIN)), F.lit(RHO_MAX))), F.lit(RHO_MAX)).alias("rho")
    )
    s = F.least(1 / rho.scalar() - 1, F.col("k"))  # no surer of a child than of its parent
    return (
        g.withColumn("_s", s)
        .withColumn("a", F.col("m") * F.col("_s") + F.col("bad"))
        .withColumn("b", (1 - F.col("m")) * F.col("_s") + F.col("n") - F.col("bad"))
        .withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))
        .drop("_s", "m", "k")
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """``(page_id, bad)`` from ``labels(doc_id, quality, toxic)``: low quality or toxic is bad."""
    bad = F.greatest((F.col("quality") == 0).cast("int"), (F.col("toxic") == 1).cast("int"))
    return (
        labels.filter(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
        .filter(F.col("bad").isNotNull())
        .groupBy("page_id").agg(F.max("bad").alias("bad"))
    )


def host_reputation(
    pages: DataFrame, outcomes: DataFrame, url_col: str = "url", id_col: str = "page_id", z: float = Z, suffixes: DataFrame | None = None
) -> DataFrame:
    """One row per host: ``host, domain, suffix, n, bad, a, b, mean, bound`` (lower bound of the bad rate)."""
    seen = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"))
    hosts = (
        seen.join(outcomes.select("page_id", "bad"), "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    hosts = staged(hosts, "hosts")
    names = registered_domains(hosts.select("host"), default_suffixes(pages.sparkSession) if suffixes is None else suffixes)
    hosts = staged(hosts.join(names, "host"), "named-hosts")
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    suffixes = hosts.groupBy("suffix").agg(*counts)
    overall = hosts.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("m")).scalar()
    weight = hosts.agg((F.sum("n") + 2).cast("double").alias("k")).scalar()
    suffixes = _posterior(suffixes, suffixes.select("suffix", overall.alias("m"), weight.alias("k")), "suffix")
    prior = [F.col("mean").alias("m"), (F.col("a") + F.col("b")).alias("k")]
    domains = _posterior(
        hosts.groupBy("domain", "suffix").agg(*counts), suffixes.select("suffix", *prior), "suffix"
    )
    out = _posterior(hosts, domains.select("domain", *prior), "domain")
    ab = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (ab + 1))
    return out.withColumn("bound", F.col("mean") - z * sd)


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = DEFAULT_RULES,
    max_bad: float = MAX_BAD,
    z: float = Z,
    url_col: str = "url",
    id_col: str = "page_id",
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """All columns of ``pages`` plus ``host, path, rule, verdict, bad_bound``."""
    made = ("host", "path", "rule", "verdict", "bad_bound")
    old = [c for c in pages.columns if c not in made]
    rep = staged(
        host_reputation(pages, outcomes, url_col, id_col, z, suffixes).select(F.col("host").alias("_host"), F.col("bound").alias("_bound")),
        "host-reputation",
    )
    url = F.col(url_col)
    rows = pages.select(F.struct(*old).alias("_row"), url_host(url).alias("_h"), url_path(url).alias("_p"))
    rule = matching_rule(F.col("_h"), F.col("_p"), rules, "rule")
    ruled = matching_rule(F.col("_h"), F.col("_p"), rules, "verdict")
    method = F.when(F.col("_bound") > max_bad, "block").otherwise("allow")
    return rows.join(rep, F.col("_h") == F.col("_host"), "left").select(
        *[F.col("_row")[c].alias(c) for c in old],
        F.col("_h").alias("host"),
        F.col("_p").alias("path"),
        rule.alias("rule"),
        F.coalesce(ruled, method).alias("verdict"),
        F.col("_bound").alias("bad_bound"),
    )
