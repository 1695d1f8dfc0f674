"""Link operators over fetched listing pages.

Fetching pages is not built (no network client); these operators start from
a table of pages ``(url, html)`` and do the parsing half: extract anchors,
resolve them against the page URL, pick a link by keywords, read the period
from a link, and choose the latest periods.

All of a page's links live in one row, so link extraction and keyword
picking are per-row array expressions: no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from ..functions.dates import QUARTER_PATTERN, YEAR_PATTERN, quarter_from_text, year_from_text

# An anchor's double-quoted href attribute, and the hrefs a
# directory listing carries that are not content (parent link, sort links).
ANCHOR_HREF = r'(?i)<a\s(?:[^>]*?\s)?href="([^"]*)"'
PARENT_HREF = "../"
QUERY_PREFIX = "?"
SCHEME_AUTHORITY = r"^([a-zA-Z][a-zA-Z0-9+.-]*:)//([^/?#]*)([^?#]*)"
# Link shapes resolved natively, each exactly as ``urljoin`` resolves it:
# lower-case scheme with an authority (kept as is), scheme-relative (base
# scheme + link), and paths: root-relative or relative, merged with the base
# path and cleaned of '.'/'..' segments, and query-only / fragment-only
# links. None may carry ';' parameters or end in an empty query or fragment
# (``urljoin`` rewrites those); those, empty links and scheme-only links go
# to ``urljoin``.
_TAIL = r"(?:\?[^#]+)?(?:#.+)?$"
NATIVE_ABSOLUTE = r"^[a-z][a-z0-9+.-]*://[^?#;]*" + _TAIL
NATIVE_SCHEME_RELATIVE = r"^//[^/?#;]+[^?#;]*" + _TAIL
NATIVE_PATH = r"^(?![a-zA-Z][a-zA-Z0-9+.-]*:)[^?#;]+" + _TAIL


def link_array(html: Column) -> Column:
    """All anchor hrefs of a page in document order, ``&amp;`` decoded."""
    raw = F.regexp_extract_all(html, F.lit(ANCHOR_HREF), F.lit(1))
    return F.transform(raw, lambda h: F.replace(h, F.lit("&amp;"), F.lit("&")))


def is_content_link(href: Column) -> Column:
    """Not empty, not the parent link and not a ``?`` sort link."""
    return (href != "") & (href != PARENT_HREF) & ~href.startswith(QUERY_PREFIX)


def extract_links(pages: DataFrame, html: str = "html", keep: Sequence[str] = ("page_id", "url"),
                  ) -> DataFrame:
    """One row per content link: ``keep..., pos, href``.

    ``pos`` is the 0-based position among all anchors of the page.
    """
    exploded = pages.select(*keep, F.posexplode(link_array(F.col(html))).alias("pos", "href"))
    return exploded.filter(is_content_link(F.col("href")))


@pandas_udf(StringType())
def _urljoin(base: pd.Series, href: pd.Series) -> pd.Series:
    from urllib.parse import urljoin

    return pd.Series(
        [None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href)],
        dtype=object,
    )


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _native_sql(b: str, h: str) -> tuple[str, str]:
    """SQL text ``(is_native, resolved)`` for base column ``b`` and link ``h``.

    Path links are merged with the base directory (inner empty segments of a
    relative link dropped) and cleaned of '.'/'..' segments with a stack
    (``aggregate``): a link with n segments takes n steps, whatever n is.
    Intermediate values are bound once as lambda variables
    (``transform(array(x), v -> ...)``) so nothing is computed twice.
    """
    sa = _sql_str(SCHEME_AUTHORITY)
    scheme = f"lower(regexp_extract({b}, {sa}, 1))"
    has_base = f"({scheme} <> '' AND NOT contains({b}, ';'))"
    absolute = f"({h} RLIKE {_sql_str(NATIVE_ABSOLUTE)})"
    scheme_rel = f"({h} RLIKE {_sql_str(NATIVE_SCHEME_RELATIVE)} AND {has_base})"
    path_like = (f"(NOT {absolute} AND NOT startswith({h}, '//') "
                 f"AND {h} RLIKE {_sql_str(NATIVE_PATH)} AND {has_base})")
    path = f"regexp_extract({h}, '^([^?#]*)', 1)"
    rest = f"substring({h}, length({path}) + 1)"
    base_dir = (f"element_at(transform(array(split(regexp_extract({b}, {sa}, 3), '/')), "
                f"p -> CASE WHEN element_at(p, -1) <> '' THEN slice(p, 1, size(p) - 1) "
                f"ELSE p END), 1)")
    relative = (f"element_at(transform(array(concat({base_dir}, split({path}, '/'))), "
                f"m -> CASE WHEN size(m) >= 2 THEN concat(slice(m, 1, 1), "
                f"filter(slice(m, 2, greatest(size(m) - 2, 0)), x -> x <> ''), "
                f"slice(m, size(m), 1)) ELSE m END), 1)")
    segs = f"CASE WHEN startswith({path}, '/') THEN split({path}, '/') ELSE {relative} END"
    stack = ("aggregate(s, cast(array() AS array<string>), (acc, seg) -> "
             "CASE WHEN seg = '..' THEN slice(acc, 1, greatest(size(acc) - 1, 0)) "
             "WHEN seg = '.' THEN acc ELSE concat(acc, array(seg)) END)")
    cleaned = (f"element_at(transform(array({segs}), s -> element_at(transform(array({stack}), "
               f"st -> CASE WHEN element_at(s, -1) IN ('.', '..') THEN concat(st, array('')) "
               f"ELSE st END), 1)), 1)")
    merged = (f"element_at(transform(array(array_join({cleaned}, '/')), j -> "
              f"CASE WHEN j = '' THEN '/' WHEN startswith(j, '/') THEN j ELSE concat('/', j) END), 1)")
    authority = f"regexp_extract({b}, {sa}, 2)"
    base_path = f"regexp_extract({b}, {sa}, 3)"
    base_query = f"regexp_extract({b}, {_sql_str(r'^[^?#]*(\?[^#]+)')}, 1)"
    # '?q' keeps the base path; '#f' keeps base path and (non-empty) query
    query_only = f"({h} RLIKE {_sql_str(r'^\?[^#]+(?:#.+)?$')} AND {has_base})"
    fragment_only = f"({h} RLIKE {_sql_str(r'^#.+$')} AND {has_base})"
    value = (f"CASE WHEN {absolute} THEN {h} "
             f"WHEN {scheme_rel} THEN concat({scheme}, {h}) "
             f"WHEN {path_like} THEN concat({scheme}, '//', {authority}, {merged}, {rest}) "
             f"WHEN {query_only} THEN concat({scheme}, '//', {authority}, {base_path}, {h}) "
             f"WHEN {fragment_only} THEN concat({scheme}, '//', {authority}, {base_path}, "
             f"{base_query}, {h}) END")
    native = f"({absolute} OR {scheme_rel} OR {path_like} OR {query_only} OR {fragment_only})"
    return native, value


def resolve_native(base: str, href: str) -> Column:
    """Absolute URL for the link shapes resolved natively (absolute,
    ``//host``, root-relative and relative paths; see the patterns above) of
    the columns named ``base`` and ``href``; NULL for the others, which
    :func:`resolve_links` sends to ``urljoin`` (S2)."""
    return F.expr(_native_sql(f"`{base}`", f"`{href}`")[1])


def resolve_links(df: DataFrame, base: str = "url", href: str = "href",
                  out: str = "absolute_url") -> DataFrame:
    """Add the absolute URL of every link.

    Absolute, scheme-relative, root-relative and relative path links (the
    bulk of a directory listing) are resolved natively. Only rare shapes
    (empty, ``;params``, empty ``?``/``#`` parts, scheme without authority)
    need an Arrow-batched ``urljoin``. ``df`` is read once: every row passes
    the Python node, but the rows resolved natively hand it two NULLs.
    """
    is_native, value = _native_sql(f"`{base}`", f"`{href}`")
    native = df.withColumn("_resolved", F.expr(f"CASE WHEN coalesce({is_native}, false) THEN {value} END"))
    rare = [F.when(F.col("_resolved").isNull(), F.col(f"`{c}`")) for c in (base, href)]
    return native.withColumn(out, F.coalesce("_resolved", _urljoin(*rare))).drop("_resolved")


def archive_links(pages: DataFrame, extension: str = ".zip", html: str = "html",
                  keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Absolute URLs of the archive links of each page (S1 + ends-with + S2).

    A quarter folder's page lists its archives; a link qualifies when it
    ends with ``extension`` (case-insensitive). A page URL that is itself an
    archive is its own single link.
    """
    links = extract_links(pages, html, keep)
    wanted = links.filter(F.lower(F.col("href")).endswith(extension.lower()))
    resolved = resolve_links(wanted, "url", "href", "archive_url")
    direct = pages.filter(F.lower(F.col("url")).endswith(extension.lower())).select(
        *keep, F.lit(-1).alias("pos"), F.col("url").alias("href"), F.col("url").alias("archive_url"))
    return resolved.unionByName(direct)


def pick_link(links: Column, keywords: Iterable[str], mode: str = "all",
              fallback: str | None = None, suffix: str | None = None) -> Column:
    """First content link containing all (or any) keywords, case-insensitive (S3).

    With ``suffix`` the link must end with it too, in either case. Works on the page's link array, so the pick is a per-row expression;
    ``fallback`` is used when nothing matches.
    """
    kws = [k.lower() for k in keywords]
    if not kws:
        raise ValueError("at least one keyword")

    def match(h: Column) -> Column:
        conds = [F.lower(h).contains(k) for k in kws]
        out = conds[0]
        for c in conds[1:]:
            out = (out & c) if mode == "all" else (out | c)
        if suffix is not None:
            out = out & F.lower(h).endswith(suffix.lower())
        return is_content_link(h) & out

    first = F.try_element_at(F.filter(links, match), F.lit(1))
    return F.coalesce(first, F.lit(fallback)) if fallback is not None else first


def with_period(df: DataFrame, year_text: str, quarter_text: str | None = None) -> DataFrame:
    """Year and quarter read from link text (S4, C12); links without both are dropped."""
    yt, qt = F.col(year_text), F.col(quarter_text or year_text)
    # the texts are tested, not the extracted numbers, so unused columns are still pruned
    both = df.filter(yt.rlike(YEAR_PATTERN) & qt.rlike(QUARTER_PATTERN))
    return both.withColumns({"ano": year_from_text(yt), "trimestre": quarter_from_text(qt)})


def latest_periods(periods: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` latest distinct (ano, trimestre) pairs (S5, decision D7)."""
    return (
        periods.select("ano", "trimestre").distinct()
        .orderBy(F.col("ano").desc(), F.col("trimestre").desc())
        .limit(n)
    )


def prune_to_periods(fact: DataFrame, periods: DataFrame, n_max: int = 64) -> DataFrame:
    """Keep fact rows of the given periods with *literal* partition filters.

    The few chosen pairs (bounded by ``n_max``) are brought to the driver and
    written into the filter, which a partitioned table turns into
    ``PartitionFilters`` (a semi join would not prune partitions).
    """
    pairs = periods.select("ano", "trimestre").limit(n_max + 1).collect()
    if len(pairs) > n_max:
        return fact.join(periods.select("ano", "trimestre"), ["ano", "trimestre"], "left_semi")
    if not pairs:
        return fact.limit(0)
    cond = None
    for p in pairs:
        c = (F.col("ano") == p["ano"]) & (F.col("trimestre") == p["trimestre"])
        cond = c if cond is None else cond | c
    return fact.filter(cond)
