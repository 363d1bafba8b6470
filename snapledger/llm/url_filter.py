"""URL filters with redirect equivalence: pages that lead to each other share a block decision.

Rules name a host, with all of its subdomains, and the beginning of a path; the longest that fits a URL decides on it. A
URL without a rule is judged by its aliases: URLs that redirect to each other or name each other as canonical, directly or over
others, are a class, found as connected components of the edges. An explicit allowance in a class outranks its
blocks, and a URL's own rule outranks its class. Everything is DataFrame functions.

Rules are a list of the driver's and become one expression, so ``MAX_RULES`` bounds them; pages are not shuffled to meet
them. What moves are the edges, and the classes of pages that no rule fits.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import packed, unpacked
from snapledger.llm.graph import components
from snapledger.session import materialize

MAX_RULES = 1000
ALLOW, BLOCK = "allow", "block"

#: Schemes with the port that may be left out.
PORTS = {"http": "80", "https": "443"}

#: A link element, a meta element, and values of attributes with any quotes.
_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_REL = rf"(?is)\brel\s*=\s*(?:\"[^\"]*\bcanonical\b[^\"]*\"|'[^']*\bcanonical\b[^']*'|canonical(?=[\s/>]))"
_REFRESH = r"(?is)\bhttp-equiv\s*=\s*[\"']?refresh\b"
_URL_IN_CONTENT = r"(?is)\bcontent\s*=\s*(?:\"[^\"]*?url\s*=\s*'?|'[^']*?url\s*=\s*\"?)([^\"'>]+)"
_HREF = (r"(?is)\bhref\s*=\s*\"([^\"]*)\"", r"(?is)\bhref\s*=\s*'([^']*)'", r"(?is)\bhref\s*=\s*([^\s\"'>]+)")


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the beginning of a path, such as ``example.net/en/``; ``verdict`` is allow or block."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0].lower()

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits, or null; of equally long ones an allowance."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES} fit one expression")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == ALLOW)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, rule.text).otherwise(found)
    return found


def spelling(url: Column) -> Column:
    """One spelling for URLs that differ in scheme http or https, its own port, a leading ``www.``, a bare root or a fragment.

    Null for what is no http URL with a host.
    """

    def spelt(url: Column) -> Column:
        scheme = F.lower(F.regexp_extract(url, r"^([A-Za-z]+)://", 1))
        rest = F.regexp_extract(url, r"(?s)^[^:]*://[^/?#]*([^#]*)", 1)
        site = F.concat(scheme, F.lit("://"), host_of(url))
        for name, port in PORTS.items():
            site = F.regexp_replace(site, f"^({name}://.*):{port}$", "$1")
        host = F.regexp_replace(F.regexp_replace(site, r"^[a-z]*://(www\.)?", ""), r"\.(?=:|$)", "")
        full = F.concat(host, F.regexp_replace(rest, "^(?!/)", "/"))
        return F.when(scheme.isin(*PORTS) & ~full.startswith("/"), full)

    return _bound(F.trim(url), spelt)


def resolved(target: Column, base: Column) -> Column:
    """A link's target as a full URL, seen from the page ``base``; null for an empty one."""
    scheme = F.regexp_extract(base, r"^[A-Za-z]+:", 0)
    site = F.regexp_extract(base, r"^[A-Za-z]+://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_extract(path_of(base), r"(?s)^.*/", 0), "^$", "/")

    def full(target: Column) -> Column:
        return (
            F.when(target == "", None)
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
            .when(target.startswith("//"), F.concat(scheme, target))
            .when(target.startswith("/"), F.concat(site, target))
            .when(target.startswith("?"), F.concat(F.regexp_extract(base, r"^[^?#]*", 0), target))
            .when(target.startswith("#"), base)
            .otherwise(F.concat(site, folder, target))
        )

    return _bound(F.trim(F.replace(target, F.lit("&amp;"), F.lit("&"))), full)


def declared_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a``, ``b``: URLs of pages and what they name as canonical or redirect to at once by a refresh, as full URLs."""
    html, url = F.col(f"`{html_col}`"), F.col(f"`{url_col}`")
    # A plain search first: few pages have such elements at all.
    some = pages.filter(html.rlike("(?i)canonical") | html.rlike("(?i)http-equiv"))
    rows = some.select(
        url.alias("a"),
        F.filter(F.regexp_extract_all(html, F.lit(_LINK), 0), lambda x: x.rlike(_REL)).alias("links"),
        F.filter(F.regexp_extract_all(html, F.lit(_META), 0), lambda x: x.rlike(_REFRESH)).alias("metas"),
    )
    links = rows.select("a", F.explode("links").alias("element"))
    first = F.regexp_extract("element", _HREF[-1], 1)
    for pattern in _HREF[-2::-1]:
        first = F.when(F.col("element").rlike(pattern), F.regexp_extract("element", pattern, 1)).otherwise(first)
    metas = rows.select("a", F.explode("metas").alias("element"))
    both = links.select("a", first.alias("b")).unionByName(metas.select("a", F.regexp_extract("element", _URL_IN_CONTENT, 1).alias("b")))
    return both.select("a", resolved(F.col("b"), F.col("a")).alias("b"))


def _own_verdict(rows: DataFrame, url: Column, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` with ``host``, ``path``, ``rule``, ``_own`` (the verdict of the rule) and ``_node`` (the spelling)."""
    rows = rows.select("*", host_of(url).alias("host"), path_of(url).alias("path"), spelling(url).alias("_node"))
    rows = rows.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("rule"))
    own = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: r.verdict == ALLOW):
        own = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(own)
    return rows.select("*", own.alias("_own"))


def blocked_classes(members: DataFrame) -> DataFrame:
    """Classes (``_class``) with a block, no allowance, and a URL that no rule fits: the only ones that decide anything."""
    has = lambda condition: F.max(F.coalesce(condition, F.lit(False)))
    found = members.filter(F.col("_class").isNotNull()).groupBy("_class").agg(
        has(F.col("_own") == ALLOW).alias("_allowed"),
        has(F.col("_own") == BLOCK).alias("_blocked"),
        has(F.col("_own").isNull()).alias("_open"),
    )
    return found.filter("_blocked AND _open AND NOT _allowed").select("_class")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    edges: DataFrame | None = None,
    url_col: str = "url",
    html_col: str | None = "html",
) -> DataFrame:
    """Every input row, without its HTML, with ``host``, ``path``, ``rule``, ``verdict`` and ``alias_of``.

    ``rule`` is the longest that fits, or null. ``verdict`` is the rule's; without one, ``allow`` if any alias has a
    rule that allows it, else ``block`` if any alias has one that blocks it, else ``allow``. Aliases are URLs of one spelling
    (``spelling``), and those connected by redirects: elements of the pages' HTML (``html_col``, or None for none) and
    ``edges``, a table of URLs ``a`` and ``b`` such as a crawler's log of redirects. ``alias_of`` is the least spelling of the
    class, null if the URL has no host.

    * A null URL, or one without ``://``, has an empty host and path, no rule and no alias: it is allowed.
    * Edges with a null or an end that is no http URL count as none; loops, repeated edges and cycles do no harm.
    * Ends of edges that are no pages still connect those that lead there, and rules fit them as well.
    * Input columns of the five names are replaced; repeated rows stay; an empty table stays empty.
    """
    added = ["host", "path", "rule", "verdict", "alias_of"]
    plain = pages.drop(html_col) if html_col else pages
    rows = _own_verdict(plain.select(packed(plain, added), F.col(f"`{url_col}`").alias("_url")), F.col("_url"), rules)
    tables = [edges] if edges is not None else []
    if html_col:
        tables.append(declared_edges(pages, url_col, html_col))
    members = rows.select("_node", "_own")
    links = None
    for each in tables:
        spelt = each.select("a", "b", spelling(F.col("a")).alias("_a"), spelling(F.col("b")).alias("_b")).filter("_a <> _b")
        links = spelt if links is None else links.unionByName(spelt)
    links = None if links is None else materialize(links, "edges")
    if links is None or links.isEmpty():
        rows, members = (x.withColumn("_class", F.col("_node")) for x in (rows, members))
    else:
        ends = links.select(F.col("a").alias("_url")).unionByName(links.select(F.col("b").alias("_url")))
        ruled = _own_verdict(ends, F.col("_url"), rules).filter("_own IS NOT NULL")
        members = members.unionByName(ruled.select("_node", "_own"))
        # Stored, so that a URL with very many rows can be split in the join.
        known = materialize(components(links, "_a", "_b"), "classes")
        known = known.select(F.col("node").alias("_node"), F.col("comp").alias("_comp"))
        rows, members = (
            x.join(known, "_node", "left").withColumn("_class", F.coalesce("_comp", "_node")) for x in (rows, members)
        )
    blocked = materialize(blocked_classes(members), "blocked").withColumn("_hit", F.lit(True))
    judged = rows.join(blocked, "_class", "left")
    verdict = F.coalesce("_own", F.when(F.col("_hit"), BLOCK), F.lit(ALLOW))
    return judged.select(*unpacked(judged), "host", "path", "rule", verdict.alias("verdict"), F.col("_class").alias("alias_of"))
