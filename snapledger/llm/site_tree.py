"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is a branch, that is the labels of the elements from the page's
root. Its presentation is the sequence of children that the element has on a page, its content the text of
its blocks. A node whose presentation and content vary from page to page carries information; one that looks and
reads the same on all pages is the site's furniture. Importance is measured by entropy, relative to the pages that
have the node:

* presentation: -sum p_s log_m p_s over its styles s, on m pages;
* content: 1 - sum over occurrences of log_m n_f, averaged, for a block's text f found on n_f of the m pages;
* together: the content's importance, and the share PRESENTATION of its parent's presentation.

What goes from each page: branches below ``threshold``, and single blocks whose text is on almost all pages of the
site (content below ``TEXT_LEAST``). Within a main element, such as ``article``, only the latter go, as its branches hold the
site's own texts side by side with what it repeats below each of them. Elements that HTML itself or their names mark as furniture
are always removed; a main element inside a form or a widget's wrapper is none. Pages with the same whole article count as one, so that
an article that a site has several times is no furniture; and where repeated blocks make up half of a page's main text or more, they
are a copied article as well, and stay. Counts are aggregated by (host, branch, feature) with partial sums, so that a host with a third
of all pages is spread over all tasks; pages meet the few removed branches and texts of their own, not the tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.llm.common import packed, row_key, unpacked
from snapledger.llm.markup import MAIN, NOISE, OPEN, read_page, text_hash
from snapledger.session import materialize

#: Share of the parent's presentation in a branch's importance.
PRESENTATION = 0.2
#: Pages that must have a branch before its statistics count.
LEAST_PAGES = 5
#: Content importance below which a text is the site's, wherever it stands.
TEXT_LEAST = 0.05
#: Removals up to which pages meet them by broadcast.
BROADCAST_ROWS = 100_000

_CONTENT, _STYLE = 0, 1


def _host(url: str | None) -> str:
    """The host of a URL, lower-cased; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _nodes(pages: DataFrame) -> DataFrame:
    """Of each page its branches outside furniture (``branch``, ``parent``, ``status``) with their features: ``kind``, ``feature``.

    ``_a1`` and ``_a2`` identify the page for counting: by its whole main text, or by itself if it has none. A feature that a
    branch has several times on a page counts once.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k1, k2, url, source in zip(*(batch.column(c).to_pylist() for c in ("_k1", "_k2", "_url", "_html")), strict=True):
                blocks, styles = read_page(source or "")
                host, found = _host(url), {}
                article = "\n".join(b.text for b in blocks if b.status == MAIN)
                page = (text_hash(article), text_hash(article, 1)) if article else (k1, k2)
                for b in blocks:
                    if b.status != NOISE:
                        found[b.branch, _CONTENT, text_hash(b.text)] = (b.parent, b.status)
                for branch, style in styles:
                    found[branch, _STYLE, text_hash(style)] = (0, OPEN)
                rows += [(k1, k2, *page, host, *node, *more) for node, more in found.items()]
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["_k1", "_k2", "_a1", "_a2", "host", "branch", "kind", "feature", "parent", "status"]
    kinds = [*[pa.int64()] * 4, pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]
    schema = "_k1 long, _k2 long, _a1 long, _a2 long, host string, branch long, kind int, feature long, parent long, status int"
    return pages.select("_k1", "_k2", "_url", "_html").mapInArrow(parsed, schema)


def feature_counts(nodes: DataFrame) -> DataFrame:
    """On how many pages (``n``) each feature of a branch is; pages with the same article count once."""
    each = nodes.groupBy("host", "branch", "kind", "feature", "_a1", "_a2").agg(F.min("parent").alias("parent"))
    return each.groupBy("host", "branch", "kind", "feature").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent"))


def branch_pages(nodes: DataFrame) -> DataFrame:
    """How many pages (``n_pages``) have each branch; pages with the same article count once."""
    each = nodes.select("host", "branch", "kind", "_a1", "_a2").distinct()
    return each.groupBy("host", "branch", "kind").agg(F.count(F.lit(1)).alias("n_pages"))


def node_importance(nodes: DataFrame) -> DataFrame:
    """``host``, ``branch``, pages that have it (``n_pages``) and ``importance`` (0 to 1) of every content branch."""
    n = F.col("n")
    sums = feature_counts(nodes).groupBy("host", "branch", "kind").agg(
        F.sum(n).alias("total"), F.sum(n * F.log(n)).alias("weighted"), F.min("parent").alias("parent")
    )
    tree = sums.join(branch_pages(nodes), ["host", "branch", "kind"])
    m = F.log("n_pages")
    entropy = F.log("total") - F.col("weighted") / F.col("total")
    # One page shows no repetition: all of it is important.
    many = F.col("n_pages") > 1
    style = tree.filter(F.col("kind") == _STYLE).select(
        "host", F.col("branch").alias("parent"), F.when(many, entropy / m).otherwise(1.0).alias("_style")
    )
    content = tree.filter(F.col("kind") == _CONTENT).select(
        "host", "branch", "parent", "n_pages", F.when(many, 1 - F.col("weighted") / F.col("total") / m).otherwise(1.0).alias("_text")
    )
    joined = content.join(style, ["host", "parent"], "left")
    both = (1 - PRESENTATION) * F.col("_text") + PRESENTATION * F.coalesce("_style", F.lit(1.0))
    return joined.select("host", "branch", "n_pages", both.alias("importance"))


def site_texts(nodes: DataFrame) -> DataFrame:
    """``host``, ``branch``, ``feature``: texts that are on almost all pages that have their branch."""
    often = feature_counts(nodes.filter(F.col("kind") == _CONTENT)).filter(F.col("n") >= LEAST_PAGES)
    pages = branch_pages(nodes.filter(F.col("kind") == _CONTENT)).drop("kind").filter(F.col("n_pages") >= LEAST_PAGES)
    # Few texts are on several pages at all, so few rows meet the pages of their branch.
    both = often.join(pages, ["host", "branch"])
    return both.filter(1 - F.log("n") / F.log("n_pages") < TEXT_LEAST).select("host", "branch", "feature")


def _removed(pages: DataFrame, threshold: float) -> DataFrame:
    """What goes from each page that has it: ``_k1``, ``_k2``, ``_gone`` with ``branch`` and, unless all of it goes, ``feature``."""
    nodes = materialize(_nodes(pages), "page-nodes")
    low = node_importance(nodes).filter((F.col("importance") < threshold) & (F.col("n_pages") >= LEAST_PAGES))
    # Stored, so that a branch with very many pages can be split in the joins.
    low = materialize(low.select("host", "branch"), "low-branches")
    texts = materialize(site_texts(nodes), "site-texts")
    content = nodes.filter(F.col("kind") == _CONTENT)
    whole = content.filter(F.col("status") == OPEN).join(low, ["host", "branch"])
    single = content.join(texts, ["host", "branch", "feature"])
    own = whole.select("_k1", "_k2", "branch", F.lit(None).cast("long").alias("feature")).unionByName(
        single.select("_k1", "_k2", "branch", "feature")
    )
    return own.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("branch", "feature")).alias("_gone"))


def main_text(source: str, gone: set[tuple[int, int | None]]) -> tuple[str, int, int]:
    """The text of a page without what goes from it, how many blocks were judged by the tree, and how many of them went."""
    blocks = [b for b in read_page(source)[0] if b.status != NOISE]
    if not gone:
        return "\n".join(b.text for b in blocks), len(blocks), 0
    goes = [(b.status == OPEN and (b.branch, None) in gone) or (b.branch, text_hash(b.text)) in gone for b in blocks]
    main = sum(len(b.text) for b in blocks if b.status == MAIN)
    repeated = sum(len(b.text) for b, g in zip(blocks, goes, strict=True) if g and b.status == MAIN)
    if 2 * repeated >= main:
        goes = [g and b.status != MAIN for b, g in zip(blocks, goes, strict=True)]
    return "\n".join(b.text for b, g in zip(blocks, goes, strict=True) if not g), len(blocks), sum(goes)


def extract_text(
    pages: DataFrame,
    url_col: str = "url",
    html_col: str = "html",
    target: str = "text",
    id_col: str = "page_id",
    threshold: float = 0.3,
) -> DataFrame:
    """Every input row without ``html_col`` but with its main text as ``target``: blocks joined by line feeds.

    ``n_judged`` counts the blocks outside furniture, which the style tree decides on, and ``n_site_blocks`` those of them that went.

    * Null or empty html, and pages without main text, give an empty text. Rows without a URL are pages of one nameless host.
    * Equal rows count as one page of the site and get equal texts. Only blocks with text are joined; nothing is capped.
    * Damaged markup is read as browsers do where it matters for text; see ``markup``.
    * Input columns of the three names are replaced. An empty table stays empty.
    """
    url, source = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    keyed = pages.select(
        packed(pages, [html_col, target, "n_judged", "n_site_blocks"]), *row_key(F.col(f"`{id_col}`"), url, source), url.alias("_url"), source.alias("_html")
    )
    removed = materialize(_removed(keyed, threshold), "removed-branches")
    if removed.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        removed = F.broadcast(removed)
    joined = keyed.join(removed, ["_k1", "_k2"], "left").select("_row", "_html", "_gone")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                main_text(source or "", {(g["branch"], g["feature"]) for g in gone or ()})
                for source, gone in zip(batch.column("_html").to_pylist(), batch.column("_gone").to_pylist(), strict=True)
            ]
            texts, judged, went = zip(*found, strict=True) if found else ((), (), ())
            columns = [pa.array(texts, pa.string()), pa.array(judged, pa.int64()), pa.array(went, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *columns], ["_row", "_text", "_judged", "_went"])

    zero = F.lit(0).cast("long")
    schema = joined.select("_row", F.lit("").alias("_text"), zero.alias("_judged"), zero.alias("_went")).schema
    out = joined.mapInArrow(extracted, schema)
    counts = [F.col("_judged").alias("n_judged"), F.col("_went").alias("n_site_blocks")]
    return out.select(*unpacked(out), F.col("_text").alias(target), *counts)
