"""Listing fields from raw HTML pages, by tables of selectors.

A rule set names the selectors of the listing container and, per field, the selectors to try in order. Rule sets are
registered by name, which is how a new marketplace is added.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.functions import listing as L
from marketloom.operators.lookup import spread

# Elements that never have content.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


@dataclass(frozen=True)
class Rules:
    """Selectors of one page layout. A field is (selectors, what to take): "text", "count" or an attribute name."""

    container: tuple[str, ...]
    fields: dict[str, tuple[tuple[str, ...], str]]
    required: str | None = None


@dataclass
class Node:
    tag: str
    attrs: dict[str, str]
    parent: "Node | None" = None
    parts: list = field(default_factory=list)


RULES: dict[str, Rules] = {}


def register(name: str, rules: Rules) -> None:
    RULES[name] = rules


_NAME = ("a.pn", ".prd-name", "h2 a", "a[title]")

# Selectors of the marketplace's listing pages.
register(
    "marketplace",
    Rules(
        container=("div.c-p", "div.prd-card", "li.prd-li", "div[data-ggl]"),
        fields={
            "product_name": (_NAME, "text"),
            "name_title": (_NAME, "title"),
            "price_raw": ((".prc", ".price"), "text"),
            "supplier_name": ((".cname", ".company-name"), "text"),
            "city": ((".cloc", ".location"), "text"),
            "source_url": (_NAME, "href"),
        },
        required="product_name",
    ),
)

# Whole web pages.
register(
    "page",
    Rules(
        container=("html",),
        fields={
            "title": (("title",), "text"),
            "h1": (("h1",), "text"),
            "n_links": (("nav a[href]",), "count"),
            "footer_text": (("footer",), "text"),
        },
    ),
)


class _Tree(HTMLParser):
    """Element tree of a page; unclosed elements end with their parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("", {})

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.here)
        self.here.parts.append(node)
        if tag not in VOID_TAGS:
            self.here = node

    def handle_endtag(self, tag):
        node = self.here
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.here = node.parent

    def handle_data(self, data):
        self.here.parts.append(data)

    def parse_html_declaration(self, i):
        """Declarations as usual; a marked section that is none, such as ``<![foo bar]]>``, is text."""
        if self.rawdata[i : i + 3] != "<![" or self.rawdata[i : i + 9] == "<![CDATA[":
            return super().parse_html_declaration(i)
        self.handle_data("<![")
        return i + 3


def _descendants(node: Node) -> Iterator[Node]:
    """Elements below ``node`` in page order, without recursion: pages may nest deeply."""
    stack = [p for p in reversed(node.parts) if isinstance(p, Node)]
    while stack:
        here = stack.pop()
        yield here
        stack.extend(p for p in reversed(here.parts) if isinstance(p, Node))


def _text(node: Node) -> str:
    """All text below a node, each piece stripped, joined without a separator."""
    out: list[str] = []
    stack: list = list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part.strip())
        else:
            stack.extend(reversed(part.parts))
    return "".join(out)


def _fits(node: Node, step: str) -> bool:
    """One step of a selector: an element name with .class and [attribute] conditions."""
    tag = re.match(r"[\w-]*", step).group()
    classes = node.attrs.get("class", "").split()
    return (
        (not tag or node.tag == tag)
        and all(c in classes for c in re.findall(r"\.([\w-]+)", step))
        and all(a in node.attrs for a in re.findall(r"\[([\w-]+)\]", step))
    )


def _select(top: Node, selector: str) -> Iterator[Node]:
    """Elements below ``top`` that match; steps are separated by blanks and may skip levels."""
    *above, last = selector.split()
    for node in _descendants(top):
        if not _fits(node, last):
            continue
        need, up = list(above), node.parent
        while need and up is not None and up is not top.parent:
            if _fits(up, need[-1]):
                need.pop()
            up = up.parent
        if not need:
            yield node


def _first(top: Node, selectors: tuple[str, ...]) -> Node | None:
    return next((n for s in selectors for n in _select(top, s)), None)


def _field(item: Node, selectors: tuple[str, ...], take: str) -> str | None:
    if take == "count":
        return str(sum(1 for s in selectors for _ in _select(item, s)))
    found = _first(item, selectors)
    if found is None:
        return None
    return _text(found) if take == "text" else found.attrs.get(take)


def parse_page(html: str, rules: Rules) -> list[dict[str, str | None]]:
    """Field texts of every listing on a page. The first container selector that matches anything is used."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    items = next((found for s in rules.container if (found := list(_select(tree.root, s)))), [])
    rows = [{name: _field(item, *rule) for name, rule in rules.fields.items()} for item in items]
    # A listing counts as found when its required element exists, even with empty text.
    return [r for r in rows if rules.required is None or r[rules.required] is not None]


def extract_fields(pages: DataFrame, rules: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, place on the page, one text column per field): no row, one or many for each page."""
    chosen = RULES[rules]
    names = list(chosen.fields)

    def extract(batches):
        for pdf in batches:
            parsed = ((k, parse_page(text or "", chosen)) for k, text in zip(pdf[key], pdf[html]))
            rows = [(k, place, *r.values()) for k, found in parsed for place, r in enumerate(found)]
            yield pd.DataFrame(rows, columns=[key, "place", *names])

    schema = f"{key} long, place int, " + ", ".join(f"{n} string" for n in names)
    return spread(pages.select(key, html)).mapInPandas(extract, schema)


def extract_listings(pages: DataFrame, category: str | Column, key: str = "page_id") -> DataFrame:
    """Raw listings of marketplace pages, ready for validation.

    ``id`` is a 64-bit code of the page's key, the listing's place on the page and its link: two listings of a page differ, and
    unequal listings share one with a probability of n * n / 2^65 among n listings.
    """
    found = extract_fields(pages, "marketplace", key)
    slug = F.lit(category) if isinstance(category, str) else category
    prices = L.price_bounds(F.col("price_raw"))
    name = F.when(F.length("product_name") > 0, F.col("product_name")).otherwise(F.coalesce("name_title", F.lit("")))
    return found.select(
        F.xxhash64(key, "place", "source_url").alias("id"),
        key,
        name.alias("product_name"),
        prices["price_min"].alias("price_min"),
        prices["price_max"].alias("price_max"),
        "price_raw",
        "supplier_name",
        "city",
        L.category_label(slug).alias("category"),
        F.lit("indiamart").alias("source"),
        "source_url",
        F.current_timestamp().cast("timestamp_ntz").alias("scraped_at"),
    )


def extract_page_fields(pages: DataFrame) -> DataFrame:
    """Title, headline, number of navigation links and footer of whole web pages."""
    return extract_fields(pages, "page").drop("place").withColumn("n_links", F.col("n_links").cast("long"))
