"""Product cards and estimate pages: from HTML to nested rows.

Python only turns markup into rows (mapInArrow, a page at a time, the standard library's parser); what a card's name, code, price and
offers are is decided by column expressions in operators/variants.py. Markup that is broken is read as far as it makes
sense, never an error; a null page has no cards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructType

#: Marks of cards and of what is in them (classes, ids and test ids of the two layouts).
LEGACY_CARD, LEGACY_ADVERT, MODERN_CARD = "productItem", "ad_prod_item", "dnw-product-list-item"
IMAGE_MARKS = ["dnw-product-image", "ProductListBaseProductImage"]
OFFER_MARKS = ["prod_pricelist", "ProductListPriceCompare", "dnw-product-price", "pricelist", "price-list", "price_compare"]
DETAIL_MARKS = ["spec_list", "prod_spec_set"]
CODE_NAMES = ["pcode", "productcode", "productid", "productno", "prodcode"]
LIST_ID = "recom_search_ul"
TITLE_MARKS = ["name", "tit", "product_name"]
TABLE_WORDS, TABLE_KINDS = ["개당 가격", "수량"], ["PC 주요부품", "변동사항"]
PAGE_TITLES = ["product_title", "prd_name", "product_name"]
#: Of how many cards a page's signature is made, and of how many characters of each.
SIGNED_CARDS, SIGNED_WIDTH = 8, 120
#: Rows that a task hands on at once, those of a page together.
ROWS_AT_ONCE = 200
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
#: What an opening tag closes if it is open: items and cells without end tags.
CLOSES = {"li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"ul", "ol", "table", "select"}

STRONG = "struct<text:string,context:string>"
LINK = "struct<label:string,text:string>"
OFFER = f"struct<text:string,strongs:array<{STRONG}>,labels:array<string>,tokens:array<string>,links:array<{LINK}>>"
CARD = (
    "mode: string, legacy_name: string, legacy_price: string, code_attribute: string, links: array<struct<place:string,href:string,label:string,text:string>>, "
    f"pictures: array<string>, details: array<string>, full: string, prices: array<string>, strongs: array<{STRONG}>, offers: array<{OFFER}>"
)


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def text(self, without: frozenset[str] = frozenset({"script", "style"})) -> str:
        if all(isinstance(c, str) for c in self.children):
            return " ".join(" ".join(self.children).split()) if self.tag not in without else ""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            elif n.tag not in without:
                stack.extend(reversed(n.children))
        return " ".join(" ".join(out).split())

    def all(self, test: Callable[[Node], bool] = lambda n: True) -> Iterator[Node]:
        """Elements below this one, in order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            if test(n):
                yield n
            if n.children:
                stack.extend([c for c in reversed(n.children) if isinstance(c, Node)])

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def marked(self, mark: str) -> bool:
        """By class, id or test id; a mark that is part of a class counts as well."""
        if not self.attrs:
            return False
        return mark == self.attrs.get("id") or mark == self.attrs.get("data-testid") or any(mark in c for c in self.classes())

    def under(self, marks: list[str], top: Node) -> bool:
        n = self.parent
        while n is not None and n is not top.parent:
            if any(n.marked(m) for m in marks):
                return True
            n = n.parent
        return False


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        n = self.at
        while n.parent is not None and n.tag not in STOPS:
            if n.tag in CLOSES.get(tag, ()):
                self.at = n.parent
            n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        n = self.at
        while n.parent is not None and n.tag != tag:
            n = n.parent
        if n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _strongs(top: Node) -> list[dict]:
    return [{"text": n.text(), "context": n.parent.text()} for n in top.all(lambda n: n.tag == "strong")]


def _offer(row: Node) -> dict:
    return {
        "text": row.text(),
        "strongs": _strongs(row),
        "labels": [n.attrs["aria-label"] for n in row.all(lambda n: "aria-label" in n.attrs)],
        "tokens": [n.text() for n in row.all(lambda n: n.tag in ("span", "div"))],
        "links": [{"label": n.attrs.get("aria-label"), "text": n.text()} for n in row.all(lambda n: n.tag == "a")],
    }


def _place(a: Node, card: Node) -> str:
    if a.under(["prod_name"], card):
        return "name"
    if a.under(IMAGE_MARKS, card):
        return "image"
    if a.under(["product-info"], card):
        return "info"
    n = a.parent
    while n is not card and n.tag not in ("h3", "h4"):
        n = n.parent
    return "other" if n is card else n.tag


def _first(nodes: Iterator[Node]) -> str | None:
    n = next(nodes, None)
    return None if n is None else n.text()


def _card(n: Node, mode: str) -> dict:
    links = [a for a in n.all(lambda x: x.tag == "a" and ("href" in x.attrs or "aria-label" in x.attrs))]
    details: dict[str, None] = {}
    if mode == "legacy":
        for d in n.all(lambda x: any(x.marked(m) for m in DETAIL_MARKS) or (x.tag in ("a", "span") and x.under(DETAIL_MARKS, n))):
            details.setdefault(d.text())
    else:
        details.setdefault(_first(n.all(lambda x: x.marked("product-info"))) or "")
    codes = ["".join(v.split()) for x in [n, *n.all()] for k, v in x.attrs.items() if "".join(c for c in k if c.isalnum()).lower().removeprefix("data") in CODE_NAMES]
    return {
        "mode": mode,
        "legacy_name": _first(n.all(lambda x: x.tag == "a" and x.under(["prod_name"], n))),
        "legacy_price": _first(n.all(lambda x: x.tag == "strong" and x.under(["price_sect"], n))),
        "code_attribute": next((c for c in codes if c), None),
        "links": [{"place": _place(a, n), "href": a.attrs.get("href"), "label": a.attrs.get("aria-label"), "text": a.text()} for a in links],
        "pictures": [i.attrs["alt"] for i in n.all(lambda x: x.tag == "img" and "alt" in x.attrs and x.under(IMAGE_MARKS, n))],
        "details": [d for d in details if d],
        "full": n.text(),
        "prices": [x.text() for x in n.all(lambda x: x.tag in ("strong", "a", "span") and x.under(["price"], n))],
        "strongs": _strongs(n),
        "offers": [_offer(o) for o in n.all(lambda x: x.tag == "li" and x.under(OFFER_MARKS, n))],
    }


def _found(html: str) -> tuple[list[Node], str]:
    """The cards of a page, legacy ones if there are any, else modern ones."""
    root = tree(html)
    found = list(root.all(lambda n: n.tag == "li" and n.attrs.get("id", "").startswith(LEGACY_CARD) and LEGACY_ADVERT not in n.classes()))
    return (found, "legacy") if found else (list(root.all(lambda n: MODERN_CARD in n.classes())), "modern")


def _cards(html: str) -> list[dict]:
    found, mode = _found(html)
    return [_card(n, mode) for n in found]


def _signature(html: str | None) -> str | None:
    found, _ = _found(html or "")
    return "||".join(n.text()[:SIGNED_WIDTH] for n in found[:SIGNED_CARDS]) if found else None


@F.pandas_udf(StringType())
def signature(html: pd.Series) -> pd.Series:
    """What tells a page from others: the texts of its first cards, of either layout and with any attributes; null for a
    page without cards, of which nothing can be told."""
    return html.map(_signature)


def _rows(pages: DataFrame, keep: str, html: str, read: Callable[[str], list[dict]], schema: str, name: str) -> DataFrame:
    """`keep`, n (number on the page) and a struct `name` for each row that `read` finds on a page."""
    out = f"`{keep}` {dict(pages.dtypes)[keep]}, n int, {name} struct<{schema}>"
    inner = to_arrow_type(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n, rows = [], [], []
            for i in range(len(batch)):
                for k, row in enumerate(read(batch.column(1)[i].as_py() or "")):
                    at.append(i)
                    n.append(k)
                    rows.append(row)
                # What pages gave goes on together: a batch of its own for each would cost more than reading it.
                if rows and (len(rows) >= ROWS_AT_ONCE or i == len(batch) - 1):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), pa.array(n, pa.int32()), pa.array(rows, inner)], names=[keep, "n", name])
                    at, n, rows = [], [], []

    return pages.select(keep, html).mapInArrow(run, out)


def cards(pages: DataFrame, keep: str = "page_id", html: str = "html") -> DataFrame:
    """keep, n, card: the product cards of each page, legacy ones if there are any, else modern ones."""
    return _rows(pages, keep, html, _cards, CARD, "card")


def _listed(html: str) -> list[dict]:
    box = next(tree(html).all(lambda n: n.attrs.get("id") == LIST_ID), None)
    out = []
    for li in [c for c in (box.children if box else []) if isinstance(c, Node) and c.tag == "li"]:
        link = next(li.all(lambda n: n.tag == "a" and "ProductNo=" in n.attrs.get("href", "")), None)
        if link is None:
            continue
        boxes = list(li.all(lambda n: "txt_box" in n.classes()))
        titles = [_first(b.all(lambda n, m=m: m in n.classes())) for m in TITLE_MARKS for b in boxes] + [b.text() for b in boxes] + [link.text()]
        out.append({"href": link.attrs["href"], "title": next((t for t in titles if t), "")[:300]})
    return out


def listed_estimates(pages: DataFrame, keep: str = "page_id", html: str = "html") -> DataFrame:
    """keep, n, item (href, title of 300 characters at most): the top items of the list of estimates."""
    return _rows(pages, keep, html, _listed, "href: string, title: string", "item")


def _linked(html: str) -> list[dict]:
    inside = lambda n: n is not None and (n.tag == "li" or inside(n.parent))
    return [{"href": a.attrs.get("href"), "name": a.text()} for a in tree(html).all(lambda n: n.tag == "a" and "href" in n.attrs and inside(n.parent))]


def linked_items(pages: DataFrame, keep: str = "page_id", html: str = "html") -> DataFrame:
    """keep, n, item (href, name): the links in list items, in order."""
    return _rows(pages, keep, html, _linked, "href: string, name: string", "item")


def _cell(c: Node) -> dict:
    text = c.text()
    if all(isinstance(x, str) for x in c.children):
        return {"text": text, "name": text[:250], "values": []}
    return {"text": text, "name": _named(c), "values": [x.attrs["value"] for x in c.all(lambda n: n.tag == "input" and "value" in n.attrs)]}


def _named(cell: Node) -> str:
    for a in cell.all(lambda n: n.tag == "a" and "href" in n.attrs):
        name = " ".join((a.attrs.get("title") or a.text()).split())
        if len(name) >= 7:
            return name[:250]
    return cell.text(frozenset({"script", "style", "select", "option", "button", "input", "ul", "ol"}))[:250]


def _table(html: str) -> list[dict]:
    root = tree(html)
    for table in root.all(lambda n: n.tag == "table"):
        lines = list(table.all(lambda n: n.tag == "tr"))
        head = " ".join(r.text() for r in lines[:3])
        if all(w in head for w in TABLE_WORDS) and any(w in head for w in TABLE_KINDS):
            break
    else:
        return []
    titles = [n.text() for n in root.all(lambda n: n.tag == "h1" or ("class" in n.attrs and any(t in n.classes() for t in PAGE_TITLES)))]
    cells = [[c for c in r.children if isinstance(c, Node) and c.tag in ("td", "th")] for r in lines]
    rows = [[_cell(c) for c in line] for line in cells if len(line) >= 4]
    return [{"text": table.text(), "titles": titles, "lines": rows}]


def part_tables(pages: DataFrame, keep: str = "page_id", html: str = "html") -> DataFrame:
    """keep, n, parts (text, titles of the page, lines: array of cells of text, name, values): the first table of parts of
    each page that has one."""
    return _rows(pages, keep, html, _table, "text: string, titles: array<string>, lines: array<array<struct<text:string,name:string,values:array<string>>>>", "parts")
