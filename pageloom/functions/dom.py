"""Element tree of a page as one nested column, and CSS access to it.

``parse`` turns each page into a struct of its elements and text pieces in page
order.  An element is numbered by its place and encloses the numbers up to its
``end``, so the tree takes room in proportion to the page, however deep it is.
Everything after that is a column expression on the row of the page: descendants
of an element are one slice, and whether an element lies inside others is read from
flags over the page that follow from their intervals.  Selecting needs neither a join
nor a shuffle.  ``node_table`` gives the same elements as rows.

The tree follows the usual rules for void elements, implied end tags, implied
``tbody`` and stray end tags.  It does not add missing ``html``/``body`` elements
and does not re-open formatting elements, unlike a browser.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.columns import ColumnOrName, col, first_of, let, pieces, strip, unpack
from pageloom.functions.entities import decoded_attribute

_INT, _TEXT = T.IntegerType(), T.StringType()
NODE_TYPE = T.StructType(
    [
        T.StructField("id", _INT),
        T.StructField("parent", _INT),
        # Place among the children of the parent, and the child before it.
        T.StructField("sib", _INT),
        T.StructField("prev", _INT),
        T.StructField("last", T.BooleanType()),
        T.StructField("end", _INT),
        T.StructField("tag", _TEXT),
        T.StructField("attrs", T.MapType(_TEXT, _TEXT)),
        # Text pieces c0..c1, outer HTML o0..o1 and inner HTML i0..i1 of the element.
        *[T.StructField(name, _INT) for name in ("c0", "c1", "o0", "o1", "i0", "i1")],
    ]
)
_CHUNK_TYPE = T.StructType([T.StructField("text", _TEXT), T.StructField("node", _INT)])
DOM_TYPE = T.StructType(
    [T.StructField("chunks", T.ArrayType(_CHUNK_TYPE)), T.StructField("nodes", T.ArrayType(NODE_TYPE))]
)

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset(("script", "style"))
PLAIN_TEXT = frozenset(("title", "textarea"))
CLOSES_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
TABLE_PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
# Opening one of these ends the listed open elements, up to the boundary.
IMPLIED_END = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "tr": (frozenset(("td", "th", "tr", "caption", "colgroup")), frozenset(("table",))),
}
for _part in ("thead", "tbody", "tfoot"):
    IMPLIED_END[_part] = (
        frozenset(("td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup")),
        frozenset(("table",)),
    )
for _part in CLOSES_PARAGRAPH:
    IMPLIED_END[_part] = (frozenset(("p",)), frozenset(("td", "th", "table", "button", "object")))

# A comment, tag or quoted value without its end takes the rest of the page.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


# Places in a node record.
_ID, _PARENT, _SIB, _PREV, _LAST, _END, _TAG, _C0, _C1, _O0, _O1, _I0, _I1 = range(13)
_CELLS = ("td", "th", "table")


class _Batch:
    """Elements and text of one batch of pages, on the way to Arrow arrays."""

    def __init__(self) -> None:
        self.nodes: list[list] = []
        self.keys: list[str] = []
        self.values: list[str] = []
        self.attr_at = [0]
        self.text: list[str] = []
        self.owner: list[int] = []
        self.chunk_at = [0]
        self.node_at = [0]

    def add_attributes(self, source: str) -> None:
        known = set()
        for name, double, single, bare in _ATTRIBUTE.findall(source):
            name = name.lower()
            if name not in known:
                known.add(name)
                value = double or single or bare
                self.keys.append(name)
                self.values.append(decoded_attribute(value))

    def add_page(self, page: str) -> None:
        nodes: list[list] = []
        chunk0 = len(self.text)
        stack: list[int] = []
        depths: dict[str, list[int]] = {}  # of each tag: where in the stack it is open
        youngest: dict[int, int] = {}  # of each parent: its last child so far
        search, text, owner = _TOKEN.search, self.text, self.owner

        def add_text(piece: str) -> None:
            if piece:
                text.append(_html.unescape(piece) if "&" in piece else piece)
                owner.append(stack[-1] if stack else -1)

        def open_node(tag: str, attributes: str, start: int, stop: int) -> None:
            number = len(nodes)
            parent = stack[-1] if stack else -1
            before = youngest.get(parent, -1)
            place = nodes[before][_SIB] + 1 if before >= 0 else 0
            chunk = len(text) - chunk0
            nodes.append(
                [number, parent, place, before, False, number + 1, tag, chunk, chunk, start, stop, stop, stop]
            )
            youngest[parent] = number
            if attributes:
                self.add_attributes(attributes)
            self.attr_at.append(len(self.keys))
            depths.setdefault(tag, []).append(len(stack))
            stack.append(number)

        def close_top(inner: int, outer: int) -> None:
            node = nodes[stack.pop()]
            depths[node[_TAG]].pop()
            node[_END] = len(nodes)
            node[_C1] = len(text) - chunk0
            node[_I1], node[_O1] = inner, outer

        def close_down_to(depth: int, position: int) -> None:
            while len(stack) > depth:
                close_top(position, position)

        def deepest(tags: Iterable[str]) -> int:
            return max((depths[t][-1] for t in tags if depths.get(t)), default=-1)

        def end_tag(tag: str, start: int, stop: int) -> None:
            depth = deepest((tag,))
            if depth >= 0 and (tag in TABLE_PARTS or depth > deepest(_CELLS)):
                close_down_to(depth + 1, start)
                close_top(start, stop)

        def end_implied(tag: str, position: int) -> None:
            ended, boundary = IMPLIED_END[tag]
            some = [depths[t] for t in ended if depths.get(t)]
            if some:
                edge = deepest(boundary)
                cut = min((d[k] for d in some if (k := bisect_right(d, edge)) < len(d)), default=None)
                if cut is not None:
                    close_down_to(cut, position)

        position, size = 0, len(page)
        while position < size:
            token = search(page, position)
            if token is None:
                add_text(page[position:])
                break
            start = token.start()
            if start > position:
                add_text(page[position:start])
            position = token.end()
            closing, tag, attributes, ending = token.groups()
            if tag is None or not ending:
                continue
            tag = tag.lower()
            if closing:
                end_tag(tag, start, position)
                continue
            if tag in IMPLIED_END:
                end_implied(tag, start)
            if tag == "tr" and stack and nodes[stack[-1]][_TAG] == "table":
                open_node("tbody", "", start, start)
            open_node(tag, attributes, start, position)
            if tag in VOID:
                close_top(position, position)
            elif tag in RAW_TEXT or tag in PLAIN_TEXT:
                stop = re.compile(f"</{tag}[^>]*+(?:>|\\Z)", re.I).search(page, position)
                inner, outer = (stop.start(), stop.end()) if stop else (size, size)
                body = page[position:inner]
                if tag in RAW_TEXT and body:
                    text.append(body)
                    owner.append(stack[-1])
                else:
                    add_text(body)
                close_top(inner, outer)
                position = outer
        close_down_to(0, size)
        for number in youngest.values():
            nodes[number][_LAST] = True
        self.nodes.extend(nodes)

    def elements(self) -> Iterator[tuple[int, int, int, str]]:
        """Parent, place, end and tag of each element."""
        return ((n[_PARENT], n[_SIB], n[_END], n[_TAG]) for n in self.nodes)

    def end_row(self) -> None:
        self.chunk_at.append(len(self.text))
        self.node_at.append(len(self.nodes))

    def arrow(self) -> pa.Array:
        def ints(values: list[int]) -> pa.Array:
            return pa.array(values, pa.int32())

        flat = list(zip(*self.nodes)) if self.nodes else [()] * (_I1 + 1)
        attrs = pa.MapArray.from_arrays(
            ints(self.attr_at), pa.array(self.keys, pa.string()), pa.array(self.values, pa.string())
        )
        parts = [
            ints(flat[_ID]), ints(flat[_PARENT]), ints(flat[_SIB]), ints(flat[_PREV]), pa.array(flat[_LAST], pa.bool_()),
            ints(flat[_END]), pa.array(flat[_TAG], pa.string()), attrs, *[ints(flat[i]) for i in range(_C0, _I1 + 1)],
        ]
        nodes = pa.ListArray.from_arrays(
            ints(self.node_at), pa.StructArray.from_arrays(parts, NODE_TYPE.fieldNames())
        )
        chunks = pa.ListArray.from_arrays(
            ints(self.chunk_at),
            pa.StructArray.from_arrays([pa.array(self.text, pa.string()), ints(self.owner)], ["text", "node"]),
        )
        return pa.StructArray.from_arrays([chunks, nodes], ["chunks", "nodes"])


@F.arrow_udf(DOM_TYPE)
def _parse(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    # Elements take many times the room of their text, so a batch is read and handed on in pieces.
    for pages in (piece for whole in batches for piece in pieces(whole)):
        batch = _Batch()
        for page in pages:
            text = page.as_py()
            if text:
                batch.add_page(text)
            batch.end_row()
        yield batch.arrow()


def parse(html: ColumnOrName) -> Column:
    """The element tree column of a page (empty lists for NULL)."""
    return _parse(col(html))


def node_table(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """One row per element, numbered in page order.

    ``parent`` is the number of the enclosing element and ``id``/``end`` enclose the
    descendants, so joins of children are equi-joins on page and element number, and
    those of descendants are range joins inside a page.
    """
    parsed = pages.select(*keep, parse(html).alias("dom"))
    opened = unpack(parsed, keep, F.col("dom.nodes"), "_place", "_node")
    return opened.select(*keep, "_node.*")


# --- containment ----------------------------------------------------------------

#: Intervals that are folded at once; a fold copies what it has at each step.
_FOLD = 256
_SPANS = "array<struct<id:int,end:int>>"


def _outermost(marked: Column) -> Column:
    """The intervals of nested nodes (in page order) that lie in no other one.

    They are nested or apart, so one counts if it begins behind the greatest end before it.
    """

    def part(k: Column) -> Column:
        before = F.transform(F.slice(marked, F.lit(1), k * _FOLD), lambda m: m["end"])
        state = F.struct(F.coalesce(F.array_max(before), F.lit(0)).alias("edge"), F.array().cast(_SPANS).alias("kept"))

        def step(held: Column, m: Column) -> Column:
            span = F.struct(m["id"].alias("id"), m["end"].alias("end"))
            grown = F.struct(m["end"].alias("edge"), F.concat(held["kept"], F.array(span)).alias("kept"))
            return F.when(m["id"] >= held["edge"], grown).otherwise(held)

        return F.aggregate(F.slice(marked, k * _FOLD + 1, _FOLD), state, step, lambda held: held["kept"])

    parts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(marked) / _FOLD).cast("int") - 1, F.lit(0)))
    return F.flatten(F.transform(parts, part))


def _covered(dom: Column, marked: Column, own: bool) -> Column:
    """A boolean for each element: whether it lies inside a ``marked`` one, or is one where ``own`` counts."""

    def build(spans: Column) -> Column:
        def piece(m: Column, i: Column) -> Column:
            edge, start = F.coalesce(F.get(spans, i - 1)["end"], F.lit(0)), m["id"] if own else m["id"] + 1
            return F.concat(F.array_repeat(F.lit(False), start - edge), F.array_repeat(F.lit(True), m["end"] - start))

        rest = F.size(dom["nodes"]) - F.coalesce(F.get(spans, F.size(spans) - 1)["end"], F.lit(0))
        return F.flatten(F.concat(F.transform(spans, piece), F.array(F.array_repeat(F.lit(False), rest))))

    return let(marked, lambda some: let(_outermost(some), build))


def inside(dom: ColumnOrName, marked: Column) -> Column:
    """A boolean for each element of the page: whether it lies inside one of the ``marked`` ones (in page order)."""
    return _covered(col(dom), marked, own=False)


def within(dom: ColumnOrName, marked: Column) -> Column:
    """As :func:`inside`, and true for the ``marked`` elements themselves."""
    return _covered(col(dom), marked, own=True)


def flagged(flags: Column, number: Column) -> Column:
    """The flag of an element; false for -1, which stands for no element."""
    return F.coalesce(F.get(flags, number), F.lit(False))


# --- selectors ----------------------------------------------------------------

_SELECTOR = re.compile(
    r"""(?P<link>\s*[>+~]\s*)|(?P<space>\s+)|(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?:"(?P<v1>[^"]*)"|'(?P<v2>[^']*)'|(?P<v3>[^\]\s]*)))?\s*\]
    |:not\((?P<no>[^()]*)\)|:(?:is|where)\((?P<any>[^()]*)\)
    |:(?P<nth>first-child|last-child|only-child|nth-child\(\s*(?P<every>[^()]*?)\s*\))""",
    re.X,
)
_EVERY = re.compile(r"(?P<step>[+-]?\d*)n(?:\s*(?P<sign>[+-])\s*(?P<shift>\d+))?|(?P<one>[+-]?\d+)")
Test = Callable[[Column], Column]


class SelectorError(ValueError):
    """The text is no selector this library supports."""


def _attribute_test(name: str, op: str | None, value: str) -> Test:
    def test(node: Column) -> Column:
        held = F.try_element_at(node["attrs"], F.lit(name))
        if op is None:
            return held.isNotNull()
        if op == "=":
            return held == value
        if not value:
            return F.lit(False)
        if op == "^=":
            return F.startswith(held, F.lit(value))
        if op == "$=":
            return F.endswith(held, F.lit(value))
        if op == "*=":
            return F.contains(held, F.lit(value))
        return F.array_contains(F.split(held, r"\s+"), value)

    return test


def _compound_test(tests: list[Test]) -> Test:
    def test(node: Column) -> Column:
        result = F.lit(True)
        for one in tests:
            result = result & F.coalesce(one(node), F.lit(False))
        return result

    return test


def _simple_test(found: re.Match) -> Test:
    if found["tag"]:
        name = found["tag"].lower()
        return lambda node: F.lit(True) if name == "*" else node["tag"] == name
    if found["id"]:
        return _attribute_test("id", "=", found["id"])
    if found["cls"]:
        return _attribute_test("class", "~=", found["cls"])
    if found["attr"]:
        return _attribute_test(found["attr"].lower(), found["op"], found["v1"] or found["v2"] or found["v3"] or "")
    if found["no"] is not None or found["any"] is not None:
        inner = [_chain(part) for part in _split_list(found["no"] if found["any"] is None else found["any"])]
        if any(len(chain) != 1 for chain in inner):
            raise SelectorError(found[0])
        tests = [chain[0][1] for chain in inner]
        either = lambda node: reduce(or_, (F.coalesce(test(node), F.lit(False)) for test in tests))
        return either if found["no"] is None else lambda node: ~either(node)
    place = found["nth"]
    if place == "first-child":
        return lambda node: node["sib"] == 0
    if place == "last-child":
        return lambda node: node["last"]
    if place == "only-child":
        return lambda node: (node["sib"] == 0) & node["last"]
    return _nth_child(found["every"])


def _nth_child(formula: str) -> Test:
    """``odd``, ``even``, a number, or every ``a``-th one from the ``b``-th on (``an+b``)."""
    found = _EVERY.fullmatch({"odd": "2n+1", "even": "2n"}.get(formula.lower(), formula.lower()))
    if not found:
        raise SelectorError(formula)
    if found["one"]:
        return lambda node: node["sib"] + 1 == int(found["one"])
    step = int(found["step"] + "1") if found["step"] in ("", "+", "-") else int(found["step"])
    shift = int((found["sign"] or "+") + (found["shift"] or "0"))
    if step == 0:
        return lambda node: node["sib"] + 1 == shift
    # The count n of whole steps is a number from 0 on.
    return lambda node: (F.pmod(node["sib"] + 1 - shift, F.lit(abs(step))) == 0) & ((node["sib"] + 1 - shift) * (1 if step > 0 else -1) >= 0)


def _chain(selector: str) -> list[tuple[str, Test]]:
    """Compounds of one selector with the combinator that leads to each."""
    steps: list[tuple[str, list[Test]]] = [("", [])]
    position = 0
    while position < len(selector):
        found = _SELECTOR.match(selector, position)
        if not found:
            raise SelectorError(selector)
        if found["link"] or found["space"]:
            if not steps[-1][1]:
                raise SelectorError(selector)
            steps.append(((found["link"] or " ").strip() or " ", []))
        else:
            steps[-1][1].append(_simple_test(found))
        position = found.end()
    if not steps[-1][1]:
        raise SelectorError(selector)
    return [(link, _compound_test(tests)) for link, tests in steps]


def _split_list(selector: str) -> list[str]:
    # A comma inside brackets belongs to its selector.
    return [part.strip() for part in re.split(r",(?![^\[(]*[\])])", selector)]


def _near(nodes: Column, chain: list[tuple[str, Test]], node: Column, first: Test | None) -> Column:
    """Test of a node for compounds that are joined by ``>`` and ``+``; ``first`` is asked of the outermost one."""
    link, test = chain[-1]
    result = test(node)
    if len(chain) > 1:
        other = F.get(nodes, node["parent" if link == ">" else "prev"])
        result = result & _near(nodes, chain[:-1], other, first)
    elif first:
        result = result & first(node)
    return F.coalesce(result, F.lit(False))


def _needed(dom: Column, chain: list[tuple[str, Test]]) -> tuple[Column | None, Callable[[Column], Test]]:
    """What a chain has to know of the page, and its test beside that: what stands left of a blank or ``~``."""
    nodes = dom["nodes"]
    far = [k for k, (link, _) in enumerate(chain) if link in (" ", "~")]
    if not far:
        return None, lambda _: lambda n: _near(nodes, chain, n, None)
    tail = chain[far[-1] :]
    known, test = _needed(dom, chain[: far[-1]])
    found = F.filter(nodes, test(None)) if known is None else let(known, lambda k: F.filter(nodes, test(k)))
    if tail[0][0] == "~":

        def follows(elder: Column) -> Test:
            return lambda n: F.exists(elder, lambda s: (s["parent"] == n["parent"]) & (s["sib"] < n["sib"]))

        return found, lambda elder: lambda n: _near(nodes, tail, n, follows(elder))
    return inside(dom, found), lambda flags: lambda n: _near(nodes, tail, n, lambda top: flagged(flags, top["id"]))


def with_tests(dom: ColumnOrName, selectors: Sequence[str], use: Callable[[list[Test]], Column]) -> Column:
    """``use`` of a test of nodes for each selector (comma lists too).

    What the tests need to know of the whole page is worked out once, outside of ``use``.
    """
    dom = col(dom)
    needs = [[_needed(dom, _chain(part)) for part in _split_list(s)] for s in selectors]
    known = [k.alias(f"k{i}_{j}") for i, some in enumerate(needs) for j, (k, _) in enumerate(some) if k is not None]

    def tests(held: Column | None) -> list[Test]:
        return [
            lambda n, i=i, some=some: reduce(
                or_, (test(None if k is None else held[f"k{i}_{j}"])(n) for j, (k, test) in enumerate(some))
            )
            for i, some in enumerate(needs)
        ]

    return let(F.struct(*known), lambda held: use(tests(held))) if known else use(tests(None))


def select(dom: ColumnOrName, selector: str) -> Column:
    """Matching nodes in page order."""
    return with_tests(dom, [selector], lambda tests: F.filter(col(dom)["nodes"], lambda n: tests[0](n)))


def select_first(dom: ColumnOrName, selector: str) -> Column:
    return first_of(select(dom, selector))


def descendants(dom: ColumnOrName, node: Column) -> Column:
    return F.slice(col(dom)["nodes"], node["id"] + 2, node["end"] - node["id"] - 1)


def raw_text(dom: ColumnOrName, node: Column) -> Column:
    """Text of an element and everything in it."""
    chunks = F.slice(col(dom)["chunks"], node["c0"] + 1, node["c1"] - node["c0"])
    return F.array_join(F.transform(chunks, lambda c: c["text"]), "")


def text(dom: ColumnOrName, node: Column) -> Column:
    return strip(raw_text(dom, node))


def outer_html(html: ColumnOrName, node: Column) -> Column:
    return F.substring(col(html), node["o0"] + 1, node["o1"] - node["o0"])


def inner_html(html: ColumnOrName, node: Column) -> Column:
    return F.substring(col(html), node["i0"] + 1, node["i1"] - node["i0"])


def attr(node: Column, name: str) -> Column:
    return F.try_element_at(node["attrs"], F.lit(name))


def _read(html: Column, dom: Column, node: Column, accessor: str) -> Column:
    if accessor == "html":
        return outer_html(html, node)
    if accessor.startswith("attr:"):
        return attr(node, accessor[5:])
    return text(dom, node)


def access(html: ColumnOrName, selector: str, accessor: str = "text", dom: ColumnOrName | None = None) -> Column:
    """Value of the first match: ``text``, ``html`` (outer), ``attr:name``, the same
    after ``parent.``, or after ``children.N.``; NULL without a match."""
    if dom is None:
        return let(parse(html), lambda d: access(html, selector, accessor, d))
    html, dom = col(html), col(dom)
    try:
        found = select_first(dom, selector)
    except SelectorError:
        return F.lit(None).cast("string")
    nodes = dom["nodes"]
    if accessor.startswith("parent."):
        return let(found, lambda n: let(F.get(nodes, n["parent"]), lambda p: _read(html, dom, p, accessor[7:])))
    child = re.fullmatch(r"children\.(\d+)\.(.*)", accessor)
    if child:

        def nth(node: Column) -> Column:
            inside = F.filter(
                descendants(dom, node), lambda c: (c["parent"] == node["id"]) & (c["sib"] == int(child[1]))
            )
            return let(first_of(inside), lambda c: _read(html, dom, c, child[2]))

        return let(found, nth)
    if accessor.startswith("children."):
        return F.lit(None).cast("string")
    return let(found, lambda n: _read(html, dom, n, accessor))


def element(html: ColumnOrName, selector: str, dom: ColumnOrName | None = None) -> Column:
    """First match as ``struct(text, html, attr)`` with inner HTML; NULL without one.

    A `` @name`` suffix asks for a bare attribute, which leaves the fields NULL.
    """
    if dom is None:
        return let(parse(html), lambda d: element(html, selector, d))
    html, dom = col(html), col(dom)
    kind = "struct<text:string,html:string,attr:map<string,string>>"
    bare = re.fullmatch(r"(.*) @(\S+)\s*", selector)
    try:
        found = select_first(dom, bare[1].strip() if bare else selector)
    except SelectorError:
        return F.lit(None).cast(kind)
    if bare:
        nothing = F.lit(None).cast("string")
        empty = F.struct(
            nothing.alias("text"), nothing.alias("html"), F.lit(None).cast("map<string,string>").alias("attr")
        )
        return let(found, lambda n: F.when(attr(n, bare[2]).isNotNull(), empty))
    return let(
        found,
        lambda n: F.when(
            n.isNotNull(),
            F.struct(text(dom, n).alias("text"), inner_html(html, n).alias("html"), n["attrs"].alias("attr")),
        ),
    )


def element_attribute(
    html: ColumnOrName, selector: str, name: str, dom: ColumnOrName | None = None
) -> Column:
    """Attribute of the first match; an empty string where there is none."""
    return F.coalesce(access(html, selector, f"attr:{name}", dom), F.lit(""))


def css_select(
    html: ColumnOrName, selector: str, accessor: str = "text", dom: ColumnOrName | None = None
) -> Column:
    """:func:`access` that gives an empty string instead of NULL."""
    return F.coalesce(access(html, selector, accessor, dom), F.lit(""))


def all_texts(html: ColumnOrName, selector: str, dom: ColumnOrName | None = None) -> Column:
    """Trimmed text of every match; an empty array for a bad selector."""
    if dom is None:
        return let(parse(html), lambda d: all_texts(html, selector, d))
    try:
        found = select(dom, selector)
    except SelectorError:
        return F.array().cast("array<string>")
    return F.transform(found, lambda n: text(dom, n))
