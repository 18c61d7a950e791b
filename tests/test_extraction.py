"""Golden extraction cases on literal pages."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pageloom.functions import article as A
from pageloom.functions import dom as D
from pageloom.functions import entities as N
from pageloom.functions import json_path as J
from pageloom.functions import script_vars as S
from pageloom.functions import tags as T
from pageloom.functions import url as U
from pageloom.functions.htmlpath import htmlpath
from pageloom.functions.sql_names import register
from pageloom.operators import extract as E
from pageloom.plans import documents as DOC
from pageloom.sources import html_table as H
from pageloom.sources import tables


@pytest.fixture
def value(spark):
    """One expression over one page."""

    def run(html, make, **columns):
        row = spark.createDataFrame([(html, *columns.values())], ["html", *columns])
        return row.withColumn("dom", D.parse("html")).select(make().alias("v")).first()["v"]

    return run


def test_batches_are_read_in_pieces():
    """Python functions hand on a part of a large batch before they read the rest."""
    pages = pa.array(["<p>x</p>" * 40_000] * 8 + [None])
    scripts = pa.array([["var a = 1; " * 30_000]] * 8 + [None])
    data = pa.array([['{"@type": "Thing"}' + " " * 300_000]] * 8 + [None])
    for read, batch in [
        (D._parse, pages), (S._plain, scripts), (S._with_window, scripts), (S._per_script, scripts),
        (S._strict_items, data), (S._lenient_items, data),
    ]:
        found = [len(part) for part in read.func(iter([batch, batch.slice(0, 0)]))]
        assert sum(found) == 9 and max(found) < 5


def test_steps_of_a_link_are_worked_out_once(spark):
    """A pattern that stands several times in one expression runs several times for every link or page."""
    assert str(T._link_attributes("html")).count("]href") == 1
    assert str(U.base_parts("url")).count("^(.*?)://") == 1
    html = "<a href='//h.com/a'><a href=//h.com/b/../c><a href='//H.com/d'><a href=/e><a href=.f><a href='#g'><a href=mailto:h>"
    pages = spark.createDataFrame([(b, html) for b in ("https://e.com/a/b", "ftp://e.com/a/b")], "url string, html string")
    found = sorted(r["link"] for r in T.links(pages, ["url"]).collect())
    assert found == [f"https://{p}" for p in ("e.com/a/.f", "e.com/e", "h.com/a", "h.com/c", "h.com/d")]


def test_plain_json_in_scripts_is_read_at_once(monkeypatch):
    """A literal that is JSON needs no reader of its own; what the two would read differently takes the other one."""
    steps, plain = [], S._read_array
    monkeypatch.setattr(S, "_read_array", lambda *a: steps.append(a[1]) or plain(*a))
    held = dict(S.assignments('var a = [{"b": [1, 2.0, -0.0, "x"]}, null];\nc = {"d": [true], "d": [1e3]}'))
    assert held == {"a": [{"b": [1, 2, 0, "x"]}, None], "c": {"d": [1000]}} and not steps
    long = "1" * 4001
    held = dict(S.assignments(f'var a = ["\\ud83d", "\\x41"], b = [NaN, 1e999, {long}], c = [1,,{{d: 2}},], e = [[1] + 2], f = {"[" * 3000}{"]" * 3000}'))
    assert held == {"a": ["\ufffd", "A"], "b": [None, None, None], "c": [1, None, {"d": 2}], "e": [None]} and steps
    # A script of many literals that are no JSON is not tried again and again.
    tried, scan = [], S._SCAN
    monkeypatch.setattr(S, "_SCAN", lambda *a: tried.append(a[1]) or scan(*a))
    assert len(S.assignments("a = [{b: 'c'}];" * 100)) == 100 and len(tried) < 20


def test_required_fields_are_worked_out_once(spark, capsys):
    pages = spark.createDataFrame([("a", "<h1>x</h1>"), ("b", "<p>y</p>")], "k string, html string")
    wanted = [E.css("name", "h1", required=True)]
    good, bad = E.split_required(E.extract(pages, wanted, ["k"]), wanted)
    assert [r["k"] for r in good.collect()] == ["a"] and [(r["k"], r["missing"]) for r in bad.collect()] == [("b", ["name"])]
    good.explain()
    bad.explain()
    assert "EvalPython" not in capsys.readouterr().out


def test_rows_that_become_pages_are_dealt_evenly(spark, sf, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_TASK", 20)
    sizes = DOC.product_pages(spark, sf).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) <= 30


STATION = (
    '<section><ul><li class="gauge wet"><a href="/gauges/7?unit=c&amp;day=1">Gauge 7</a> <em data-taken=06:30>18.4 °C</em></li></ul></section>'
    '<script type="application/ld+json">{"@type":"Observation","location":{"name":"North quay"}}</script>'
)


@pytest.mark.parametrize(
    ("html", "path", "expected"),
    [
        (STATION, "li@text", '"Gauge 7 18.4 °C"'),
        (STATION, "li.gauge em@text", '"18.4 °C"'),
        (STATION, "li a@href", '"/gauges/7?unit=c&day=1"'),
        (STATION, "li em@data-taken", '"06:30"'),
        (STATION, 'script[type="application/ld+json"]@text.location.name', '"North quay"'),
        (STATION, "section ul li em@text", '"18.4 °C"'),
        ('<input id="tides" value=\'[{"cm":110},{"at":2},{"cm":"low"}]\'>', "input#tides@value[*].cm", '[110,"low"]'),
        ('<input id="tides" value=\'[{"cm":110},{"at":2}]\'>', "input#tides@value[1].at", "2"),
        ('<input id="tides" value="no json">', "input#tides@value[*]", "null"),
        ('<input id="tides" value="{}">', "input#tides@value[*].cm", "null"),
        ("<p>x</p>", "p[[@text", "null"),
        ("<p>x</p>", "p", "null"),
        ("<script>var a = 1; var tides = [{cm: 7}]</script>", "script@$tides[0].cm", "7"),
        ("<script>var tides = [{cm: 7},{cm: 8}]</script>", "@$tides[*].cm", "[7,8]"),
        ("<p>no script</p>", "@$tides", "null"),
    ],
)
def test_htmlpath(value, html, path, expected):
    assert value(html, lambda: htmlpath("html", path, "dom")) == expected


SHELF = (
    '<section id="poetry" data-floor="2"><a href="/shelf/8b" rel=up><figure class="spine thin" data-mark="P-17">'
    '<figcaption class="title">Tides &amp; <i>Salt</i></figcaption></figure></a></section>'
)
INDEX = (
    '<ol class="letters"><li><q cite="/a">Alder</q></li><li><q cite="/b">Birch</q></li><li><q cite="/c">Cedar</q></li></ol>'
    '<dl id="notes"><dt>Oak</dt>loose words<dd lang="la">Quercus</dd></dl>'
)


@pytest.mark.parametrize(
    ("html", "selector", "accessor", "expected"),
    [
        (SHELF, "figcaption.title", "text", "Tides & Salt"),
        (SHELF, "figcaption.title", "parent.attr:data-mark", "P-17"),
        (SHELF, "figure.spine", "parent.attr:href", "/shelf/8b"),
        (SHELF, "figcaption i", "parent.text", "Tides & Salt"),
        (SHELF, "figcaption i", "html", "<i>Salt</i>"),
        (INDEX, "ol.letters", "children.0.text", "Alder"),
        (INDEX, "ol.letters", "children.2.text", "Cedar"),
        (INDEX, "dl#notes", "children.1.attr:lang", "la"),
        (INDEX, "dl#notes", "children.0.html", "<dt>Oak</dt>"),
        (INDEX, "dl#notes", "children.5.text", None),
        (INDEX, "ol > li:last-child > q[cite^='/c']", "text", "Cedar"),
        (INDEX, "li:not(:first-child) q", "attr:cite", "/b"),
        (INDEX, "dd[lang], ol", "html", INDEX[: INDEX.index("<dl")]),
        (INDEX, "li:nth-child(2)", "text", "Birch"),
        (INDEX, "dl > ol", "text", None),
        (INDEX, "dt >", "text", None),
    ],
)
def test_access(value, html, selector, accessor, expected):
    assert value(html, lambda: D.access("html", selector, accessor, "dom")) == expected


def test_element_struct(value):
    got = value('<q cite="/m" title="By heart" class=c>Ash <u>tree</u></q>', lambda: D.element("html", "q", "dom"))
    assert (got.text, got.html, got.attr["title"]) == ("Ash tree", "Ash <u>tree</u>", "By heart")
    assert value("<p>", lambda: D.element("html", "q", "dom")) is None
    bare = value('<q cite="/m">Ash</q>', lambda: D.element("html", "q @cite", "dom"))
    assert (bare.text, bare.html, bare.attr) == (None, None, None)
    assert value("<p>", lambda: D.css_select("html", "q", dom="dom")) == ""
    assert value("<p>", lambda: D.all_texts("html", "]", "dom")) == []


def test_tree_recovers_from_loose_markup(value):
    html = "<table><tr><td>1<td>2<tr><td>3</table><p>a<p>b<b>c<div>d</div></i><br>e<select><option>x<option>y</select>"
    assert value(html, lambda: D.all_texts("html", "tbody > tr > td", "dom")) == ["1", "2", "3"]
    assert value(html, lambda: D.all_texts("html", "p", "dom")) == ["a", "bc"]
    assert value(html, lambda: D.all_texts("html", "option", "dom")) == ["x", "y"]
    assert value("<!-- <p>no</p> --><p>yes", lambda: D.all_texts("html", "p", "dom")) == ["yes"]
    assert value('<script>var t="<p>no</p>"</script><p>yes', lambda: D.all_texts("html", "p", "dom")) == ["yes"]


def test_tree_of_null_page(spark):
    frame = spark.createDataFrame([(None,), ("<p>x",)], "html string").withColumn("dom", D.parse("html"))
    assert [r[0] for r in frame.select(F.size("dom.nodes")).collect()] == [0, 1]


@pytest.mark.parametrize(
    ("script", "expected"),
    [
        ("let gauges = JSON.parse('{\"quay\": [4, {\"dry\": false}]}');", {"gauges": {"quay": [4, {"dry": False}]}}),
        (r"const mark = JSON.parse('\x7b\x22sign\x22:\x22\u00bf\x22}')", {"mark": {"sign": "¿"}}),
        ("var floor = \"2\"; var shelf = {'no': 'P-17', deep: {row: [8, -0.5, null, true]}};", {"floor": "2", "shelf": {"no": "P-17", "deep": {"row": [8, -0.5, None, True]}}}),
        ("var a = 1 + 2, b = 'x'; c = [f(), 2]; d = {e: f()}", {"b": "x", "c": [None, 2]}),
        ("function f() { var hidden = 1 }\nif (x) { y = 2 }\nlet z = `t`", {"z": "t"}),
        ("window.X = {a: 1}; a.b = 2; e == 3", {}),
        ("var u = '\\u00e9\\x41'; // c\n/* d = 1 */ x = 0x10", {"u": "éA", "x": 16}),
        ("x = 1; x = 2", {"x": 2}),
    ],
)
def test_script_variables(value, script, expected):
    got = value(f"<script>{script}</script>", lambda: S.variables("html"))
    assert {k: json.loads(v) for k, v in got.items()} == expected


def test_state_variables_keep_the_first(value):
    html = "<script type='text/javascript'>window.A = {a: [1,],}; A = {}; var b = 'text'; B = ['q']</script><script type=module>C={}</script>"
    assert value(html, lambda: S.state_variables("html")) == {"A": '{"a":[1]}', "B": '["q"]'}


def test_jsonld_graph_and_types(value):
    html = (
        '<script type="application/ld+json">{"@type":"Page","@graph":[{"@type":["http://schema.org/A","B"],"n":1},[{"@type":"A","n":2}]]}</script>'
        "<script type='application/ld+json'>[[{\"@type\":\"A\",\"n\":3}],5]</script>"
    )
    got = value(html, lambda: S.jsonld("html"))
    assert sorted(got) == ["A", "B", "Page"]
    assert [o["n"] for o in json.loads(got["A"])] == [1, 2, 3]
    loose = value(html.replace('"n":2}', '"n":2,/*x*/}'), lambda: S.first_type_jsonld("html"))
    assert sorted(loose) == ["A"] and json.loads(loose["A"])["n"] == 3


def test_microdata_flattens_and_keeps_the_last(value):
    html = (
        '<div itemscope itemtype="https://schema.org/Product"><span itemprop="name"> N </span><a itemprop=url href="/u">t</a>'
        '<div itemprop=offer itemscope itemtype="x/Offer"><meta itemprop=price content="1"><i itemprop=name>M</i></div></div>'
    )
    got = value(html, lambda: S.microdata("dom"))
    assert json.loads(got["Product"]) == [{"name": "M", "offer": "M", "price": "1", "url": "/u"}]
    assert json.loads(got["Offer"]) == [{"name": "M", "price": "1"}]


def test_links_of_a_page(spark):
    html = (
        '<a href="/one">1</a><A HREF=two.html rel="NoFollow">2</A><a href="https://x.com/#f">3</a><a href="javascript:x">4</a>'
        '<a href="mailto:x">5</a><a href="#top">6</a><!-- <a href="/no">7</a> --><abbr href="/no"><a href="two.html#z">8</a>'
        "<a href='../up'>9</a><a name=x>10</a><a href=\"\">11</a><a href=\"ftp://x/y\">12</a>"
    )
    page = spark.createDataFrame([(1, "https://base.com/dir/", html)], ["id", "url", "html"])
    rows = {r.link: r.nofollow for r in T.distinct_links(page, ["id"]).collect()}
    assert rows == {
        "https://base.com/one": False,
        "https://base.com/dir/two.html": True,
        "https://x.com/": False,
        "https://base.com/up": False,
    }
    assert T.links(page, ["id"]).filter("link like '%#%'").count() == 2


def test_tables_lists_and_citations(spark):
    html = (
        "<table><thead><tr><th>Name</th><th>Value</th></tr></thead><tbody><tr><td>A<sup class=reference>[1]</sup></td><td>1</td></tr>"
        "<tr><td>B</td><td>2.5</td><td>extra</td></tr><tr><th>only</th></tr></tbody></table><ul><li>x<li>y</ul>"
        "<table><tr><td>h1<td></tr><tr><td>1<td> 2 </tr></table>"
    )
    page = spark.createDataFrame([(1, "https://en.wikipedia.org/w", html)], ["id", "url", "html"])
    rows = [tuple(r) for r in H.read_html(page, ["id"], url="url").orderBy("row").select("Name", "Value").collect()]
    assert rows == [("A", 1.0), ("B", 2.5)]
    plain = H.read_html(page, ["id"]).orderBy("row").collect()
    assert plain[0]["Name"] == "A[1]"
    second = H.read_html(page, ["id"], "table", 2)
    assert second.columns == ["id", "row", "h1", "column2"]
    assert [tuple(r) for r in second.orderBy("row").select("h1", "column2").collect()] == [("h1", None), ("1", 2)]
    assert [r["item"] for r in H.read_html(page, ["id"], "ul").orderBy("row").collect()] == ["x", "y"]
    with pytest.raises(ValueError):
        H.table_struct("dom", "table", 0)


@pytest.mark.parametrize(
    ("script", "columns", "rows"),
    [
        ("v = [{b: 1, a: 'x'}, {a: null, c: [1]}]", ["a", "b", "c"], [("x", 1, None), (None, None, "[1]")]),
        ("v = [1.123456789, 2]", ["value"], [(1.123456789,), (2.0,)]),
        ("v = {k: 'x', n: 2}", ["key", "value"], [("k", "x"), ("n", "2")]),
        ("v = 'one'", ["value"], [("one",)]),
    ],
)
def test_script_values_as_tables(spark, script, columns, rows):
    page = spark.createDataFrame([(1, f"<script>{script}</script>")], ["id", "html"])
    got = H.read_html(page, ["id"], "@$v").orderBy("row")
    assert got.columns == ["id", "row", *columns]
    assert [tuple(r) for r in got.select(*columns).collect()] == rows


def test_article_skips_navigation(value):
    body = "".join(f"<p>Sentence number {i}, with some words, and more of them to read.</p>" for i in range(5))
    html = f"<title>T &amp; t</title><nav><p>Menu, with, many, commas, that should never be chosen at all</p></nav><div id=main>{body}</div><div class=sidebar><p>Buy, buy, buy, buy, buy, buy, buy, buy, now please!</p></div>"
    got = value(html, lambda: A.article("html", "dom"))
    assert got.title == "T & t" and got.content == body
    assert got.text_content.startswith("Sentence number 0") and "Buy" not in got.text_content
    assert got.length == len(got.text_content.encode()) and got.excerpt.endswith("...") and len(got.excerpt) == 203


def test_arrow_paths(value):
    text = F.lit('{"a":{"b":[10,{"c":null}]},"s":"x"}')
    cases = {"->'a'->'b'->>0": "10", "->a->b": '[10,{"c":null}]', "->>'s'": "x", "->'s'": '"x"', "->'a'->>1": "", "": ""}
    for path, expected in cases.items():
        assert value("", lambda p=path: J.arrow(text, p)) == expected
    assert value("", lambda: J.arrow(F.lit("{bad"), "->'a'")) == ""


def test_html_struct_prunes_parts(spark):
    page = spark.createDataFrame([("<p>x", "text/html")], ["body", "kind"]).withColumn("dom", D.parse("body"))
    held = page.select(E.page_struct("body", "kind", "dom", parts=("opengraph",)).alias("h"))
    row = held.first()["h"]
    assert row.document == "<p>x" and row.js is None and row.opengraph is None and row.schema is None
    plan = held.select("h.document")._jdf.queryExecution().optimizedPlan().toString()
    assert "_parse" not in plan


def test_normalised_urls(value):
    cases = {
        "HTTP://Example.COM:80/a/?b=2&utm_source=x&a=1#f": "http://example.com/a?a=1&b=2",
        "https://example.com/?fbclid=1": "https://example.com",
        "https://e.com:443/%7Ex/%2e": "https://e.com/~x/.",
        "not a url": "not a url",
    }
    for given, expected in cases.items():
        assert value("", lambda u=given: U.normalise(F.lit(u))) == expected


def test_unclosed_openers_are_read_once(spark):
    """A page of unclosed openers takes time in proportion to its length."""
    import time

    openers = ["<!-- x ", "<script>", "<script ", "<style>", '<a "', "<a href=", "<meta '"]
    pages = spark.createDataFrame([(k, "http://e.example/", o * (300_000 // len(o))) for k, o in enumerate(openers)], "id int, url string, html string")
    T.distinct_links(pages.limit(1), ["id"]).count()
    start = time.perf_counter()
    assert T.distinct_links(pages, ["id"]).count() == 0
    pages.select(T.without_noise("html").alias("t"), T.meta_tags("html").alias("m"), T.title("html").alias("h")).collect()
    assert time.perf_counter() - start < 20


def test_links_on_odd_anchors(spark):
    html = (
        '<a href="/x?a=1&amp;b=2">1</a><a href="/login?next=https://e.com/x">2</a><a title="a > b" href="/gt">3</a>'
        '<a href="/a/../b?p=../c">4</a><a href="?p=2">5</a><a href="ftp://e.com/">6</a><a href=\'//cdn.example/"q"\'>7</a><a href="/cut'
    )
    page = spark.createDataFrame([(1, "https://h.example/d/f?old=1#z", html)], "id int, url string, html string")
    found = [r.link for r in T.links(page, ["id"]).orderBy("pos").collect()]
    assert found == [
        "https://h.example/x?a=1&b=2",
        "https://h.example/login?next=https://e.com/x",
        "https://h.example/gt",
        "https://h.example/b?p=../c",
        "https://h.example/d/f?p=2",
        "https://cdn.example/%22q%22",
    ]
    assert "Exchange" not in T.distinct_links(page, ["id"])._jdf.queryExecution().executedPlan().toString()


def test_odd_scripts_only_lose_their_value(spark):
    deep = "[" * 3_000
    scripts = [
        f"<script>var a = {deep}; var b = 1;</script>",
        "<script>var a = 1e999; var b = 12345678901234567890;</script>",
        "<script>var a = '\\u{110000}x'; var b = -0x10;</script>",
        f"<script>var a = {'[' * 900}{']' * 900}; var b = 2.5e3</script>",
        f'<script type="application/ld+json">{deep}</script><script type="application/ld+json">{{"@type": "Thing", "n": 1e999}}</script>'
        '<script type="application/ld+json">{"@type": "Thing", "n": 2}</script><script>var b = 3</script>',
    ]
    pages = spark.createDataFrame(list(enumerate(scripts)), "id int, html string")
    rows = pages.select("id", S.variables("html").alias("v"), S.jsonld("html").alias("j")).orderBy("id").collect()
    assert [r.v.get("b") for r in rows] == [None, "12345678901234567890", "-16", "2500", "3"]
    assert rows[1].v.get("a") is None and rows[2].v["a"] == '"�x"'
    assert "Thing" in str(rows[4].j) and '"n":2' in str(rows[4].j)


def test_tables_of_two_shapes_in_one_read(spark):
    pages = spark.createDataFrame(
        [
            (1, "<table><tr><th>a</th><th>b</th><th>b</th></tr><tr><td>1</td><td>x</td><td>2.5</td></tr><tr><td>2</td></tr></table>"),
            (2, "<table><tr><th>b</th><th>c</th></tr><tr><td>7</td><td> 8 </td></tr></table>"),
            (3, "<p>no table</p>"),
        ],
        "id int, html string",
    )
    found = H.read_html(pages, ["id"])
    assert found.dtypes == [("id", "int"), ("row", "int"), ("a", "bigint"), ("b", "string"), ("c", "bigint"), ("b_1", "double")]
    assert sorted(tuple(r) for r in found.collect()) == [(1, 0, 1, "x", None, 2.5), (1, 1, 2, None, None, None), (2, 0, None, "7", 8, None)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "pivot" not in plan.lower() and "Exchange" not in plan


def test_selectors_of_siblings_and_places(spark):
    page = (
        "<ul><li class=a>1</li><li>2</li><li class=b>3</li><li>4</li><li>5</li></ul><p>x</p><ol><li>6</li></ol>"
        "<div><section><p>in</p></section><p>low</p></div>"
    )
    frame = spark.createDataFrame([(page,)], "html string")
    wanted = {
        ".a + li": ["2"],
        ".a ~ li": ["2", "3", "4", "5"],
        ".a ~ li + li": ["3", "4", "5"],
        "ul + p": ["x"],
        "ul ~ ol > li": ["6"],
        "li:nth-child(odd)": ["1", "3", "5", "6"],
        "li:nth-child(even)": ["2", "4"],
        "li:nth-child(3n+2)": ["2", "5"],
        "li:nth-child(-n+2)": ["1", "2", "6"],
        "li:nth-child(n+4)": ["4", "5"],
        "li:nth-child( 2 )": ["2"],
        "li:nth-child(0n+3)": ["3"],
        "li:only-child": ["6"],
        "li:is(.a, .b)": ["1", "3"],
        "ul li:not(.a, .b):not(:last-child)": ["2", "4"],
        "div p": ["in", "low"],
        "div > p, ol li": ["6", "low"],
        "div section > p": ["in"],
        "div section + p": ["low"],
        "* * p, body div * ol * li, ul ~ p ~ div section p": ["in"],
        "li:nth-child(x)": [],
        "li:is(ul li)": [],
        "li >": [],
    }
    found = frame.select(*[D.all_texts("html", s).alias(f"c{k}") for k, s in enumerate(wanted)]).first()
    assert {s: found[f"c{k}"] for k, s in enumerate(wanted)} == wanted


def test_selectors_equal_a_walk_up_the_tree(spark):
    chance = random.Random(4)
    tags = ["div", "p", "b", "i"]

    def grow(depth):
        out = ""
        for _ in range(chance.randint(0, 4)):
            tag = chance.choice(["div", "b", "i"])
            out += f"<{tag}>{grow(depth - 1) if depth else 't'}</{tag}>"
        return out

    pages = [grow(6) for _ in range(40)]
    frame = spark.createDataFrame(list(enumerate(pages)), "id int, html string").withColumn("dom", D.parse("html"))
    pairs = [(a, b) for a in tags for b in tags]
    picked = frame.select("dom.nodes", *[F.transform(D.select("dom", f"{a} {b}"), lambda n: n["id"]).alias(f"{a}_{b}") for a, b in pairs])
    for r in picked.collect():
        nodes = r["nodes"]

        def above(n):
            while n["parent"] >= 0:
                n = nodes[n["parent"]]
                yield n["tag"]

        for a, b in pairs:
            assert r[f"{a}_{b}"] == [n["id"] for n in nodes if n["tag"] == b and a in above(n)]


def test_many_outermost_elements(spark):
    page = "<ul>" + "<li><b>x<i>y</i></b></li>" * 1_500 + "</ul><b>z</b>"
    frame = spark.createDataFrame([(page,)], "html string").withColumn("dom", D.parse("html"))
    found = frame.select(
        F.size(D.select("dom", "li i")).alias("i"), F.size(D.select("dom", "li > b > i")).alias("c"), F.size(D.select("dom", "ul b")).alias("b")
    ).first()
    assert tuple(found) == (1_500, 1_500, 1_500)


def test_deep_pages_stay_small(spark):
    depth = 100_000
    pages = {
        "open": "<b>" * depth + "x",
        "closed": "<div>" * depth + "x" + "</div>" * depth,
        "stray": "<td>" + "<i>" * depth + "</b>" * depth + "x",
        "paragraphs": "<p><i>" * (depth // 2) + "x",
        "quotes": "<a b='" * depth,
        "opens": "<!" * depth + "</script" * depth,
    }
    frame = spark.createDataFrame(list(pages.items()), "id string, html string").withColumn("dom", D.parse("html"))
    sizes = {r[0]: tuple(r)[1:] for r in frame.select("id", F.size("dom.nodes"), F.length(F.to_json("dom"))).collect()}
    assert sizes["open"][0] == sizes["closed"][0] == depth and sizes["stray"][0] == depth + 1
    assert all(length < 300 * depth for _, length in sizes.values())
    inner = frame.select("id", F.size(D.select("dom", "b b")).alias("b"), F.size(D.select("dom", "div > div")).alias("d"), F.size(D.select("dom", "td i i")).alias("i"))
    assert {r["id"]: (r["b"], r["d"], r["i"]) for r in inner.collect()} == {
        "open": (depth - 1, 0, 0), "closed": (0, depth - 1, 0), "stray": (0, 0, depth - 1), "paragraphs": (0, 0, 0), "quotes": (0, 0, 0), "opens": (0, 0, 0)
    }


def test_tags_without_an_end_take_the_rest(spark):
    pages = ["<p>a</p><b class='x", "<p>a</p><b x=1", "<p>a</p><!doctype", "<p>a</p><!-- b <i>c</i>", "<p>a</p>1 < 2 <b>c</b>"]
    frame = spark.createDataFrame([(p,) for p in pages], "html string").withColumn("dom", D.parse("html"))
    tags = [[n["tag"] for n in r[0]] for r in frame.select("dom.nodes").collect()]
    assert tags == [["p"], ["p"], ["p"], ["p"], ["p", "b"]]


def test_references_of_attributes(spark):
    chance = random.Random(6)
    odd = ["&", "&#", "&#x", "&#0;", "&#x110000;", "&#99999999;", "&#xD800;", "&#128;", "&#129;", "&#x9f", "&#65", "&#x41g", "&copy", "&copy=1"]
    odd += ["&copy;=", "&copyx", "&notit;", "&notin;", "&NotEqualTilde;", "&amp;lt;", "&amp", "&eacute;", "&bogus;", "&lt;&gt;&quot;&apos;&nbsp;", "x", "", "é😀"]
    values = odd + ["".join(chance.choices(odd + ["a", "1", ";", "="], k=6)) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    found = frame.select("id", N.decoded("v", in_attribute=True).alias("a"), N.decoded("v").alias("t")).collect()
    for r in found:
        assert r["a"] == N.decoded_attribute(values[r["id"]])
    texts = {values[r["id"]]: r["t"] for r in found}
    assert texts["&copy=1"] == "©=1" and texts["&notit;"] == "¬it;" and texts["&copyx"] == "©x" and texts["&amp;lt;"] == "&lt;"
    pages = [(k, f'<a href="/x?{v}">y</a>', "https://e.example/") for k, v in enumerate(values) if '"' not in v]
    frame = spark.createDataFrame(pages, "id int, html string, url string")
    assert sorted(T.links(frame, ["id", "url"]).collect()) == sorted(E.selected_links(frame, ["id", "url"]).collect())


@pytest.mark.parametrize(
    ("base", "href", "wanted"),
    [
        ("https://E.com", "x", "https://e.com/x"),
        ("HTTP://E.com:80/a/b?q", "?z", "http://e.com/a/b?z"),
        ("https://e.com/a/b/", "../../..", "https://e.com/"),
        ("https://e.com/a/b/c", "..", "https://e.com/a/"),
        ("https://e.com/a/b/c", "%2E%2e/x", "https://e.com/a/x"),
        ("https://e.com/a", "https:b", "https://e.com/b"),
        ("https://e.com/a", "https:/b/../c#f", "https://e.com/c#f"),
        ("https://e.com/a", "http:/b/./c", "http://b/c"),
        ("https://e.com/a", "//H.com", "https://h.com/"),
        ("https://e.com/a", "///h.com/b", "https://h.com/b"),
        ("https://e.com/a", "HTTPS://U:P@H.com:443?x", "https://U:P@h.com/?x"),
        ("https://e.com/a", "https://h.com:8080/a/../..", "https://h.com:8080/"),
        ("https://e.com/a", "ftp://H.com/a/../b", "ftp://H.com/a/../b"),
        ("https://e.com/a", "?a='b'^c{d}", "https://e.com/a?a=%27b%27^c{d}"),
        ("https://e.com/a", "b^c{d}'", "https://e.com/b%5Ec%7Bd%7D'"),
        ("https://e.com/a", "#`x y`", "https://e.com/a#%60x%20y%60"),
        ("https://e.com/a", "b%zz%20", "https://e.com/b%zz%20"),
        ("https://e.com/a/b", " c\\d?e\\f ", "https://e.com/a/c/d?e\\f"),
        ("https://e.com/a/b", "", ""),
    ],
)
def test_links_by_the_url_standard(spark, base, href, wanted):
    row = spark.createDataFrame([(base, href)], "b string, h string").select(U.resolve("b", "h")).first()
    assert row[0] == wanted


def test_ascii_form_of_a_url(spark):
    row = spark.createDataFrame([("https://e.com/café/%20?q=日本#😀",)], "u string").select(U.ascii_url("u")).first()
    assert row[0] == "https://e.com/caf%C3%A9/%20?q=%E6%97%A5%E6%9C%AC#%F0%9F%98%80"


def test_functions_in_sql_text(spark):
    register(spark)
    register(spark)
    found = spark.sql(
        "SELECT e.* FROM VALUES ('<ul CLASS=x><li>a&amp;b<b>c</b>d<li></ul>'), (NULL), ('') AS p(html), LATERAL page_elements(p.html) e"
    ).collect()
    assert [tuple(r) for r in found] == [
        (0, -1, 0, 4, "ul", {"class": "x"}, ""), (1, 0, 0, 3, "li", {}, "a&bd"), (2, 1, 0, 3, "b", {}, "c"), (3, 0, 1, 4, "li", {}, "")
    ]
    row = spark.sql("SELECT url_host('HTTP://Www.E.com:80/a?b'), url_page('http://e.com/a/b?c'), url_is_usable('ftp://e'), base_host('WWW.e.com')").first()
    assert tuple(row) == ("www.e.com", "/a/b", False, "e.com")
