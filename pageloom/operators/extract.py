"""Extraction bundles: several fields of a page from one parse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import article as A
from pageloom.functions import dom as D
from pageloom.functions import fields as FL
from pageloom.functions import json_path as J
from pageloom.functions import response as R
from pageloom.functions import script_vars as S
from pageloom.functions import tags as T
from pageloom.functions import url as U
from pageloom.functions.columns import let, unpack
from pageloom.functions.htmlpath import json_object
from pageloom.session import cut_lineage


@dataclass(frozen=True)
class Spec:
    """One field: a source, where to look in it, and what to do with the value.

    Sources: ``jsonld``, ``microdata``, ``og``, ``meta``, ``js``, ``css``, ``regex``.
    ``path`` starts with the type, property or variable name.
    """

    alias: str
    source: str
    path: str = ""
    selector: str | None = None
    accessor: str = "text"
    pattern: str | None = None
    as_text: bool = True
    json_cast: bool = False
    json_path: str | None = None
    expand: bool = False
    array_field: str | None = None
    alternatives: tuple[Spec, ...] = ()
    transforms: tuple[str, ...] = ()
    type: str = "VARCHAR"
    default: str | None = None
    required: bool = False
    parts: tuple[str, ...] = field(default=())

    def path_parts(self) -> list[str]:
        return list(self.parts) or J.split_path(self.path)


def css(alias: str, selector: str, **options: object) -> Spec:
    """CSS field; ``sel::text`` and ``sel::attr(name)`` set the accessor."""
    base, mark, tail = selector.partition("::")
    if mark:
        accessor = f"attr:{tail[5:-1]}" if tail.startswith("attr(") else tail
        return Spec(alias, "css", selector=base, accessor=accessor, **options)
    return Spec(alias, "css", selector=selector, **options)


def regex(alias: str, pattern: str, **options: object) -> Spec:
    return Spec(alias, "regex", pattern=pattern, **options)


_SOURCES = ("jsonld", "microdata", "og", "meta", "js")


def _used(specs: Sequence[Spec]) -> set[str]:
    found = set()
    for spec in specs:
        found.add(spec.source)
        found |= _used(spec.alternatives)
    return found


def with_sources(pages: DataFrame, specs: Sequence[Spec], html: str = "html") -> DataFrame:
    """Add the structured data the specs need, each part worked out once per page."""
    used = _used(specs)
    if used & {"css", "microdata"}:
        pages = pages.withColumn("_dom", D.parse(html))
    makers = {
        "jsonld": lambda: S.jsonld(html),
        "microdata": lambda: S.microdata("_dom"),
        "og": lambda: T.open_graph(html),
        "meta": lambda: T.meta_tags(html),
        "js": lambda: S.variables(html),
    }
    return pages.withColumns({f"_{name}": makers[name]() for name in _SOURCES if name in used})


def _raw(spec: Spec, html: str) -> Column:
    parts = spec.path_parts()
    if spec.source == "css":
        return D.access(html, spec.selector or "", spec.accessor, "_dom")
    if spec.source == "regex":
        return FL.first_group(html, spec.pattern or "")
    if not parts:
        return F.lit(None).cast("string")
    held = F.try_element_at(F.col(f"_{spec.source}"), F.lit(parts[0]))
    if spec.source in ("og", "meta"):
        return held
    if spec.source in ("jsonld", "microdata"):
        # Values are arrays: the first item, then object keys only.
        keys = "$[0]" + "".join(f"['{p}']" for p in parts[1:])
        found = F.to_json(F.try_variant_get(F.try_parse_json(held), keys, "variant"))
    else:
        found = J.json_at(held, parts[1:])
    return let(found, J.as_text) if spec.as_text else found


def _source_value(spec: Spec, html: str) -> Column:
    return F.coalesce(_raw(spec, html), *[_source_value(a, html) for a in spec.alternatives])


def value_of(spec: Spec, html: str = "html") -> Column:
    """Text value of a spec on a frame made by :func:`with_sources`."""
    parts = J.arrow_parts(spec.json_path)[0] if spec.json_path else []

    def cast(raw: Column) -> Column:
        good = F.try_parse_json(raw).isNotNull()
        at = J.json_at(raw, parts)
        if spec.expand:
            at = F.when(~F.startswith(F.trim(at), F.lit("[")), at)
        return F.when(good, at).otherwise(raw)

    value = _source_value(spec, html)
    if spec.json_cast or spec.expand:
        value = let(value, cast)
    if spec.default is not None:
        value = F.coalesce(value, F.lit(spec.default))
    for name in spec.transforms:
        value = FL.TRANSFORMS[name](value)
    return FL.TYPES[spec.type.upper()](value)


def expanded_of(spec: Spec, html: str = "html") -> Column:
    """Array of texts of an ``expand`` spec; NULL if the value is no array."""
    parts = J.arrow_parts(spec.json_path)[0] if spec.json_path else []

    def spread(raw: Column) -> Column:
        array = J.json_at(raw, parts)
        items = J.array_items(array, [spec.array_field] if spec.array_field else None)
        # A null element reads as the text null.
        return F.transform(items, lambda t: F.coalesce(J.as_text(t), t))

    return let(_source_value(spec, html), spread)


def extract(pages: DataFrame, specs: Sequence[Spec], keep: Sequence[str], html: str = "html") -> DataFrame:
    """``keep`` and one column per spec."""
    sourced = with_sources(pages, specs, html)
    return sourced.select(
        *keep, *[(expanded_of(s, html) if s.expand else value_of(s, html)).alias(s.alias) for s in specs]
    )


def extract_by_rule(
    pages: DataFrame, rules: Sequence[tuple[Column, Sequence[Spec]]], keep: Sequence[str], html: str = "html"
) -> DataFrame:
    """Specs that depend on the page: the first rule whose condition holds decides."""
    every = [s for _, specs in rules for s in specs]
    sourced = with_sources(pages, every, html)
    columns = []
    for alias in dict.fromkeys(s.alias for s in every):
        value = F.lit(None).cast("string")
        for condition, specs in reversed(rules):
            for spec in specs:
                if spec.alias == alias:
                    value = F.when(condition, value_of(spec, html).cast("string")).otherwise(value)
        columns.append(value.alias(alias))
    return sourced.select(*keep, *columns)


def split_required(rows: DataFrame, specs: Sequence[Spec]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required fields, and the rejected ones with the missing names.

    Both come from one table of the fields, which is worked out once: no page is parsed
    again for the other half, or for the test whether a field is missing.
    """
    missing = F.filter(
        F.array(*[F.when(F.col(s.alias).isNull(), s.alias) for s in specs if s.required]).cast("array<string>"),
        lambda m: m.isNotNull(),
    )
    checked = rows.withColumn("missing", missing)
    if not rows.isStreaming:
        checked = cut_lineage(checked)
    return checked.filter(F.size("missing") == 0).drop("missing"), checked.filter(F.size("missing") > 0)


def each_typed(pages: DataFrame, kind: str, keep: Sequence[str], html: str = "html") -> DataFrame:
    """One row per JSON-LD entity of a type, page fields repeated."""
    items = F.filter(S.jsonld_items(html), lambda i: i["key"] == kind)
    return unpack(pages, [*keep], items, "place", "_e").select(
        *keep, "place", F.col("_e.value").alias("entity")
    )


def each_element(
    pages: DataFrame, selector: str, parts: Mapping[str, tuple[str, str]], keep: Sequence[str], html: str = "html"
) -> DataFrame:
    """One row per matching element; ``parts`` maps a name to selector and accessor
    below it, with an empty selector for the element itself."""
    parsed = pages.withColumn("_dom", D.parse(html))
    dom = F.col("_dom")

    def part(root: Column, test: D.Test | None, accessor: str) -> Column:
        if test is None:
            return D._read(F.col(html), dom, root, accessor)
        found = F.get(F.filter(D.descendants(dom, root), lambda n: test(n)), F.lit(0))
        return let(found, lambda n: D._read(F.col(html), dom, n, accessor))

    below = {name: selector_ for name, (selector_, _) in parts.items() if selector_}

    def read(tests: list[D.Test]) -> Column:
        known = dict(zip(below, tests[1:]))
        return F.transform(
            F.filter(dom["nodes"], lambda n: tests[0](n)),
            lambda root: F.struct(*[part(root, known.get(a), accessor).alias(a) for a, (_, accessor) in parts.items()]),
        )

    rows = D.with_tests(dom, [selector, *below.values()], read)
    return unpack(parsed, [*keep], rows, "place", "_e").select(
        *keep, "place", *[F.col(f"_e.{a}").alias(a) for a in parts]
    )


def selected_links(
    pages: DataFrame, keep: Sequence[str], selector: str = "a[href]", base: str = "url", html: str = "html"
) -> DataFrame:
    """Links of the elements a selector picks; see :func:`pageloom.functions.tags.links`."""
    parsed = pages.withColumn("_dom", D.parse(html))
    read = F.transform(
        D.select("_dom", selector),
        lambda n: F.struct(
            U.cleaned(F.coalesce(D.attr(n, "href"), F.lit(""))).alias("href"),
            F.coalesce(F.contains(F.lower(D.attr(n, "rel")), F.lit("nofollow")), F.lit(False)).alias("nofollow"),
        ),
    )
    return T.followable(parsed, [*keep], base, read)


def page_struct(
    body: str, content_type: str, dom: str, parts: Sequence[str] = ("js", "opengraph", "schema", "readability")
) -> Column:
    """The ``html`` struct of a page; parts not asked for, and those of other content
    types, are NULL.  Empty objects are NULL, an empty schema is an empty map."""
    is_html = R.is_html(content_type, body)
    makers = {
        "js": lambda: json_object(S.variables(body)),
        "opengraph": lambda: F.to_json(T.open_graph(body)),
        "schema": lambda: S.schema_map(body, dom),
        "readability": lambda: F.to_json(A.article(body, dom)),
    }
    columns = [F.col(body).alias("document")]
    for name, make in makers.items():
        if name not in parts:
            kind = "map<string,string>" if name == "schema" else "string"
            columns.append(F.lit(None).cast(kind).alias(name))
        elif name == "schema":
            empty = F.create_map().cast("map<string,string>")
            columns.append(F.when(is_html, make()).otherwise(empty).alias(name))
        else:
            columns.append(F.when(is_html, F.nullif(make(), F.lit("{}"))).alias(name))
    return F.struct(*columns)


def bundle(html: str, url: str, columns: Sequence[str] = ("jsonld", "opengraph", "meta", "hydration", "js")) -> list[Column]:
    """The switchable bundle as JSON text columns; only those named are worked out."""
    makers = {
        "jsonld": lambda: json_object(S.first_type_jsonld(html)),
        "opengraph": lambda: F.to_json(T.open_graph(html)),
        "meta": lambda: F.to_json(T.meta_digest(html, url)),
        "hydration": lambda: json_object(S.hydration(html)),
        "js": lambda: json_object(S.state_variables(html)),
    }
    return [makers[name]().alias(name) for name in columns]


def discover(html: str) -> Column:
    """JSON text of what a page offers: ``jsonld``, ``opengraph``, ``js_vars``; empty parts left out."""

    def part(name: str, values: Column) -> Column:
        return F.when(
            F.size(values) > 0,
            F.concat(F.lit(f'"{name}":'), json_object(values) if name != "opengraph" else F.to_json(values)),
        )

    parts = F.array(
        part("jsonld", S.jsonld(html)), part("opengraph", T.open_graph(html)), part("js_vars", S.variables(html))
    )
    kept = F.filter(parts, lambda p: p.isNotNull())
    return F.concat(F.lit("{"), F.array_join(kept, ","), F.lit("}"))


#: Texts worth counting when a new site is looked at; a caller may give others.
PATTERNS = {
    "clock_time": r"\b[0-2]?[0-9]:[0-5][0-9]\b",
    "currency_amount": r"[€$£]\s?[0-9][0-9.,]*|[0-9][0-9.,]*\s?[€£]",
    "ean_code": r"\b[0-9]{13}\b",
    "iso_date": r"\b[0-9]{4}-[0-9]{2}-[0-9]{2}\b",
    "mail_address": r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]+",
    "percentage": r"[0-9]+\s?%",
}


def discovery_report(pages: DataFrame, key: str, html: str = "html", patterns: Mapping[str, str] = PATTERNS) -> DataFrame:
    """Rows ``(key, section, name, n)``: types, og properties, data attributes, patterns.

    The counts of a page are made inside its row, in one pass and without a shuffle.
    """

    def entry(section: str, name: Column, n: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), name.alias("name"), n.cast("long").alias("n"))

    def tally(section: str, names: Column) -> Column:
        def runs(found: Column) -> Column:
            kinds = F.array_distinct(found)
            return F.transform(
                kinds, lambda k: entry(section, k, F.size(F.filter(found, lambda f: f == k)))
            )

        return let(names, runs)

    types = tally("jsonld_type", F.transform(S.jsonld_items(html), lambda i: i["key"]))
    graph = F.transform(F.map_keys(T.open_graph(html)), lambda k: entry("opengraph", k, F.lit(1)))
    data = tally("data_attribute", F.regexp_extract_all(html, F.lit(r"\sdata-([a-z0-9-]+)="), F.lit(1)))
    hits = F.filter(
        F.array(*[entry("pattern", F.lit(n), F.regexp_count(html, F.lit(p))) for n, p in patterns.items()]),
        lambda e: e["n"] > 0,
    )
    found = unpack(pages, [key], F.concat(types, graph, data, hits), "i", "e")
    return found.select(key, "e.section", "e.name", "e.n")
