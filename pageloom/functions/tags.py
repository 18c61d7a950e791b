"""Fields read from single tags of raw HTML, as column expressions only.

These need no document tree: comments are dropped and script and style bodies
blanked, then tags are found by pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import url as U
from pageloom.functions.columns import ColumnOrName, col, first_of, last_wins, let, unpack
from pageloom.functions.entities import decoded

# Attributes up to the end of the tag: a quoted ">" does not end it, an unpaired quote does
# not hide the tag, and an unclosed tag takes the rest of the page, so that it is read once.
_ATTRIBUTES = r"""(?:[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+(?=>|\z)|[^>]*+)(?:>|\z)"""
LINK_TAG = rf"a(?:\s{_ATTRIBUTES}|>)"
META_TAG = rf"meta\s{_ATTRIBUTES}"
HEAD_LINK_TAG = rf"link\s{_ATTRIBUTES}"
# Comments and the bodies of scripts and styles, after the opening angle bracket.  Unclosed
# ones take the rest of the page, so that no start is looked at twice.
_NOISE = r"!--.*?(?:-->|\z)|(?:script|style)\b[^>]*+(?:>.*?(?:</(?:script|style)|\z)|\z)"
# Link targets that are not pages.
SKIPPED_TARGET = r"^(?i:javascript:|mailto:|tel:|data:|#)"


def without_noise(html: ColumnOrName) -> Column:
    """HTML without comments and without the bodies of scripts and styles."""
    text = F.regexp_replace(col(html), r"(?s)<!--.*?(?:-->|\z)", "")
    text = F.regexp_replace(text, r"(?is)(<script\b[^>]*+(?:>|\z)).*?(?:</script|\z)", "$1</script")
    return F.regexp_replace(text, r"(?is)(<style\b[^>]*+(?:>|\z)).*?(?:</style|\z)", "$1</style")


def decode_entities(text: ColumnOrName) -> Column:
    return decoded(text)


def attribute_text(tag: ColumnOrName, name: str) -> Column:
    """Value of an attribute in a start tag, quoted or bare; empty if there is none.

    One pattern with one group serves the three quoting styles.
    """
    value = r"[\"']?((?<=\")[^\"]*|(?<=')[^']*|(?<![\"'])[^\s>\"']+)"
    return F.regexp_extract(col(tag), rf"(?is)[\s\"'/]{name}\s*=\s*{value}", 1)


def attribute(tag: ColumnOrName, name: str) -> Column:
    """:func:`attribute_text` with NULL for an absent or empty attribute."""
    return F.nullif(attribute_text(tag, name), F.lit(""))


def all_tags(html: ColumnOrName, pattern: str) -> Column:
    """Matching start tags without their angle bracket, in page order.

    Comments, scripts and styles are skipped in the same pass over the page.
    """
    found = F.regexp_extract_all(col(html), F.lit(f"<(?is:{_NOISE}|({pattern}))"), F.lit(1))
    return F.filter(found, lambda t: F.endswith(t, F.lit(">")))


def tag_rows(pages: DataFrame, pattern: str, keep: list[str], html: str = "html") -> DataFrame:
    """One row per matching tag with its position on the page."""
    return unpack(pages, keep, all_tags(html, pattern), "pos", "tag")


def links(pages: DataFrame, keep: list[str], base: str = "url", html: str = "html") -> DataFrame:
    """Every followable link: ``keep`` columns, position, absolute URL, nofollow flag.

    Duplicates and fragments are kept; only http(s) targets remain.
    """
    return followable(pages, keep, base, _link_attributes(html))


def _link_attributes(html: ColumnOrName) -> Column:
    """``struct(href, nofollow)`` of every link tag; read inside the array, so later filters do not read it again."""

    def target(tag: Column) -> Column:
        # Each step names its input several times, so that is bound first.
        return let(attribute_text(tag, "href"), lambda raw: let(decoded(raw, in_attribute=True), U.cleaned))

    return F.transform(
        all_tags(html, LINK_TAG),
        lambda t: F.struct(
            target(t).alias("href"),
            F.when(t.rlike("(?i)nofollow"), attribute_text(t, "rel").rlike("(?i)nofollow")).otherwise(False).alias("nofollow"),
        ),
    )


def _is_followable(href: Column, base: Column) -> Column:
    """Whether a link leads to an http(s) page; the scheme is judged where it stands, ahead of resolving."""
    rooted = F.startswith(href, F.lit("/"))  # names no scheme; most links need no pattern
    own_scheme = ~rooted & U.has_own_scheme(href)
    is_web = F.when(own_scheme, href.rlike("^(?i:https?):")).otherwise(U.is_web_base(base) & (base["origin"] != ""))
    return (href != "") & (rooted | ~href.rlike(SKIPPED_TARGET)) & is_web


def followable(pages: DataFrame, keep: list[str], base: str, read: Column) -> DataFrame:
    """Resolved http(s) links of an array of ``struct(href, nofollow)`` per page."""
    # Both go below the explode: beside it they would be worked out once per link.
    prepared = pages.select(*keep, U.base_parts(base).alias("_base"), read.alias("_tags"))
    tags = unpack(prepared, [*keep, "_base"], F.col("_tags"), "pos", "_a")
    hrefs = tags.select(*keep, "_base", "pos", "_a.href", "_a.nofollow")
    link = U.resolve_at(F.col("_base"), F.col("href"))
    return hrefs.filter(_is_followable(F.col("href"), F.col("_base"))).select(*keep, "pos", link.alias("link"), "nofollow")


def distinct_links(
    pages: DataFrame, keep: list[str], base: str = "url", html: str = "html"
) -> DataFrame:
    """Links without fragments, once per row of ``pages``; the first occurrence sets nofollow.

    A page is one row, so its duplicates collapse inside the array and nothing is shuffled.
    """
    prepared = pages.select(*keep, U.base_parts(base).alias("_base"), _link_attributes(html).alias("_tags"))
    placed = F.transform("_tags", lambda t, i: F.struct(t["href"].alias("href"), i.alias("pos"), t["nofollow"].alias("nofollow")))
    good = F.filter(placed, lambda t: _is_followable(t["href"], F.col("_base")))
    resolved = F.transform(
        good,
        lambda t: F.struct(
            U.without_fragment(U.resolve_at(F.col("_base"), t["href"])).alias("link"), t["pos"].alias("pos"), t["nofollow"].alias("nofollow")
        ),
    )
    first = let(
        F.array_sort(resolved),
        lambda rows: F.filter(rows, lambda r, i: F.coalesce(F.get(rows, i - 1)["link"] != r["link"], F.lit(True))),
    )
    found = unpack(prepared.select(*keep, first.alias("_links")), keep, F.col("_links"), "_at", "_l")
    return found.select(*keep, "_l.link", "_l.pos", "_l.nofollow")


def canonical(html: ColumnOrName, base: ColumnOrName) -> Column:
    """Resolved target of the first ``link rel=canonical`` with a target."""
    hrefs = F.transform(
        F.filter(
            all_tags(html, HEAD_LINK_TAG),
            lambda t: F.lower(attribute_text(t, "rel")) == "canonical",
        ),
        lambda t: decode_entities(attribute_text(t, "href")),
    )
    first = first_of(F.filter(hrefs, lambda h: h != ""))
    return let(first, lambda href: U.resolve(base, href))


def _robots_meta(html: ColumnOrName, word: str) -> Column:
    return F.exists(
        all_tags(html, META_TAG),
        lambda t: (F.lower(attribute_text(t, "name")) == "robots")
        & F.contains(F.lower(attribute_text(t, "content")), F.lit(word)),
    )


def has_nofollow(html: ColumnOrName) -> Column:
    return _robots_meta(html, "nofollow")


def has_noindex(html: ColumnOrName) -> Column:
    return _robots_meta(html, "noindex")


def _meta_pairs(html: ColumnOrName, key: str, prefix: str) -> Column:
    """Array of key/value structs of the meta tags with a key and a content."""
    with_content = F.filter(
        all_tags(html, META_TAG), lambda t: t.rlike(r"(?is)[\s\"'/]content\s*=")
    )
    pairs = F.transform(
        with_content,
        lambda t: F.struct(
            attribute_text(t, key).alias("key"), decode_entities(attribute_text(t, "content")).alias("value")
        ),
    )
    named = F.filter(pairs, lambda p: (p["key"] != "") & F.startswith(p["key"], F.lit(prefix)))
    if not prefix:
        return named
    return F.transform(
        named, lambda p: F.struct(F.substring(p["key"], len(prefix) + 1, 1 << 30).alias("key"), p["value"].alias("value"))
    )


def open_graph(html: ColumnOrName) -> Column:
    """Map of ``og:`` properties without their prefix."""
    return last_wins(_meta_pairs(html, "property", "og:"))


def twitter_card(html: ColumnOrName) -> Column:
    return last_wins(_meta_pairs(html, "name", "twitter:"))


def meta_tags(html: ColumnOrName) -> Column:
    """Map of every named meta tag."""
    return last_wins(_meta_pairs(html, "name", ""))


def meta_digest(html: ColumnOrName, base: ColumnOrName) -> Column:
    """Description, keywords, author and robots (any letter case) plus the canonical URL."""
    lowered = F.transform(
        _meta_pairs(html, "name", ""),
        lambda p: F.struct(F.lower(p["key"]).alias("key"), p["value"].alias("value")),
    )
    names = ("description", "keywords", "author", "robots")

    def fields(found: Column) -> Column:
        return F.struct(*(F.try_element_at(found, F.lit(n)).alias(n) for n in names))

    return let(last_wins(lowered), fields).withField("canonical", canonical(html, base))


def title(html: ColumnOrName) -> Column:
    found = F.regexp_extract(col(html), r"(?is)<title[^>]*>\s*(.*?)\s*</title>", 1)
    return let(decode_entities(found), lambda t: F.nullif(t, F.lit("")))


def heading(html: ColumnOrName, level: int = 1) -> Column:
    inner = F.regexp_extract(
        without_noise(html), rf"(?is)<h{level}(?:\s[^>]*)?>\s*(.*?)\s*</h{level}>", 1
    )
    bare = decode_entities(F.regexp_replace(inner, "<[^>]*>", ""))
    return let(bare, lambda t: F.nullif(t, F.lit("")))


def scripts_of_type(html: ColumnOrName, media_type: str) -> Column:
    """Bodies of the script elements of one type, in page order."""
    escaped = media_type.replace("+", r"\+").replace(".", r"\.")
    pattern = rf"(?is)<script\b[^>]*?\stype\s*=\s*[\"']?{escaped}[\"']?(?:\s[^>]*)?>(.*?)</script"
    return F.regexp_extract_all(
        F.regexp_replace(col(html), r"(?s)<!--.*?(?:-->|\z)", ""), F.lit(pattern), F.lit(1)
    )
