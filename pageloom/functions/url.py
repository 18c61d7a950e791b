"""URL parts, keys, resolution and normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.columns import ColumnOrName, col, let, strip

MAX_URL_BYTES = 8192


def _after_scheme(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)


def _has_scheme(url: Column) -> Column:
    return F.contains(url, F.lit("://"))


def validation_error(url: ColumnOrName) -> Column:
    """Why a URL cannot be looked up; an empty string for a usable URL."""
    url = col(url)
    rest = F.regexp_replace(url, r"^(?i:https?://)", "")
    authority = F.when(F.contains(rest, F.lit("/")), F.substring_index(rest, "/", 1)).otherwise(
        F.substring_index(rest, "?", 1)
    )
    host = F.when(F.contains(authority, F.lit("[")), authority).otherwise(
        F.regexp_replace(authority, r":[^:]*$", "")
    )
    return (
        F.when(url == "", "URL is empty")
        .when(F.octet_length(url) > MAX_URL_BYTES, f"URL exceeds maximum length of {MAX_URL_BYTES}")
        .when(~url.rlike(r"^(?i:https?://)"), "URL must start with http:// or https://")
        .when(host == "", "URL has no hostname")
        .when(host.rlike(r"[\x00-\x20\x7f]"), "URL hostname contains invalid character")
        .when(url.isNotNull(), "")
    )


def domain(url: ColumnOrName) -> Column:
    """Authority up to the first slash without port; letter case is kept."""
    return F.substring_index(F.regexp_extract(col(url), r"(?s)^.*?://([^/]*)", 1), ":", 1)


def path(url: ColumnOrName) -> Column:
    """Path with query and fragment, ``/`` if the URL has none."""
    return F.concat(F.lit("/"), F.regexp_extract(col(url), r"(?s)^.*?://[^/]*/(.*)$", 1))


def host(url: ColumnOrName) -> Column:
    """Lower-case host; ends at the first slash, else at ``?``, else at ``#``."""
    authority = F.regexp_extract(col(url), r"(?s)^.*?://([^/]*(?=/)|[^/?]*(?=\?)|[^/#]*)", 1)
    return F.lower(F.substring_index(authority, ":", 1))


def bare_path(url: ColumnOrName) -> Column:
    """Path without query and fragment."""
    return F.concat(F.lit("/"), F.regexp_extract(col(url), r"(?s)^.*?://[^/]*/([^?]*(?=\?)|[^?#]*)", 1))


def base_domain(hostname: ColumnOrName) -> Column:
    """Lower-case host without a leading ``www.``."""
    return F.regexp_replace(F.lower(col(hostname)), r"^www\.(.)", "$1")


def same_domain(url: ColumnOrName, base: ColumnOrName, subdomains: bool = False) -> Column:
    """Whether a URL belongs to a base domain, optionally with its subdomains."""
    url_host = host(url)
    wanted = base_domain(base)
    same = base_domain(url_host) == wanted
    if subdomains:
        same = same | F.endswith(url_host, F.concat(F.lit("."), wanted))
    return (url_host != "") & same


def _reversed_labels(authority: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.substring_index(authority, ":", 1)), r"^www\.", "")
    return F.array_join(F.reverse(F.split(bare, r"\.")), ",")


def surt(url: ColumnOrName) -> Column:
    """Sort-friendly key: reversed host labels, ``)``, then the path."""
    url = col(url)
    rest = _after_scheme(url)
    tail = F.regexp_extract(rest, r"(?s)(/.*)$", 1)
    key = F.concat(
        _reversed_labels(F.substring_index(rest, "/", 1)),
        F.lit(")"),
        F.when(tail == "", "/").otherwise(tail),
    )
    return F.when(_has_scheme(url), key).otherwise(url)


def domain_surt(hostname: ColumnOrName) -> Column:
    """The host part of :func:`surt`."""
    hostname = col(hostname)
    return F.when(hostname == "", "").otherwise(F.concat(_reversed_labels(hostname), F.lit(")")))


def fold_dots(full_path: ColumnOrName) -> Column:
    """Resolve ``.``, ``..`` and empty segments of an absolute path."""
    full_path = col(full_path)
    kept = F.aggregate(
        F.split(full_path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when((part == "..") & (F.size(done) > 0), F.slice(done, F.lit(1), F.size(done) - 1))
        .when(part == "..", done)
        .otherwise(F.array_append(done, part)),
    )
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    slash = (F.length(full_path) > 1) & F.endswith(full_path, F.lit("/")) & ~F.endswith(joined, F.lit("/"))
    folded = F.when(slash, F.concat(joined, F.lit("/"))).otherwise(joined)
    # Most paths have nothing to fold and skip the array work.
    return F.when(full_path.rlike(r"//|/\.{1,2}(/|$)"), folded).otherwise(full_path)


_OWN_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def has_own_scheme(href: ColumnOrName) -> Column:
    """Whether a link names its scheme itself; ``://`` further on, as in a query, does not count."""
    return col(href).rlike(_OWN_SCHEME)


_DOT = r"(?:\.|%2[eE])"


def without_dots(full_path: ColumnOrName) -> Column:
    """Remove ``.`` and ``..`` segments of an absolute path as the URL standard does; empty segments stay."""
    full_path = col(full_path)
    one, two = (lambda part: part.rlike(rf"^{_DOT}\z")), (lambda part: part.rlike(rf"^{_DOT}{_DOT}\z"))
    kept = F.aggregate(
        F.split(F.substring(full_path, 2, 1 << 30), "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(one(part), done)
        .when(two(part), F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    open_end = full_path.rlike(rf"/{_DOT}{{1,2}}\z") & ~F.endswith(joined, F.lit("/"))
    folded = F.when(open_end, F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(full_path.rlike(rf"/{_DOT}{{1,2}}(?:/|\z)"), folded).otherwise(full_path)


# Characters that may not stand in a part of a URL and become percent codes.
_NOT_IN_PATH = r"\x00-\x20\x22<>\x5E`{}\x7F"
_NOT_IN_QUERY = r"\x00-\x20\x22'<>\x7F"
_NOT_IN_FRAGMENT = r"\x00-\x20\x22<>`\x7F"
# What may stand everywhere and is no backslash; most links are made of these.
_PLAIN_LINK = r"^[^\x00-\x20\x22'<>\x5C\x5E`{}\x7F]*+\z"


def _percent_coded(text: Column, unsafe: str) -> Column:
    parts = F.regexp_extract_all(text, F.lit(f"[{unsafe}]++|[^{unsafe}]++"), F.lit(0))
    code = lambda part: F.regexp_replace(F.hex(F.encode(part, "UTF-8")), "(..)", "%$1")
    every = F.transform(parts, lambda part: F.when(part.rlike(f"^[{unsafe}]"), code(part)).otherwise(part))
    return F.array_join(every, "")


def ascii_url(url: ColumnOrName) -> Column:
    """A URL with percent codes for all characters outside ASCII; host names are not put into their ASCII form."""
    return _percent_coded(col(url), r"\x80-\x{10FFFF}")


def cleaned(href: ColumnOrName) -> Column:
    """A link as the URL standard reads it: no blanks around it, no line breaks, ``/`` for a
    backslash, and percent codes for ASCII characters that may not stand in a URL.

    Characters outside ASCII stay as they are written (:func:`ascii_url` codes them), so links
    meet the URLs of a store that has them in this form.
    """
    href = col(href)

    def coded(text: Column) -> Column:
        head = F.regexp_replace(F.regexp_extract(text, r"(?s)^([^?#]*+)", 1), r"\\", "/")
        front = F.regexp_extract(head, r"(?s)^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*+)?)", 1)
        return F.concat(
            front,
            _percent_coded(F.substring(head, F.length(front) + 1, F.length(head)), _NOT_IN_PATH),
            _percent_coded(F.regexp_extract(text, r"(?s)^[^?#]*+(\?[^#]*+)", 1), _NOT_IN_QUERY),
            _percent_coded(F.regexp_extract(text, r"(?s)^[^#]*+(#.*)\z", 1), _NOT_IN_FRAGMENT),
        )

    bare = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+\z", ""), r"[\t\r\n]", "")
    return F.when(href.rlike(_PLAIN_LINK), href).otherwise(let(bare, coded))


def _authority(text: Column, scheme: Column) -> Column:
    """User as it is, host in lower case, no default or empty port."""
    user = F.regexp_extract(text, r"(?s)^(.*@)", 1)
    place = F.lower(F.substring(text, F.length(user) + 1, F.length(text)))
    port = F.when(scheme == "http", F.regexp_replace(place, r":(?:0*80)?\z", ""))
    spelled = F.concat(user, port.when(scheme == "https", F.regexp_replace(place, r":(?:0*443)?\z", "")).otherwise(place))
    return F.when(text.rlike(r"^[a-z0-9.\-]*+\z"), text).otherwise(spelled)


def absolute(url: ColumnOrName) -> Column:
    """One spelling of an absolute http(s) URL: case of scheme and host, default port, dot segments, a path."""
    url = col(url)
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z]+):", 1))
    authority = F.regexp_extract(url, r"(?s)^[A-Za-z]+:/*+([^/?#]*+)", 1)
    own_path = F.regexp_extract(url, r"(?s)^[A-Za-z]+:/*+[^/?#]*+([^?#]*+)", 1)
    tail = F.regexp_extract(url, r"(?s)^[^?#]*+(.*)\z", 1)
    full = F.when(own_path == "", "/").otherwise(without_dots(own_path))
    spelled = F.concat(scheme, F.lit("://"), _authority(authority, scheme), full, tail)
    plain = url.rlike(r"^https?://[a-z0-9.\-]++/") & ~url.rlike(rf"/{_DOT}{{1,2}}(?:[/?#]|\z)")
    return F.when(plain, url).otherwise(spelled)


def base_parts(base: ColumnOrName) -> Column:
    """``struct(scheme, origin, folder, page)`` of a page URL, for :func:`resolve_at`.

    Worked out once per page, however many links the page has.
    """
    base = col(base)
    read = F.struct(
        F.lower(F.regexp_extract(base, r"(?s)^(.*?)://", 1)).alias("scheme"),
        F.regexp_extract(base, r"(?s)^.*?://([^/?#]*)", 1).alias("authority"),
        F.regexp_extract(base, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1).alias("path"),
        # As the page spells it, for the older rule.
        F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1).alias("written"),
    )
    folder = lambda path: F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))

    def parts(own: Column, page: Column) -> Column:
        origin = F.concat(own["scheme"], F.lit("://"), _authority(own["authority"], own["scheme"]))
        return F.struct(
            F.when(_has_scheme(base), F.concat(own["scheme"], F.lit(":"))).otherwise("https:").alias("scheme"),
            F.when(_has_scheme(base), origin).otherwise("").alias("origin"),
            folder(page).alias("folder"),
            page.alias("page"),
            own["written"].alias("written"),
            folder(own["path"]).alias("written_folder"),
        )

    page = lambda own: F.when(own["path"] == "", "/").otherwise(without_dots(own["path"]))
    return let(read, lambda own: let(page(own), lambda p: parts(own, p)))


def _older_link(base: Column, href: Column) -> Column:
    return (
        F.when(href == "", "")
        .when(_has_scheme(href), href)
        .when(F.startswith(href, F.lit("//")), F.concat(F.substring_index(base["written"], "//", 1), href))
        .when(base["written"] == "", "")
        .when(F.startswith(href, F.lit("/")), F.concat(base["written"], href))
        .otherwise(F.concat(base["written"], fold_dots(F.concat(base["written_folder"], href))))
    )


def is_web_base(base: Column) -> Column:
    """Whether a page of these :func:`base_parts` has an http(s) URL."""
    return base["scheme"].isin("http:", "https:")


def _may_have_dots(href: Column) -> Column:
    """A plain test ahead of the pattern of dot segments: what it refuses has none."""
    found = F.contains(href, F.lit("/.")) | F.contains(href, F.lit("/%2"))
    return found | F.startswith(href, F.lit(".")) | F.startswith(href, F.lit("%2"))


def resolve_at(base: Column, href: Column, standard: bool = True) -> Column:
    """:func:`resolve` for a :func:`cleaned` link (trimmed, for the older rule) and the parts of its page URL."""
    if not standard:
        return _older_link(base, href)
    # Most links need nothing but the front of the page put before them.  The rest is kept
    # out of the generated code, which would grow too large to be compiled.
    rooted, hosted = F.startswith(href, F.lit("/")), F.startswith(href, F.lit("//"))
    dotless = ~(_may_have_dots(href) & href.rlike(rf"(?:^|/){_DOT}{{1,2}}(?:[/?#]|\z)"))
    here = dotless & (base["origin"] != "")
    return (
        F.when(rooted & ~hosted & here, F.concat(base["origin"], href))
        .when(hosted & is_web_base(base) & href.rlike(r"^//[a-z0-9.\-]++/") & dotless, F.concat(base["scheme"], href))
        .when(dotless & href.rlike(r"^https?://[a-z0-9.\-]++/"), href)
        .when(here & href.rlike(r"^[A-Za-z0-9_~%\-][^:/?#]*+(?:[/?#]|\z)"), F.concat(base["origin"], base["folder"], href))
        .otherwise(let(F.struct(base.alias("base"), href.alias("href")), lambda p: _resolved(p["base"], p["href"])))
    )


def _resolved(base: Column, href: Column) -> Column:
    link_path = F.regexp_extract(href, r"^([^?#]*+)", 1)
    tail = F.regexp_extract(href, r"(?s)^[^?#]*+(.*)\z", 1)
    whole = F.when(F.startswith(link_path, F.lit("/")), link_path).otherwise(F.concat(base["folder"], link_path))
    return (
        F.when(href == "", "")
        .when(href.rlike("^(?i:https?)://"), absolute(href))
        .when(has_own_scheme(href), F.when(href.rlike("^(?i:https?):"), _schemed(base, href)).otherwise(href))
        .when(F.startswith(href, F.lit("//")), absolute(F.concat(base["scheme"], href)))
        .when(base["origin"] == "", "")
        .when(link_path == "", F.concat(base["origin"], base["page"], tail))
        .otherwise(F.concat(base["origin"], without_dots(whole), tail))
    )


def _schemed(base: Column, href: Column) -> Column:
    """A link like ``https:x`` or ``https:/x``: a part of the same site under the scheme of the page, else a host."""
    own, rest = F.lower(F.regexp_extract(href, "^([A-Za-z]+:)", 1)), F.regexp_extract(href, "(?s)^[A-Za-z]+:(.*)", 1)
    link_path = F.regexp_extract(rest, r"^([^?#]*+)", 1)
    whole = F.when(F.startswith(link_path, F.lit("/")), link_path).otherwise(F.concat(base["folder"], link_path))
    here = F.when(link_path == "", base["page"]).otherwise(without_dots(whole))
    there = absolute(F.concat(own, F.lit("//"), F.regexp_replace(rest, "^/+", "")))
    local = F.concat(base["origin"], here, F.substring(rest, F.length(link_path) + 1, F.length(rest)))
    return F.when((own == base["scheme"]) & (base["origin"] != ""), local).otherwise(there)


def resolve(base: ColumnOrName, href: ColumnOrName, standard: bool = True) -> Column:
    """Absolute URL of a link found on ``base``; an empty string if there is none.

    The standard rule reads a link as the URL standard does: scheme and host in lower case,
    no default port, dot segments of every path removed, percent codes for characters that
    may not stand in a URL (:func:`cleaned`); the file name of the base stays for a ``?query``
    or ``#fragment`` link, and a scheme counts only at the front.
    The other rule drops that file name, folds empty segments too, takes an absolute
    path as it is, and a ``://`` anywhere for a scheme.
    """
    link = cleaned(href) if standard else strip(col(href))
    return let(F.struct(base_parts(base).alias("base"), link.alias("href")), lambda p: resolve_at(p["base"], p["href"], standard))


def without_fragment(url: ColumnOrName) -> Column:
    return F.substring_index(col(url), "#", 1)


# Query parameters that do not change the page.
TRACKING_PARAMETER = r"^(utm_[^=]*|fbclid|gclid|msclkid)(=|$)"


def normalise(url: ColumnOrName) -> Column:
    """One spelling per page: lower-case host, no default port, fragment,
    tracking parameters or trailing slash, and sorted query parameters."""
    bare = without_fragment(url)
    scheme = F.lower(F.regexp_extract(bare, r"^([A-Za-z]+)://", 1))
    authority = F.lower(F.regexp_extract(bare, r"^[A-Za-z]+://([^/?]*)", 1))
    authority = F.when(scheme == "http", F.regexp_replace(authority, ":80$", "")).otherwise(
        F.regexp_replace(authority, ":443$", "")
    )
    page = F.regexp_replace(F.regexp_extract(bare, r"^[A-Za-z]+://[^/?]*([^?]*)", 1), "/+$", "")
    # Percent codes of unreserved marks are spelled out.
    for code, mark in (("2[dD]", "-"), ("2[eE]", "."), ("5[fF]", "_"), ("7[eE]", "~")):
        page = F.regexp_replace(page, f"%{code}", mark)
    query_text = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_sort(
        F.filter(F.split(query_text, "&"), lambda p: (p != "") & ~p.rlike(TRACKING_PARAMETER))
    )
    query_part = F.when(query_text == "", "").otherwise(
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    )
    whole = F.concat(scheme, F.lit("://"), authority, page, query_part)
    return F.when(scheme == "", bare).otherwise(whole)
