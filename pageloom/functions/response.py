"""Status, header and body rules of page responses as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.columns import ColumnOrName, col

DEFAULT_MAX_BYTES = 10485760


def error_class(status: ColumnOrName, message: ColumnOrName) -> Column:
    """Class of a failed response, empty for a response without an error."""
    status, message = col(status), F.coalesce(col(message), F.lit(""))
    return (
        F.when(status == 429, "http_rate_limited")
        .when(status.between(500, 599), "http_server_error")
        .when(status.between(400, 499), "http_client_error")
        .when(status > 0, "")
        .when(message.rlike("[tT]imeout"), "network_timeout")
        .when(message.rlike("DNS|resolve"), "network_dns_failure")
        .when(message.rlike("SSL|certificate"), "network_ssl_error")
        .when(message.rlike("refused|connect"), "network_connection_refused")
        .when(status.isNotNull(), "network_timeout")
    )


def is_success(status: ColumnOrName) -> Column:
    return col(status).between(200, 299)


def is_retryable(status: ColumnOrName) -> Column:
    """Network failures and 500-504; a 429 blocks the domain instead."""
    status = col(status)
    return (status <= 0) | status.between(500, 504)


def retry_after_ms(header: ColumnOrName) -> Column:
    """Whole seconds of a Retry-After header in milliseconds, 0 if it has none or too many."""
    seconds = F.regexp_extract(F.coalesce(col(header), F.lit("")), r"^\s*([+-]?[0-9]+)", 1)
    return F.coalesce(F.try_multiply(seconds.try_cast("long"), F.lit(1000)), F.lit(0).cast("long"))


def is_html(content_type: ColumnOrName, body: ColumnOrName) -> Column:
    kind = col(content_type)
    return (
        (F.contains(kind, F.lit("text/html")) | F.contains(kind, F.lit("application/xhtml")))
        & (F.length(col(body)) > 0)
    )


def _media_type(content_type: Column) -> Column:
    return F.lower(F.regexp_replace(F.substring_index(content_type, ";", 1), r"^\s+|\s+$", ""))


def content_type_matches(content_type: ColumnOrName, pattern: str) -> Column:
    """Match ``type/subtype`` or ``type/*`` against a content type."""
    media, pattern = _media_type(col(content_type)), pattern.strip().lower()
    if not pattern:
        return F.lit(False)
    if pattern.endswith("/*"):
        return F.startswith(media, F.lit(pattern[:-1]))
    return media == pattern


def content_type_accepted(
    content_type: ColumnOrName, accept: list[str] | None = None, reject: list[str] | None = None
) -> Column:
    """Must match one of ``accept`` when given and none of ``reject``."""

    def any_of(patterns: list[str]) -> Column:
        result = F.lit(False)
        for pattern in patterns:
            result = result | content_type_matches(content_type, pattern)
        return result

    verdict = any_of(accept) if accept else F.lit(True)
    return verdict & ~any_of(reject) if reject else verdict


def content_hash(body: ColumnOrName) -> Column:
    body = col(body)
    return F.when(body == "", "").otherwise(F.sha2(body, 256))


def server_date(header: ColumnOrName, as_of: Column, tolerance_minutes: int = 15) -> Column:
    """HTTP date as ``yyyy-MM-dd HH:mm:ss``; empty if unreadable or far from ``as_of``."""
    stamp = F.regexp_extract(
        col(header), r"^[^,]+, ([0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}:[0-9]{2})", 1
    )
    parsed = F.try_to_timestamp(stamp, F.lit("d MMM yyyy HH:mm:ss"))
    seconds = F.unix_timestamp(parsed) - F.unix_timestamp(as_of.cast("timestamp"))
    near = F.abs(seconds) <= tolerance_minutes * 60
    return F.when(near, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")).otherwise("")


def size_limited(body: ColumnOrName, limit: int = DEFAULT_MAX_BYTES) -> Column:
    """Struct of the body and the error of the size rule; one of them is NULL."""
    body = col(body)
    over = F.octet_length(body) > limit
    return F.struct(
        F.when(~over, body).alias("body"),
        F.when(over, "content_too_large").alias("error"),
    )


def without_noindex(body: ColumnOrName, noindex: Column) -> Column:
    """Body of a page unless its robots meta tag forbids indexing."""
    return F.when(~noindex, col(body))
