"""Response rules over an attempt log built from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import response as R
from pageloom.functions import tags as T
from pageloom.operators.quality import mark_copies
from pageloom.plans.registry import query
from pageloom.sources.tables import response_store, table

# The response each event type stands for.
STATUS = {"view": 200, "click": 304, "purchase": 404, "signup": 429, "error": 503}
MESSAGES = ("Connection timeout", "DNS lookup failed", "SSL handshake failed", "connect refused", "reset")


def attempt_log(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows read as fetch attempts; every seventh one failed on the network."""
    e = table(spark, sf, "events")
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])[F.col("event_type")]
    failed = F.col("event_id") % 7 == 0
    message = F.element_at(
        F.array(*map(F.lit, MESSAGES)), (F.col("event_id") % len(MESSAGES) + 1).cast("int")
    )
    return e.select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(".example")).alias("domain"),
        F.when(failed, 0).otherwise(status).alias("status"),
        F.when(failed, message).otherwise("").alias("error"),
        F.round(F.col("value") * 100).cast("long").alias("ms"),
        F.when(F.col("event_type") == "signup", F.concat((F.col("event_id") % 90).cast("string"), F.lit("s")))
        .when(F.col("event_type") == "error", F.lit("Wed, 21 Oct 2025 07:28:00 GMT"))
        .alias("retry_after"),
        F.col("ts"),
    )


ATTEMPTS = """
WITH attempts AS (
  SELECT event_id AS seq, 'host' || user_id || '.example' AS domain,
    CASE WHEN event_id % 7 = 0 THEN 0 ELSE CASE event_type WHEN 'view' THEN 200 WHEN 'click' THEN 304
      WHEN 'purchase' THEN 404 WHEN 'signup' THEN 429 ELSE 503 END END AS status,
    CASE WHEN event_id % 7 = 0 THEN (['Connection timeout', 'DNS lookup failed', 'SSL handshake failed',
      'connect refused', 'reset'])[CAST(event_id % 5 + 1 AS INTEGER)] ELSE '' END AS error,
    CAST(round(value * 100) AS BIGINT) AS ms,
    CASE event_type WHEN 'signup' THEN (event_id % 90) || 's'
      WHEN 'error' THEN 'Wed, 21 Oct 2025 07:28:00 GMT' END AS retry_after, ts
  FROM events)
"""


ADAPTIVE_DELAYS = (
    ATTEMPTS.replace("WITH attempts", "WITH RECURSIVE attempts")
    + """
, n AS (SELECT domain, seq, ms, ms::DOUBLE AS x, row_number() OVER (PARTITION BY domain ORDER BY seq) AS rn FROM attempts),
f AS (SELECT domain, seq, ms, rn, x AS ema, 1::DOUBLE AS delay FROM n WHERE rn = 1
  UNION ALL SELECT n.domain, n.seq, n.ms, n.rn, 0.2::DOUBLE * x + 0.8::DOUBLE * ema,
    CASE WHEN n.rn >= 3 AND x > 2 * (0.2::DOUBLE * x + 0.8::DOUBLE * ema) THEN least(delay * 1.5::DOUBLE, 60)
      WHEN n.rn >= 3 AND x < 0.5::DOUBLE * (0.2::DOUBLE * x + 0.8::DOUBLE * ema) THEN greatest(delay * 0.9::DOUBLE, 0.5::DOUBLE)
      ELSE delay END FROM f JOIN n ON n.domain = f.domain AND n.rn = f.rn + 1)
SELECT domain, seq, ms, round(ema, 2) AS ema, round(delay, 6) AS delay FROM f"""
)


def rounded_delays(delays: DataFrame) -> DataFrame:
    return delays.select("domain", "seq", "ms", F.round("ema", 2).alias("ema"), F.round("delay", 6).alias("delay"))


@query(
    "u12_error_class",
    ATTEMPTS
    + """
SELECT CASE WHEN status = 429 THEN 'http_rate_limited' WHEN status >= 500 THEN 'http_server_error'
  WHEN status >= 400 THEN 'http_client_error' WHEN status > 0 THEN ''
  WHEN contains(lower(error), 'timeout') THEN 'network_timeout'
  WHEN contains(error, 'DNS') THEN 'network_dns_failure' WHEN contains(error, 'SSL') THEN 'network_ssl_error'
  WHEN contains(error, 'refused') THEN 'network_connection_refused' ELSE 'network_timeout' END AS error_class,
  count(*) AS attempts, sum(ms)::BIGINT AS total_ms FROM attempts GROUP BY 1""",
)
def error_class(spark: SparkSession, sf: str) -> DataFrame:
    return (
        attempt_log(spark, sf)
        .groupBy(R.error_class("status", "error").alias("error_class"))
        .agg(F.count("*").alias("attempts"), F.sum("ms").alias("total_ms"))
    )


@query(
    "u16_f15_success_and_retryable",
    ATTEMPTS
    + """
SELECT seq, (status >= 200 AND status < 300) AS success,
  (status <= 0 OR status IN (500, 501, 502, 503, 504)) AS retryable FROM attempts""",
)
def success(spark: SparkSession, sf: str) -> DataFrame:
    return attempt_log(spark, sf).select(
        "seq", R.is_success("status").alias("success"), R.is_retryable("status").alias("retryable")
    )


@query(
    "f16_retry_after",
    ATTEMPTS
    + """
SELECT seq, coalesce(try_cast(nullif(regexp_extract(retry_after, '^[0-9]+'), '') AS BIGINT), 0) * 1000
  AS wait_ms FROM attempts""",
)
def retry_after(spark: SparkSession, sf: str) -> DataFrame:
    return attempt_log(spark, sf).select("seq", R.retry_after_ms("retry_after").alias("wait_ms"))


# One content type per remainder of the page number.
TYPES = ("text/html; charset=utf-8", " Application/XHTML+xml ", "image/png", "application/json")
_TYPED = """
WITH t AS (SELECT page_id, html, (['text/html; charset=utf-8', ' Application/XHTML+xml ', 'image/png',
  'application/json'])[CAST(page_id % 4 + 1 AS INTEGER)] AS ct FROM pages)
"""


def typed_pages(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, TYPES)), (F.col("page_id") % len(TYPES) + 1).cast("int"))
    return table(spark, sf, "pages").select("page_id", "html", kind.alias("ct"))


@query(
    "u10_content_type_match",
    _TYPED
    + """
SELECT page_id, lower(trim(split_part(ct, ';', 1))) = 'text/html' AS exact,
  lower(trim(ct)) LIKE 'application/%' AS family FROM t""",
)
def content_type_match(spark: SparkSession, sf: str) -> DataFrame:
    return typed_pages(spark, sf).select(
        "page_id",
        R.content_type_matches("ct", "text/HTML").alias("exact"),
        R.content_type_matches("ct", "application/*").alias("family"),
    )


@query(
    "u11_content_type_accepted",
    _TYPED
    + """
SELECT page_id, (ct LIKE 'text/%' OR lower(trim(ct)) LIKE 'application/%')
  AND trim(ct) <> 'application/json' AS accepted FROM t""",
)
def content_type_accepted(spark: SparkSession, sf: str) -> DataFrame:
    verdict = R.content_type_accepted("ct", ["text/*", "application/*"], ["application/json"])
    return typed_pages(spark, sf).select("page_id", verdict.alias("accepted"))


@query(
    "u15_is_html",
    _TYPED + "SELECT page_id, contains(ct, 'text/html') AND length(html) > 0 AS is_html FROM t",
)
def is_html(spark: SparkSession, sf: str) -> DataFrame:
    return typed_pages(spark, sf).select("page_id", R.is_html("ct", "html").alias("is_html"))


@query(
    "u13_content_duplicates",
    """
WITH h AS (SELECT doc_id, CASE WHEN text = '' THEN '' ELSE sha256(text) END AS hash FROM documents),
c AS (SELECT hash, count(*) AS copies, min(doc_id) AS first_doc FROM h GROUP BY 1)
SELECT doc_id, hash, copies, doc_id <> first_doc AS duplicate FROM h JOIN c USING (hash)""",
)
def content_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    hashed = table(spark, sf, "documents").select("doc_id", R.content_hash("text").alias("hash"))
    return mark_copies(hashed, "doc_id", "hash")


@query(
    "u14_server_date",
    """
WITH d AS (SELECT event_id, ts, ts + to_minutes(CAST(event_id % 40 AS INTEGER)) AS sent FROM events),
s AS (SELECT event_id, ts, date_trunc('second', sent) AS sent FROM d)
SELECT event_id, CASE WHEN abs(epoch(sent)::BIGINT - floor(epoch(ts))::BIGINT) <= 900
  THEN strftime(sent, '%Y-%m-%d %H:%M:%S') ELSE '' END AS server_date FROM s""",
)
def server_date(spark: SparkSession, sf: str) -> DataFrame:
    sent = F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 40).cast("int"))
    header = F.concat(F.lit("Day, "), F.date_format(sent, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return (
        table(spark, sf, "events")
        .select("event_id", "ts", header.alias("header"))
        .select("event_id", R.server_date("header", F.col("ts")).alias("server_date"))
    )


@query(
    "u17_size_limit",
    """
SELECT doc_id, CASE WHEN strlen(text) > 2000 THEN 'content_too_large' END AS error,
  CASE WHEN strlen(text) <= 2000 THEN length(text) END AS kept_chars FROM documents""",
)
def size_limit(spark: SparkSession, sf: str) -> DataFrame:
    limited = table(spark, sf, "documents").select("doc_id", R.size_limited("text", 2000).alias("r"))
    return limited.select(
        "doc_id", F.col("r.error"), F.length("r.body").cast("long").alias("kept_chars")
    )


@query(
    "u19_noindex",
    """
SELECT page_id, page_id % 3 = 0 AS noindex, CASE WHEN page_id % 3 <> 0 THEN html END IS NULL AS cleared
FROM pages""",
)
def noindex(spark: SparkSession, sf: str) -> DataFrame:
    robots = F.when(F.col("page_id") % 3 == 0, '<META content="NoIndex, follow" NAME=robots>').otherwise(
        '<meta name="robots" content="all">'
    )
    tagged = table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("html", "<head>", F.concat(F.lit("<head>"), robots)).alias("html")
    )
    flagged = tagged.select("page_id", "html", T.has_noindex("html").alias("noindex"))
    return flagged.select(
        "page_id",
        "noindex",
        R.without_noindex("html", F.col("noindex")).isNull().alias("cleared"),
    )


@query(
    "content_type_histogram",
    _TYPED + "SELECT lower(trim(split_part(ct, ';', 1))) AS media, count(*) AS pages FROM t GROUP BY 1",
)
def content_type_histogram(spark: SparkSession, sf: str) -> DataFrame:
    media = F.lower(F.trim(F.substring_index("ct", ";", 1)))
    return typed_pages(spark, sf).groupBy(media.alias("media")).agg(F.count("*").alias("pages"))


@query(
    "error_report",
    ATTEMPTS
    + """
SELECT domain, count(*) AS failures, max(status) AS worst_status, count(DISTINCT status) AS kinds
FROM attempts WHERE status >= 400 OR error <> '' GROUP BY 1""",
)
def error_report(spark: SparkSession, sf: str) -> DataFrame:
    return (
        attempt_log(spark, sf)
        .filter("status >= 400 or error <> ''")
        .groupBy("domain")
        .agg(
            F.count("*").alias("failures"),
            F.max("status").alias("worst_status"),
            F.countDistinct("status").alias("kinds"),
        )
    )


@query(
    "slow_attempts",
    ATTEMPTS + "SELECT seq, domain, ms FROM attempts WHERE ms > 20000 ORDER BY ms DESC, seq LIMIT 50",
)
def slow_attempts(spark: SparkSession, sf: str) -> DataFrame:
    slow = attempt_log(spark, sf).filter("ms > 20000").select("seq", "domain", "ms")
    return slow.orderBy(F.desc("ms"), "seq").limit(50)


@query(
    "retry_list",
    ATTEMPTS
    + """
SELECT domain, count(*) AS attempts, max(seq) AS last_seq FROM attempts
WHERE status <= 0 AND (contains(error, 'timeout') OR error = 'reset') GROUP BY 1""",
)
def retry_list(spark: SparkSession, sf: str) -> DataFrame:
    return (
        attempt_log(spark, sf)
        .filter(R.error_class("status", "error") == "network_timeout")
        .groupBy("domain")
        .agg(F.count("*").alias("attempts"), F.max("seq").alias("last_seq"))
    )


@query(
    "s04_stream_columns",
    """
SELECT url, 200 AS status_code, 'text/html; charset=utf-8' AS content_type, '' AS error,
  CAST(0 AS BIGINT) AS response_time_ms, strlen(html) AS content_length, '{}' AS jsonld,
  '{}' AS opengraph, '' AS meta FROM pages""",
)
def stream_columns(spark: SparkSession, sf: str) -> DataFrame:
    from pageloom.streaming.pages import finished_pages

    return finished_pages(response_store(table(spark, sf, "pages"))).drop("body")
