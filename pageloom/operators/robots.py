"""Robots rules as a table and the verdicts derived from it.

A robots file is one short row, so its rules are cut out by column expressions
and kept as one narrow row per host; URLs then meet their host row in a salted
join and are judged without multiplying them by the number of rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import url as U
from pageloom.functions.columns import let
from pageloom.operators.running import lookup

# Sections come before lines; no text has so many lines, so all lines stay in order.
_SECTION_SPAN = 1 << 32
# An agent line that names an agent opens a section.
_AGENT_LINE = r"(?im)^[ \t]*user-agent:(?=[ \t]*[^\s])"
_FIRST_LINE = r"^[ \t]*([^\r\n]*?)[ \t\r]*(?:\n|$)"


def rules(robots: DataFrame) -> DataFrame:
    """One row per directive: host, agent, kind, value, line_no.

    Every agent line opens a section of its own, empty values are ignored and
    sitemaps belong to the host.  Directives before the first agent have no agent.
    """
    lines = robots.select(
        "host",
        F.posexplode(F.split("body", _AGENT_LINE)).alias("section", "text"),
    ).select(
        "host",
        "section",
        F.when(
            F.col("section") > 0, F.lower(F.regexp_extract("text", _FIRST_LINE, 1))
        ).alias("agent"),
        F.posexplode(F.split("text", "\n")).alias("line", "raw"),
    )
    text = F.regexp_replace("raw", r"^\s+|\s+$", "")
    kind = F.lower(F.regexp_extract(text, r"^(?i)(allow|disallow|crawl-delay|request-rate|sitemap):", 1))
    value = F.regexp_replace(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1), r"^\s+", "")
    parsed = lines.select(
        "host",
        "agent",
        kind.alias("kind"),
        value.alias("value"),
        (F.col("section").cast("long") * _SECTION_SPAN + F.col("line")).alias("line_no"),
        ((F.col("line") == 0) & (F.col("section") > 0)).alias("is_agent_line"),
    ).filter("not is_agent_line and kind <> '' and value <> ''")
    return parsed.select(
        "host",
        F.when(F.col("kind") != "sitemap", F.col("agent")).alias("agent"),
        "kind",
        "value",
        "line_no",
    )


def _sections(body: Column) -> Column:
    """Agent and text of every section of a robots file."""
    pieces = F.split(body, _AGENT_LINE)
    return F.filter(
        F.transform(
            pieces,
            lambda text, i: F.struct(
                F.when(i > 0, F.lower(F.regexp_extract(text, _FIRST_LINE, 1))).alias("agent"),
                F.regexp_replace(text, r"^[^\n]*", "").alias("text"),
            ),
        ),
        lambda s: s["agent"].isNotNull(),
    )


def _chosen(sections: Column, user_agent: str) -> Column:
    """Name of the group that speaks to ``user_agent``, NULL if there is none.

    An exact name wins, then the longest name that starts the user agent, then ``*``.
    """
    ua = user_agent.lower()

    def rank(agent: Column) -> Column:
        return (
            F.when(agent == ua, 1_000_000)
            .when((agent != "*") & F.startswith(F.lit(ua), agent), F.length(agent) + 1)
            .when(agent == "*", 1)
        )

    ranked = F.transform(sections, lambda s: F.struct(rank(s["agent"]).alias("rank"), s["agent"].alias("agent")))
    return F.array_max(F.filter(ranked, lambda r: r["rank"].isNotNull()))["agent"]


def chosen_agent(robots: DataFrame, user_agent: str) -> DataFrame:
    """The one group of each host that speaks to ``user_agent``."""
    picked = let(_sections(F.col("body")), lambda s: _chosen(s, user_agent))
    return robots.select("host", picked.alias("agent")).filter("agent is not null")


def host_rules(robots: DataFrame, user_agent: str) -> DataFrame:
    """One row per host: the allow and disallow patterns of the chosen group.

    Patterns are read and cut at their stars here, once per host and not once per
    URL, and without leaving the row of the host.
    """

    def patterns(text: Column, kind: str) -> Column:
        values = F.regexp_extract_all(text, F.lit(rf"(?im)^[ \t]*{kind}:[ \t]*([^\r\n]*[^\s])"), F.lit(1))

        def cut(value: Column) -> Column:
            tied = F.endswith(value, F.lit("$"))
            body = F.when(tied, F.substring(value, F.lit(1), F.length(value) - 1)).otherwise(value)
            return F.struct(
                value.alias("text"), F.split(body, r"\*").alias("parts"), tied.alias("tied"), F.length(value).alias("size")
            )

        return F.transform(values, cut)

    def both(found: Column) -> Column:
        def of(agent: Column) -> Column:
            mine = F.filter(found, lambda s: s["agent"] == agent)
            text = F.array_join(F.transform(mine, lambda s: s["text"]), "\n")
            return let(
                text,
                lambda t: F.struct(patterns(t, "allow").alias("allow"), patterns(t, "disallow").alias("disallow")),
            )

        return let(_chosen(found, user_agent), of)

    held = robots.select("host", let(_sections(F.col("body")), both).alias("_r"))
    return held.select("host", "_r.allow", "_r.disallow")


def _starts(patterns: str, path: Column) -> Column:
    return F.coalesce(F.exists(patterns, lambda p: F.startswith(path, p["text"])), F.lit(False))


def _fits(pattern: Column, path: Column) -> Column:
    """Whether a pattern with ``*`` and a closing ``$`` fits a path.

    The pieces between the stars must follow each other, each taken as early as
    possible; a closing ``$`` ties the last piece to the end of the path.
    """
    parts, tied = pattern["parts"], pattern["tied"]
    head, last = F.get(parts, F.lit(0)), F.element_at(parts, -1)
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - F.when(tied, 2).otherwise(1), F.lit(0)))

    def step(at: Column, part: Column) -> Column:
        found = F.position(part, path, at)
        return F.when((at > 0) & (found > 0), found + F.length(part)).otherwise(0)

    reached = F.aggregate(inner, F.length(head) + 1, step)
    at_end = F.endswith(path, last) & (F.length(path) - F.length(last) + 1 >= reached)
    return F.startswith(path, head) & (
        F.when(F.size(parts) == 1, ~tied | (path == head)).otherwise((reached > 0) & (~tied | at_end))
    )


def _longest(patterns: str, path: Column) -> Column:
    """Length of the longest pattern that fits the path, -1 if none does."""
    sizes = F.transform(patterns, lambda p: F.when(_fits(p, path), p["size"]).otherwise(-1))
    return F.coalesce(F.array_max(sizes), F.lit(-1))


def allowed(path: Column, longest_match: bool = False) -> Column:
    """Verdict for a path beside ``allow`` and ``disallow`` patterns.

    Plain form: any fitting allow pattern wins, then any fitting disallow one.
    ``longest_match``: the longest fitting pattern wins, a tie allows.
    """
    if longest_match:
        return _longest("allow", path) >= _longest("disallow", path)
    return _starts("allow", path) | ~_starts("disallow", path)


def with_verdict(
    urls: DataFrame, robots: DataFrame, user_agent: str, longest_match: bool = True
) -> DataFrame:
    """URLs with an ``allowed`` column; hosts without rules allow everything."""
    keyed = urls.withColumn("host", U.host("url"))
    joined = lookup(keyed, host_rules(robots, user_agent), "host")
    judged = joined.withColumn("_path", U.path("url"))
    return judged.withColumn("allowed", allowed(F.col("_path"), longest_match)).drop("allow", "disallow", "_path")


def allowed_urls(urls: DataFrame, robots: DataFrame, user_agent: str) -> DataFrame:
    return with_verdict(urls, robots, user_agent).filter("allowed").select(*urls.columns)


def mark_disallowed(urls: DataFrame, robots: DataFrame, user_agent: str) -> DataFrame:
    """Keep every URL; a forbidden one gets status -1 and its error class."""
    judged = with_verdict(urls, robots, user_agent)
    return judged.select(
        *urls.columns,
        F.when(~F.col("allowed"), -1).alias("status"),
        F.when(~F.col("allowed"), "robots_disallowed").alias("error_class"),
    )


def group_delays(robots: DataFrame) -> DataFrame:
    """Delay and request spacing of every group; the last valid value counts."""
    delay = F.when(F.col("kind") == "crawl-delay", F.col("value").try_cast("double"))
    n = F.regexp_extract("value", r"^\s*([0-9.]+)\s*/", 1).try_cast("double")
    m = F.regexp_extract("value", r"/\s*([0-9.]+)", 1).try_cast("double")
    rate = F.when((F.col("kind") == "request-rate") & (n > 0) & (m > 0), m / n)
    parsed = rules(robots).filter("agent is not null").select(
        "host", "agent", "line_no", F.when(delay >= 0, delay).alias("delay"), rate.alias("rate")
    )
    last = parsed.groupBy("host", "agent").agg(
        F.max_by("delay", F.when(F.col("delay").isNotNull(), F.col("line_no"))).alias("crawl_delay"),
        F.max_by("rate", F.when(F.col("rate").isNotNull(), F.col("line_no"))).alias("request_rate"),
    )
    stricter = F.greatest("crawl_delay", "request_rate")
    return last.withColumn("effective_delay", stricter)


def crawl_delay(robots: DataFrame, user_agent: str) -> DataFrame:
    """First delay of a section for ``*`` or a part of the user agent, else the first of all."""
    ua = F.lit(user_agent.lower())
    delays = rules(robots).filter("kind = 'crawl-delay'").withColumn(
        "delay", F.col("value").try_cast("double")
    ).filter("delay is not null")
    mine = F.coalesce((F.col("agent") == "*") | F.contains(ua, F.col("agent")), F.lit(False))
    return delays.groupBy("host").agg(
        F.coalesce(
            F.min_by("delay", F.when(mine, F.col("line_no"))), F.min_by("delay", "line_no")
        ).alias("crawl_delay")
    )


def sitemaps(robots: DataFrame) -> DataFrame:
    """Sitemap addresses named by each host."""
    return rules(robots).filter("kind = 'sitemap'").select("host", F.col("value").alias("sitemap_url"))
