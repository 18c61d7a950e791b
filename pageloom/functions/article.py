"""Main article of a page, chosen by text scores of its containers.

Each paragraph gives its parent a score for length and commas and half of it to
the grandparent; links, and names such as sidebar or footer, take score away.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions import dom as D
from pageloom.functions import tags
from pageloom.functions.columns import ColumnOrName, col, let

# Fixed values of the scoring.
NOISE_TAGS = ("script", "style", "noscript", "nav", "footer", "aside", "form", "template")
PARAGRAPH_TAGS = ("p", "pre", "td", "blockquote")
BAD_NAME = r"(?i)sidebar|footer|nav|comment|promo|advert|\bad\b|menu|related"
EXCERPT_CHARS = 200


def _chars(chunks: Column) -> Column:
    return F.aggregate(chunks, F.lit(0), lambda n, c: n + F.length(F.trim(c["text"])))


def _paragraph_score(text: Column) -> Column:
    commas = F.length(text) - F.length(F.replace(text, F.lit(","), F.lit("")))
    return F.lit(1.0) + commas + F.least(F.length(text) / F.lit(100.0), F.lit(3.0))


def _best_container(dom: Column, clean: Column) -> Column:
    """Node with the highest score; an article, main or body element failing that."""
    nodes = dom["nodes"]

    def text_of(node: Column) -> Column:
        part = F.slice(clean, node["c0"] + 1, node["c1"] - node["c0"])
        return F.array_join(F.transform(F.filter(part, lambda c: ~c["noise"]), lambda c: c["text"]), "")

    paragraphs = F.transform(
        F.filter(nodes, lambda n: n["tag"].isin(*PARAGRAPH_TAGS)),
        lambda n: F.struct(
            n["parent"].alias("parent"),
            F.coalesce(F.get(nodes, n["parent"])["parent"], F.lit(-1)).alias("grand"),
            _paragraph_score(text_of(n)).alias("score"),
            F.length(text_of(n)).alias("chars"),
        ),
    )

    def choose(rows: Column) -> Column:
        long_enough = F.filter(rows, lambda r: r["chars"] >= 25)
        gifts = F.flatten(
            F.transform(
                long_enough,
                lambda r: F.array(
                    F.struct(r["parent"].alias("node"), r["score"].alias("score")),
                    F.struct(r["grand"].alias("node"), (r["score"] / 2).alias("score")),
                ),
            )
        )

        def totals(given: Column) -> Column:
            # Sorted by container, so one pass adds up each run.
            zero = F.struct(
                F.lit(-1).alias("node"), F.lit(0.0).alias("sum"), F.lit(-1).alias("best"), F.lit(-1.0).alias("top")
            )

            def weight(number: Column) -> Column:
                node = F.get(nodes, number)
                part = F.slice(clean, node["c0"] + 1, node["c1"] - node["c0"])
                all_chars = _chars(F.filter(part, lambda c: ~c["noise"]))
                linked = _chars(F.filter(part, lambda c: ~c["noise"] & c["linked"]))
                name = F.concat_ws(" ", D.attr(node, "class"), D.attr(node, "id"))
                density = F.when(all_chars > 0, linked / all_chars).otherwise(0.0)
                return (F.lit(1.0) - density) * F.when(name.rlike(BAD_NAME), 0.2).otherwise(1.0)

            def step(state: Column, gift: Column) -> Column:
                same = gift["node"] == state["node"]
                total = F.when(same, state["sum"]).otherwise(0.0) + gift["score"]
                closes = gift["last"]
                final = F.when(closes, total * weight(gift["node"])).otherwise(-1.0)
                better = closes & (gift["node"] >= 0) & (final > state["top"])
                return F.struct(
                    gift["node"].alias("node"),
                    total.alias("sum"),
                    F.when(better, gift["node"]).otherwise(state["best"]).alias("best"),
                    F.when(better, final).otherwise(state["top"]).alias("top"),
                )

            marked = let(
                F.array_sort(given),
                lambda s: F.transform(
                    s,
                    lambda g, i: F.struct(
                        g["node"].alias("node"),
                        g["score"].alias("score"),
                        F.coalesce(F.get(s, i + 1)["node"] != g["node"], F.lit(True)).alias("last"),
                    ),
                ),
            )
            return F.aggregate(marked, zero, step, lambda s: s["best"])

        return totals(gifts)

    def first_id(tag: str) -> Column:
        return F.get(F.filter(nodes, lambda n: n["tag"] == tag), F.lit(0))["id"]

    fallback = F.coalesce(first_id("article"), first_id("main"), first_id("body"), F.lit(-1))
    return let(
        let(paragraphs, choose), lambda best: F.get(nodes, F.when(best >= 0, best).otherwise(fallback))
    )


def article(html: ColumnOrName, dom: ColumnOrName | None = None) -> Column:
    """``struct(title, content, text_content, length, excerpt)``; length is in bytes."""
    if dom is None:
        return let(D.parse(html), lambda d: article(html, d))
    html, dom = col(html), col(dom)
    nodes = dom["nodes"]

    def marked(noise: Column, linked: Column) -> Column:
        return F.transform(
            dom["chunks"],
            lambda c: F.struct(
                c["text"].alias("text"),
                D.flagged(noise, c["node"]).alias("noise"),
                D.flagged(linked, c["node"]).alias("linked"),
            ),
        )

    noise = D.within(dom, F.filter(nodes, lambda n: n["tag"].isin(*NOISE_TAGS)))
    linked = D.within(dom, F.filter(nodes, lambda n: n["tag"] == "a"))

    def build(clean: Column) -> Column:
        def read(node: Column) -> Column:
            part = F.slice(clean, node["c0"] + 1, node["c1"] - node["c0"])
            kept = F.array_join(F.transform(F.filter(part, lambda c: ~c["noise"]), lambda c: c["text"]), "")
            return let(
                F.trim(F.regexp_replace(F.coalesce(kept, F.lit("")), r"\s+", " ")),
                lambda text: F.struct(
                    F.coalesce(tags.title(html), F.lit("")).alias("title"),
                    F.coalesce(D.inner_html(html, node), F.lit("")).alias("content"),
                    text.alias("text_content"),
                    F.octet_length(text).cast("long").alias("length"),
                    F.concat(
                        F.substring(text, 1, EXCERPT_CHARS),
                        F.when(F.octet_length(text) > EXCERPT_CHARS, "...").otherwise(""),
                    ).alias("excerpt"),
                ),
            )

        return let(_best_container(dom, clean), read)

    return let(let(noise, lambda x: let(linked, lambda y: marked(x, y))), build)
