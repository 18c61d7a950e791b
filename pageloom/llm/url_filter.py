"""URL filter: list rules first, then a weighted vocabulary found by one Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.text import lower_ascii

#: Terms and weights.  A term of weight STRICT or more rejects alone.
STRICT = 3
TERMS: dict[str, int] = {
    **dict.fromkeys(("adult-x", "camgirls", "casino", "escorts", "free-bets", "hentai", "porn", "porno", "viagra", "warez", "xxx"), STRICT),
    **dict.fromkeys(("adult", "bet", "bets", "betting", "bonus", "cheap", "cracked", "escort", "free", "gambling", "jackpot", "loans"), 1),
    **dict.fromkeys(("nude", "pills", "poker", "sex", "slots", "torrent", "win"), 1),
}


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    text: str  # host, then a path from its first slash on
    host: str = field(init=False)
    path: str = field(init=False)

    def __post_init__(self) -> None:
        host, slash, path = self.text.partition("/")
        object.__setattr__(self, "host", host)
        object.__setattr__(self, "path", slash + path)


def host_of(url: Column | str) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(lower_ascii(found), F.lit(""))


def path_of(url: Column | str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """The longest rule that fits (the longer host among equals), or null."""
    order = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))
    fits = [
        F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(r.text))
        for r in order
    ]
    return F.coalesce(*fits, F.lit(None).cast("string"))


@lru_cache(maxsize=8)
def _automaton(terms: tuple[tuple[str, int], ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for number, (term, weight) in enumerate(terms):
        found.add_word(term, (number, len(term), weight))
    found.make_automaton()
    return found


def _word_part(text: str, at: int) -> bool:
    return 0 <= at < len(text) and (text[at].isascii() and text[at].isalnum())


def _counter(terms: tuple[tuple[str, int], ...], strict: int):
    def count(urls: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(terms)
        for batch in urls:
            rows = []
            for url in batch:
                hard, soft = 0, set()
                for end, (number, length, weight) in automaton.iter(url or ""):
                    if _word_part(url, end + 1) or _word_part(url, end - length):
                        continue
                    if weight >= strict:
                        hard += 1
                    else:
                        soft.add(number)
                rows.append((hard, len(soft), sum(terms[n][1] for n in soft)))
            yield pd.DataFrame(rows, columns=["n_strict", "n_soft", "soft_weight"])

    return F.pandas_udf(count, "n_strict int, n_soft int, soft_weight int")


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[UrlRule] = (),
    terms: Mapping[str, int] = TERMS,
    url: str = "url",
    strict: int = STRICT,
    soft_limit: int = 2,
) -> DataFrame:
    """``host``, ``path``, ``rule``, ``verdict``, ``n_strict`` and ``n_soft`` beside all columns of ``pages``.

    A rule decides first.  Otherwise a URL is blocked if it holds one strict term, or
    if the distinct soft terms in it weigh ``soft_limit`` or more.  A term counts only
    between characters that are no ASCII letter or digit; A-Z are lower-cased first.
    A null URL, or one without ``://``, has an empty host and path, so that no rule
    fits it; null is allowed.  Equal rows get equal results, an empty table an empty
    one.  Columns of ``pages`` with the names of results are replaced.

    Work: one pass without a shuffle; rules and terms are parameters and travel with
    the code, their number does not depend on the table.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    kinds = {r.text: r.verdict for r in rules}
    if len(kinds) != len(rules):
        raise ValueError("a rule is given twice")
    blocked = [r.text for r in rules if r.verdict == "block"]
    order = tuple(sorted(terms.items()))
    found = _counter(order, strict)(lower_ascii(F.col(url)))
    own = ("host", "path", "rule", "verdict", "n_strict", "n_soft", "_terms")
    kept = [c for c in pages.columns if c not in own]
    seen = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("host"), path.alias("path"), found.alias("_terms"))
    ruled = seen.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules) if rules else F.lit(None).cast("string"))
    bad = (F.col("_terms.n_strict") > 0) | (F.col("_terms.soft_weight") >= soft_limit)
    by_rule = F.when(F.col("rule").isin(*blocked) if blocked else F.lit(False), "block").otherwise("allow")
    return ruled.select(
        *[F.col(f"`{c}`") for c in kept],
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.col("_terms.n_strict").alias("n_strict"),
        F.col("_terms.n_soft").alias("n_soft"),
    )
