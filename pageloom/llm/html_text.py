"""Main text of HTML pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

A block's features are what encloses it (tags, and hints in class, id and role) and its
own text.  The field is trained on labelled pages, written from the layouts below: each
piece of a layout says whether it belongs to the article.  Names are left out at random,
so that a page without telling names is judged by its text and its neighbours.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm import crf
from pageloom.llm.html_blocks import KINDS, TAGS, Block, blocks

#: Labelled pages the field is trained on.
TRAINING_PAGES = 500

_NAMES = (*TAGS, "embedded", *(f".{k}" for k in KINDS))
_LEVELS = (2, 5, 10, 20, 40, 80, 160)
_NEAREST = ("p", "div", "h1", "h2", "h3", "li", "td", "section", "article", "body", "footer", "header", "nav", "aside", "blockquote", "dd", "dt", "title", "pre", "figcaption", "summary", "legend", "th")


def block_features(found: list[Block]) -> np.ndarray:
    """A row of feature values for each block; every value is a small number."""
    rows = np.zeros((len(found), len(_NAMES) + 9), np.int64)
    index = {name: k for k, name in enumerate(_NAMES)}
    for k, block in enumerate(found):
        row = rows[k]
        for name in block.inside:
            row[index[name]] = 1
        text = block.text
        n = text.count(" ") + 1
        at = len(_NAMES)
        row[at] = 1 + _NEAREST.index(block.tag) if block.tag in _NEAREST else 0
        row[at + 1] = sum(n > level for level in _LEVELS)
        share = block.links / max(1, len(text))
        row[at + 2] = 0 if share == 0 else 1 if share < 0.3 else 2 if share < 0.8 else 3
        row[at + 3] = min(3, text.count(",") + text.count(";"))
        row[at + 4] = min(3, text.count(". ")) + 4 * (text[-1] in ".!?…\"”»")
        row[at + 5] = 1 if any(c in text for c in "©®»") else 0
        digits = sum(c.isdigit() for c in text)
        row[at + 6] = 0 if not digits else 1 if digits < 0.2 * len(text) else 2
        row[at + 7] = 1 if text[0].isupper() else 0
        row[at + 8] = 0 if k == 0 else 2 if k == len(found) - 1 else 1
    return rows


_WIDTHS = np.array([2] * len(_NAMES) + [len(_NEAREST) + 1, len(_LEVELS) + 1, 4, 4, 8, 2, 3, 2, 3])
_STARTS = np.concatenate([[0], np.cumsum(_WIDTHS)])


@dataclass
class Field:
    weight: np.ndarray
    start: np.ndarray
    moves: np.ndarray

    def decode(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        """1 for each block of an article."""
        return crf.viterbi(self.weight[rows + _STARTS[:-1]].sum(axis=1), first, self.start, self.moves)


# --- labelled pages ------------------------------------------------------------------

_MARK = "\ue000"  # stands in front of article text, in labelled pages only


class _Writer:
    """Writes pages from random layouts."""

    def __init__(self, seed: int) -> None:
        self.dice = random.Random(seed)
        sounds = ["an", "ber", "co", "de", "el", "fi", "gar", "hu", "in", "jo", "ka", "lo", "mer", "no", "or", "pa", "qui", "ro", "ste", "tu", "un", "vé", "wa", "xi", "yo", "zu"]
        self.lexicon = ["".join(self.dice.choices(sounds, k=self.dice.choice((1, 1, 2, 2, 3, 4)))) for _ in range(900)]

    def words(self, low: int, high: int) -> str:
        return " ".join(self.dice.choices(self.lexicon, k=self.dice.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        out = []
        for _ in range(self.dice.randint(low, high)):
            body = self.words(1, 22).split()
            for k in range(4, len(body) - 1, 7):
                body[k] += self.dice.choice((",", "", ";", "", ","))
            out.append(" ".join(body).capitalize() + self.dice.choice("....?!"))
        return " ".join(out)

    def pick(self, *options: str) -> str:
        return self.dice.choice(options)

    def named(self, tag: str, inside: str, *names: str, plain: float = 0.25) -> str:
        """An element with one of the names, or without any."""
        if not names or self.dice.random() < plain:
            return f"<{tag}>{inside}</{tag}>"
        return f'<{tag} {self.pick("class", "class", "id")}="{self.pick(*names)}">{inside}</{tag}>'

    def menu(self, n: int) -> str:
        items = [f'<a href="/{k}">{self.words(1, 3).capitalize()}</a>' for k in range(n)]
        shape = self.dice.randrange(3)
        if shape == 0:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " ".join(items) if shape == 1 else "".join(f"<div>{i}</div>" for i in items)

    def article(self) -> str:
        out = []
        title = self.sentences(1, 2)[:80] if self.dice.random() < 0.5 else self.words(3, 10).capitalize()
        heading = f"<h1>{_MARK}{title}</h1>"
        out.append(f"<header>{heading}</header>" if self.dice.random() < 0.15 else heading)
        if self.dice.random() < 0.25:
            out.append(self.named("div", f"{self.words(1, 3)} {self.pick('2021-03-04', '5 May 2019', '12:40')}", "byline", "meta", "post-meta", plain=0.1))
        for _ in range(self.dice.choice((1, 2, 3, 5, 8, 13, 25))):
            kind = self.dice.random()
            body = self.sentences(1, self.dice.choice((1, 1, 2, 4, 9, 18)))
            if kind < 0.05:
                body = self.words(1, 3).capitalize() + "."
            if kind < 0.08:
                out.append(f"<h{self.dice.randint(2, 3)}>{_MARK}{self.words(1, 6).capitalize()}</h2>")
            elif kind < 0.12:
                out.append("<ul>" + "".join(f"<li>{_MARK}{self.sentences(1, 1)}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.15:
                out.append(f"<blockquote>{_MARK}{body}</blockquote>")
            elif kind < 0.19:
                out.append(self.ad())
            elif kind < 0.21:
                out.append(self.named("div", self.menu(3), "share", "social", "related", plain=0.1))
            elif kind < 0.27:
                noise = self.pick(" | ", "### ", "%%% ", "!! ")
                out.append(f"<p>{_MARK}{body.replace(' ', noise)}</p>")
            elif kind < 0.32:
                link = f'<a href="/x">{self.words(1, 4)}</a>'
                out.append(f"<p>{_MARK}{body} {link} {self.words(2, 9)}.</p>")
            elif kind < 0.38:
                out.append(f"<div>{_MARK}{body}</div>")
            elif kind < 0.42:
                tag = self.pick("noscript", "object", "video", "audio")
                out.append(f"<{tag}><p>{_MARK}{body}</p></{tag}>")
            else:
                out.append(f"<p>{'<b>' if self.dice.random() < 0.2 else ''}{_MARK}{body}" + self.pick("</p>", "</p>", "<br>", ""))
        if self.dice.random() < 0.2:
            out.append(self.comments())
        return "\n".join(out)

    def ad(self) -> str:
        return self.named("div", self.sentences(1, 3), "ad", "ads", "advert", "sponsored", "promo-box", "ad-slot", plain=0.03)

    def notice(self) -> str:
        text = self.sentences(1, 3) + self.pick("", " <button>OK</button>", ' <a href="/privacy">Privacy</a>')
        return self.named("div", f"<p>{text}</p>" if self.dice.random() < 0.5 else text, "cookie-notice", "notice", "consent", "newsletter", "alert", plain=0.03)

    def fallback(self) -> str:
        tag = self.pick("noscript", "noscript", "object", "canvas", "iframe")
        return f"<{tag}>{self.named('div', self.sentences(1, 2), 'notice', 'alert', plain=0.03)}</{tag}>"

    def comments(self) -> str:
        each = [f"<{t}>{self.named('b', self.words(1, 2), 'author')} {self.sentences(1, 4)}</{t}>" for t in [self.pick("p", "div", "li")] * self.dice.randint(1, 5)]
        return self.named(self.pick("section", "div", "ol"), f"<h3>{self.words(1, 2).capitalize()}</h3>" * self.dice.randint(0, 1) + "".join(each), "comments", "comment-list", "responses", "disqus", plain=0.02)

    def side(self) -> str:
        inside = f"<h4>{self.words(1, 3).capitalize()}</h4>" + (self.menu(4) if self.dice.random() < 0.7 else f"<p>{self.sentences(1, 3)}</p>")
        return self.named(self.pick("aside", "aside", "div"), inside, "sidebar", "related", "widget", "popular", plain=0.05)

    def form(self) -> str:
        return f'<form action="/s"><label>{self.words(1, 3)}</label><input name="q"> {self.words(0, 6) if self.dice.random() < 0.5 else ""}<p>{self.sentences(1, 1)}</p>{self.choices()}</form>'

    def choices(self) -> str:
        if self.dice.random() < 0.6:
            return ""
        return "<select>" + "".join(f"<option>{self.words(1, 4)}" for _ in range(4)) + f"</select><button>{self.words(1, 2)}</button>"

    def page(self) -> str:
        head = f"<title>{self.words(2, 8)}</title><style>p{{}}</style><script>var a='</p>';</script>"
        top = [self.named(self.pick("nav", "nav", "div"), self.menu(self.dice.randint(3, 9)), "menu", "navbar", "topnav", plain=0.4)]
        if self.dice.random() < 0.5:
            top.insert(0, self.named(self.pick("header", "header", "div"), f"<p>{self.words(1, 6)}</p>" + self.menu(2) * self.dice.randint(0, 1), "header", "masthead", plain=0.2))
        extras = [piece() for piece in (self.ad, self.notice, self.side, self.form) if self.dice.random() < 0.45]
        extras += [self.fallback()] * (self.dice.random() < 0.25)
        body = self.article()
        wrap = self.dice.random()
        if wrap < 0.4:
            body = f"<article>{body}</article>"
        elif wrap < 0.55:
            body = f"<main>{body}</main>"
        elif wrap < 0.9:
            body = self.named("div", body, "content", "post-body", "entry", "article", "story", "main", plain=0.3)
        else:
            body = f"<table><tr><td>{self.menu(5)}</td><td>{body}</td></tr></table>"
        cut = self.dice.randint(0, len(extras))
        after = [self.comments()] if self.dice.random() < 0.35 else []
        foot = f"{self.pick('&copy; ', '© ', '')}{self.words(1, 3)} &middot; {self.sentences(1, 3) if self.dice.random() < 0.6 else self.menu(3)}"
        foot = self.named(self.pick("footer", "footer", "footer", "div"), foot, "footer", "site-footer", "copyright", plain=0.3)
        tail = self.pick("</body></html>", "")
        return f"<!DOCTYPE html><html><head>{head}</head><body>" + "".join([*top, *extras[:cut], body, *extras[cut:], *after, foot]) + tail


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 1) -> list[tuple[list[Block], np.ndarray]]:
    """Blocks and labels of ``n`` pages, the same ones for the same seed."""
    writer, out = _Writer(seed), []
    for _ in range(n):
        found = blocks(writer.page())
        labels = np.array([_MARK in b.text for b in found], np.int64)
        for block in found:
            block.text = block.text.replace(_MARK, "").strip() or "-"
        out.append((found, labels))
    return out


@lru_cache(maxsize=2)
def train(n: int = TRAINING_PAGES, seed: int = 1) -> Field:
    pages = labelled_pages(n, seed)
    rows = np.concatenate([block_features(found) for found, _ in pages])
    labels = np.concatenate([marks for _, marks in pages])
    first = np.concatenate([[0], np.cumsum([len(marks) for _, marks in pages])])
    weight, start, moves = crf.fit(rows + _STARTS[:-1], int(_STARTS[-1]), labels, first, 2)
    return Field(weight, start, moves)


def article_blocks(pages: list[str | None], field: Field) -> list[list[str]]:
    """The article blocks of each page, decoded together."""
    found = [blocks(p or "") for p in pages]
    first = np.concatenate([[0], np.cumsum([len(b) for b in found])])
    if not first[-1]:
        return [[] for _ in pages]
    rows = np.concatenate([block_features(b) for b in found if b])
    state = field.decode(rows, first)
    return [[b.text for b, s in zip(own, state[a:z]) if s] for own, a, z in zip(found, first[:-1], first[1:])]


def main_text(pages: DataFrame, field: Field | None = None, html: str = "html", together: int = 64) -> DataFrame:
    """``text``, ``n_chars`` and ``n_blocks`` beside all columns of ``pages`` but the html.

    Blocks are joined by an empty line.  A null or empty page, or one without article
    blocks, has an empty text.  Broken markup is read as far as it goes; text of any
    length is kept whole.  Columns of ``pages`` named like results are replaced.  One
    pass, no shuffle.
    """
    field = field or train()

    def extract(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in columns:
            texts, counts = [], []
            for low in range(0, len(column), together):
                for own in article_blocks(list(column.iloc[low : low + together]), field):
                    texts.append("\n\n".join(own))
                    counts.append(len(own))
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts], "n_blocks": counts}).astype({"n_chars": "int64", "n_blocks": "int64"})

    own = ("text", "n_chars", "n_blocks")
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html and c not in own]
    found = F.pandas_udf(extract, "text string, n_chars long, n_blocks long")(F.col(html))
    return pages.select(*kept, found.alias("_found")).select(*kept, "_found.*")
