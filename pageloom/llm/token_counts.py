"""Token counts that follow edits: a segment tree over each document's pre-tokens.

A byte-pair tokenizer first cuts a text into pre-tokens by a pattern and encodes each by
itself.  Leaves of the tree are blocks of pre-tokens with their characters and tokens,
inner nodes hold sums.  An edit finds its place by descending along character sums, cuts
the text anew from a pre-token that cannot depend on it until a cut meets an old one behind
it, encodes only those pre-tokens, and updates the sums above the touched blocks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A ranked byte-pair vocabulary in the tiktoken format; read by the driver, sent to the executors.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern that belongs to the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Pre-tokens whose counts a task remembers.
REMEMBERED = 200_000
_BLOCK = 32


class Tokenizer:
    """Pre-tokens and their numbers of tokens."""

    def __init__(self, ranked: bytes, pattern: str = PATTERN) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranked.splitlines())}
        self.encoding = tiktoken.Encoding("ranked", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}
        self.encoded = 0  # pre-tokens looked up so far

    def cut(self, text: str, at: int = 0) -> Iterator[str]:
        for found in self.pattern.finditer(text, at):
            yield found[0]

    def counts(self, parts: Sequence[str]) -> list[int]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        out = [known.get(p, 0) for p in parts]
        for k, n in enumerate(out):
            if n == 0:
                piece = parts[k]
                out[k] = known[piece] = len(self.encoding.encode_ordinary(piece))
        self.encoded += len(parts)
        return out

    def total(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


@dataclass(frozen=True)
class Edit:
    """Characters ``start`` to ``end`` of the text as it stands become ``new``."""

    start: int
    end: int
    new: str


class TokenTree:
    """A document's text with the token count of every part of it."""

    def __init__(self, tokenizer: Tokenizer, text: str) -> None:
        self.tokenizer = tokenizer
        parts = tokenizer.pattern.findall(text)
        self.touched = 0
        self._build(parts, tokenizer.counts(parts))

    def _build(self, parts: list[str], counts: list[int]) -> None:
        edges = range(0, max(1, len(parts)), _BLOCK)
        self.parts = [parts[k : k + _BLOCK] for k in edges]
        self.counts = [counts[k : k + _BLOCK] for k in edges]
        self.width = 1 << max(0, (len(self.parts) - 1).bit_length())
        # Heap order: node 1 is the root, block k is node width + k; (characters, tokens).
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for k in range(len(self.parts)):
            self.sums[self.width + k] = sum(map(len, self.parts[k])), sum(self.counts[k])
        level = self.width
        while level > 1:
            half = level // 2
            self.sums[half:level] = self.sums[level : 2 * level].reshape(half, 2, 2).sum(axis=1)
            level = half

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def text(self) -> str:
        return "".join("".join(block) for block in self.parts)

    def _locate(self, char: int) -> tuple[int, int]:
        """The block that holds a character (the last block behind the end) and its first character."""
        node, before = 1, 0
        while node < self.width:
            left = int(self.sums[2 * node, 0])
            node *= 2
            if char >= before + left and (char < before + int(self.sums[node // 2, 0]) or self.sums[node + 1, 0] > 0):
                before += left
                node += 1
        return min(node - self.width, len(self.parts) - 1), before

    def _update(self, block: int) -> None:
        node = self.width + block
        self.sums[node] = sum(map(len, self.parts[block])), sum(self.counts[block])
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, change: Edit) -> None:
        """Apply one edit; places outside the text are moved to its ends."""
        start = min(max(change.start, 0), self.n_chars)
        end = min(max(change.end, start), self.n_chars)
        if start == end and not change.new:
            return
        # A pre-token is fixed by its characters and the two behind it at most.
        first, begin = self._locate(max(0, start - 2))
        last, _ = self._locate(end)
        while True:
            old_parts = [p for block in self.parts[first : last + 1] for p in block]
            old_counts = [c for block in self.counts[first : last + 1] for c in block]
            done = self._recut(old_parts, old_counts, start - begin, end - begin, change.new, last + 1 == len(self.parts), self._ahead(last))
            if done:
                break
            last += 1
        parts, counts = done
        self.parts[first], self.counts[first] = parts, counts
        for k in range(first + 1, last + 1):
            self.parts[k], self.counts[k] = [], []
        if len(parts) > 8 * _BLOCK:
            self._build([p for b in self.parts for p in b], [c for b in self.counts for c in b])
            return
        for k in range(first, last + 1):
            self._update(k)

    def _ahead(self, last: int) -> str:
        """Two characters behind a block, for patterns that look ahead."""
        out = ""
        for k in range(last + 1, len(self.parts)):
            for part in self.parts[k]:
                out += part
                if len(out) >= 2:
                    return out[:2]
        return out

    def _recut(self, parts: list[str], counts: list[int], start: int, end: int, new: str, at_end: bool, ahead: str):
        """Pre-tokens of the region after the edit, or None if no cut behind it meets an old one."""
        kept = place = 0
        while kept < len(parts) and place + len(parts[kept]) <= start - 2:
            place += len(parts[kept])
            kept += 1
        old = "".join(parts[kept:])
        region = old[: start - place] + new + old[end - place :]
        # Old cuts at or behind the edit, as places in the region.
        shift, cuts, at = len(new) - (end - start), {}, place
        for k in range(kept, len(parts)):
            if at >= end:
                cuts[at - place + shift] = k
            at += len(parts[k])
        if not at_end:
            cuts.pop(len(region), None)
        behind = start - place + len(new)
        fresh, at = [], 0
        for part in self.tokenizer.cut(region + ahead):
            if at >= behind and at in cuts:
                k = cuts[at]
                break
            if at >= len(region):
                k = len(parts)
                break
            fresh.append(part)
            at += len(part)
        else:
            k = len(parts)
        if at != len(region) and at not in cuts or (k == len(parts) and not at_end):
            return None
        self.touched += len(fresh)
        return parts[:kept] + fresh + parts[k:], counts[:kept] + self.tokenizer.counts(fresh) + counts[k:]


_loaded: dict[int, Tokenizer] = {}


def _tokenizer_of(sent: Broadcast) -> Tokenizer:
    key = hash(sent.value)
    if key not in _loaded:
        _loaded[key] = Tokenizer(sent.value)
    return _loaded[key]


#: What a cleaning step replaces: addresses, long numbers, licence lines.
REDACTED = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "[address]"),
    (r"\+?[0-9](?:[ ().-]?[0-9]){6,}", "[number]"),
    (r"Licensed under[^\n]*", ""),
)


def redactions(text: str, rules: Sequence[tuple[str, str]] = REDACTED) -> list[Edit]:
    """Edits that apply the rules one after another, each from the front of the text on."""
    out = []
    for pattern, new in rules:
        moved = 0
        for found in regex.finditer(pattern, text):
            out.append(Edit(found.start() + moved, found.end() + moved, new))
            moved += len(new) - len(found[0])
        text = regex.sub(pattern, lambda _, new=new: new, text)
    return out


def _edit_of(given: dict) -> Edit:
    start = 0 if given["start"] is None or given["start"] != given["start"] else int(given["start"])
    end = start if given["end"] is None or given["end"] != given["end"] else int(given["end"])
    return Edit(start, end, given["new"] or "")


def edited_counts(
    docs: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", edits: str | None = None, edited: bool = False
) -> DataFrame:
    """Token counts before and after edits, beside the columns of ``docs`` but text and edits.

    ``edits`` names a column of type array<struct<start int, end int, new string>>, each
    edit over the text that the earlier ones left, places in code points; without it the
    edits are ``redactions``.  Results: ``n_tokens``, ``n_edits``, ``n_tokens_after``,
    ``n_touched`` (pre-tokens that were encoded again) and, with ``edited``, ``text_after``.
    A null or empty text has no tokens; null edits are none; a null ``start`` is the front of
    the text, a null ``end`` the place of ``start``, a null ``new`` an empty text; edits outside
    the text are moved to its ends.  Columns named like results are replaced.  One pass, no shuffle; a
    document without edits costs one count.
    """
    spark = docs.sparkSession
    ranked = spark.sparkContext.broadcast(_file_bytes(spark, vocabulary))

    def count(columns: Iterator[tuple[pd.Series, pd.Series | None]]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer_of(ranked)
        for texts, lists in columns:
            out = []
            for k, body in enumerate(texts):
                body = body or ""
                if lists is not None:
                    given = lists.iloc[k]
                    changes = [_edit_of(e) for e in given if e is not None] if given is not None else []
                else:
                    changes = redactions(body)
                if not changes:
                    n = tokenizer.total(body)
                    out.append((n, 0, n, 0, body))
                    continue
                tree = TokenTree(tokenizer, body)
                before = tree.n_tokens
                for change in changes:
                    tree.edit(change)
                out.append((before, len(changes), tree.n_tokens, tree.touched, tree.text if edited else ""))
            yield pd.DataFrame(out, columns=["n_tokens", "n_edits", "n_tokens_after", "n_touched", "text_after"])

    def given(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        yield from count(columns)

    def found_out(columns: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from count((texts, None) for texts in columns)

    own = ["n_tokens", "n_edits", "n_tokens_after", "n_touched", "text_after"]
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, edits, *own)]
    shape = "n_tokens long, n_edits long, n_tokens_after long, n_touched long, text_after string"
    found = F.pandas_udf(given, shape)(text, edits) if edits else F.pandas_udf(found_out, shape)(text)
    return docs.select(*kept, found.alias("_found")).select(*kept, *[F.col(f"_found.{c}").alias(c) for c in own[: 4 + edited]])


def _file_bytes(spark, path: str) -> bytes:
    """The vocabulary, from a local file of the driver or any store that Spark reads."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as file:
        return file.read()
