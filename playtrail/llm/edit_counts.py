"""Token counts that follow edits without encoding the document again.

A document's text is split into pre-tokens by the vocabulary's pattern; no token
crosses one, so the count of a text is the sum over its pre-tokens. They lie in
leaves of up to ``LEAF`` pre-tokens, and a segment tree over the leaves holds
characters and tokens of every subtree.

An edit (start, end, new text) touches the pre-tokens from the one that ends at
or holds the place before ``start`` (its end may move: the boundary
context on the left). Splitting goes on from there over the new text until a
boundary falls on an old boundary behind the edit; matches look ahead only, so from
there on both splits agree. Only these pre-tokens are counted, and only the sums
above their leaves are renewed.

Positions are code points. Edits are applied one after another, each to the text that the
one before left; positions outside the text are moved to its nearest end. Nulls: a null text is empty, a
null list of edits is no edit. Rows come back one for one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import Memory, text_chunks

# Fixed value: the split pattern of the vocabulary's family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 64
MAX_KNOWN = 250_000


class Counter:
    """Pre-tokens of a text and their token counts, with a bounded memory of counts."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.encoding = tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.known = Memory(MAX_KNOWN)

    def count(self, piece: str) -> int:
        """Tokens of one pre-token."""
        n = self.known.young.get(piece) or self.known.find(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(piece) <= 64:
                self.known.put(piece, n)
        return n


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    """The counter of a vocabulary file, one per Python worker."""
    return Counter(path)


class TokenTree:
    """Segment tree over the leaves of one document."""

    def __init__(self, text: str, own: Counter):
        self.own = own
        self.counted = 0
        self._build(own.pattern.findall(text))

    def _build(self, pieces: list[str]) -> None:
        self.leaves = [pieces[k : k + LEAF] for k in range(0, len(pieces), LEAF)] or [[]]
        self.size = 1
        while self.size < len(self.leaves):
            self.size *= 2
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for k, leaf in enumerate(self.leaves):
            self._sum(k, leaf)
        for k in range(self.size - 1, 0, -1):
            self._add(k)

    def _sum(self, k: int, leaf: list[str]) -> None:
        get, count = self.own.known.young.get, self.own.count
        self.chars[self.size + k] = sum(map(len, leaf))
        self.tokens[self.size + k] = sum([get(p) or count(p) for p in leaf])

    def _add(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _renew(self, first: int, last: int) -> None:
        low, high = (self.size + first) // 2, (self.size + last) // 2
        while low:
            for k in range(low, high + 1):
                self._add(k)
            low, high = low // 2, high // 2

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(p for leaf in self.leaves for p in leaf)

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character (the last leaf beyond the end) and where it begins."""
        k, before = 1, 0
        while k < self.size:
            k *= 2
            if place >= before + self.chars[k] and self.chars[k + 1]:
                before += self.chars[k]
                k += 1
        return min(k - self.size, len(self.leaves) - 1), before

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters [start, end) by ``new``."""
        start = max(0, min(start, self.n_chars))
        end = max(start, min(end, self.n_chars))
        leaf, at = self._leaf_at(max(0, start - 2))
        # What ends at the edit may go on, and white space leaves its last character to what follows.
        k = 0
        while k < len(self.leaves[leaf]) and at + len(self.leaves[leaf][k]) < start - 1:
            at += len(self.leaves[leaf][k])
            k += 1
        head, first = self.leaves[leaf][:k], leaf
        # Old pre-tokens from here on, taken leaf by leaf as far as they are needed.
        old, place, last = self.leaves[leaf][k:], at, leaf
        fresh: list[str] = []
        window = "".join(old)
        while len(window) < end - at and last + 1 < len(self.leaves):
            last += 1
            old = old + self.leaves[last]
            window = "".join(old)
        tail: list[str] = []
        while True:
            joined = window[: start - at] + new + window[end - at :]
            more = last + 1 < len(self.leaves)
            bounds, place = {}, at
            for n, p in enumerate(old):
                if place >= end:
                    bounds[place + len(new) - (end - start)] = n
                place += len(p)
            if not more:
                bounds[at + len(joined)] = len(old)
            fresh, place, done = [], at, False
            pieces = self.own.pattern.findall(joined)
            # The last match may change with what follows, and white space looks one further.
            for p in pieces if not more else pieces[:-2]:
                if place in bounds and place >= start + len(new):
                    tail, done = old[bounds[place] :], True
                    break
                fresh.append(p)
                place += len(p)
            if done or not more:
                break
            last += 1
            old = old + self.leaves[last]
            window = "".join(old)
        self.counted += len(fresh)
        merged = head + fresh + tail
        span = last - first + 1
        if len(merged) > 4 * LEAF * span or not merged and len(self.leaves) == 1:
            self._build([p for x in (*self.leaves[:first], merged, *self.leaves[last + 1 :]) for p in x])
            return
        cut = -(-len(merged) // span) or 1
        for n in range(span):
            self.leaves[first + n] = merged[n * cut : (n + 1) * cut]
            self._sum(first + n, self.leaves[first + n])
        self._renew(first, last)


def count_edits(docs: DataFrame, vocabulary: str) -> DataFrame:
    """For every row of (doc_id, text, edits): n_tokens of the text, tokens and characters
    after all edits, pre-tokens of the text, pre-tokens counted again, and the SHA-256 of the edited text.
    ``edits`` is an array of (start, end, new)."""
    schema = (
        "doc_id long, n_tokens long, n_pretokens long, n_edits long, n_recounted long, "
        "edited_tokens long, edited_chars long, edited_sha256 string"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(vocabulary)
        for b in text_chunks(batches):
            rows = []
            for doc, text, edits in zip(*(c.to_pylist() for c in b.columns)):
                tree = TokenTree(text or "", own)
                before, pieces = tree.n_tokens, sum(map(len, tree.leaves))
                for e in edits or []:
                    tree.edit(e["start"], e["end"], e["new"] or "")
                digest = hashlib.sha256(tree.text().encode()).hexdigest()
                rows.append((doc, before, pieces, len(edits or []), tree.counted, tree.n_tokens, tree.n_chars, digest))
            columns = list(zip(*rows)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "edits")
    return picked.mapInArrow(run, schema)


def scripted_edits(n: int = 3, width: int = 12):
    """``n`` edits a document, drawn from hashes of doc_id: ``width`` characters are
    replaced by a passage from elsewhere in the text."""
    length = F.length(F.coalesce(F.col("text"), F.lit("")))

    def place(k: int, salt: int):
        return F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(k * 10 + salt)), length + 1).cast("long")

    return F.array(
        *[
            F.struct(
                place(k, 1).alias("start"),
                (place(k, 1) + (k * width) // max(1, n - 1)).alias("end"),
                F.substring(F.coalesce("text", F.lit("")), (place(k, 2) + 1).cast("int"), F.lit(width)).alias("new"),
            )
            for k in range(n)
        ]
    )
