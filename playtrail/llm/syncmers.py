"""Document fingerprints from closed syncmers.

Over the UTF-8 bytes of a text, with ``K - 1`` zero bytes in front (so that
short texts and beginnings have k-mers), a k-mer is an anchor if the smallest
hash among its s-mers lies at its first or last s-mer. Whether a k-mer is chosen
depends on its own bytes only, so a shared passage gives the same anchors in
any document, at positions that differ by one offset.

The fingerprint of a text is all its anchors with their places. Written as a string it has a
digest of all of them, then those that a rule picks, hash and place: every anchor
whose hash is in the lowest 1 / ``SHARE``, and the ``SKETCH`` smallest in any case, so
that the string grows with the text. A window of ``K - S + 1`` k-mers always holds an
anchor, so a change of one character anywhere changes the digest. The likeness
of two fingerprints is the Jaccard index of their anchors, where shared anchors count
only as far as they lie in the same order in both texts (longest increasing run of
places): 1 for equal texts, 0 for texts without a common anchor, and above it for a
shared passage of any two texts, however long they are.

Each document's successor in descending order of doc_id is found without a
global sort: ranges of doc_id from approximate quantiles, one shuffle by range,
and each range's first document is sent to the range before it as well.

Nulls and ties: a null text is empty; an empty text has an empty
fingerprint, and two of those have likeness 1. Rows without a doc_id come last,
in order of a hash of their text; rows of equal doc_id are ordered by text.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import shuffle_parts, text_chunks

K = 16
S = 8
SKETCH = 64  # anchors in a fingerprint's string at least, and
SHARE = 16  # one in so many of the text's
CHUNK = 1 << 18


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, position) of the closed syncmers of a text, by position."""
    n, window = len(data), K - S + 1
    hashes, places = [], []
    padded = np.frombuffer(b"\0" * (K - 1) + data, np.uint8)
    for start in range(0, n, CHUNK):  # k-mers start..; bounded working memory for very long texts
        part = np.ascontiguousarray(padded[start : min(n, start + CHUNK) + K - 1])
        eights = np.ndarray(len(part) - S + 1, "<u8", part, strides=(1,))
        small = _mix(eights.astype(np.uint64))
        count = len(small) - window + 1
        low = small
        span = 1
        while span * 2 <= window:  # minimum over the window by doubling
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        rest = window - span
        low = np.minimum(low[:count], low[rest : rest + count])
        at = np.flatnonzero((small[:count] == low) | (small[window - 1 : window - 1 + count] == low))
        hashes.append(_mix(small[at] ^ (small[at + K - S] * np.uint64(0xD6E8FEB86659FD93))))
        places.append(at + start)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


class Fingerprint:
    """The anchors of a text: distinct hashes in order, each at its first place, and a digest
    of all anchors with all their places."""

    def __init__(self, hashes: np.ndarray, places: np.ndarray):
        self.digest = xxhash.xxh3_64_hexdigest(hashes.tobytes() + places.tobytes()) if len(hashes) else ""
        self.hashes, first = np.unique(hashes, return_index=True)  # the first of equal ones
        self.places = places[first]


def sketch(data: bytes) -> Fingerprint:
    """The fingerprint of a text."""
    return Fingerprint(*anchors(data))


def spell(own: Fingerprint, size: int = SKETCH) -> str:
    """A fingerprint as a string; empty for an empty text."""
    if not own.digest:
        return ""
    count = max(size, int(np.searchsorted(own.hashes, np.uint64((1 << 64) // SHARE))))
    entries = zip((own.hashes[:count] >> np.uint64(32)).tolist(), own.places[:count].tolist())
    return own.digest + ":" + ",".join([f"{h:08x}{p:x}" for h, p in entries])


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of common, equally ordered anchors among all anchors of both."""
    if not len(a.hashes) or not len(b.hashes):
        return float(len(a.hashes) == len(b.hashes))
    shared, at_a, at_b = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    tails: list[int] = []
    for place in b.places[at_b][np.argsort(a.places[at_a])].tolist():
        if not tails or place > tails[-1]:
            tails.append(place)
        else:
            tails[bisect_left(tails, place)] = place
    return len(tails) / (len(a.hashes) + len(b.hashes) - len(shared))


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_successors(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """(range, ahead, doc_id, text) in order within each range: every row, and
    behind a range's rows the first of the next range (``ahead``)."""
    parts = parts or shuffle_parts(docs)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    # The order's key: doc_id; rows without one are spread by text, behind all others.
    last = F.lit(-(1 << 63)) + F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    rows = rows.withColumn("key", F.coalesce("doc_id", last))
    shares = [k / parts for k in range(1, parts)] or [0.5]
    cuts, least = rows.agg(F.percentile_approx("key", shares, 10_000), F.min("key")).first()
    bounds = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts or [])) if c > least])
    ranged = rows.withColumn("range", F.size(F.filter(bounds, lambda c: F.col("key") < c)))
    # One row per range: its first key; that document is also wanted behind the range before.
    heads = sorted(tuple(r) for r in ranged.groupBy("range").agg(F.max("key")).collect())
    before = F.create_map(*[F.lit(x) for k, (_, key) in enumerate(heads) for x in (key, heads[k - 1][0])])
    before = before[F.col("key")] if heads else F.lit(None).cast("int")
    places = F.array_compact(
        F.array(
            F.struct("range", F.lit(False).alias("ahead")),
            F.when(before.isNotNull(), F.struct(before.alias("range"), F.lit(True).alias("ahead"))),
        )
    )
    dealt = ranged.select(F.explode(places).alias("p"), "key", "doc_id", "text")
    dealt = dealt.select("p.range", "p.ahead", "key", "doc_id", "text")
    ordered = dealt.repartition(parts, "range").sortWithinPartitions("range", "ahead", F.desc("key"), "text")
    return ordered.drop("key")


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, str, str]]:
    """(doc_id, text, next text) of every row that isn't only there as a successor."""
    held = None  # (range, doc_id, text) still without its successor
    for b in text_chunks(batches):
        for place, ahead, doc, text in zip(*(c.to_pylist() for c in b.columns)):
            if held is not None and held[0] == place:
                yield held[1], held[2], text
            held = None if ahead else (place, doc, text)


def fingerprints(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last = [], (None, None)
        for doc, text, following in _pairs(batches):
            own = last[1] if last[0] == text else sketch(text.encode())
            other = sketch(following.encode())
            last = (following, other)
            new = edited(text, following)
            changed = own if new == text else sketch(new.encode())
            rows.append(
                (doc, len(text), hashlib.sha256(new.encode()).hexdigest(), spell(own), spell(changed),
                 likeness(own, changed), likeness(own, other))
            )
            if len(rows) >= 512:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), _arrow(names))
                rows = []
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))), _arrow(names))

    return with_successors(docs, parts).mapInArrow(run, schema)


def _arrow(names: list[str]) -> pa.Schema:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.schema(list(zip(names, kinds)))
