"""Substring deduplication: winnowed seeds, extended both ways to maximal repeats.

Words are the maximal runs of characters other than U+0020 and U+0009..U+000D, kept
as they are. A window is ``length`` consecutive words of one text. Every word that a
window covers whose word sequence starts anywhere else too (in the same text or in
another) is part of a repeat; overlapping windows grow together into maximal repeats.

Seeds. The hashes of all k-word grams are winnowed: each window selects its leftmost
least gram, so equal windows select equal anchors at the same place, and a text keeps
about one anchor in ``length / 2.5`` words. An anchor belongs to the run of windows that
selected it; the words of these windows are its reach, to the left and to the right.

Extension. Occurrences of an anchor are joined by its hash, never pair by pair. If all
of them have the same reach, they extend both ways over the whole of it, and all their
windows are repeats. Otherwise each occurrence is extended by every number of words to
the left that a window can hold, and by the rest of the window to the right: the digests
of these stretches are counted, and those met twice or more are matches. A match is
identified by 64 bits of the anchor and 64 independent bits of the stretch.

Shuffles: anchors by hash (counts with a partial aggregate, so copies of one passage
cost a row per task; then anchors against the repeated ones, a join that adaptive
execution splits where a hash is hot), the stretches of anchors with different reaches,
and each text once: both joins of the texts use one exchange.

Nulls, ties, repeats: a null or empty text has no words and nothing to remove. Texts
shorter than ``length`` words have no window. Rows are judged each by its own text, so
a repeated row is a copy like any other, null or repeated doc_ids included; one row is
returned for each. A text of any length is read whole. Extra columns stay as they are;
a column that bears the name of a result must be renamed before (an error says so).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playtrail.llm.common import cut, text_chunks

LENGTH = 35
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4D)  # odd: they have inverses modulo 2^64
RESULTS = {"n_words": "long", "n_removed": "long", "kept": "string", "repeats": "array<struct<start:long,end:long>>"}


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit integers over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def gram(length: int) -> tuple[int, int]:
    """(words of a gram, grams in a window) for a window of ``length`` words."""
    grams = max(1, length * 4 // 5)
    return length - grams + 1, grams


class Stretches:
    """Digests of any stretch of a sequence of words, from sums of their hashes."""

    def __init__(self, words: list[bytes]):
        hashes = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
        self.sums, self.inverse = [], []
        for column, base in enumerate(BASES):
            powers = np.full(len(words), base, np.uint64).cumprod()
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), (hashes[:, column] * powers).cumsum(dtype=np.uint64)]))
            self.inverse.append(np.full(len(words) + 1, pow(base, -1, 1 << 64), np.uint64).cumprod())

    def digest(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64 bits that settle the words of [start, end), wherever they stand."""
        sums = self.sums[which]
        return mix((sums[end] - sums[start]) * self.inverse[which][start])


class Anchors:
    """The anchors of a list of texts, and the windows that selected each.

    ``text`` is the number of the text, ``at`` the anchor's first word (in the words of
    all texts), ``first`` and ``last`` its first and last window, ``hash`` its 64 bits.
    """

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        split = [t.split() for t in texts]  # bytes: ASCII white space only
        self.bounds = np.concatenate([[0], np.cumsum([len(w) for w in split], dtype=np.int64)]).astype(np.int64)
        self.words = [w for ws in split for w in ws]
        size, grams = gram(length)
        total = len(self.words)
        # Windows that end inside the text they start in.
        counts = np.diff(self.bounds)
        starts = np.arange(total)
        ends = np.repeat(self.bounds[1:], counts)
        windows = starts[starts + length <= ends]
        if not len(windows):
            self.text = self.at = self.first = self.last = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.uint64)
            return
        self.stretches = Stretches(self.words)
        hashes = np.full(total, 2**64 - 1, np.uint64)
        whole = starts[: total - size + 1]
        hashes[: len(whole)] = self.stretches.digest(0, whole, whole + size)
        # Leftmost least of the next ``span`` grams, for growing spans; a window's own grams are inside its text.
        least, span = starts, 1
        while span < grams:
            step = min(span, grams - span)
            ahead = np.minimum(starts + step, total - 1)
            least = np.where(hashes[least] <= hashes[least[ahead]], least, least[ahead])
            span += step
        chosen = least[windows]
        new = np.flatnonzero(np.concatenate([[True], np.diff(chosen) != 0]))
        self.at, self.first = chosen[new], windows[new]
        self.last = windows[np.concatenate([new[1:], [len(windows)]]) - 1]
        self.text = np.searchsorted(self.bounds, self.at, side="right") - 1
        self.hash = hashes[self.at]

    def reach(self) -> np.ndarray:
        """64 bits for what each anchor's windows cover, and its place in that."""
        if not len(self.at):
            return np.zeros(0, np.uint64)
        place = ((self.at - self.first) * (self.length + 1) + self.last - self.first).astype(np.uint64)
        return mix(self.stretches.digest(1, self.first, self.last + self.length) ^ mix(place + np.uint64(1)))

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, window, digest of the window) for the windows of some anchors."""
        sizes = self.last[which] - self.first[which] + 1
        anchor = np.repeat(which, sizes)
        inside = np.arange(len(anchor)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        start = self.first[anchor] + inside
        if not len(start):
            return anchor, start, np.zeros(0, np.uint64)
        return anchor, start, self.stretches.digest(1, start, start + self.length)


def _bytes(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column.cast(pa.large_string())]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _seeds(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            found = Anchors(_bytes(b.column(1)), length)
            rid = b.column(0).take(pa.array(found.text))
            yield pa.RecordBatch.from_arrays(
                [rid, _signed(found.hash), _signed(found.reach())], ["rid", "seed", "reach"]
            )

    return run


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for every value of a list column."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    return rows, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _among(texts: np.ndarray, values: np.ndarray, column: pa.Array) -> np.ndarray:
    """Which (text, value) are in the list of that text."""
    rows, known = _sets(column)
    rows, known = np.concatenate([texts, rows]), np.concatenate([values, known])
    order = np.lexsort((known, rows))
    new = (np.diff(rows[order]) != 0) | (np.diff(known[order]) != 0)
    number = np.zeros(len(rows), np.int64)
    number[order[1:]] = np.cumsum(new)
    return np.isin(number[: len(texts)], number[len(texts) :])


def _matches(length: int, text: int):
    """From (row, rid, mixed): the windows of anchors whose occurrences differ in their
    reach. ``text`` is the place of the text in a row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            found = Anchors(_bytes(b.column(0).flatten()[text]), length)
            open_ = np.flatnonzero(_among(found.text, found.hash, b.column(2)))
            anchor, _, digest = found.windows(open_)
            yield pa.RecordBatch.from_arrays(
                [b.column(1).take(pa.array(found.text[anchor])), _signed(found.hash[anchor]), _signed(digest)],
                ["rid", "seed", "stretch"],
            )

    return run


def covered(found: Anchors, alike: np.ndarray, mixed: np.ndarray, stretches: pa.Array) -> np.ndarray:
    """Which words of all texts a repeated window covers."""
    edges = np.zeros(len(found.words) + 1, np.int64)
    np.add.at(edges, found.first[alike], 1)
    np.add.at(edges, found.last[alike] + found.length, -1)
    anchor, start, digest = found.windows(np.flatnonzero(mixed))
    start = start[_among(found.text[anchor], digest, stretches)]
    np.add.at(edges, start, 1)
    np.add.at(edges, start + found.length, -1)
    return edges.cumsum()[:-1] > 0


def _removed(length: int, text: int):
    """From (row, alike, mixed, stretches): the row and ``RESULTS``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            found = Anchors(_bytes(b.column(0).flatten()[text]), length)
            alike, mixed = (_among(found.text, found.hash, b.column(i)) for i in (1, 2))
            gone = covered(found, alike, mixed, b.column(3))
            counts, removed, kept, repeats = [], [], [], []
            for start, end in zip(found.bounds[:-1], found.bounds[1:]):
                own, words = gone[start:end], found.words[start:end]
                turns = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]).astype(np.int8)))
                counts.append(len(words))
                removed.append(int(own.sum()))
                repeats.append([{"start": int(x), "end": int(y)} for x, y in zip(turns[::2], turns[1::2])])
                kept.append(b" ".join(compress(words, (~own).tolist())).decode())
            spans = pa.array(repeats, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), spans],
                ["row", *RESULTS],
            )

    return run


def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with n_words, n_removed, kept (the words left, joined by one space) and
    repeats (the maximal repeats as spans of words)."""
    names = docs.columns
    clash = sorted(set(names) & set(RESULTS))
    if clash:
        raise ValueError(f"docs already has the columns {clash}; rename or drop them")
    identity = [F.col(c).cast("string") for c in ("doc_id", "text") if c in names]
    rows = docs.select(F.struct(*names).alias("row"), F.xxhash64(*identity).alias("rid"))
    anchors = docs.select(F.xxhash64(*identity).alias("rid"), F.col("text").cast("string"))
    anchors = anchors.mapInArrow(_seeds(length), "rid long, seed long, reach long")
    seeds = anchors.groupBy("seed").agg(F.count("*").alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high"))
    seeds = cut(seeds.filter("n > 1").select("seed", F.expr("low < high").alias("mixed")))
    # Hints: the same plan at every size, and joins that split a hot seed.
    met = anchors.select("seed", "rid").join(seeds.hint("merge"), "seed")
    known = cut(
        met.groupBy("rid").agg(
            F.collect_set(F.when(~F.col("mixed"), F.col("seed"))).alias("alike"),
            F.collect_set(F.when(F.col("mixed"), F.col("seed"))).alias("mixed"),
        )
    )
    # The exchange of ``rows`` by rid serves this join and the last one.
    text = names.index("text")
    candidates = rows.join(known.hint("merge"), "rid").select("row", "rid", "mixed")
    stretches = candidates.mapInArrow(_matches(length, text), "rid long, seed long, stretch long")
    repeated = stretches.groupBy("seed", "stretch").agg(F.count("*").alias("n")).filter("n > 1")
    # As one column, the key is dealt out anew on both sides, and the join can split one that is hot.
    pair = F.struct("seed", "stretch").alias("pair")
    matched = stretches.select("rid", "stretch", pair).join(repeated.select(pair).hint("merge"), "pair")
    matched = matched.groupBy("rid").agg(F.collect_set("stretch").alias("stretches"))
    done = rows.join(known.hint("merge"), "rid", "left").join(matched.hint("merge"), "rid", "left")
    done = done.select("row", "alike", "mixed", "stretches")
    schema = StructType([rows.schema["row"], *StructType.fromDDL(", ".join(f"{n} {t}" for n, t in RESULTS.items()))])
    return done.mapInArrow(_removed(length, text), schema).select("row.*", *RESULTS)


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): one row per row of ``docs``."""
    done = remove(docs.select("doc_id", "text"), length)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept_sha256) of every text, by counting all windows."""
    split = [(t or "").encode().split() for t in texts]
    counts: dict[tuple, int] = {}
    for words in split:
        for i in range(len(words) - length + 1):
            key = tuple(words[i : i + length])
            counts[key] = counts.get(key, 0) + 1
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - length + 1):
            if counts[tuple(words[i : i + length])] > 1:
                gone.update(range(i, i + length))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
