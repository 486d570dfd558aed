"""Benchmark decontamination by an FM-index of each shard of the corpus.

Words are the matches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing
A-Z. A test phrase (window) is ``window`` consecutive words of a benchmark
item; an item with fewer words, but not none, is one phrase.

Documents stay in the partitions they are read in (no shuffle). A shard is a
bounded run of rows of one partition. Its word sequence is written over the
alphabet of the benchmark's words; every other word can't be part of a match
and becomes a terminator, and a run between terminators that is shorter than
the shortest phrase can't hold one and is left out. Over the rest: suffix
array by prefix doubling, the Burrows-Wheeler transform in a wavelet matrix,
and every ``SAMPLE``-th text position kept. All phrases are searched backwards
at once, one wavelet rank per bit level and word; the rows found are walked to a
sampled position; spans are merged per document.

The phrases are what every task gets. Items are dealt into blocks by doc order
of item_id so that one block has at most ``BLOCK_WORDS`` words (a proven bound
of the closure's size, or one item); with several blocks the corpus passes each
block in turn, and what the earlier ones found is carried along in the row. The
driver holds one block at a time.

Nulls and ties: a null text has no words; a null item text gives no phrase.
Items with equal phrases each count. Items without an item_id mark words as hit
but are not named. Rows come back one for one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut

WINDOW = 10
SAMPLE = 8
SHARD_WORDS = 2_000_000
BLOCK_WORDS = 4_000_000

# Lower-case A-Z; every other ASCII character but 0-9 and a-z becomes a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(data: bytes) -> list[bytes]:
    """The words of a UTF-8 text."""
    return data.translate(FOLD).split()


class Phrases:
    """The phrases of one block of benchmark items, as word numbers."""

    def __init__(self, items: list[tuple[object, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        rows: dict[tuple[int, ...], int] = {}
        owners: list[list[int]] = []
        self.items: list[object] = []
        for item, text in items:
            ids = [self.number.setdefault(w, len(self.number) + 2) for w in words(text)]
            if not ids:
                continue
            at = len(self.items)
            self.items.append(item)
            for k in range(max(1, len(ids) - window + 1)):
                row = rows.setdefault(tuple(ids[k : k + window]), len(rows))
                if row == len(owners):
                    owners.append([])
                owners[row].append(at)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.table = np.zeros((len(rows), window), np.int64)  # right-aligned: searched from the last word on
        for r, k in rows.items():
            self.table[k, window - len(r) :] = r
        self.owners = [sorted(set(o)) for o in owners]
        self.shortest = int(self.lengths.min()) if len(rows) else 0


class FMIndex:
    """FM-index over numbers >= 1, 1 being the terminator of every run."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        n = len(text)
        # Terminators differ by position, so that no suffix comparison passes one.
        ends = np.flatnonzero(text == 1)
        rank = text + len(ends)
        rank[ends] = np.arange(len(ends))
        width = 1
        while True:
            after = np.full(n, -1, np.int64)
            after[: n - width] = rank[width:]
            order = np.lexsort((after, rank))
            fresh = np.empty(n, bool)
            fresh[0] = False
            fresh[1:] = (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(fresh)
            width *= 2
            if fresh.sum() == n - 1 or width >= n:
                break
        self.n, self.sample = n, sample
        self.last = text[order - 1]  # the transform: the word before each suffix
        top = int(text.max())
        self.first = np.searchsorted(text[order], np.arange(top + 2))  # where each word's suffixes begin
        # Run starts are kept too: a walk never has to step over a terminator.
        sampled = (order % sample == 0) | (self.last == 1)
        self.sampled = np.concatenate([[0], np.cumsum(sampled)])
        self.is_sampled, self.places = sampled, order[sampled]
        self.bits = max(1, top.bit_length())
        self.levels: list[np.ndarray] = []  # ones before each place, per level, highest bit first
        self.zeros: list[int] = []
        now = self.last
        for level in range(self.bits - 1, -1, -1):
            one = (now >> level) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append(ones)
            self.zeros.append(n - int(ones[-1]))
            now = np.concatenate([now[one == 0], now[one == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs in the transform before ``place``."""
        low, high = np.zeros(len(symbol), np.int64), place.astype(np.int64)
        for k, ones in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            low_1, high_1 = ones[low], ones[high]
            low = np.where(one, self.zeros[k] + low_1, low - low_1)
            high = np.where(one, self.zeros[k] + high_1, high - high_1)
        return high - low

    def find(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of right-aligned rows; 0 stands before a short row."""
        low, high = np.zeros(len(table), np.int64), np.full(len(table), self.n, np.int64)
        top = len(self.first) - 2
        live = np.arange(len(table))
        for column in range(table.shape[1] - 1, -1, -1):
            symbol = table[live, column]
            go = symbol > 0
            gone = go & (symbol > top)
            low[live[gone]] = high[live[gone]] = 0
            at, symbol = live[go & ~gone], symbol[go & ~gone]
            low[at] = self.first[symbol] + self.rank(symbol, low[at])
            high[at] = self.first[symbol] + self.rank(symbol, high[at])
            live = live[low[live] < high[live]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows, by walking back to a sampled one."""
        rows, steps, out = rows.copy(), 0, np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            here = self.is_sampled[rows[open_]]
            done = open_[here]
            out[done] = self.places[self.sampled[rows[done]]] + steps
            open_ = open_[~here]
            at = rows[open_]
            symbol = self.last[at]
            rows[open_] = self.first[symbol] + self.rank(symbol, at)
            steps += 1
        return out


def search_shard(docs: list[list[bytes]], phrases: Phrases) -> list[tuple[np.ndarray, list[int]]]:
    """For each document (as words): merged hit spans, an array of rows
    (first word, end), and the numbers of the items with occurring phrases."""
    none = np.zeros((0, 2), np.int64)
    lengths = np.array([len(d) for d in docs], np.int64)
    get = phrases.number.get
    text = np.fromiter((get(w, 1) for d in docs for w in (*d, b"")), np.int64, int(lengths.sum()) + len(docs))
    known = text > 1
    edge = np.diff(np.concatenate([[0], known.astype(np.int8), [0]]))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    fit = stops - starts >= max(1, phrases.shortest)
    starts, stops = starts[fit], stops[fit]
    if not len(starts):
        return [(none, [])] * len(docs)
    sizes = stops - starts + 1  # with the terminator that follows each run
    base = np.cumsum(sizes) - sizes
    place = np.repeat(starts - base, sizes) + np.arange(int(sizes.sum()))
    index = FMIndex(text[place])
    low, high = index.find(phrases.table)
    found = np.flatnonzero(high > low)
    counts = (high - low)[found]
    phrase = np.repeat(found, counts)
    rows = np.repeat(low[found] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    first = place[index.locate(rows)]
    doc_end = np.cumsum(lengths + 1)
    doc = np.searchsorted(doc_end, first, side="right")
    first = first - (doc_end - lengths - 1)[doc]
    end = first + phrases.lengths[phrase]
    out: list[tuple[np.ndarray, list[int]]] = [(none, [])] * len(docs)
    order = np.lexsort((first, doc))
    doc, first, end, phrase = doc[order], first[order], end[order], phrase[order]
    cuts = np.flatnonzero(np.diff(doc)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(doc)]):
        if a == b:
            continue
        reach = np.maximum.accumulate(end[a:b])
        new = np.concatenate([[True], first[a + 1 : b] > reach[:-1]])
        begin = np.flatnonzero(new)
        spans = np.stack([first[a:b][begin], np.concatenate([reach[begin[1:] - 1], reach[-1:]])], axis=1)
        out[int(doc[a])] = (spans, sorted({o for p in set(phrase[a:b].tolist()) for o in phrases.owners[p]}))
    return out


def _shards(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with the words of their texts, ``SHARD_WORDS`` or
    one text at most in a slice."""
    for batch in batches:
        start, held, docs = 0, 0, []
        for k, t in enumerate(batch.column(column).cast(pa.large_string())):
            own = words(t.as_buffer().to_pybytes()) if t.is_valid else []
            if docs and held + len(own) > SHARD_WORDS:
                yield batch.slice(start, k - start), docs
                start, held, docs = k, 0, []
            docs.append(own)
            held += len(own)
        if docs:
            yield batch.slice(start), docs


def phrase_blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[Phrases]:
    """The benchmark's phrases, a block of bounded size at a time."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    held, size = [], 0
    for row in items.orderBy("item_id", "text").toLocalIterator():
        data = row["text"].encode()
        if held and size + len(data) // 2 > block_words:
            yield Phrases(held, window)
            held, size = [], 0
        held.append((row["item_id"], data))
        size += len(data) // 2 + 1
    yield Phrases(held, window)


def _search(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """``docs`` with n_words, and the hits of these phrases added to its
    columns spans (arrays of [first word, end)) and items (item ids)."""
    names = docs.columns
    at = {c: names.index(c) for c in ("text", "spans", "items")}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _shards(batches, at["text"]):
            columns = dict(zip(names, part.columns))
            hits = search_shard(texts, phrases)
            ids = [[str(phrases.items[i]) for i in own if phrases.items[i] is not None] for _, own in hits]
            columns["n_words"] = pa.array([len(t) for t in texts], pa.int64())
            columns["spans"] = pa.array(
                [old + new.tolist() for old, (new, _) in zip(columns["spans"].to_pylist(), hits)],
                pa.list_(pa.list_(pa.int64())),
            )
            columns["items"] = pa.array(
                [old + new for old, new in zip(columns["items"].to_pylist(), ids)], pa.list_(pa.string())
            )
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` (whose columns must not be called n_words, spans
    or items) with its number of words, hit spans and items, all blocks done."""
    docs = docs.withColumns(
        {
            "text": F.col("text").cast("string"),
            "n_words": F.lit(None).cast("long"),
            "spans": F.lit(None).cast("array<array<bigint>>"),
            "items": F.lit(None).cast("array<string>"),
        }
    ).withColumns({"spans": F.coalesce("spans", F.array()), "items": F.coalesce("items", F.array())})
    for k, phrases in enumerate(phrase_blocks(benchmark, window, block_words)):
        docs = _search(cut(docs) if k else docs, phrases)
    return docs


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row."""
    hits = find(docs.select("doc_id", "text"), benchmark, window, block_words)
    hit = F.expr(
        "aggregate(array_sort(spans), named_struct('n', 0L, 'reach', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s[1] - greatest(s[0], a.reach)), 'reach', greatest(a.reach, s[1])), a -> a.n)"
    )
    ids = F.array_sort(F.array_distinct("items"))
    return hits.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` without an occurrence of any phrase, columns unchanged."""
    names = docs.columns
    row = docs.select(F.struct(*names).alias("row"), F.col("text").cast("string").alias("text"))
    found = find(row, benchmark, window, block_words)
    return found.filter(F.size("spans") == 0).select("row.*")


def items_digest(items: Iterable[str]) -> str:
    """What ``items_sha256`` holds for these item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
