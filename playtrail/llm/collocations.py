"""Phrase collocations: counts of the longest windows only, shorter ones by ROLLUP.

Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and U+000A..U+000D into pieces, and
these at U+0020 and U+0009 into words. All counts are per language (null: ``und``).

Top-order marginalisation. Each word leads one window: it and the words after it in its
piece in ``size`` columns, padded with nulls where the piece ends. Only these windows are
counted; Spark's ROLLUP over the columns then sums the counts of every prefix, which
are the counts of all phrases of 1 to ``size`` words, and of all words.

Shuffles. A task counts the windows of its own texts block by block and ships them
sorted and compressed, in buckets of (language, first word, second word). The task of a
bucket adds them up and, as no phrase under ``least`` occurrences is asked for, pads a
window after its first or second word where the count of its two or three words
shows that no longer phrase can reach it: sums of prefixes stay what they are. What is
left is small and goes to the grouping and to ROLLUP as plain rows. Two words that hold
a large share of a block are dealt out by whole windows, and a mark tells the bucket of
these words that their counts lie elsewhere, so that nothing is padded there.

Candidates of two and more words are scored by their weakest cut, a / (l + r) in
millionths of two, in decimals; a candidate inside a longer one that has at least
``inside`` percent of its occurrences is dropped.

Nulls, ties, repeats: a null text is empty, repeated rows count again, whatever their
doc_id. Equal scores go by count and then by phrase (UTF-8 bytes). A text of any length
is read whole. Extra columns are ignored.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut, shuffle_parts

SIZE = 4  # words of a window
LEAST = 30
INSIDE = 80
TOP = 2000
BLOCK = 1 << 20  # windows counted at a time in a task
BUCKET_BYTES = 4 << 20  # of text that a bucket holds the windows of, about
HEAVY = 64  # two words with over 1/HEAVY of a block's windows are dealt out by whole windows
UNKNOWN = "und"

_PIECES = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)


class Numbers(dict):
    """Numbers for words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Windows:
    """Distinct windows with their counts: ``codes`` (rows x (language, words)) point into
    ``words``, -1 for padding; ``apart`` marks those that were dealt out by whole windows."""

    def __init__(self, words: list[bytes], codes: np.ndarray, counts: np.ndarray, apart: np.ndarray):
        self.words, self.codes, self.counts, self.apart = words, codes, counts, apart

    def pack(self) -> bytes:
        """The windows as one compressed string, with the words they use."""
        used = np.zeros(len(self.words) + 1, bool)
        used[self.codes] = True  # padding marks the last
        used[-1] = False
        number = np.cumsum(used)  # from 1
        number[-1] = 0  # padding
        codes = number.astype("<u4")[self.codes]
        words = [self.words[i] for i in np.flatnonzero(used).tolist()]
        order = _order(codes)
        return zstandard.ZstdCompressor(level=3).compress(
            np.array([len(words), len(codes), codes.shape[1]], "<i8").tobytes()
            + np.array([len(w) for w in words], "<i4").tobytes()
            + _split(codes[order].T.tobytes(), 4)
            + _split(self.counts[order].astype("<i8").tobytes(), 8)
            + self.apart[order].astype(np.uint8).tobytes()
            + b"".join(words)
        )

    @staticmethod
    def unpack(data: bytes) -> Windows:
        data = zstandard.ZstdDecompressor().decompress(data)
        known, rows, width = np.frombuffer(data, "<i8", 3).tolist()
        at = np.cumsum([24, 4 * known, 4 * rows * width, 8 * rows, rows]).tolist()
        ends = at[4] + np.cumsum(np.frombuffer(data, "<i4", known, at[0]), dtype=np.int64)
        words = [data[i:j] for i, j in zip([at[4], *ends.tolist()], ends.tolist())]
        codes = np.frombuffer(_join(data[at[1] : at[2]], 4), "<u4").reshape(width, rows).T.astype(np.int32)
        counts = np.frombuffer(_join(data[at[2] : at[3]], 8), "<i8")
        return Windows(words, codes - 1, counts, np.frombuffer(data, np.uint8, rows, at[3]) > 0)

    @staticmethod
    def sum(parts: list[Windows]) -> Windows:
        """All windows of the parts, equal ones added up, in the order of their codes."""
        number = Numbers()
        codes = []
        for p in parts:
            own = np.array([*map(number.__getitem__, p.words), -1], np.int32)
            codes.append(own[p.codes])  # -1 finds the last
        return Windows(
            list(number), np.concatenate(codes), np.concatenate([p.counts for p in parts]), np.concatenate([p.apart for p in parts])
        ).added()

    def added(self) -> Windows:
        """Equal windows added up, in the order of their codes."""
        order = _order(self.codes + np.int32(1))
        codes, counts, apart = self.codes[order], self.counts[order], self.apart[order]
        first = _first(codes)
        return Windows(self.words, codes[first], np.add.reduceat(counts, first), np.logical_or.reduceat(apart, first))


def _split(data: bytes, width: int) -> bytes:
    """Bytes of equal weight side by side: small numbers compress better."""
    return np.frombuffer(data, np.uint8).reshape(-1, width).T.tobytes()


def _join(data: bytes, width: int) -> bytes:
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.tobytes()


def _order(codes: np.ndarray) -> np.ndarray:
    """The order of rows of numbers from 0 to 2^32 - 1: two columns make a key."""
    wide = [codes[:, i].astype(np.uint64) for i in range(codes.shape[1])]
    keys = [a << np.uint64(32) | b for a, b in zip(wide[::2], wide[1::2])] + wide[len(wide) // 2 * 2 :]
    return np.lexsort(keys[::-1])


def _first(codes: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before."""
    return np.flatnonzero(np.concatenate([[True], (codes[1:] != codes[:-1]).any(axis=1)]))


def pieces(text: bytes) -> list[list[bytes]]:
    """The words of each piece that has any."""
    return [w for p in text.lower().translate(_PIECES).split(b"\n") if (w := p.split())]


class Block:
    """Pieces of texts as codes, until their windows are counted."""

    def __init__(self, size: int = SIZE):
        self.size, self.number = size, Numbers()
        self.codes, self.langs, self.lengths = array("i"), array("i"), array("q")

    def add(self, lang: bytes, pieces: list[list[bytes]]) -> None:
        self.codes.extend(map(self.number.__getitem__, chain.from_iterable(pieces)))
        self.lengths.extend(map(len, pieces))
        self.langs.extend([self.number[lang]] * len(pieces))

    def windows(self, tail: int = 0) -> Windows:
        """Distinct padded windows. The last ``tail`` words lead none."""
        lengths, codes = np.array(self.lengths), np.array(self.codes, np.int32)
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # words up to the end of the piece
        table = np.full((len(codes), self.size + 1), -1, np.int32)
        table[:, 0] = np.repeat(np.array(self.langs, np.int32), lengths)
        for step in range(self.size):
            lead = table[: len(codes) - step, step + 1]
            np.copyto(lead, codes[step:], where=left[: len(codes) - step] > step)
        table = table[: len(codes) - tail]
        # Equal windows meet under hashes of their codes, which sort faster than the codes do.
        # Different windows of one hash may lie among each other; they are added up later.
        keys = np.zeros(len(table), np.uint64)
        for column, weight in zip(table.T, _weights(self.size + 1)):
            keys += (column + np.int32(2)).astype(np.uint64) * weight
        table = table[np.argsort(keys)]
        first = _first(table)
        counts = np.diff(np.concatenate([first, [len(table)]]))
        return Windows(list(self.number), table[first], counts, np.zeros(len(first), bool))


def _weights(columns: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(b"%d" % i) | 1 for i in range(columns)], np.uint64)


def deal(block: Windows, buckets: int) -> Iterator[tuple[int, Windows]]:
    """The block's windows by bucket."""
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in block.words] + [1], np.uint64)
    weights = _weights(block.codes.shape[1])

    def bucket(columns: int) -> np.ndarray:
        sums = np.zeros(len(block.codes), np.uint64)
        for column, weight in zip(block.codes.T[:columns], weights):
            sums += hashes[column] * weight
        return (sums ^ (sums >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)

    pair = bucket(3)
    _, number, sizes = np.unique(pair, return_inverse=True, return_counts=True)
    heavy = sizes[number] > max(LEAST, len(pair) // HEAVY)
    marks, at = np.unique(block.codes[heavy, :3], axis=0, return_index=True)
    mark = np.full((len(marks), block.codes.shape[1]), -1, np.int32)
    mark[:, :3] = marks
    codes = np.concatenate([block.codes, mark])
    counts = np.concatenate([block.counts, np.zeros(len(marks), np.int64)])
    apart = np.concatenate([heavy, np.ones(len(marks), bool)])
    target = np.concatenate([np.where(heavy, bucket(len(weights)), pair), pair[heavy][at]]) % np.uint64(buckets)
    order = np.argsort(target, kind="stable")
    bounds = np.searchsorted(target[order], np.arange(buckets + 1, dtype=np.uint64))
    for b in np.flatnonzero(np.diff(bounds)).tolist():
        take = order[bounds[b] : bounds[b + 1]]
        yield b, Windows(block.words, codes[take], counts[take], apart[take])


def _count(buckets: int, size: int, block: int):
    def packed(found: Windows) -> pa.RecordBatch:
        dealt = list(deal(found, buckets))
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in dealt], pa.int32()), pa.array([w.pack() for _, w in dealt], pa.binary())],
            ["bucket", "windows"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Block(size)
        for b in batches:
            for lang, text in zip(b.column(0), b.column(1)):
                if not text.is_valid:
                    continue
                code = lang.as_buffer().to_pybytes()
                found = pieces(text.as_buffer().to_pybytes())
                for long in [p for p in found if len(p) > block]:
                    for start in range(0, len(long) - block, block - size + 1):
                        # A block of its own, whose last words lead no window: they do in the next one.
                        alone = Block(size)
                        alone.add(code, [long[start : start + block]])
                        yield packed(alone.windows(tail=size - 1))
                    del long[: start + block - size + 1]
                held.add(code, found)
                if len(held.codes) >= block:
                    yield packed(held.windows())
                    held = Block(size)
        if held.codes:
            yield packed(held.windows())

    return run


def padded(found: Windows, least: int) -> Windows:
    """Windows cut after the first word, or after the second, where the count of
    their two, or three, words stays under ``least``. Sums of prefixes don't change."""
    codes = found.codes.copy()
    by_pair, by_three = _first(codes[:, :3]), _first(codes[:, :4])
    rows = len(codes)

    def spread(first: np.ndarray, values: np.ndarray) -> np.ndarray:
        return np.repeat(values, np.diff(np.concatenate([first, [rows]])))

    apart = spread(by_pair, np.logical_or.reduceat(found.apart, by_pair))
    pairs = spread(by_pair, np.add.reduceat(found.counts, by_pair))
    threes = spread(by_three, np.add.reduceat(found.counts, by_three))
    codes[~apart & (threes < least), 3:] = -1
    codes[~apart & (pairs < least), 2:] = -1
    codes[~apart & (found.counts < least), 4:] = -1
    return Windows(found.words, codes, found.counts, found.apart)


def _add_up(least: int, size: int):
    columns = ["lang", *(f"w{i}" for i in range(1, size + 1)), "n"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
            found = padded(Windows.sum([Windows.unpack(p) for p in parts]), least)
            found = found.added()
            found_rows = np.flatnonzero(found.counts)
            words = pa.array(found.words, pa.binary()).cast(pa.string())
            for start in range(0, len(found_rows), 1 << 16):
                take = found_rows[start : start + (1 << 16)]
                codes = found.codes[take]
                arrays = [words.take(pa.array(c, mask=c < 0)) for c in codes.T]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(found.counts[take])], columns)

        now, parts = None, []
        for b in batches:  # in the order of the buckets
            for bucket, data in zip(b.column(0).to_pylist(), b.column(1)):
                if parts and bucket != now:
                    yield from rows(parts)
                    parts = []
                now = bucket
                parts.append(data.as_buffer().to_pybytes())
        if parts:
            yield from rows(parts)

    return run


def phrase_counts(docs: DataFrame, least: int = LEAST, size: int = SIZE, block: int = BLOCK) -> DataFrame:
    """(lang, words, f): all phrases of 1 to ``size`` words with ``least`` or more
    occurrences, and for each language the number of all words, under no words."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text")
    )
    total = texts.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0] or 0
    parts = shuffle_parts(docs)
    buckets = max(parts, int(total // BUCKET_BYTES) + 1)
    names = [f"w{i}" for i in range(1, size + 1)]
    packed = texts.mapInArrow(_count(buckets, size, block), "bucket int, windows binary")
    packed = packed.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    schema = "lang string, " + "".join(f"{n} string, " for n in names) + "n long"
    top = packed.mapInArrow(_add_up(least, size), schema)
    top = top.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    sums = docs.sparkSession.sql(
        f"SELECT lang, {', '.join(names)}, grouping_id() AS level, sum(n) AS f "
        f"FROM {{top}} GROUP BY lang, ROLLUP ({', '.join(names)})",
        top=top,
    )
    # Of a level's columns the last is null where windows were padded before it.
    whole = [F.lit(True), *[F.col(n).isNotNull() for n in names]]
    kept = F.lit(False)
    for k in range(size + 1):
        kept = kept | ((F.col("level") == (1 << (size - k)) - 1) & whole[k] & (F.lit(k == 0) | (F.col("f") >= least)))
    phrase = F.array_compact(F.array(*names))
    return sums.filter(kept).select("lang", phrase.alias("words"), "f")


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP, size: int = SIZE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` best candidates of each language."""
    found = cut(phrase_counts(docs, least, size).select("*", _joined(F.col("words")).alias("phrase")))
    total = found.filter(F.size("words") == 0).select("lang", F.col("f").alias("n"))
    part = found.filter(F.size("words") > 0).select("lang", "phrase", "f")
    candidates = found.filter(F.size("words") > 1).select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = candidates.select(
        "lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k")
    ).select(
        "lang", "phrase", "a", "k",
        _joined(F.expr("slice(words, 1, k)")).alias("head"), _joined(F.expr("slice(words, k + 1, size(words))")).alias("tail"),
    )
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    wide = "decimal(38,0)"
    cuts = cuts.withColumn("score", F.expr(f"(CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(20,0))) div (CAST(l AS {wide}) + r)"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # What a candidate's longer phrases have at most.
    spans = [(i, m) for m in range(2, size) for i in range(1, size - m + 2)]
    parts = F.array(*[
        F.when(F.size("words") >= F.lit(i + m - 1), F.struct(_joined(F.slice("words", i, m)).alias("phrase"), F.lit(m).alias("m")))
        for i, m in spans
    ])
    longer = candidates.filter(F.size("words") > 2).select("lang", "a", F.size("words").alias("whole"), F.explode(parts).alias("p"))
    longer = longer.filter("p is not null and p.m < whole").groupBy("lang", F.col("p.phrase").alias("phrase")).agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(
        f"longer is null or not (CAST(100 AS {wide}) * longer >= CAST({inside} AS {wide}) * a)"
    )
    best = kept.select("lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").alias("score"))
    # The first ``top`` of each task go on, so a language with a third of all phrases is no task's own.
    rank = F.expr("row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)")
    ranked = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def brute_force(rows: list[tuple[str | None, str | None]], least: int = LEAST, inside: int = INSIDE, top: int = TOP) -> list[tuple]:
    """The rows of ``collocations`` for (text, lang) pairs, by plain counting."""
    from collections import Counter, defaultdict

    counts: dict[str, Counter] = defaultdict(Counter)
    totals: Counter = Counter()
    for text, lang in rows:
        lang = UNKNOWN if lang is None else lang
        for words in pieces((text or "").encode()):
            totals[lang] += len(words)
            for k in range(1, SIZE + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, found in counts.items():
        good = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in good.items():
            cuts = [(2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if not any(
                len(q) > len(p) and 100 * b >= inside * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in good.items()
            ):
                kept.append((-score, -a, b" ".join(p), found[p[:k]], found[p[k:]]))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -s))
    return out
