"""SimHash near-duplicates: exact search over tiles of fingerprints.

Words are the maximal runs of characters other than the ASCII white space
U+0020 and U+0009..U+000D, after lower-casing A-Z; a shingle is ``shingle``
words joined by spaces (a shorter text is one shingle, a text without words
has fingerprint zero). A bit of the fingerprint is set when it is set in over
half of the shingles' XXH64 values.

Equal fingerprints are merged first (a partial aggregate, so a group of copies
costs one row per task). The distinct ones are laid out in tiles. A tile's key
is its vector of population counts, one per 16-bit quarter of the fingerprint:
the sum of the differences of two such vectors never exceeds the number of
differing bits, so a pair of tiles whose counts differ beyond the radius holds
no link and is skipped. The remaining tile pairs are compared exactly with
numpy: exclusive-or and bit counts over the whole block. There are at most
17^4 count vectors, which bounds the broadcast list of tiles; a tile with many
fingerprints is split by hash into blocks of about ``TILE_ROWS``, so neither a
task nor a row grows with a dense group.

A block of comparisons returns a spanning set of its links (at most one per
fingerprint of the pair of blocks), never all pairs. Components come from
alternating large-star and small-star steps, each written to the checkpoint
folder.

Nulls, ties, repeats: a null text has no words. Rows without a doc_id take part
in linking but give no component id of their own: their component_id is the
smallest doc_id reachable, null if there is none. Repeated rows are kept, one
result row per input row. Extra columns are ignored by ``components``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut, text_chunks

SHINGLE = 3
SEED = 42
RADIUS = 2
TILE_ROWS = 1024
QUARTERS = 4  # of 16 bits


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a UTF-8 text."""
    words = data.lower().split()  # on bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest, seed = xxhash.xxh64_digest, SEED
    joined = b"".join([digest(s, seed) for s in shingles])
    rows = np.frombuffer(joined, np.uint8).reshape(-1, 8)
    total = len(rows)
    ones = np.zeros(64, np.int64)
    for start in range(0, total, 8192):
        ones += np.unpackbits(rows[start : start + 8192], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str | None = None) -> DataFrame:
    """(doc_id, fp): one row per document, ``fp`` as a signed 64-bit integer; the string
    column ``key`` goes along, if one is named."""
    extra = [key] if key else []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_chunks(batches):
            fps = [
                fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                for t in b.column(1).cast(pa.large_string())
            ]
            signed = np.array(fps, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed), *b.columns[2:]], ["doc_id", "fp", *extra])

    picked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra
    )
    return picked.mapInArrow(run, ", ".join(["doc_id long", "fp long", *(f"{c} binary" for c in extra)]))


def _spanning(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links (pairs of fingerprints) that connect what the block's links connect."""
    rows, cols = [], []
    for start in range(0, len(a), 256):
        near = np.bitwise_count(a[start : start + 256, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        i += start
        if same:
            i, j = i[i < j], j[i < j]
        rows.append(i)
        cols.append(j)
    i, j = np.concatenate(rows), np.concatenate(cols)
    if not len(i):
        return []
    nodes, ends = np.unique(np.concatenate([a[i], b[j]]), return_inverse=True)
    u, v = ends[: len(i)], ends[len(i) :]
    if len(i) < len(nodes):
        return list(zip(nodes[u].tolist(), nodes[v].tolist()))
    label = np.arange(len(nodes))  # smallest node reachable, by spreading minima
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    away = np.flatnonzero(label != np.arange(len(nodes)))
    return list(zip(nodes[away].tolist(), nodes[label[away]].tolist()))


def _compare(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, same = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            lo, ro = left.offsets.to_numpy(), right.offsets.to_numpy()
            lv, rv = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (left, right))
            links: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                links += _spanning(lv[lo[k] : lo[k + 1]], rv[ro[k] : ro[k + 1]], same[k], radius)
            pairs = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["u", "v"]
            )

    return run


def links(nodes: DataFrame, radius: int = RADIUS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(u, v): links that connect every two distinct fingerprints of ``nodes``
    (column fp) at ``radius`` or fewer differing bits."""
    quarter = [
        F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(QUARTERS)
    ]
    key = sum((q * 17**i for i, q in enumerate(quarter)), F.lit(0))
    keyed = nodes.select("fp", key.alias("cell"))
    # At most 17^4 = 83,521 rows: a proven bound for the broadcasts below.
    cells = cut(keyed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("blocks")))
    blocked = keyed.join(F.broadcast(cells), "cell").select(
        "fp", "cell", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int").alias("block")
    )
    tiles = cut(blocked.groupBy("cell", "block").agg(F.collect_list("fp").alias("fps")))

    # Steps between count vectors whose differences sum to the radius at most.
    steps = {(0,) * QUARTERS}
    for _ in range(radius):
        steps |= {s[:i] + (s[i] + d,) + s[i + 1 :] for s in steps for i in range(QUARTERS) for d in (-1, 1)}
    moves = F.array(*[F.struct(*[F.lit(d).alias(f"d{i}") for i, d in enumerate(s)]) for s in sorted(steps)])
    parts = [F.floor(F.col("cell") / 17**i).cast("int") % 17 for i in range(QUARTERS)]
    near = cells.select("cell", "blocks", *[p.alias(f"p{i}") for i, p in enumerate(parts)]).select(
        "*", F.explode(moves).alias("m")
    )
    moved = [F.col(f"p{i}") + F.col(f"m.d{i}") for i in range(QUARTERS)]
    inside = [m.between(0, 16) for m in moved]
    near = near.filter(inside[0] & inside[1] & inside[2] & inside[3]).select(
        "cell", "blocks", sum((m * 17**i for i, m in enumerate(moved)), F.lit(0)).alias("cell2")
    )
    near = near.filter("cell <= cell2").join(
        F.broadcast(cells.select(F.col("cell").alias("cell2"), F.col("blocks").alias("blocks2"))), "cell2"
    )
    pairs = (
        near.select("*", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
        .select("*", F.explode(F.expr("sequence(0, blocks2 - 1)")).alias("block2"))
        .filter("cell < cell2 or block <= block2")
        .select("cell", "block", "cell2", "block2")
    )
    left = tiles.select("cell", "block", F.col("fps").alias("a"))
    right = tiles.select(F.col("cell").alias("cell2"), F.col("block").alias("block2"), F.col("fps").alias("b"))
    blocks = (
        pairs.join(left, ["cell", "block"])
        .join(right, ["cell2", "block2"])
        .select("a", "b", F.expr("cell = cell2 and block = block2").alias("same"))
    )
    return blocks.mapInArrow(_compare(radius), "u long, v long")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component of every node in
    ``edges`` (u, v), by alternating large-star and small-star steps."""
    edges = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        )
        # Every node keeps its own link to its minimum.
        large = large.unionByName(low.filter("m < u").select("u", F.col("m").alias("v"))).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        edges = cut(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.countDistinct("u")
        ).first()
        if now == mark:
            break
        mark = now
    stars = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


def _rooted(fps: DataFrame, radius: int) -> DataFrame:
    """(fp, first_id, root): every fingerprint of ``fps`` (doc_id, fp), its smallest
    doc_id, and the smallest fingerprint of its component."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected(links(nodes, radius))
    return cut(
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "first_id", F.coalesce("root", "fp").alias("root")
        )
    )


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``."""
    fps = cut(fingerprints(docs, shingle))
    known = _rooted(fps, radius)
    ids = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = known.join(ids, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def row_key() -> Column:
    """16 bytes for a row's doc_id and text, which settle its component and its rank there."""
    doc, text = F.col("doc_id").cast("long").cast("string"), F.col("text").cast("string")
    known = F.concat(F.when(doc.isNull(), "-").otherwise(doc), F.when(text.isNull(), "-").otherwise("+"))
    return F.unhex(F.md5(F.concat(known, F.coalesce(text, F.lit("")))))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id (rows
    without one come last), then the smallest ``row_key``, then the smallest other columns.
    Rows are judged each by its own text, so rows of one doc_id in several components are
    several documents.

    The texts are shuffled once at every size: the rows meet the keys of those that stay in a
    merge join, and rows of a key that several have are told apart where they then lie."""
    names = docs.columns
    fps = cut(fingerprints(docs.withColumn("key", row_key()), shingle, "key"))
    known = _rooted(fps, radius).select("fp", "root")
    rows = fps.groupBy("key", "fp", "doc_id").agg(F.count("*").alias("n")).join(known, "fp")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "key", "n")
    kept = cut(rows.groupBy("root").agg(F.min(first).alias("row")).select("row.key", "row.n"))
    stay = docs.select(F.struct(*names).alias("row"), row_key().alias("key")).join(kept.hint("merge"), "key")
    once = stay.filter("n = 1").select("row")
    # The join again, on the same exchange of the texts.
    equal = stay.filter("n > 1").groupBy("key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(equal).select("row.*")
