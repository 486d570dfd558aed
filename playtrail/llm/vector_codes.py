"""Vector code compression: product codes learned by Lloyd rounds over two trees.

Vectors become integers, floor(``SCALE`` x component), and are cut into ``parts`` equal
consecutive parts. Each part position has a codebook of ``entries`` integer points. A
round gives every part to its nearest entry (squared Euclidean distance, ties to the lower
index) and moves each entry to floor(sum / count) of its parts; unused entries stay.

Dual tree. Rows are taken in blocks. For each part position a block holds a balanced tree
over its parts, built once: every node has the box of its points, their sum and their
number. The entries get a tree of boxes too. Both trees are walked down together, level by
level, over the pairs (node of parts, node of entries) that are left:

* a pair goes when its least distance exceeds the largest distance from the node to the
  entries of another pair of the same node;
* a single entry also goes when another one is nearer to every point of the node's box (the
  difference of both distances is linear, so its largest value lies in a corner);
* a node with one entry left is assigned whole: its cached sum and number go to the entry.

Points of leaves with several entries left are compared with them one by one. All of this is
in integers, so every bound and every tie is exact. A round's result is one row for each
entry, part position and component in a task; Spark adds them up.

Only codebooks (``entries`` x dimension integers) reach the driver and the tasks. Blocks of
integers with their trees are written to the checkpoint folder once and read by each round.

Nulls, ties, repeats: rows whose vector is null or has null or non-finite components are
dropped; so are empty vectors and rows whose vector hasn't the most frequent length (the
longer one in a tie), as their parts can't be compared. Dimensions that ``parts`` doesn't divide are cut at
floor(i x dimension / parts). The first entries come from the rows with the smallest vec_ids
(nulls last, repeated ids by their vectors), one entry each, repeated rows included; fewer
rows give fewer entries. Null vec_ids and null labels are kept; null labels are equal to
each other. An empty table gives no rows. Integers so large that a distance needs over 62
bits are an error. Extra columns are ignored by ``codes``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from playtrail.llm.common import cut
from playtrail.plans.guards import bounded_broadcast

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK = 2048  # rows of a block
LEAF = 8  # points of a leaf, about
SALTS = 32


def bounds(dimension: int, parts: int = PARTS) -> list[int]:
    """Where the parts begin and end."""
    return [i * dimension // parts for i in range(parts + 1)]


def integers(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x component), exact; an error where distances would not fit."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    most = np.abs(scaled).max(initial=0)
    if most * most * 4 * max(1, values.shape[1]) >= 2.0**62:
        raise OverflowError(f"components up to {most / SCALE:g} are too large for integer distances")
    return scaled.astype(np.int64)


class Tree:
    """A balanced tree over points: the points in the order of its leaves, and for every
    level the boxes, sums and ranges of its nodes."""

    def __init__(self, points: np.ndarray, order: np.ndarray, lows: list, highs: list, sums: list):
        self.points, self.order, self.lows, self.highs, self.sums = points, order, lows, highs, sums

    @staticmethod
    def depth(rows: int) -> int:
        """Levels below the root."""
        return max(0, (rows // LEAF).bit_length() - 1)

    @staticmethod
    def ends(rows: int, level: int) -> np.ndarray:
        """Where the nodes of a level begin, and the end of the last."""
        return np.arange((1 << level) + 1) * rows >> level

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        rows, depth = len(points), cls.depth(len(points))
        order = np.arange(rows)
        for level in range(depth):
            ends, below = cls.ends(rows, level), cls.ends(rows, level + 1)
            for node in range(1 << level):
                a, b, middle = ends[node], ends[node + 1], below[2 * node + 1]
                own = points[order[a:b]]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if points.shape[1] else 0
                if points.shape[1]:
                    order[a:b] = order[a:b][np.argpartition(own[:, widest], middle - a)]
        points = points[order]
        first = cls.ends(rows, depth)[:-1]
        low, high = np.minimum.reduceat(points, first), np.maximum.reduceat(points, first)
        total = np.add.reduceat(points, first)
        lows, highs, sums = [low], [high], [total]
        for _ in range(depth):
            low, high, total = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), total[::2] + total[1::2]
            lows, highs, sums = [low, *lows], [high, *highs], [total, *sums]
        return cls(points, order, lows, highs, sums)


class EntryTree:
    """Groups of a codebook's entries, halved level by level down to single entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        groups = [np.arange(len(entries))]
        self.levels, self.children = [groups], []
        while any(len(g) > 1 for g in groups):
            below, kids = [], []
            for g in groups:
                if len(g) == 1:
                    kids.append([len(below)])
                    below.append(g)
                    continue
                own = entries[g]
                widest = int(np.argmax(own.max(axis=0) - own.min(axis=0))) if own.shape[1] else 0
                g = g[np.argsort(own[:, widest], kind="stable")] if own.shape[1] else g
                kids.append([len(below), len(below) + 1])
                below += [g[: len(g) // 2], g[len(g) // 2 :]]
            self.children.append(kids)
            self.levels.append(below)
            groups = below
        self.lows = [np.stack([entries[g].min(axis=0) for g in level]) for level in self.levels]
        self.highs = [np.stack([entries[g].max(axis=0) for g in level]) for level in self.levels]

    def move(self, level: int) -> np.ndarray:
        """(children, nodes): which node of the next level lies in which of this one."""
        matrix = np.zeros((len(self.levels[level + 1]), len(self.levels[level])), bool)
        for node, kids in enumerate(self.children[level]):
            matrix[kids, node] = True
        return matrix


def assign(tree: Tree, book: EntryTree) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Decisions of the walk: (level, nodes, entries) for nodes assigned whole, and
    (-1, places of points, entries) for points of uncertain leaves."""
    depth, far = len(tree.lows) - 1, np.iinfo(np.int64).max
    nodes, open_, step = np.zeros(1, np.int64), np.ones((1, 1), bool), 0
    last = len(book.levels) - 1
    entry = np.array([g[0] for g in book.levels[last]])
    for level in range(depth + 1):
        while True:
            low, high = tree.lows[level][nodes], tree.highs[level][nodes]
            q, r = np.nonzero(open_)
            e_low, e_high = book.lows[step][r], book.highs[step][r]
            gap = np.maximum(0, np.maximum(low[q] - e_high, e_low - high[q]))
            reach = np.maximum(high[q] - e_low, e_high - low[q])
            most = np.full(open_.shape, far)
            most[q, r] = (reach * reach).sum(axis=1)
            open_[q, r] = (gap * gap).sum(axis=1) <= most.min(axis=1)[q]
            if step == last:
                break
            open_ = (open_[:, None, :] & book.move(step)[None]).any(axis=2)
            step += 1
            if level < depth:
                break  # one level down in both trees
        if step == last and len(entry) > 1:
            # Another entry, the one nearest to the middle of the box, against the rest.
            middle = low + high
            away = 2 * book.entries[entry][None] - middle[:, None]
            best = np.where(open_, (away * away).sum(axis=2), far).argmin(axis=1)
            a = book.entries[entry[best]]
            q, r = np.nonzero(open_)
            b = book.entries[entry[r]]
            slope = 2 * (b - a[q])
            worst = np.maximum(slope * low[q], slope * high[q]).sum(axis=1) + (a[q] * a[q]).sum(axis=1) - (b * b).sum(axis=1)
            open_[q, r] = (worst >= 0) | (r == best[q])
        single = (open_.sum(axis=1) == 1) & (step == last)
        if single.any():
            yield level, nodes[single], entry[open_[single].argmax(axis=1)]
        nodes, open_ = nodes[~single], open_[~single]
        if not len(nodes):
            return
        if level < depth:
            nodes = (2 * nodes[:, None] + np.arange(2)).reshape(-1)
            open_ = open_.repeat(2, axis=0)
    ends = Tree.ends(len(tree.points), depth)
    sizes = ends[nodes + 1] - ends[nodes]
    places = np.repeat(ends[nodes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    order = np.argsort(entry)  # by index, so that ties go to the lower one
    away = tree.points[places][:, None] - book.entries[None]
    distance = np.where(open_.repeat(sizes, axis=0)[:, order], (away * away).sum(axis=2), far)
    yield -1, places, distance.argmin(axis=1)


def _spans(tree: Tree, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the points of some nodes, and the size of each node."""
    ends = Tree.ends(len(tree.points), level)
    sizes = ends[nodes + 1] - ends[nodes]
    return np.repeat(ends[nodes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum()), sizes


def sums(tree: Tree, book: EntryTree) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the points by entry, from cached sums where nodes went whole."""
    total = np.zeros(book.entries.shape, np.int64)
    count = np.zeros(len(book.entries), np.int64)
    for level, which, entry in assign(tree, book):
        if level < 0:
            np.add.at(total, entry, tree.points[which])
            np.add.at(count, entry, 1)
        else:
            np.add.at(total, entry, tree.sums[level][which])
            ends = Tree.ends(len(tree.points), level)
            np.add.at(count, entry, ends[which + 1] - ends[which])
    return total, count


def nearest(tree: Tree, book: EntryTree) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of every point, in the order of the rows."""
    chosen = np.zeros(len(tree.points), np.int64)
    for level, which, entry in assign(tree, book):
        if level >= 0:
            which, sizes = _spans(tree, level, which)
            entry = np.repeat(entry, sizes)
        chosen[which] = entry
    away = tree.points - book.entries[chosen]
    out, error = np.empty_like(chosen), np.empty_like(chosen)
    out[tree.order], error[tree.order] = chosen, (away * away).sum(axis=1)
    return out, error


# --- blocks ---------------------------------------------------------------


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    """The values in the narrowest integers that hold them."""
    low, high = values.min(initial=0), values.max(initial=0)
    kind = next(k for k in ("<i2", "<i4", "<i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind, values.astype(kind).tobytes()


TREE = ("points", "order", "lows", "highs", "sums")


def _pack(tree: Tree) -> dict:
    out = {}
    for name in TREE:
        value = getattr(tree, name)
        kind, data = _narrow(np.concatenate(value) if isinstance(value, list) else value)
        out |= {name: data, f"{name}_kind": kind}
    return out


def _unpack(x: dict, rows: int, width: int) -> Tree:
    own = {n: np.frombuffer(x[n], x[f"{n}_kind"]).astype(np.int64) for n in TREE}
    depth = Tree.depth(rows)
    starts = [(1 << level) - 1 for level in range(depth + 2)]

    def levels(name: str) -> list[np.ndarray]:
        values = own[name].reshape(starts[-1], width)
        return [values[a:b] for a, b in zip(starts, starts[1:])]

    return Tree(own["points"].reshape(rows, width), own["order"], levels("lows"), levels("highs"), levels("sums"))


TREE_TYPE = pa.list_(pa.struct([f for n in TREE for f in (pa.field(n, pa.binary()), pa.field(f"{n}_kind", pa.string()))]))
TREE_DDL = "array<struct<" + ",".join(f"{n}:binary,{n}_kind:string" for n in TREE) + ">>"


def _blocks(dimension: int, parts: int, block: int):
    cuts = bounds(dimension, parts)

    def rows_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column("vector").combine_chunks()
        points = integers(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(table), dimension))
        trees = [_pack(Tree.build(points[:, a:b])) for a, b in zip(cuts, cuts[1:])]
        whole = [0, len(table)]
        out = [pa.ListArray.from_arrays(pa.array(whole, pa.int32()), table.column(c).combine_chunks()) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*out, pa.array([trees], TREE_TYPE)], ["vec_ids", "labels", "trees"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for b in batches:
            start = 0
            while start < b.num_rows:
                piece = b.slice(start, block - rows)
                held.append(piece)
                start, rows = start + piece.num_rows, rows + piece.num_rows
                if rows == block:
                    yield rows_of(held)
                    held, rows = [], 0
        if held:
            yield rows_of(held)

    return run


def _trees(batches: Iterable[pa.RecordBatch], cuts: list[int]) -> Iterator[tuple[pa.RecordBatch, list[Tree]]]:
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            rows = len(row.column(0)[0])
            packed = row.column(2)[0].as_py()
            yield row, [_unpack(x, rows, hi - lo) for x, lo, hi in zip(packed, cuts, cuts[1:])]


def _round(books: list[np.ndarray], cuts: list[int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [EntryTree(b) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for _, trees in _trees(batches, cuts):
            for part, tree in enumerate(trees):
                t, n = sums(tree, entries[part])
                total[part] += t
                count[part] += n
        out = [
            (part, entry, place, int(total[part][entry, place]), int(count[part][entry]))
            for part, book in enumerate(books)
            for entry in np.flatnonzero(count[part]).tolist()
            for place in range(book.shape[1])
        ]
        if out:
            arrays = [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "place", "total", "n"])

    return run


def _final(books: list[np.ndarray], cuts: list[int]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = [EntryTree(b) for b in books]
        for row, trees in _trees(batches, cuts):
            found = [nearest(t, e) for t, e in zip(trees, entries)]
            marks = np.stack([e for e, _ in found], axis=1).astype(np.uint8)
            code = [m.tobytes().hex() for m in marks]
            error = sum(d for _, d in found)
            ids, labels = (row.column(i).flatten() for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(code, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"]
            )

    return run


# --- Spark ----------------------------------------------------------------


def clean(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows whose vector can be coded."""
    vector = F.col("embedding").cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = vectors.filter((F.size("embedding") > 0) & ~bad).select("vec_id", "label", vector.alias("vector"))
    lengths = kept.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.col("count").desc(), F.col("size").desc()).first()
    return kept.filter(F.size("vector") == (common["size"] if common else 0))


def train(blocks: DataFrame, books: list[np.ndarray], cuts: list[int], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after all rounds over the written blocks."""
    books = [b.copy() for b in books]
    schema = "part int, entry int, place int, total long, n long"
    for _ in range(rounds):
        found = blocks.mapInArrow(_round(books, cuts), schema).groupBy("part", "entry", "place")
        # At most entries x dimension rows, whatever the table's size.
        for r in found.agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect():
            books[r.part][r.entry, r.place] = int(r.total) // r.n
    return books


def codebook_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def codes(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, block: int = BLOCK
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector that can be
    coded. Entries are at most 256: a code has two hex digits for each part."""
    if entries > 256:
        raise ValueError("a code holds at most 256 entries")
    kept = clean(vectors)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return kept.select(
            "vec_id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")],
            F.lit("").alias("codebooks_sha256"),
        )
    dimension = len(first[0].vector)
    cuts = bounds(dimension, parts)
    start = integers(np.array([r.vector for r in first], np.float64).reshape(len(first), dimension))
    books = [start[:, a:b] for a, b in zip(cuts, cuts[1:])]
    types = {f.name: f.dataType for f in kept.schema}
    schema = StructType(
        [StructField("vec_ids", ArrayType(types["vec_id"])), StructField("labels", ArrayType(types["label"]))]
        + list(StructType.fromDDL(f"trees {TREE_DDL}"))
    )
    blocks = cut(kept.mapInArrow(_blocks(dimension, parts, block), schema))
    books = train(blocks, books, cuts, rounds)
    out = StructType([kept.schema["vec_id"], kept.schema["label"], *StructType.fromDDL("code string, error long")])
    coded = cut(blocks.mapInArrow(_final(books, cuts), out))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    # A hot label is dealt out by a salt, and the sums, one row a label, to every salt; where
    # they are small by count they are broadcast.
    by_label, _ = bounded_broadcast(by_label, materialize_first=True)
    salted = by_label.select(F.col("label").alias("known"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    of_row = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")
    joined = coded.join(salted, F.col("label").eqNullSafe(F.col("known")) & (of_row == F.col("s")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebook_digest(books)).alias("codebooks_sha256"))


def brute_force(
    rows: list[tuple[int | None, list | None, int | None]], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> list[tuple]:
    """The rows of ``codes`` for (vec_id, vector, label), by comparing all points with all entries."""
    import math

    good = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    vectors = [[math.floor(SCALE * x) for x in v] for _, v, _ in good]
    d = len(vectors[0]) if vectors else 0
    cuts = bounds(d, parts)
    books = [[v[a:b] for v in vectors[:entries]] for a, b in zip(cuts, cuts[1:])]

    def near(part: int, v: list[int]) -> tuple[int, int]:
        own = v[cuts[part] : cuts[part + 1]]
        return min((sum((x - y) ** 2 for x, y in zip(own, e)), k) for k, e in enumerate(books[part]))

    for _ in range(rounds):
        for part in range(parts):
            groups: dict[int, list] = {}
            for v in vectors:
                groups.setdefault(near(part, v)[1], []).append(v[cuts[part] : cuts[part + 1]])
            for k, own in groups.items():
                books[part][k] = [sum(c) // len(own) for c in zip(*own)]
    found = [[near(p, v) for p in range(parts)] for v in vectors]
    by_label: dict = {}
    for (_, _, label), f in zip(good, found):
        by_label[label] = by_label.get(label, 0) + sum(e for e, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [
        (i, "".join(f"{k:02x}" for _, k in f), sum(e for e, _ in f), by_label[label], sha)
        for (i, _, label), f in zip(good, found)
    ]
