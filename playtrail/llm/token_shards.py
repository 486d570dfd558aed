"""Training-order materialisation of token sequences in fixed-stride shards.

Texts are encoded with a public vocabulary and packed, partition by partition,
into sequences of ``length`` tokens (an end-of-text id behind every document; a
partition's last sequence is filled up with it). A first pass only counts: the
tokens of every input partition give each sequence its ordinal. A keyed
Feistel network over the next power of four, walked on until it falls
below the number of sequences, permutes the ordinals: each has one global slot,
in an order that only the key decides.

A second pass encodes again (cheaper than keeping a copy of all ids on disk),
sends each sequence to its shard, a range of slots, and writes the shard in slot
order: little-endian 16-bit ids, no header, so slot s lies at
``(s - first slot) x stride`` bytes of its shard and reading can be resumed at any slot. A
shard is written under a name of its own attempt and then moved into place, so a
lost executor or a second attempt leaves whole files only. The second pass
compares each partition with the counts of the first and fails if they differ.

Nulls and ties: a null text is empty (its end-of-text id remains); repeated rows
are encoded again. Rows come in the order in which they are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import cut, text_chunks

# Fixed value: the split pattern of the vocabulary's family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LENGTH = 1024
SHARD_BYTES = 32 << 20
KEY = "order-1"
ROUNDS = 6

# White space as the pattern knows it (White_Space in Unicode), and the place before the last of several.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LAST_SPACE = re.compile(f"(?<=[{SPACES}])(?=[{SPACES}][^{SPACES}])")


class Encoder:
    """Ids of a text as 16-bit integers.

    The pattern looks ahead for one thing only: the last of several white-space characters before other text
    isn't taken with the others. Texts are cut in front of it, and what is left is split by the pattern
    without the look, which an automaton can run."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        if len(ranks) >= 1 << 16:
            raise ValueError("a 16-bit shard needs a vocabulary of fewer than 65,536 ids")
        plain = PATTERN.replace(r"|\s+(?!\S)", "")
        self.encoding = tiktoken.Encoding("shards", pat_str=plain, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1  # the first free id ends a document

    def ids(self, text: str) -> list[int]:
        own = [c for c in SPACES if c in text]
        if any(a + b in text for a in own for b in own):
            return [i for part in LAST_SPACE.split(text) for i in self.encoding.encode_ordinary(part)]
        return self.encoding.encode_ordinary(text)

    def encode(self, text: str) -> bytes:
        return np.array(self.ids(text), np.uint16).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a vocabulary file, one per Python worker."""
    return Encoder(path)


def feistel(x: np.ndarray, n: int, key: str = KEY) -> np.ndarray:
    """A keyed permutation of range(n), applied to an array of its members."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [
        np.frombuffer(hashlib.sha256(f"{key}/{r}".encode()).digest()[:8], "<u8")[0] for r in range(ROUNDS)
    ]

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            f = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            left, right = right, left ^ (f & mask)
        return (left << np.uint64(half)) | right

    out = once(x.astype(np.uint64))
    while True:  # cycle-walking: a place outside the range is stepped over
        far = np.flatnonzero(out >= n)
        if not len(far):
            return out.astype(np.int64)
        out[far] = once(out[far])


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for b in text_chunks(batches):
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            yield doc, text or ""


def count(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """(part, tokens, sequences) of every input partition with rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        tokens = sum(len(own.ids(text)) + 1 for _, text in _texts(batches))
        part = TaskContext.get().partitionId()
        if tokens:
            yield pa.RecordBatch.from_pydict({"part": [part], "tokens": [tokens], "sequences": [-(-tokens // length)]})

    return docs.select("doc_id", "text").mapInArrow(run, "part long, tokens long, sequences long")


def write_shards(
    docs: DataFrame, vocabulary: str, path: str, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, key: str = KEY
) -> DataFrame:
    """Write ``docs`` (doc_id, text) below ``path`` (a uri every executor can reach) as
    ``shard-NNNNNN.bin``; returns one row per sequence: slot, ordinal, shard, byte offset,
    first doc_id, tokens that aren't filling, SHA-256 of its bytes as written."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stride = 2 * length
    # One row per input partition.
    counts = sorted(tuple(r) for r in cut(count(docs, vocabulary, length)).collect())
    first, total = {}, 0
    for part, tokens, sequences in counts:
        first[part] = (total, tokens)
        total += sequences
    shards = max(1, -(-total * stride // shard_bytes))
    per_shard = max(1, -(-total // shards))

    def sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(vocabulary)
        part = TaskContext.get().partitionId()
        ordinal, expected = first.get(part, (0, 0))
        held, doc_ids, filled, seen, rows = bytearray(), [], [], 0, []
        opened = None  # the document that the sequence begins in

        def batch() -> pa.RecordBatch:
            slots = feistel(np.arange(ordinal - len(rows), ordinal), total, key)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(slots // per_shard, pa.int32()),
                    pa.array(slots),
                    pa.array(np.arange(ordinal - len(rows), ordinal)),
                    pa.array(doc_ids, pa.int64()),
                    pa.array(filled, pa.int32()),
                    pa.array(rows, pa.binary()),
                ],
                ["shard", "slot", "ordinal", "doc_id", "n_tokens", "ids"],
            )
            rows.clear(), doc_ids.clear(), filled.clear()
            return out

        def add(data: bytes, tokens: int) -> None:
            nonlocal ordinal
            rows.append(data), doc_ids.append(opened), filled.append(tokens)
            ordinal += 1

        end = np.uint16(own.end).tobytes()
        for doc, text in _texts(batches):
            ids = own.encode(text) + end
            seen += len(ids) // 2
            if not held:
                opened = doc
            held += ids
            at = 0
            while len(held) - at >= stride:
                add(bytes(held[at : at + stride]), length)
                at += stride
                opened = doc
                if len(rows) >= 512:
                    yield batch()
            del held[:at]
        if held:
            add(bytes(held) + np.full(length - len(held) // 2, own.end, np.uint16).tobytes(), len(held) // 2)
        if seen != expected:
            raise RuntimeError(f"partition {part} holds {seen} tokens, {expected} when counted")
        if rows:
            yield batch()

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(path)
        shard, out, name = None, None, ""

        def close() -> None:
            if out is not None:
                out.close()
                store.move(name, f"{root}/shard-{shard:06d}.bin")

        store.create_dir(root, recursive=True)
        for b in batches:
            own, slot, ids = (b.column(k).to_pylist() for k in (0, 1, 5))
            for k, at in enumerate(own):
                if at != shard:
                    close()
                    shard, name = at, f"{root}/_writing-{at:06d}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(name)
                out.write(ids[k])
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(1),
                    b.column(2),
                    b.column(0),
                    pa.array([(s - a * per_shard) * stride for s, a in zip(slot, own)], pa.int64()),
                    b.column(3),
                    b.column(4),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                ],
                ["slot", "ordinal", "shard", "byte_offset", "doc_id", "n_tokens", "ids_sha256"],
            )
        close()

    made = docs.mapInArrow(
        sequences, "shard int, slot long, ordinal long, doc_id long, n_tokens int, ids binary"
    )
    ranged = made.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")  # a task per shard
    return ranged.mapInArrow(
        write,
        "slot long, ordinal long, shard int, byte_offset long, doc_id long, n_tokens int, ids_sha256 string",
    )


def read_slots(path: str, start: int, stop: int, per_shard: int, length: int = LENGTH) -> np.ndarray:
    """Sequences of the slots [start, stop), read in order from written shards."""
    store, root = pyarrow.fs.FileSystem.from_uri(path)
    out, stride = [], 2 * length
    while start < stop:
        shard, at = divmod(start, per_shard)
        upto = min(stop, (shard + 1) * per_shard)
        with store.open_input_file(f"{root}/shard-{shard:06d}.bin") as f:
            out.append(f.read_at((upto - start) * stride, at * stride))
        start = upto
    return np.frombuffer(b"".join(out), np.uint16).reshape(-1, length)
