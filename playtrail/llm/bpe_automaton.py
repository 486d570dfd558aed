"""BPE encoding and decoding by a deterministic tokenization automaton.

**The token automaton.** It reads token labels and accepts exactly the label
sequences that the merges leave alone. It starts as one state with a loop for
every byte. Each merge (u, v) -> w, in order of rank, adds a gadget: the state
that u leads to is copied without its v arc and becomes u's target, and every
state with a u arc gets a w arc to where v led. So a label always leads to one
state, a copy differs from its model by one arc, and the automaton after 50,000
gadgets is held as the list of copies (model, arc taken away, time) instead of
50,000 x 50,000 cells. ``TokenAutomaton.allows(u, v)`` asks for the arc v of the
state behind u: it follows the copies and the arcs' origins back to the bytes.

**Encoding.** A pre-split word is composed with the automaton: from a state, the
labels that the word goes on with are read off a spelling table, and the arcs
asked of the automaton are kept in a transition table (state behind the last
label, label) -> open or not, of at most ``MAX_ARCS`` cells. Exactly one path spells
the whole word, and a place in the word is reached by one path at most, so
trying long labels first and marking places without a way on takes time in
proportion to the word.

Words are split by the byte-level pattern. A text is cut at single spaces
between other characters first (no match of the pattern reaches across one, other
than as its leading space), so that pieces repeat and are looked up. Special
tokens in a text keep their own ids, as in the tokenizers library.

Decoding joins the labels' bytes; bytes that are no UTF-8 become U+FFFD.

Nulls: a null text is encoded as an empty one. Any text of any length is
encoded whole.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.common import Memory, text_chunks

# Fixed value: the byte-level split pattern of the vocabulary's family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_ARCS = 1_000_000
MAX_PIECES = 250_000

SPACES = [c for c in map(chr, range(0x3001)) if c.isspace()]


def uneven(text: str) -> bool:
    """Is there a space that isn't alone between two other characters? Such texts are split by the pattern as a whole."""
    return text.startswith(" ") or text.endswith(" ") or any(f" {c}" in text or f"{c} " in text for c in SPACES if c in text)


def byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenAutomaton:
    """The automaton over labels, one merge gadget after another."""

    def __init__(self, base: Iterable[int], merges: list[tuple[int, int, int]]):
        self.time = {label: 0 for label in base}  # when a label's arcs came in
        self.parts: dict[int, tuple[int, int]] = {}
        self.taken: dict[tuple[int, int], int] = {}  # (label, arc taken from its state) -> time
        for now, (u, v, w) in enumerate(merges, 1):
            if w not in self.time and self.allows(u, v):
                self.taken[u, v] = now
                self.time[w] = now
                self.parts[w] = (u, v)

    def allows(self, u: int, v: int) -> bool:
        """Is there an arc v in the state that u leads to?"""
        time, taken, until = self.time, self.taken, 1 << 60
        while True:
            if taken.get((u, v), 1 << 60) < until:
                return False
            born_u, born_v = time[u], time[v]
            if born_u == born_v == 0:
                return True
            if born_u > born_v:  # u's first state was the one behind its right part then
                until, u = born_u, self.parts[u][1]
            else:  # v's arc came to the states that had its left part's, the gadget's copy included
                until, v = born_v + 1, self.parts[v][0]


class WordEncoder:
    """Runs words through the composition of spelling and token automaton."""

    def __init__(self, tokens: TokenAutomaton, labels: dict[int, bytes]):
        self.tokens, self.labels = tokens, labels
        self.label = {data: i for i, data in labels.items() if i in tokens.time}
        # The spelling's trie as tables: the next shorter label of a label, and the longest one of a beginning.
        self.shorter: dict[int, int] = {}
        for data, i in self.label.items():
            ends = (self.label.get(data[:n], -1) for n in range(len(data) - 1, 0, -1))
            self.shorter[i] = next((e for e in ends if e >= 0), -1)
        # Every beginning of a label, with the longest label that it begins with.
        self.deepest: dict[bytes, int] = {}
        for data in sorted(self.label, key=len):
            at = -1
            for n in range(1, len(data) + 1):
                at = self.label.get(data[:n], at)
                self.deepest[data[:n]] = at
        self.sizes = {i: len(data) for data, i in self.label.items()}
        self.arcs: dict[tuple[int, int], bool] = {}

    def _arc(self, u: int, v: int) -> bool:
        got = self.arcs.get((u, v))
        if got is None:
            if len(self.arcs) >= MAX_ARCS:
                self.arcs.clear()
            got = self.arcs[u, v] = self.tokens.allows(u, v)
        return got

    def encode(self, word: bytes) -> list[int]:
        """The labels of one pre-split word: the one path the automaton accepts."""
        whole = self.label.get(word)
        if whole is not None:
            return [whole]
        sizes, shorter, deepest, arc, n = self.sizes, self.shorter, self.deepest.get, self.arcs.get, len(word)
        out: list[int] = []
        dead: set[int] = set()
        at, last, label = 0, -1, None
        while at < n:
            if label is None:  # a new place: the longest label that the word goes on with
                label, end = -1, at + 1
                longest = deepest(word[at : at + 3])  # most go on for three bytes
                if longest is not None:
                    label, end = longest, at + 4
                while end <= n:
                    longest = deepest(word[at:end])
                    if longest is None:
                        break
                    label = longest
                    end += 1
            while label >= 0:
                end = at + sizes[label]
                if end not in dead:
                    if last < 0:
                        break
                    is_open = arc((last, label))
                    if is_open or (is_open is None and self._arc(last, label)):
                        break
                label = shorter[label]
            if label >= 0:
                out.append(label)
                at, last, label = end, label, None
            elif out:  # no way on from here: one label back, and a shorter one
                dead.add(at)
                label = out.pop()
                at -= sizes[label]
                label = shorter[label]
                last = out[-1] if out else -1
            else:
                raise ValueError("the vocabulary has no label for a byte of the text")
        return out


class Codec:
    """Encoder and decoder of one byte-level BPE vocabulary file (JSON)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.labels = {i: spell(s) for s, i in vocab.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        triples = [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges]
        base = [vocab[c] for c in letters if c in vocab]
        self.words = WordEncoder(TokenAutomaton(base, triples), self.labels)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels |= {i: s.encode() for s, i in self.special.items()}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.pattern = regex.compile(PATTERN)
        self.known = Memory(MAX_PIECES)  # words of the pattern, and texts between spaces
        self.arcs = [self.labels.get(i, b"") for i in range(max(self.labels) + 1)]

    def _piece(self, piece: str) -> bytes:
        """Ids of a text as 4-byte integers."""
        return b"".join(map(self._word, self.pattern.findall(piece)))

    def _word(self, word: str) -> bytes:
        """Ids of one match of the pattern."""
        ids = self.known.young.get(word) or self.known.find(word)
        if ids is None:
            ids = array("I", self.words.encode(word.encode())).tobytes()
            if len(word) <= 64:
                self.known.put(word, ids)
        return ids

    def _plain(self, text: str) -> list[bytes]:
        if uneven(text):
            return [self._piece(text)]
        first, *rest = text.split(" ")
        new = self._looked_up
        pieces = list(map(" ".__add__, rest))
        found = zip(map(self.known.young.get, pieces), pieces)
        return [new(first), *[ids or new(piece) for ids, piece in found]]

    def _looked_up(self, piece: str) -> bytes:
        ids = self.known.find(piece)
        if ids is None:
            words = self.pattern.findall(piece)
            if len(words) == 1:
                return self._word(piece)
            ids = b"".join(map(self._word, words))
            if len(piece) <= 64:
                self.known.put(piece, ids)
        return ids

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        out, at = [], 0
        for m in self.cut.finditer(text) if self.special and any(s in text for s in self.special) else ():
            if m.start() > at:
                out += self._plain(text[at : m.start()])
            out.append(np.uint32(self.special[m[0]]).tobytes())
            at = m.end()
        if at < len(text):
            out += self._plain(text[at:] if at else text)
        return np.frombuffer(b"".join(out), np.uint32)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; an id without a label adds nothing."""
        arcs = self.arcs
        if ids and not 0 <= min(ids) <= max(ids) < len(arcs):
            ids = [i for i in ids if 0 <= i < len(arcs)]
        return self.spelled(ids)

    def spelled(self, ids: list[int]) -> str:
        """The text of ids that all have a place in the vocabulary, as those of ``encode``."""
        return b"".join(map(self.arcs.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of a vocabulary file, one per Python worker."""
    return Codec(path)


def encode(docs: DataFrame, vocabulary: str, name: str = "ids") -> DataFrame:
    """``docs`` with its text's ids in a column ``name`` (which must not exist yet)."""
    from pyspark.sql import types as T

    names = docs.columns
    at = names.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for b in text_chunks(batches):
            got = [own.encode(t or "") for t in b.column(at).cast(pa.large_string()).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int32)
            values = np.concatenate(got) if got else np.zeros(0, np.uint32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text of the column ``ids`` in a column ``name``."""
    from pyspark.sql import types as T

    names = docs.columns
    at = names.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        for b in text_chunks(batches):
            got = [own.decode(i or []) for i in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], names=[*names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


def coded(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, ids_sha256, decoded_sha256): every text encoded and its ids decoded again, both in
    one pass, so that ids and decoded texts don't leave the worker in between."""
    from pyspark.sql import types as T

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocabulary)
        digits = [str(i) for i in range(len(own.arcs))]
        for b in text_chunks(batches):
            ids, ids_sha, decoded_sha = [], [], []
            for text in b.column(1).cast(pa.large_string()).to_pylist():
                found = own.encode(text or "")
                plain = found.tolist()
                ids.append(found)
                ids_sha.append(hashlib.sha256(",".join(map(digits.__getitem__, plain)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(own.spelled(plain).encode()).hexdigest())
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            values = pa.array(np.concatenate(ids).astype(np.int32)) if ids else pa.array([], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())],
                ["doc_id", "ids", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    more = [("ids", T.ArrayType(T.IntegerType())), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    return picked.mapInArrow(run, T.StructType([picked.schema["doc_id"], *(T.StructField(n, t) for n, t in more)]))


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), encoded then decoded."""
    return coded(docs, vocabulary).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", "decoded_sha256")
