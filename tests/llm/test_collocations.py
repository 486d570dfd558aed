"""Phrases by top-order counts against plain counts of every length."""

import random

import pytest

from playtrail.llm import collocations as C

PARTS = ["the of and", "x y z w", "no. one", "a\tb", "q\nr", "É é", "x y", "p,q;r", "x\x0by\x0c"]


def rows_of(seed):
    rnd = random.Random(seed)
    words = [f"W{i}" for i in range(60)]
    rows = []
    for i in range(500):
        text = [rnd.choice(words) if rnd.random() < 0.5 else rnd.choice(PARTS) for _ in range(rnd.randrange(60))]
        rows.append((i, " ".join(text), rnd.choice(["en", "en", None, "", "a\nb", "und"])))
    rows += [(1, None, "en"), (None, "", "fr"), (2, "h i " * 1500 + "k " * 200, "en")]
    # Two words with very many continuations.
    rows.append((3, "x y " + " x y ".join(words[i % 60] + " " + words[(i * 7) % 60] for i in range(800)), "en"))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, n int, phrase string")


@pytest.mark.parametrize("seed,block", [(1, 1 << 20), (2, 50), (3, 1000)])
def test_counts_and_phrases(spark, seed, block, monkeypatch):
    monkeypatch.setattr(C.phrase_counts, "__defaults__", (C.LEAST, C.SIZE, block))
    rows = rows_of(seed)
    want = C.brute_force([(t, la) for _, t, la in rows])
    got = [tuple(r) for r in C.collocations(frame(spark, rows).repartition(6)).collect()]
    assert len(got) > 50 and sorted(got) == sorted(want)


def test_limits_and_order(spark):
    rows = rows_of(4)
    want = C.brute_force([(t, la) for _, t, la in rows], least=5, inside=50, top=7)
    got = [tuple(r) for r in C.collocations(frame(spark, rows), least=5, inside=50, top=7).collect()]
    assert sorted(got) == sorted(want)


def test_odd_tables(spark, odd_docs, no_docs):
    docs = odd_docs.withColumnRenamed("spans", "lang")
    got = [tuple(r) for r in C.collocations(docs).collect()]
    assert got == [("en", 1, "word next", 30_000, 30_000, 30_000, 60_008, 1_000_000)]
    assert C.collocations(no_docs.withColumnRenamed("spans", "lang")).count() == 0


def test_packed_windows_come_back():
    block = C.Block()
    block.add(b"en", [[b"a", b"b"], [b"a", b"b"]])
    block.add(b"", [[b""]])
    found = block.windows()
    back = C.Windows.unpack(found.pack())

    def plain(w):
        return sorted((tuple(w.words[i] if i >= 0 else b"-" for i in c), int(n)) for c, n in zip(w.codes, w.counts))

    assert plain(back) == plain(found)
