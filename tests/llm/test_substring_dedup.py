"""Seed and extend against a count of all windows."""

import random

import pytest

from playtrail.llm import substring_dedup as S
from playtrail.llm.common import read

from ..conftest import SF_SMALL


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)


def same(spark, texts, length):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.report(frame(spark, texts), length).collect()}
    assert [got[i] for i in range(len(texts))] == S.brute_force(texts, length)


@pytest.mark.parametrize("length,seed", [(35, 1), (35, 2), (12, 3), (7, 4)])
def test_random_passages(spark, length, seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)]
    base = [[rnd.choice(words) for _ in range(300)] for _ in range(5)]
    texts = []
    for _ in range(150):
        text = []
        for _ in range(rnd.randrange(6)):
            if rnd.random() < 0.5:
                source, start = rnd.choice(base), rnd.randrange(260)
                text += source[start : start + rnd.randrange(5, 90)]
            else:
                text += [rnd.choice(words) for _ in range(rnd.randrange(60))]
        texts.append(rnd.choice([" ", "\n", " \t"]).join(text))
    texts += [texts[3], texts[3], None, "", "a " * 100, "a b " * 40, "x y " * 50, "é中 " * 30]
    same(spark, texts, length)


def test_borders_of_a_repeat(spark):
    """35 words are a repeat, 34 are none; one place in each text, found at any offset."""
    rnd = random.Random(9)
    passage = [f"p{i}" for i in range(35)]
    for cut in (34, 35):
        texts = []
        for k in range(40):
            own = [f"t{k}_{i}_{rnd.random()}" for i in range(60)]
            at = rnd.randrange(60)
            texts.append(" ".join(own[:at] + passage[:cut] + own[at:]))
        got = S.report(frame(spark, texts)).collect()
        assert {r.n_removed for r in got} == {35 if cut == 35 else 0}
        same(spark, texts, 35)


def test_spans_and_other_columns(spark, odd_docs, no_docs):
    got = S.remove(odd_docs.drop("n_words"))
    assert got.count() == odd_docs.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[5].n_removed == rows[5].n_words == 60_000 and rows[5].repeats[0].end == 60_000 and rows[5].kept == ""
    assert rows[3].n_words == rows[2].n_words == rows[4].n_words == 0
    assert rows[1].kept == "alpha beta gamma delta"  # shorter than a window
    assert S.remove(no_docs.drop("n_words")).count() == 0
    with pytest.raises(ValueError, match="n_words"):
        S.remove(odd_docs)
    assert S.report(odd_docs).columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_repeated_rows_are_copies(spark):
    text = " ".join(f"u{i}" for i in range(40))
    got = S.report(spark.createDataFrame([(1, text), (1, text), (None, text + " x")], "doc_id long, text string"))
    assert sorted(r.n_removed for r in got.collect()) == [40, 40, 40]


def test_texts_are_shuffled_once(spark):
    """Both joins of the texts read one exchange."""
    done = S.report(read(spark, SF_SMALL, "documents"))
    done.collect()
    assert "ReusedExchange [row" in done._jdf.queryExecution().executedPlan().toString()
