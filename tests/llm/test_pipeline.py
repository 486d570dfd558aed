"""The pipeline's stages take effect, and its queries are registered."""

import random

import corpus_pipeline

import __spark_entry__


def table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def test_stages(spark, tmp_path):
    rnd = random.Random(1)
    say = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    leak = say(15)
    texts = {k: say(60) for k in range(120)}
    for k in range(0, 40, 2):
        texts[k] += " you vile grubbler. " + say(5)
    texts[100] = texts[99]
    texts[101] = say(20) + " " + leak + " " + say(9)
    texts[102] += " write to jo.doe@mail.example.com now"
    texts |= {103: None, 104: ""}
    docs = [(k, t, "en", "s", len(t or "")) for k, t in texts.items()]
    table(spark, tmp_path, "documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    table(spark, tmp_path, "labels", [(k, 1, int(k < 40 and k % 2 == 0)) for k in range(80)], "doc_id long, quality int, toxic int")
    table(spark, tmp_path, "benchmark", [(5, leak), (6, None)], "item_id long, text string")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == names
        seen.append({r["doc_id"]: r for r in docs.collect()})
    assert set(texts) - set(seen[0]) == set(range(0, 40, 2))
    assert set(seen[0]) - set(seen[1]) == {100, 104}
    assert set(seen[1]) - set(seen[2]) == {101}
    changed = seen[3][102]
    assert set(seen[3]) == set(seen[2]) and "jo.doe" not in changed["text"] and len(changed["text"]) == changed["n_chars"]
    assert all(seen[3][k]["text"] == seen[2][k]["text"] for k in seen[2] if k != 102)
    done = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(done) == set(seen[3])


def test_empty_tables(spark, tmp_path):
    table(spark, tmp_path, "documents", [], "doc_id long, text string, lang string, source string, n_chars long")
    table(spark, tmp_path, "labels", [], "doc_id long, quality int, toxic int")
    table(spark, tmp_path, "benchmark", [], "item_id long, text string")
    table(spark, tmp_path, "pages", [], "page_id long, url string, html string")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    for name, query in __spark_entry__.queries().items():
        if name.startswith("op"):
            assert query(spark, str(tmp_path)).count() == 0, name


def test_every_operator_is_registered():
    names = list(__spark_entry__.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
