"""Language ID: held-out accuracy, rejection, and unusual rows."""

import zlib

import pytest
from pyspark.sql import functions as F

from matchlake.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    rows = language.predict(docs, model).join(docs, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) > 0.97 * len(held)
    accepted = [r for r in held if r.accepted]
    assert len(accepted) > 0.9 * len(held)
    assert sum(r.lang_pred == r.lang for r in accepted) > 0.98 * len(accepted)


def test_the_held_out_fold_is_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    other = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1
    changed = docs.withColumn("lang", F.when(other, F.lit("xx")).otherwise(F.col("lang")))
    a, b = language.train(docs), language.train(changed)
    assert a.languages == b.languages and (a.table == b.table).all()


def test_edge_rows(spark):
    rows = [
        (1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "the of and " * 40_000, "en"), (None, "le la les de", "fr"),
        (5, "the and of", None), (5, "the and of", None), (7, "é", "fr"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns(
        {"score": F.lit("x"), "rank": F.lit(1), "hash": F.lit(1)}
    )
    got = language.predict(docs, language.train(docs)).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 4, 5, 5, 7]
    for r in got:
        assert 0 <= r.score <= 1
        assert r.lang_pred == "und" if r.doc_id in (1, 2, 3) else r.lang_pred in ("en", "fr")


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = language.train(docs)
    assert [(r.lang_pred, r.score) for r in language.predict(docs, model).collect()] == [("und", 0.0)]
    assert language.predict(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("distinct", [1, 3])
def test_a_language_of_many_copies_of_few_texts(spark, distinct):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    own = F.concat(
        F.lit("kuu paistaa taivaalla ja yö on pitkä "),
        F.element_at(F.array(*map(F.lit, ("tuuli", "lumi", "meri"))), (F.col("id") % distinct + 1).cast("int")),
    )
    lost = []
    for turn in range(6):  # other texts, so other hashes
        copies = spark.range(10**6, 10**6 + 5_000).select(
            F.col("id").alias("doc_id"), F.concat(own, F.lit(f" {turn}")).alias("text"), F.lit("fi").alias("lang")
        )
        all_docs = docs.unionByName(copies)
        model = language.train(all_docs)
        assert len(model.languages) == 5, turn
        if not turn:
            lost = language.predict(copies, model).where("lang_pred <> 'fi'").collect()
            rows = language.predict(docs, model).join(docs, "doc_id").where("held_out").collect()
            assert sum(r.lang_pred == r.lang for r in rows) > 0.97 * len(rows)
    assert lost == []


def test_each_of_five_languages_is_learned():
    words = ["alpha", "bravo", "tango", "kilo", "zulu"]
    texts = [f"{w} {w}{i} {w}" for i in range(20) for w in words]
    model = language.fit(texts, words * 20)
    assert [model.predict(f"{w} {w}")[0] for w in words] == words


def test_one_very_long_text_leaves_room_for_the_other_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_BYTES", 1 << 16)
    rows = [(i, t, lang) for lang, t in (("en", "the of and"), ("fr", "le la les")) for i in range(9)]
    rows.append((20, "12 🙂 " * 20_000 + "das der die " * 20_000, "de"))
    rows = [(i + 100 * k, f"{t} {i}", lang) for k, (i, t, lang) in enumerate(rows)]
    held_out = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    rows = [(i if i not in held_out else None, t, lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.languages == ["de", "en", "fr"]
    got = language.predict(docs, model).join(docs, "doc_id").collect()
    assert got and all(r.lang_pred == r.lang for r in got)
