"""Personal data: base spans against a direct reading of the formats, and discovered ones."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from matchlake.llm import pii

SF = "/root/testdata/sf0.01"
FORMATS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind, value):
    digits = [int(c) for c in value if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1]))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in FORMATS
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]


def check(rows):
    for r, text in rows:
        want = plain(text)
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text[:200]
        for kind, _ in FORMATS:
            assert r[f"n_{kind}"] == sum(w.startswith(kind) for w in want)
        assert set(want) <= set(r.spans.split(",")) | {""}


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = pii.find(docs).collect()
    assert len(rows) == len(texts)
    check([(r, texts[r.doc_id]) for r in rows])


HARD = [
    "", "a@b.c.d@e.f", "a@b.cc_%x@d.ee", "a@b", "a@b..c x@y.z.", "é@b.c jo.doe+x%y@mail-1.example.com,",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.255 1..2.3.4.5", "999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111 1111 1111", "4111111111111112",
    "0000 0000 0000 0", "1-2-3 4 5 - 6 7", "+1 (743) 555-3824. +1 (2 +49.170.1234567-8-", "+12345678",
    "+1234567890123456", "𝟙😀 a@b.co 😀 +1 234 567 890", "5" * 60_000, "a" * 60_000 + "@", "a.b@" * 2_000,
    "1." * 30_000, "+1 " * 10_000, "a@b.c " * 300, "x\n+1 234\n567 8901 +1 234 567 890\n",
]


def test_hard_texts(spark):
    docs = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    check([(r, HARD[r.doc_id]) for r in pii.find(docs).collect()])


def test_edge_rows(spark):
    rows = [(1, None), (2, "x@y.zz"), (2, "x@y.zz"), (None, "x@y.zz"), (3, "y" * 300_000 + " x@y.zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"base": F.lit(1), "email": F.lit("x"), "n_chars": F.length("text")}
    )
    found = pii.find(docs).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.spans) for r in found) == [
        (0, 1, "email:0:6"), (1, 0, ""), (2, 1, "email:0:6"), (2, 1, "email:0:6"), (3, 1, "email:300001:300007"),
    ]
    masked = pii.mask_documents(docs)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert {(r.doc_id, r.text, r.n_chars) for r in masked.where("doc_id < 3").collect()} == {
        (1, None, None), (2, "[EMAIL]", 7),
    }
    assert masked.where("doc_id = 3 AND text LIKE '%y [EMAIL]'").count() == 1
    assert pii.find(docs.limit(0)).count() == 0 == pii.mask_documents(docs.limit(0)).count()


def test_context_discovers_identifiers_the_formats_miss(spark):
    good = ["4111111111111111", "5500005555555559", "4012888888881881", "378282246310005", "6011000990139424"]
    rows = [(i, f"Some text {i}. Please charge my card number {n} today, she said.") for i, n in enumerate(good)]
    rows.append((10, "Other words. Please charge my card number 4111111111111112 today, or so."))
    rows += [(20 + i, f"In the year {1900 + i} we saw {i} birds and page {i * 7} of it.") for i in range(40)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text = dict(rows)[10]
    at = text.index("4111")
    assert found[10].n_card == 0 and found[10].spans == f"card:{at}:{at + 16}"
    assert all(found[d].spans == "" for d in found if d >= 20)
    assert all(found[d].spans.count(":") == 2 and found[d].n_card == 1 for d in range(5))


@pytest.mark.parametrize(
    "spans, want",
    [
        ([], "0123456789"),
        ([("ip", 0, 2), ("card", 5, 10)], "[IP]234[CARD]"),
        ([("phone", 3, 7), ("card", 4, 9), ("ip", 9, 10)], "012[PHONE][IP]"),
    ],
)
def test_masking(spark, spans, want):
    kind = "array<struct<kind:string,start:bigint,end:bigint>>"
    row = spark.createDataFrame([("0123456789", spans)], f"text string, spans {kind}")
    assert row.select(pii.masked(F.col("text"), F.col("spans"))).first()[0] == want


def test_no_python_on_the_way(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = pii.find(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_columns_named_like_the_keys_stay(spark):
    docs = spark.createDataFrame(
        [(1, "to a@b.cd now", 7, "x", 9)], "doc_id long, text string, __pii_id int, __pii_text string, __pii_spans int"
    )
    rows = pii.mask_documents(docs).collect()
    assert [tuple(r) for r in rows] == [(1, "to [EMAIL] now", 7, "x", 9)]
