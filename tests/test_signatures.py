import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from threatframe.config import SIGNATURES
from threatframe.operators import signature
from threatframe.plans.demo import TEXTS

EXPECTED = ["SIG-AUTH-001", "SIG-AUTH-002", "SIG-AUTH-003", "SIG-WEB-001", "SIG-WEB-002", "SIG-WEB-003", "SIG-WEB-004",
            "SIG-MAL-001", "SIG-MAL-002", "SIG-MAL-003", "SIG-MAL-004", "SIG-PRIV-001", "SIG-PRIV-002", "SIG-DATA-001",
            "SIG-DATA-002", "SIG-NET-001", "SIG-NET-002", None, None, None, "SIG-AUTH-002", "SIG-WEB-004", "SIG-WEB-001"]


def hits(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {(r.i, r.signature_id) for r in signature.matches(df, F.col("t")).collect()}


def test_truth_table(spark):
    found = hits(spark, TEXTS)
    for i, wanted in enumerate(EXPECTED):
        assert {s for j, s in found if j == i} == ({wanted} if wanted else set()), TEXTS[i]


def test_same_as_regular_expressions_with_unicode_and_words_missing(spark):
    texts = TEXTS + ["UNıON\u00a0ſELECT", "UNıON ſELECT", "ADMİN paſſword 123456", "MIMIKATZ", "mimi\nkatz", "GET\t/ABCDEF0123456789",
                     "python x -c\nsocket", "python x -c socket", "bacKup DATABASE backup 10000mb", "x" * 5000 + "|", "", "٣ = ٣"]
    found = hits(spark, texts)
    for i, text in enumerate(texts):
        assert {s for j, s in found if j == i} == {s.rule_id for s in SIGNATURES if re.search(s.pattern, text, re.I)}, text


def test_needed_words_only_spare_work(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("page_id", F.col("html").alias("text"))
    for df in (docs, pages):
        plain = [F.sum(F.col("text").rlike(signature.FLAGS + s.pattern).cast("int")).alias(s.rule_id) for s in SIGNATURES]
        want = {k: v for k, v in df.agg(*plain).first().asDict().items() if v}
        got = {r.rule_id: r.hits for r in signature.counts(df, F.col("text")).collect()}
        assert got == want


def test_own_signature_without_words_and_bad_pattern(spark):
    own = replace(SIGNATURES[0], rule_id="OWN-1", pattern="fo+bar'\\d")
    bad = replace(SIGNATURES[0], rule_id="OWN-2", pattern="(unclosed")
    off = replace(SIGNATURES[0], rule_id="OWN-3", enabled=False)
    good, errors = signature.valid([own, bad, off], spark)
    assert [s.rule_id for s in good] == ["OWN-1"] and list(errors) == ["OWN-2"]
    df = spark.createDataFrame([("a FOOBAR'7",)], "t string")
    row = signature.matches(df, F.col("t"), good).first()
    assert row.signature_attrs["matched_text"] == "FOOBAR'7"


def test_search_text_joins_parts(spark):
    df = spark.createDataFrame([("raw", "", None, "cmd", None, "u")], "a string, b string, c string, d string, e string, f string")
    text = signature.search_text(*[F.col(c) for c in "abcdef"])
    assert df.select(text).first()[0] == "raw cmd u"


@pytest.mark.parametrize("level, cf, score", [("HIGH", 0.85, 73.0), ("CRITICAL", 0.95, 100.0)])
def test_score(spark, level, cf, score):
    from threatframe.functions.scoring import level_number, threat_score

    row = spark.range(1).select(threat_score(level_number(F.lit(level)), F.lit(cf), F.lit(1)).alias("s")).first()
    assert row.s == pytest.approx(score)


def test_own_pattern_under_a_known_id(spark):
    from dataclasses import replace

    from threatframe.config import SIGNATURES

    own = [replace(s, pattern="evilcorp") for s in SIGNATURES if s.rule_id == "SIG-MAL-001"]
    rows = spark.createDataFrame([("evilcorp beacon",), ("mimikatz",)], "t string")
    assert [r.t for r in signature.matches(rows, F.col("t"), own).collect()] == ["evilcorp beacon"]
