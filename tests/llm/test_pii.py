"""Fixed forms against plain regular expressions; patterns on a literal corpus."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tests.conftest import DATA

from caresift.llm import pii

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        total = 0
        for i, c in enumerate(reversed(digits)):
            twice = int(c) * (1 + i % 2)
            total += twice - 9 * (twice > 9)
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, f in FORMS.items() for m in re.finditer(f, text or "") if valid(k, m.group())]


def base_spans(rows):
    return [(r["doc_id"], [(x["kind"], x["start"], x["end"]) for x in r["base"]]) for r in rows]


CASES = [
    None,
    "",
    "plain words only",
    "a@b.cd+x@e.f @x.y a.b@c-d.e.f. q@w q@.com",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.255 1.2.3",
    "\U0001f600 x@y.zz ñ +49 (30) 1234-5678. +1 2 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 0000000000000",
    "9" * 3000 + " " + "a" * 20_000 + "@" + "b." * 3000 + "c +1" + " " * 3000 + "2",
]


def test_fixed_forms(spark):
    rows = [(i, t, "row") for i, t in enumerate(CASES)] + [(3, CASES[3], "again"), (None, "x@y.zz", "no id")]
    got = base_spans(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, row string")).collect())
    assert sorted(got, key=repr) == sorted([(i, brute(t)) for i, t, _ in rows], key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="01239 .@+-()abZ\n", max_size=60), min_size=30, max_size=60))
def test_fixed_forms_on_drawn_texts(spark, texts):
    rows = list(enumerate(texts))
    got = base_spans(pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert sorted(got) == sorted([(i, brute(t)) for i, t in rows])


def test_trusted_pattern_discovers(spark):
    seeds = [(i, f"Some text. Call me at +1 (555) 555-{1000 + i} now") for i in range(12)]
    rows = seeds + [
        (100, "Then call me at (555) 555-1234 please"),
        (101, "Serial number (555) 555-1234 of the part"),
        (102, "call me at noon"),
    ]
    got = {r["doc_id"]: r["added"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(x["kind"], x["start"], x["end"]) for x in got[100]] == [("phone", 16, 30)]
    assert all(not got[k] for k in got if k != 100)


def test_pattern_with_many_other_values_is_not_trusted(spark):
    rows = [(i, f"part no +1 (555) 555-{1000 + i}") for i in range(5)] + [(50 + i, f"part no 555-444-{1000 + i}") for i in range(20)]
    spots = pii.spans(pii.matches(spark.createDataFrame(rows, "doc_id long, text string")))
    assert pii.trusted_patterns(spots).count() == 0


def test_query_on_the_tables(spark):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    for r in pii.op4_pii(spark, f"{DATA}/sf0.001").collect():
        found = brute(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in FORMS] == [sum(f[0] == k for f in found) for k in FORMS]
        assert set(line.split(",")) <= set(r["spans"].split(","))


def test_empty_table(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("kind", pii.KINDS)
def test_native_plan(spark, kind):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = pii.personal_data(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
