"""Every stage on its own input, then all of them against plain Python."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import DATA

import corpus_pipeline
from caresift.llm import bitpack, decontam, mixing, simhash_vp
from tests.llm.test_simhash_vp import plain_classes, plain_fingerprint

SF = f"{DATA}/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int, item_id int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def run(spark, stage, df, sf=SF):
    return dict(corpus_pipeline.STAGES)[stage](spark, df, sf)


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_ids"]


def odd(spark):
    rows = [
        (1, "Some words of a plain text here", "en", "s", 3, 1, 1),
        (1, "Some words of a plain text here", "en", "s", 3, 1, 1),
        (2, None, "en", None, None, 1, 1),
        (3, "", None, "s", 0, 1, 1),
        (4, "12 34 !", "en", "t", 7, 1, 1),
        (None, "Another text without any id at all", "en", "t", 1, 1, 1),
        (6, "word " * 60_000, "en", "t", 1, 1, 1),
        (7, "Some words of a plain text here", "en", "u", 3, 1, 1),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_odd_rows_pass_all_stages(spark):
    df = odd(spark)
    kept = run(spark, "language", df)
    assert kept.columns == df.columns
    assert sorted((r[0] for r in kept.collect()), key=repr) == sorted([1, 1, None, 6, 7], key=repr)
    single = run(spark, "near_duplicates", kept)
    assert single.columns == df.columns
    assert sorted((r[0] for r in single.collect()), key=repr) == sorted([1, None, 6], key=repr)
    clean = run(spark, "decontamination", single)
    assert clean.columns == df.columns and clean.count() == 3
    again = run(spark, "mixing", clean.withColumn("sources", F.lit("own")))
    assert {r["sources"] for r in again.collect()} == {"own"}
    mixed = run(spark, "mixing", clean)
    assert mixed.columns == df.columns and mixed.count() > 0
    assert run(spark, "token_ids", mixed).count() == mixed.count()


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_empty_table(spark, stage):
    assert run(spark, stage, odd(spark).limit(0)).count() == 0


def test_whole_run_against_plain_python(spark, docs):
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    rows = [r for r in rows if r["text"] and any(c.isalpha() for c in r["text"])]
    names = plain_classes([plain_fingerprint(r["text"]) for r in rows])
    rows = [r for k, r in enumerate(rows) if names[k] == k]
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {r["doc_id"] for r in decontam.contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert all(r["doc_id"] in hit for r in rows if any(i in decontam.normal(r["text"]) for i in items))
    rows = [r for r in rows if r["doc_id"] not in hit]
    left = spark.createDataFrame([(r["doc_id"], r["text"], [r["source"]]) for r in rows], "doc_id long, text string, sources array<string>")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(left).collect()}
    coder, place, want = bitpack.CachedEncoder(bitpack.tokenizer_path()), 0, []
    for r in rows:
        ids = np.append(coder._whole(r["text"]), np.uint32(2)).astype("<u4")
        for _ in range(copies[r["doc_id"]]):
            want.append((r["doc_id"], place, len(ids), zlib.crc32(ids.tobytes())))
            place += len(ids)
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, SF).collect()), key=lambda r: r[1])
    assert got == want


def test_one_of_each_keeps_the_smallest(spark, docs):
    got = {r["doc_id"] for r in run(spark, "near_duplicates", docs).collect()}
    classes = {r["doc_id"]: r["component_id"] for r in simhash_vp.near_duplicates(docs).collect()}
    assert got == set(classes.values())


def test_copies_are_told_by_their_text(spark):
    one, other = "Some words of a plain text here", "Quite another text that has nothing of the first in it at all"
    rows = [(1, one), (2, one), (2, other), (None, one), (None, one), (5, other + " again and again until it differs")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t), 1, 1) for i, t in rows], SCHEMA)
    kept = run(spark, "near_duplicates", df)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, one), (2, other), (5, rows[5][1])]
    nameless = run(spark, "near_duplicates", df.where("doc_id IS NULL"))
    assert [(r["doc_id"], r["text"]) for r in nameless.collect()] == [(None, one)]
