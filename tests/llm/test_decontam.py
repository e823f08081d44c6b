"""Passages in documents against plain edit distances."""

import random

import numpy as np
import pytest
from tests.conftest import DATA

from caresift.llm import decontam


def best_place(pattern, text):
    """(edits, earliest end) of the whole pattern anywhere in the text."""
    row = [0] * (len(text) + 1)
    for c in pattern:
        new = [row[0] + 1]
        for j, d in enumerate(text):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    edits = min(row)
    return edits, row.index(edits)


def edited(text, edits, draw):
    out = list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        how = draw.choice("sid")
        if how == "s":
            out[at] = draw.choice("xyz")
        elif how == "i":
            out.insert(at, draw.choice("xyz"))
        else:
            del out[at]
    return "".join(out)


def prose(draw, words):
    return " ".join("".join(draw.choice("aeiounstrl") for _ in range(draw.randrange(2, 9))) for _ in range(words))


@pytest.mark.parametrize("seed", range(6))
def test_every_occurrence_within_budget_is_found(seed):
    draw = random.Random(seed)
    items = [(i, prose(draw, draw.randrange(4, 60))) for i in range(12)]
    index = decontam.PassageIndex(items)
    texts = []
    for i, t in items:
        budget = decontam.budget(len(decontam.normal(t)))
        texts.append(prose(draw, draw.randrange(0, 80)) + " " + edited(decontam.normal(t), budget, draw) + prose(draw, 5))
        texts.append(prose(draw, 100))
    got = {(k, i): e for k, i, _, _, e in decontam.search(index, texts)}
    for k, text in enumerate(texts):
        for i, t in items:
            # an item up to a window's length as a whole, a longer one by its best window
            pattern = decontam.normal(t)
            last = max(0, len(pattern) - decontam.WINDOW)
            starts = {*range(0, last, decontam.STRIDE), last}
            edits = min(best_place(pattern[a : a + decontam.WINDOW], decontam.normal(text))[0] for a in starts)
            most = decontam.budget(min(len(pattern), decontam.WINDOW))
            assert ((k, i) in got) == (edits <= most), (k, i, edits)
            if (k, i) in got:
                assert edits <= got[k, i] <= most


def test_places_are_in_the_normal_form():
    index = decontam.PassageIndex([(1, "The Quick\nbrown fox jumps over it")])
    ((k, item, start, end, edits),) = decontam.search(index, ["none here", None, "So:\tTHE quick  brown\nfox jumps over it, yes"])
    assert (k, item, edits) == (2, 1, 0)
    assert decontam.normal("So:\tTHE quick  brown\nfox jumps over it, yes")[start:end] == "the quick brown fox jumps over it"


def test_gram_codes_tell_runs_apart():
    points = decontam.code_points("abcdefgh abcdefgh 日本語日本語日本")
    codes = decontam.gram_codes(points)
    assert len(codes) == len(points) - 7 and codes[0] == codes[9] and len(np.unique(codes)) == len(codes) - 2
    assert len(decontam.gram_codes(points[:7])) == 0


ITEM = "it was the best of times, it was the worst of times, it was the age of wisdom"
DOCS = [
    (1, f"Before. {ITEM.upper()} After.", "x", 9),
    (2, None, "x", 9),
    (3, "", "x", 9),
    (4, "nothing of the kind", "x", 9),
    (1, f"Before. {ITEM.upper()} After.", "x", 9),
    (None, ITEM, "x", 9),
    (5, "word " * 50_000 + ITEM.replace("best", "bist") + " word" * 50_000, "x", 9),
    (6, ITEM[:40] + " and now for something else " + ITEM[40:], "x", 9),
]


def test_rows(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, item_id string, start int").repartition(3)
    bench = spark.createDataFrame([(7, ITEM), (7, ITEM), (8, None), (9, ""), (10, "short"), (None, "a passage that nobody has")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"], r["edits"]) for r in decontam.contaminated(docs, bench).collect()), key=repr)
    assert got == sorted([(1, 7, 0), (1, 7, 0), (None, 7, 0), (5, 7, 1)], key=repr)


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    bench = spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet")
    one = sorted(map(tuple, decontam.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 2000)
    assert one and sorted(map(tuple, decontam.contaminated(docs, bench).collect())) == one


@pytest.mark.parametrize("chars", [2_000_000, 300, 40])
def test_repeated_rows_match_each_for_itself_in_any_number_of_blocks(spark, monkeypatch, chars):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", chars)
    draw = random.Random(8)
    others = [(20 + k, prose(draw, 12)) for k in range(12)]
    docs = spark.createDataFrame([(1, f"x {ITEM}"), (1, f"x {ITEM}"), (1, f"other {ITEM} {others[3][1]}"), (2, others[5][1])], "doc_id long, text string")
    bench = spark.createDataFrame([(7, ITEM), (7, ITEM.replace("best", "bist")), *others], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], r["start"], r["edits"]) for r in decontam.contaminated(docs, bench).collect())
    assert got == [(1, 7, 2, 0), (1, 7, 2, 0), (1, 7, 6, 0), (1, 23, 7 + len(decontam.normal(ITEM)), 0), (2, 25, 0, 0)]
    assert decontam.clean(docs, bench).count() == 0


def test_long_items_are_found_by_their_windows(spark):
    draw = random.Random(4)
    item = prose(draw, 400)
    half = item[len(item) // 3 : len(item) // 3 + 900]
    docs = spark.createDataFrame([(1, "x " + half), (2, prose(draw, 300))], "doc_id long, text string")
    got = decontam.contaminated(docs, spark.createDataFrame([(3, item)], "item_id long, text string")).collect()
    assert [(r["doc_id"], r["item_id"]) for r in got] == [(1, 3)]


@pytest.mark.parametrize("words", [44, 70, 400])
def test_a_copied_run_is_found_wherever_it_starts(words):
    draw = random.Random(words)
    item = decontam.normal(prose(draw, words))
    assert len(item) > decontam.WINDOW + decontam.STRIDE
    index = decontam.PassageIndex([(1, item)])
    run = decontam.WINDOW + decontam.STRIDE - 1
    texts = [f"{prose(draw, 20)} {item[a : a + run]} {prose(draw, 20)}" for a in range(0, len(item) - run + 1, 7)]
    assert [k for k, *_ in decontam.search(index, texts)] == list(range(len(texts)))


def test_query_against_plain_search(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontam.op10_decontam(spark, f"{DATA}/sf0.001").collect()}
    exact = {(d, i) for d, t in docs for i, p in items if decontam.normal(p) in decontam.normal(t)}
    assert exact and {k for k, e in got.items() if e == 0} == exact


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    assert decontam.contaminated(docs, bench).count() == 0
    assert decontam.contaminated(some, bench).count() == 0
    assert decontam.contaminated(docs, some.withColumnRenamed("doc_id", "item_id")).count() == 0
