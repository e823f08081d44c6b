"""Near copies against plain Jaccard similarities of all pairs."""

import random

import numpy as np
import pytest
from tests.conftest import DATA

import corpus_pipeline
from caresift.llm import shingle_jaccard


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def expected(rows):
    """Smallest id of the class of every row, by all pairs."""
    sets = [plain_set(t) for _, t in rows]
    labels = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if labels[i] != labels[j] and (sets[i] == sets[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both)):
                low, high = sorted((labels[i], labels[j]))
                labels = [low if x == high else x for x in labels]
    first = {}
    for (doc_id, _), n in zip(rows, labels):
        if doc_id is not None:
            first[n] = min(first.get(n, doc_id), doc_id)
    return sorted(((d, first.get(n)) for (d, _), n in zip(rows, labels)), key=repr)


def edited_rows(seed):
    draw = random.Random(seed)
    rows, line = [], "one very common line of words that stands in every text here"
    for k in range(25):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.randrange(20, 200))]
        for _ in range(6):
            copy = list(words)
            for _ in range(draw.randrange(0, 5)):
                copy[draw.randrange(len(copy))] = f"x{draw.randrange(3000)}"
            rows.append((len(rows), " ".join(copy) + ("\n" + line if k % 2 else "")))
    return [*rows, (None, rows[0][1]), (900, None), (901, ""), (902, "two words"), (903, "Two  words"), (904, "four words of text")]


@pytest.mark.parametrize("frequent", [0, 100_000])
def test_all_classes_are_found(spark, monkeypatch, frequent):
    monkeypatch.setattr(shingle_jaccard, "FREQUENT", frequent)
    rows = edited_rows(3)
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, node string")
    got = [tuple(r) for r in shingle_jaccard.near_copies(docs).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_bitmap_never_differs_more_than_the_sets():
    draw = np.random.default_rng(1)
    for _ in range(50):
        x = np.unique(draw.integers(0, 2**64, 300, dtype=np.uint64))
        y = np.unique(np.append(x[20:], draw.integers(0, 2**64, 9, dtype=np.uint64)))
        bits = np.bitwise_count((shingle_jaccard.bitmap(x) ^ shingle_jaccard.bitmap(y)).view(np.uint64)).sum()
        assert bits <= len(np.setxor1d(x, y))


def test_one_replaced_word_is_a_near_copy_in_the_pipeline(spark):
    words = [f"word{k}" for k in range(100)]
    copy = [*words[:50], "other", *words[51:]]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(copy)), (3, " ".join(words[::-1]))], "doc_id long, text string")
    got = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, DATA)
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3]
