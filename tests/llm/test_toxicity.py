"""Toxicity: n-grams against plain Python, gradients, held-out accuracy, unseen spellings and odd rows."""

import random
import zlib

import numpy as np
import pytest
from tests.conftest import DATA

from caresift.llm import toxicity


def plain_grams(word: bytes) -> list[str]:
    spelled = f"<{word.decode()}>"
    return [spelled[k : k + n] for n in range(toxicity.SHORTEST, toxicity.LONGEST + 1) for k in range(len(spelled) - n + 1)]


def test_subwords_are_those_of_every_word_alone():
    spelled = [w.encode() for w in ("a", "idiot", "été", "日本語", "x" * 300, "ab", "idiots")]
    buckets, starts = toxicity.subwords(spelled)
    ends = [*starts[1:].tolist(), len(buckets)]
    for k, word in enumerate(spelled):
        alone, _ = toxicity.subwords([word])
        assert sorted(buckets[starts[k] : ends[k]].tolist()) == sorted(alone.tolist())
        assert len(alone) == len(plain_grams(word)) + 1
    one, other = (set(toxicity.subwords([w])[0].tolist()) for w in (b"idiot", b"idiots"))
    shared = set(plain_grams(b"idiot")) & set(plain_grams(b"idiots"))
    assert len(one & other) == len(shared)


def test_words_of_a_text():
    assert toxicity.words("Ab,c9D É-x\n\t_y") == [b"ab", b"c", b"d", "é".encode(), b"x", b"y"]
    assert toxicity.words(None) == toxicity.words("12 !") == []


def texts(seed, n, marks):
    """Invented prose; half of it holds some marked words."""
    draw = random.Random(seed)
    parts = "an er th on ti es re la mo vi qu".split()
    rows = []
    for k in range(n):
        body = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(draw.randint(20, 200))]
        if k % 2:
            for _ in range(max(1, len(body) // 25)):
                body.insert(draw.randrange(len(body)), draw.choice(marks))
        rows.append((" ".join(body), k % 2))
    return rows


def test_unseen_spellings_share_their_ngrams():
    seen = texts(1, 400, ["wretched", "scoundrel", "imbecile"])
    model = toxicity.train(*zip(*seen))
    new = texts(2, 200, ["wretchedly", "scoundrels", "imbeciles", "wretchd", "scoundrell"])
    found = np.array(model.scores([t for t, _ in new])) >= 0.5
    right = found == np.array([y for _, y in new], bool)
    assert right.mean() > 0.95
    assert model.word_odds([b"scoundrell"])[0] > 10 * abs(model.word_odds([b"lamoviqu"])[0])


def test_average_and_slopes_against_plain_sums():
    rows = texts(3, 60, ["wretched", "scoundrel"])
    bags = toxicity.Bags([t for t, _ in rows], np.array([y for _, y in rows]), least=2.0)
    table = np.random.default_rng(0).normal(size=(len(bags.rows), 3))
    at = {b: k for k, b in enumerate(bags.rows.tolist())}
    for k, (text, _) in enumerate(rows):
        vectors = []
        for word in toxicity.words(text):
            grams = toxicity.subwords([word])[0].tolist()
            vectors.append(sum((table[at[g]] for g in grams if g in at), np.zeros(3)) / len(grams))
        assert np.allclose(bags.average(table)[k], toxicity.SCALE * np.mean(vectors, axis=0))
    slope = np.random.default_rng(1).normal(size=(len(rows), 3))
    step = np.random.default_rng(2).normal(size=table.shape)
    # the average is linear in the table, so its transpose is what spread() gives
    assert np.isclose((bags.average(step) * slope).sum(), (bags.spread(slope) * step).sum())


def test_score_is_the_average_of_all_words():
    model = toxicity.train(*zip(*texts(4, 200, ["wretched"])))
    text = "Wretched the and wretched. Another"
    odds = np.mean([model.word_odds([w])[0] for w in toxicity.words(text)]) + model.bias
    assert np.isclose(model.scores([text])[0], 1 / (1 + np.exp(-odds)))
    assert model.scores([None, "", "1 2"]) == [1 / (1 + np.exp(-model.bias))] * 3


def test_held_out_documents(spark):
    sf = f"{DATA}/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.op12_toxicity(spark, sf).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    caught = [p for y, p in held if y == 1]
    clean = [p for y, p in held if y == 0]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.02


def test_only_labels_of_the_training_fold_teach(spark):
    rows = [(k, t) for k, (t, _) in enumerate(texts(5, 60, ["wretched"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(k, k % 2) for k in range(60)]
    turned = [(k, y if zlib.crc32(str(k).encode()) % 5 else 1 - y) for k, y in labels]
    first, second = (toxicity.training_rows(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert first == second
    assert len(first[0]) == sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(60))


def test_bound_of_the_sample(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 10 == 0)) for k in range(2000)], "doc_id long, toxic int")
    found, said, weights = toxicity.training_rows(docs, labels, 200)
    assert 60 < sum(said) < 140 and 60 < len(said) - sum(said) < 140
    assert np.isclose(sum(weights), sum(zlib.crc32(str(k).encode()) % 5 != 0 for k in range(2000)))


SCHEMA = "doc_id long, text string, score string, toxic int, id int, predicted int"


def test_odd_rows(spark):
    rows = texts(6, 80, ["wretched"])
    docs = [(k, t, "s", 5, 1, 1) for k, (t, _) in enumerate(rows)]
    docs += [(None, "wretched", "s", 0, 0, 0), (200, None, "s", 0, 0, 0), (201, "", "s", 0, 0, 0), (201, "wretched", "s", 0, 0, 0)]
    docs += [(202, "the " * 400_000, "s", 0, 0, 0), (203, "z" * 1_000_000, "s", 0, 0, 0), (7, rows[7][0], "s", 0, 0, 0)]
    docs = spark.createDataFrame(docs, SCHEMA)
    labels = [(k, y, "x") for k, (_, y) in enumerate(rows)] + [(None, 1, "x"), (3, None, "x"), (4, 7, "x"), (7, 1, "x"), (999, 1, "x"), (201, 0, "x"), (201, 1, "x")]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("labelled", [[], [(1, 1)], [(2, 0), (3, 0)]])
def test_without_both_labels(spark, labelled):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    got = [r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()]
    assert len(got) == 3 and len(set(got)) == 1 and 0 < got[0] < 1
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, labels)).count() == 0
