"""Counts against plain Python, learned rules against planted ones."""

import re
from collections import Counter

import numpy as np
import pytest
from tests.conftest import DATA

from caresift.llm import decision_lists as dl


def plain(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search("[^\\x20\\x09-\\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


TEXTS = [
    None, "", "   ", "a", "a b c d e", "a b c d e a b c d e", "x " * 300, "one two\none two\n\n \none two\r", "ä#ö *$% <b>&| x \x1c y",
    "a a a a a b a a a a a", "\U0001f600 w v " * 20, "z" * 100_000, "p q r s t " * 5000 + "end",
]


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert dl.text_counts(text)[:5] == plain(text)


def test_windows_of_other_lengths():
    words = [w.encode() for w in "a b c a b c d a b".split()]
    assert dl.repeated_words(words, 2) == 8 and dl.repeated_words(words, 3) == 6 and dl.repeated_words(words, 4) == 0


def test_planted_rules_are_found():
    draw = np.random.default_rng(1)
    rows = {n: draw.random(4000) for n in ("x", "y", "z")}
    bad = (rows["x"] > 0.8) | ((rows["y"] <= 0.3) & (rows["z"] > 0.5))
    rules = dl.learn(rows, bad, np.arange(4000) % 3 == 0, ("x", "y", "z"))
    hit = np.zeros(4000, bool)
    for rule in rules:
        assert 1 <= len(rule) <= dl.MOST_CONDITIONS
        hit |= dl.covers(rule, rows)
    assert (hit == bad).mean() > 0.95


def test_noise_gives_no_rule():
    draw = np.random.default_rng(2)
    rows = {"x": draw.random(2000)}
    assert dl.learn(rows, draw.random(2000) < 0.1, np.arange(2000) % 3 == 0, ("x",)) == []
    assert dl.learn(rows, np.zeros(2000, bool), np.arange(2000) % 3 == 0, ("x",)) == []


def test_expression_is_the_list(spark):
    rules = [(dl.Condition("x", True, 0.5), dl.Condition("y", False, 0.2)), (dl.Condition("y", True, 0.9),)]
    rows = [(x / 4, y / 10) for x in range(5) for y in range(11)]
    got = spark.createDataFrame(rows, "x double, y double").withColumn("r", dl.verdict(rules)).collect()
    for x, y, r in got:
        assert r == (1 if x > 0.5 and y <= 0.2 else 2 if y > 0.9 else 0)


def test_rows_and_labels(spark):
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(TEXTS)] + [(1, "", True), (None, "k " * 20, True)], "doc_id long, text string, kept boolean")
    labels = spark.createDataFrame([(1, 0), (None, 1), (3, None), (99, 0)], "doc_id long, quality int")
    got = dl.judge(docs, labels).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        if r["doc_id"] is not None:
            n, *_, repeated = plain(TEXTS[r["doc_id"]])
            assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
    assert dl.judge(docs.limit(0), labels.limit(0)).count() == 0


def test_labels_are_learned(spark):
    folder = f"{DATA}/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = {r["doc_id"]: r for r in dl.op8_decision_list(spark, folder).collect()}
    low = [got[d]["kept"] for d, q in labels.items() if q == 0]
    high = [got[d]["kept"] or got[d]["base_failed"] for d, q in labels.items() if q == 1]
    assert sum(low) <= 0.1 * len(low) and sum(high) >= 0.98 * len(high)
