"""Targets, flow and seeded selection against plain Python."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from caresift.llm import mixing


def resharing(sizes, weights, share=1.5, most=2):
    """The rule as it is told: share by weight, stop what is above, share the rest again."""
    total, fixed = share * sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        weight = sum(weights[i] for i in free)
        rest = total - sum(fixed.values())
        now = {i: rest * weights[i] / weight for i in free}
        above = [i for i in free if now[i] > most * sizes[i]]
        if not above:
            return [{**now, **fixed}[i] for i in range(len(sizes))]
        fixed.update({i: most * sizes[i] for i in above})


def test_targets():
    draw = random.Random(3)
    for _ in range(200):
        sizes = [draw.choice([0, 1, 5, 100, 10_000]) for _ in range(draw.randrange(1, 9))]
        weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
        assert mixing.targets(sizes, weights) == pytest.approx(resharing(sizes, weights))
    assert mixing.targets([], []) == []


def test_flow_is_cheapest():
    draw = random.Random(5)
    for _ in range(60):
        kinds = [("a",), ("b",), ("a", "b"), ("a", "b", "c")][: draw.randrange(1, 5)]
        patterns = {k: draw.randrange(0, 4) for k in kinds}
        quotas = {s: draw.randrange(0, 5) for s in "abc"}
        given = mixing.allocate(patterns, quotas, 2)
        sent = Counter(s for k, g in given.items() for s, n in g for _ in range(n))
        assert all(sent[s] <= quotas[s] for s in quotas)
        used = {k: sum(n for _, n in g) for k, g in given.items()}
        assert all(used[k] <= 2 * patterns[k] for k in kinds)
        best = best_plan(patterns, quotas)
        assert (sum(used.values()), sum(max(0, used[k] - patterns[k]) for k in kinds)) == best


def best_plan(patterns, quotas):
    """Most words, then fewest repeated, over all plans."""
    kinds, best = list(patterns), (0, 0)
    for totals in itertools.product(*[range(2 * patterns[k] + 1) for k in kinds]):
        score = (sum(totals), sum(max(0, t - patterns[k]) for t, k in zip(totals, kinds)))
        if (score[0], -score[1]) > (best[0], -best[1]) and fits(dict(zip(kinds, totals)), quotas):
            best = score
    return best


def fits(totals, quotas):
    """Hall's condition: what any set of patterns sends finds room in the sources they reach."""
    kinds = [k for k in totals if totals[k]]
    return all(
        sum(totals[k] for k in some) <= sum(quotas[s] for s in set().union(*some))
        for n in range(1, len(kinds) + 1)
        for some in itertools.combinations(kinds, n)
    )


ROWS = [
    (1, "a b c d", ["x"], "p"),
    (2, "one two", ["x", "y"], "p"),
    (2, "one two", ["x", "y"], "p"),
    (3, None, ["y"], "p"),
    (4, "w " * 50, [None], "p"),
    (None, "u v", ["y", None], "p"),
    (5, "lost", None, "p"),
    (6, "lost too", [], "p"),
]
SCHEMA = "doc_id long, text string, sources array<string>, pattern string"


def test_rows_keep_their_place(spark):
    got = mixing.mix(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ROWS)
    assert all(0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"] == len(r["by_source"]) * r["size"] for r in got)
    assert {r["doc_id"]: r["taken"] for r in got if r["doc_id"] in (3, 5, 6)} == {3: 0, 5: 0, 6: 0}
    for r in got:
        assert set(r["by_source"]) <= {m["source"] for m in r["memberships"]}
    again = mixing.mix(spark.createDataFrame(ROWS, SCHEMA).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_hot_source_comes_near_its_target(spark):
    draw = random.Random(7)
    rows = [(i, "w " * draw.randrange(1, 40), ["hot" if i % 3 == 0 else f"s{i % 11}"], "") for i in range(6000)]
    taken, target, size = defaultdict(int), {}, {}
    for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect():
        home = r["memberships"][0]
        taken[home["source"]] += r["taken"]
        target[home["source"]], size[home["source"]] = home["target"], home["size"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_order_is_the_seeded_one(spark):
    """One source: copies by hand, along the order of the digests."""
    rows = [(i, "w " * (1 + i % 5), ["x"], "") for i in range(40)]
    sizes = {i: len(re.findall(r"\S+", t)) for i, t, *_ in rows}
    got = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()}
    total, before, want = sum(sizes.values()), 0, {}
    for i in sorted(sizes, key=lambda i: int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:15], 16)):
        cut = int(1.5 * total + 0.5)
        want[i] = sum(2 * (again * total + before) + sizes[i] <= 2 * cut for again in (0, 1))
        before += sizes[i]
    assert got == want


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_the_copies_taken(spark):
    draw = random.Random(9)
    rows = [(i, "w " * draw.randrange(0, 9), draw.choice([["x"], ["x", "y"], ["y"], [None]]), f"p{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    got = mixing.repeated(docs, mixing.F.col("sources"))
    assert got.columns == docs.columns
    kept = got.collect()
    assert Counter(r["doc_id"] for r in kept) == want
    assert all(r["pattern"] == f"p{r['doc_id']}" for r in kept)
