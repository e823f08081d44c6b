"""Divergence of sources against plain Python, whole tables and odd rows."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import DATA

from caresift.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value int, rank int"


def plain(rows, least=10, ranks=10):
    """The whole audit by its formulas, over every term."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        text, lang, source = text or "", lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups.add((lang, source))
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        names = [s for k, s in groups if k == lang]
        v = len(kept)

        def shares(count):
            size = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (size + 2 * v) for t in kept}

        total = sum((counts[lang, s] for s in names), Counter())
        q, p = shares(total), {s: shares(counts[lang, s]) for s in names}

        def far(x, y):
            return (x - y) ** 2 // (x + y)

        for s in names:
            pairs = [(b, sum(far(p[s][t], p[b][t]) for t in kept)) for b in names if b != s]
            terms = [(t, far(p[s][t], q[t])) for t in kept if counts[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, ranks)):
                ordered = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ordered)]
    return sorted(out)


def test_whole_table_against_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in divergence.audit(docs).collect())
    assert got == plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()])


def odd(spark):
    common = "Été naïve WORD word x_y z9z a-b 日本"
    rows = [(k, f"{common} only{'abcdefgh'[k % 8]}", "en", f"s{k % 3}") for k in range(40)]
    rows += [(k, common, None, None) for k in range(12)] + [(None, common, None, "")] * 3
    rows += [(100, None, "de", "t"), (101, "", "de", "u"), (102, "12 34 !", "de", None), (103, "einmal", "fr", "s0")]
    rows += [(104, "tief " * 300_000 + "Berg", "en", "s1"), (105, "ab" * 700_000, "en", "s1")]
    rows = [(*r, "term", 1, 2, 3) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("least", [1, 10])
def test_odd_rows(spark, least):
    docs = odd(spark)
    got = sorted(tuple(r) for r in divergence.audit(docs, least).collect())
    assert got == plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()], least)


def test_empty_table(spark):
    assert divergence.audit(odd(spark).limit(0)).count() == 0


def test_equal_values_are_ranked_by_item(spark):
    rows = [(0, " ".join(f"w{c}" for c in "qwertzuiopasdfg"), "en", "a", "", 0, 0, 0)] * 10 + [(1, "other", "en", "b", "", 0, 0, 0)] * 20
    docs = spark.createDataFrame(rows, SCHEMA)
    found = divergence.audit(docs).where("source = 'a' AND part = 'term'").orderBy("rank").collect()
    assert [r["item"] for r in found] == sorted(f"w{c}" for c in "qwertzuiopasdfg")[:10]
    assert len({r["value"] for r in found}) == 1


def test_sums_by_stripes_and_blocks(spark, monkeypatch):
    rows = [(k, " ".join(f"{'abcdefghij'[(k * 7 + i) % 10]}{'xyz'[i % 3]}" for i in range(k % 9)), "en", f"s{k % 11}", "", 0, 0, 0) for k in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = divergence.kept_counts(docs, 1)
    groups = divergence.group_sizes(docs, kept)
    sizes = {(r["lang"], r["source"]): r for r in groups.collect()}
    names = sorted(s for _, s in sizes)
    v = sizes["en", names[0]]["terms"]
    by_term = defaultdict(dict)
    for r in kept.collect():
        by_term[r["term"]][r["source"]] = 1 + 1_000_000_000 * (r["n"] + 2) // (sizes["en", r["source"]]["size"] + 2 * v)
    zero = {s: 1 + 1_000_000_000 * 2 // (sizes["en", s]["size"] + 2 * v) for s in names}
    want = {
        (a, b): sum((by_term[t].get(a, zero[a]) - by_term[t].get(b, zero[b])) ** 2 // (by_term[t].get(a, zero[a]) + by_term[t].get(b, zero[b])) for t in by_term)
        for a in names
        for b in names
        if a != b
    }
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 24)
    got = {}
    for stripe, width in ((0, 4), (1, 4), (2, 4)):
        monkeypatch.setattr(divergence, "STRIPE", width)
        sums = divergence._Sums(stripe)
        sums.add(np.array([None] * len(names), object), np.array(names, object), np.array([zero[s] for s in names]))
        flat = [(t, s, p) for t in sorted(by_term) for s, p in sorted(by_term[t].items())]
        for a in range(0, len(flat), 5):
            t, s, p = zip(*flat[a : a + 5])
            sums.add(np.array(t, object), np.array(s, object), np.array(p))
        a, b, value = sums.result()
        got |= {(names[x], names[y]): int(z) for x, y, z in zip(a, b, value)}
    assert got == want
    assert {(r["source"], r["item"]): r["value"] for r in divergence.pair_sums(kept, groups).collect()} == want


def test_long_texts_are_cut_between_terms():
    text = ("ab é " * 400_000 + "x" * 2_500_000 + " end").encode()
    found = Counter(t for part in divergence.terms(text) for t in part)
    assert found == Counter({b"ab": 400_000, "é".encode(): 400_000, b"x" * 2_500_000: 1, b"end": 1})


def test_large_counts_stay_exact(spark):
    row = spark.range(1).selectExpr("9000000000000000000L AS n", "9100000000000000000L AS size", "1000000000L AS terms")
    p = row.select(divergence.share_of("n", "size", "terms").alias("p")).first()["p"]
    assert p == 1 + 1_000_000_000 * (9_000_000_000_000_000_002) // (9_100_000_000_000_000_000 + 2_000_000_000)
    far = spark.range(1).select(F.lit(1_000_000_001).cast("long").alias("p"), F.lit(1).cast("long").alias("q"))
    assert far.select(divergence.distance("p", "q").alias("v")).first()["v"] == 10**18 // 1_000_000_002
