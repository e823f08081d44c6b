"""Fingerprints and classes against brute force."""

import numpy as np
import pytest
import xxhash
from tests.conftest import DATA

from caresift.llm import simhash_vp
from caresift.llm.components import connected


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_classes(fps, bits=2):
    """Smallest position of the class of every position."""
    labels = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and labels[i] != labels[j]:
                low, high = sorted((labels[i], labels[j]))
                labels = [low if x == high else x for x in labels]
    return labels


TEXTS = [None, "", " \t\n", "one", "One", "two words", "A b c \x1c D e", "ÄÖ ab CD ef gh", "x " * 30_000, "X " * 30_001, "the quick brown fox jumps"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash_vp.simhash(simhash_vp.shingle_hashes(text)) == plain_fingerprint(text)


def drawn(seed, centres=40, dense=60):
    draw = np.random.default_rng(seed)
    out = draw.integers(0, 2**64, centres, dtype=np.uint64).tolist()
    for c in out[:4]:
        for _ in range(dense):
            x = c
            for b in draw.choice(64, int(draw.integers(0, 6)), replace=False):
                x ^= 1 << int(b)
            out.append(x)
    return np.unique(np.array(out, np.uint64))


@pytest.mark.parametrize("bits", [0, 1, 2, 4])
@pytest.mark.parametrize("leaf", [4, 32, 5000])
def test_shard_classes(bits, leaf):
    fps = drawn(bits)
    got = simhash_vp.shard_classes(fps, np.ones(len(fps), bool), bits, leaf)
    assert got.tolist() == plain_classes(fps.tolist(), bits)


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_every_close_pair_meets_where_one_lives(shards):
    fps = drawn(9)
    tree = simhash_vp.Tree(fps[::3], shards)
    homes, pairs = np.zeros(len(fps), int), set()
    for _, at, home in tree.route(fps, 2):
        homes[at[home]] += 1
        for i, h in zip(at.tolist(), home.tolist()):
            pairs.update((min(i, j), max(i, j)) for j in at.tolist() if h)
    assert (homes == 1).all()
    close = {(i, j) for j in range(len(fps)) for i in range(j) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 2}
    assert close and close <= pairs


def test_links_over_many_shards(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(simhash_vp, "SHARD_SIZE", 16)
    fps = drawn(11)
    signed = fps.view(np.int64).tolist()
    distinct = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["u"]: r["v"] for r in connected(simhash_vp.fingerprint_links(distinct)).collect()}
    names = plain_classes(fps.tolist())
    groups = {}
    for x, n in zip(signed, names):
        groups.setdefault(n, []).append(x)
    assert roots == {x: min(g) for g in groups.values() for x in g if x != min(g)}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (2000, 2001), (2001, 2000)], "u long, v long")
    got = {r["u"]: r["v"] for r in connected(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 300)}, 2001: 2000}
    assert connected(edges.limit(0)).count() == 0


def expected(rows):
    """Classes of whole texts by plain comparison of all fingerprints."""
    fps = [plain_fingerprint(t) for _, t in rows]
    names = plain_classes(fps)
    first = {}
    for (doc_id, _), n in zip(rows, names):
        if doc_id is not None:
            first[n] = min(first.get(n, doc_id), doc_id)
    return sorted(((d, f"{f:016x}", first.get(n)) for (d, _), f, n in zip(rows, fps, names)), key=repr)


def test_query_rows(spark):
    rows = [(20 - i, t) for i, t in enumerate(TEXTS)] + [(3, TEXTS[-1]), (3, TEXTS[-1]), (None, "two words"), (None, "alone with no id here")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, component_id string")
    got = [tuple(r) for r in simhash_vp.near_duplicates(docs).collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_query_on_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in simhash_vp.op9_simhash_vp(spark, f"{DATA}/sf0.001").collect()]
    assert sorted(got, key=repr) == expected(rows)


def test_empty_table(spark):
    assert simhash_vp.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
