"""The prefix trie against plain Python: drawn conversations, bands and shards of few turns, odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caresift.llm import prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n long, x string, ends int"


def plain_trie(paths: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    """The nodes by definition."""
    members, children, ends = defaultdict(set), defaultdict(set), defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
            if d:
                children[tuple(path[: d - 1])].add(tuple(path[:d]))
        ends[tuple(path)].append(c)

    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += own
    rows = []
    for node, inside in members.items():
        done = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(inside), len(node), parent, len(inside), len(children[node]), leaves[node], saved[node], hashlib.sha256(done.encode()).hexdigest()))
    return sorted(rows, key=repr)


def plain_paths(rows) -> dict[int, list[tuple[str, str]]]:
    """Turns in order by conversation; ties by the digest of role and text."""
    held = defaultdict(list)
    for c, turn, role, text in rows:
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
        if c is not None:
            held[c].append(((turn is not None, turn or 0), digest[:32], (role, text)))
    return {c: [t[2] for t in sorted(turns)] for c, turns in held.items()}


def plain_rebuilt(paths):
    out = {}
    for c, path in paths.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = paths.get(c - c % 5, [])[:h] + path[h:]
    return out


def digests(found, local):
    named = found.join(trie.end_digests(local), ["kx", "ky"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    rows = named.select(*columns, F.coalesce("ends_sha256", F.lit(empty))).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def drawn(seed, n=120, longest=9):
    """Conversations that share heads of every length, whole copies among them."""
    draw = random.Random(seed)
    rows, paths = [], []
    for c in range(n):
        old = draw.choice(paths) if paths and draw.random() < 0.8 else []
        path = old[: draw.randint(0, len(old))] + [(draw.choice(["user", "system"]), draw.choice("abcé")) for _ in range(draw.randint(0, longest))]
        path = draw.choice(paths) if paths and draw.random() < 0.15 else path or [("user", "a")]
        paths.append(path)
        rows += [(3 * c - 50, k if k else None, *turn) for k, turn in enumerate(path)]
    draw.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 4) for r in rows], SCHEMA)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize(("seed", "band", "shard"), [(2, 1, 8), (3, 3, 16)])
def test_nodes_of_drawn_conversations(spark, monkeypatch, seed, band, shard):
    monkeypatch.setattr(trie, "SHARD_TURNS", shard)
    rows = drawn(seed)
    local = trie.local_nodes(*trie.numbered(frame(spark, rows)), band)
    assert digests(trie.trie(local), local) == plain_trie(plain_paths(rows))


def test_rebuilt_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 40)
    rows = drawn(6, 150, 4)
    local = trie.local_nodes(*trie.rebuilt(*trie.numbered(frame(spark, rows))), 4)
    assert digests(trie.trie(local), local) == plain_trie(plain_rebuilt(plain_paths(rows)))


def test_deep_copies_and_one_long_conversation(spark):
    deep = [("user", f"t{k}") for k in range(700)]
    rows = [(c, k, *turn) for c in range(5) for k, turn in enumerate(deep[: 700 - 100 * (c % 2)])]
    rows += [(7, k, "user", f"t{k}" if k < 300 else f"own {k}") for k in range(3000)]
    local = trie.local_nodes(*trie.numbered(frame(spark, rows)))
    assert digests(trie.trie(local), local) == plain_trie(plain_paths(rows))


def test_end_list_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 16)
    rows = [(c, 0, "user", "same") for c in range(300)]
    local = trie.local_nodes(*trie.numbered(frame(spark, rows)))
    assert local.where("ends IS NOT NULL").count() > 10
    got = trie.end_digests(local).collect()
    assert [r["ends_sha256"] for r in got] == [hashlib.sha256(",".join(map(str, range(300))).encode()).hexdigest()]


def test_odd_rows_and_real_outputs(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 0, "user", ""), (2, 0, "us", "er"), (3, 0, "user", ""), (3, 0, "us", "er")]
    rows += [(None, 0, "user", "lost"), (4, 1, "user", "é" * 1_000_000), (5, 1, "user", "é" * 1_000_000), (5, 2, "user", None)]
    df = frame(spark, rows)
    local = trie.local_nodes(*trie.numbered(df))
    assert digests(trie.trie(local), local) == plain_trie(plain_paths(rows))
    found = {(r["conv_id"], r["depth"]): r for r in trie.prefix_trie(df).collect()}
    assert (found[4, 1]["role"], found[4, 1]["text"], found[4, 1]["saved_tokens"]) == ("user", "é" * 1_000_000, 2_000_000)
    assert found[4, 1]["ends"] == ["4"] and found[5, 2]["text"] == "" and found[1, 0]["text"] is None
    assert found[1, 0]["n_convs"] == 5 and found[1, 0]["ends"] == []


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(df).count() == 0
    only_null = frame(spark, [(None, 0, "user", "a")])
    local = trie.local_nodes(*trie.rebuilt(*trie.numbered(only_null)))
    assert trie.trie(local).count() == 0


def test_bits_and_members():
    import numpy as np

    places = np.array([0, 5, 63, 64, 1000])
    assert list(trie._members(trie._bits(places))) == places.tolist()
