"""Near copies by the Jaccard similarity of word shingles, found exactly by prefix filtering.

Two sets with similarity 4/5 or more share a member among the first n - ceil(4n/5) + 1 of each, whatever order all
members are put in. So only these are joined; the order puts shingles seen often in a sample last, which
changes the work, not the result. Candidates that size and a bitmap cannot rule out are compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.components import connected
from caresift.llm.simhash_vp import shingle_hashes
from caresift.llm.tables import narrow
from caresift.session import materialize

WORDS_EACH = 5
#: Rows the order of shingles is learned from, at most about this many, and how many of the frequent ones it puts last.
SAMPLE, FREQUENT = 20_000, 100_000
#: Rows of the sample that hold a frequent shingle, at least.
OFTEN = 4
#: Slots of the bit table that tells tasks whose sets are needed.
SLOTS = 1 << 22
BITMAP = [f"bits{k}" for k in range(4)]


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a whole text, sorted."""
    return np.unique(shingle_hashes(text, WORDS_EACH))


def node_of(shingles: np.ndarray) -> int:
    """One number for equal sets."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.astype("<u8").tobytes())).view(np.int64))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """256 parities: two maps differ in at most as many bits as the sets differ in members."""
    odd = np.bincount((shingles >> np.uint64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def prefix(shingles: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The members of a set that one of its near copies must share; ``frequent`` is sorted, ``ranks`` its order."""
    n = len(shingles)
    most = n - (4 * n + 4) // 5 + 1 if n else 0
    if not len(frequent):
        return shingles[:most]
    place = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    rank = np.where(frequent[place] == shingles, ranks[place], 0)
    return shingles[np.lexsort((shingles, rank))[:most]]


def _frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py()).view(np.int64))], names=["token"])

    every = max(1, math.ceil(docs.count() / SAMPLE))
    sample = docs.select("text").where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    counts = sample.mapInArrow(work, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN)
    rows = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()
    tokens = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], np.array([r[1] for r in rows], np.int64)[order]


def _sets(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(node, shingles) of the rows whose node is in ``needed``, and of few others: only a bit table of the nodes goes to the tasks."""
    import pyarrow as pa

    slots = needed.select((F.col("needed").bitwiseAND(F.lit(SLOTS - 1))).cast("int").alias("slot")).distinct().toArrow()
    wanted = np.zeros(SLOTS, bool)
    wanted[slots.column(0).to_numpy()] = True
    packed = np.packbits(wanted)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                found = shingle_set(text.as_py())
                slot = (node := node_of(found)) & (SLOTS - 1)
                if not packed[slot >> 3] >> (7 - (slot & 7)) & 1:
                    continue
                columns = [pa.array([node], pa.int64()), pa.array([found.view(np.int64)], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "shingles"])

    return docs.select("text").mapInArrow(work, "node long, shingles array<long>")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, node, size, bitmap, tokens) of every row; equal shingle sets are one node."""
    import pyarrow as pa

    frequent, ranks = _frequent(docs)
    names = ["doc_id", "node", "size", *BITMAP, "tokens"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, maps, tokens = [], [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py())
                nodes.append(node_of(found))
                sizes.append(len(found))
                maps.append(bitmap(found))
                tokens.append(prefix(found, frequent, ranks).view(np.int64))
            bits = np.array(maps, np.int64).reshape(-1, 4)
            columns = [batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *(pa.array(bits[:, k]) for k in range(4))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens, pa.list_(pa.int64()))], names=names)

    schema = f"doc_id long, node long, size long, {', '.join(f'{b} long' for b in BITMAP)}, tokens array<long>"
    return docs.mapInArrow(work, schema)


def _possible(a: str, b: str):
    """Whether size and bitmap of two nodes allow a similarity of 4/5."""
    differ = sum((F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in BITMAP), F.lit(0))
    x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
    return (5 * F.least(x, y) >= 4 * F.greatest(x, y)) & (9 * differ <= x + y)


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those (u, v) of stored ``pairs`` whose shingle sets have similarity 4/5 or more."""
    needed = materialize(pairs.select(F.col("u").alias("needed")).union(pairs.select("v")).distinct(), "jaccard-needed")
    sets = _sets(docs, needed).join(needed, F.col("node") == F.col("needed"), "left_semi").dropDuplicates(["node"])
    sets = materialize(sets, "jaccard-sets")
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "u").join(right, "v").where(9 * shared >= 4 * (F.size("x") + F.size("y")))
    return materialize(both.select("u", "v"), "jaccard-links")


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) of every row of ``docs`` (doc_id, text; other columns ignored).

    Linked are texts whose shingle sets have a Jaccard similarity of 4/5 or more; of fewer than five words the whole is the one shingle, and
    null or wordless texts are alike. ``component_id`` is the smallest doc_id in the class of linked texts, null ids
    left aside (null only where the whole class has none).
    """
    docs = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = materialize(signatures(docs), "jaccard-signatures")
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("first_id"), *[F.min(c).alias(c) for c in ("size", *BITMAP)])
    nodes = materialize(nodes, "jaccard-nodes")
    sketch = nodes.drop("first_id")
    # the rows of tokens that several nodes hold, beside the smallest of these
    least = rows.select(F.explode("tokens").alias("token"), "node").groupBy("token").agg(F.min("node").alias("leader"), F.max("node").alias("last"))
    several = materialize(least.where("leader <> last").select(F.col("token").alias("t"), "leader"), "jaccard-several")
    held = rows.select(F.explode("tokens").alias("token"), "node").join(several, F.col("token") == F.col("t"))
    held = materialize(held.select("token", "node", "leader").distinct(), "jaccard-held")
    # first to the smallest node of a token, so that a large group of copies is linked by few pairs
    star = held.where("node <> leader").select(F.col("node").alias("u"), F.col("leader").alias("v")).distinct()
    star = star.join(sketch.alias("a"), F.col("u") == F.col("a.node")).join(sketch.alias("b"), F.col("v") == F.col("b.node"))
    links = _verified(materialize(star.where(_possible("a", "b")).select("u", "v"), "jaccard-pairs"), docs)
    roots = materialize(connected(links).select(F.col("u").alias("r"), F.col("v").alias("root")), "jaccard-roots")
    # then what the stars left apart: all pairs of a token that are not in one class yet
    named = held.join(roots, F.col("node") == F.col("r"), "left").select("token", "node", F.coalesce("root", "node").alias("root"))
    named = materialize(named, "jaccard-named")
    mixed = named.groupBy(F.col("token").alias("t")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    open_ = named.join(materialize(mixed.select("t"), "jaccard-mixed"), F.col("token") == F.col("t"), "left_semi")
    open_ = materialize(open_.join(sketch.withColumnRenamed("node", "n"), F.col("node") == F.col("n")).drop("n"), "jaccard-open")
    apart = (F.col("a.token") == F.col("b.token")) & (F.col("a.node") > F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    pairs = open_.alias("a").join(open_.alias("b"), apart & _possible("a", "b"))
    pairs = pairs.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    links = links.unionByName(_verified(materialize(pairs, "jaccard-pairs"), docs))
    roots = materialize(connected(links).select(F.col("u").alias("r"), F.col("v").alias("root")), "jaccard-roots")
    rooted = nodes.join(roots, F.col("node") == F.col("r"), "left").select("node", "first_id", F.coalesce("root", "node").alias("root"))
    rooted = materialize(rooted, "jaccard-rooted")
    named = rooted.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    named = materialize(named, "jaccard-classes")
    classes = rooted.join(named, F.col("root") == F.col("r")).select(F.col("node").alias("n"), "component_id")
    return rows.select("doc_id", "node").join(materialize(classes, "jaccard-components"), F.col("node") == F.col("n")).select("doc_id", "component_id")
