"""SimHash near-duplicates found through vantage-point trees over Hamming distance.

Equal fingerprints are one node from the start. A tree of vantage points, fitted on a bounded sample, splits the
distinct fingerprints into shards: a node's ball holds what is at most ``radius`` (its median) away from the vantage
point. A fingerprint lives in one shard. Where the triangle inequality cannot rule out a
neighbour on the other side, it also visits that side, so every close pair meets in a shard where at
least one of the two lives. Inside a shard the same splitting goes on in numpy, down to small leaves that are compared in full.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.components import connected
from caresift.llm.tables import narrow, read
from caresift.session import materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2
#: Distinct fingerprints the top tree is fitted on, at most about this many.
SAMPLE = 200_000
#: Fingerprints a shard is meant to hold, and the most shards of the top tree.
SHARD_SIZE, MAX_SHARDS = 4096, 16_384
#: Inside a shard, splitting stops at this many fingerprints.
LEAF_SIZE = 1024
#: Rows to leave out whose 16-byte names are broadcast at most; beyond, the rows are shuffled to them once.
BROADCAST_NAMES = 2_000_000
#: Fingerprints of several shards that one task is given.
ROWS_PER_TASK = 32_768


def shingle_hashes(text: str | None, words_each: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of every shingle of the lower-cased (A-Z) words, repeats included."""
    import xxhash

    words = (text or "").encode().lower().split()
    if len(words) >= words_each:
        grams = map(b" ".join, zip(*(words[k:] for k in range(words_each))))
        n = len(words) - words_each + 1
    else:
        grams, n = iter([b" ".join(words)] if words else []), int(bool(words))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64, n)


def simhash(hashes: np.ndarray) -> int:
    """The 64-bit majority of ``hashes``: a bit is set if it is in over half of them; of none, zero."""
    counts = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[a : a + (1 << 14)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.add.reduce(np.unpackbits(part, axis=1, bitorder="little"), axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = SHINGLE_WORDS, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) and the long columns named in ``also`` of every whole text; fp is the fingerprint's bits as a signed long."""
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = [simhash(shingle_hashes(texts[i].as_py(), words_each)) for i in range(batch.num_rows)]
            signed = np.array(fps, np.uint64).view(np.int64)
            others = [batch.column(k) for k in range(2, batch.num_columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed), *others], names=["doc_id", "fp", *also])

    rows = narrow(docs, doc_id="doc_id", text="text", **{c: c for c in also}).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, "doc_id long, fp long" + "".join(f", {c} long" for c in also))


class Tree:
    """A vantage-point tree as arrays; node k has children 2k+1 (the ball) and 2k+2 (the rest)."""

    def __init__(self, sample: np.ndarray, shards: int, seed: int = SEED):
        self.points: dict[int, tuple[int, int]] = {}
        self.shards: dict[int, int] = {}
        self._grow(0, sample, shards, np.random.default_rng(seed))

    def _grow(self, node: int, sample: np.ndarray, shards: int, rng) -> None:
        split = vantage(sample, rng) if shards > 1 else None
        if split is None:
            self.shards[node] = len(self.shards)
            return
        point, radius, distance = split
        self.points[node] = (point, radius)
        inside = distance <= radius
        near = min(shards - 1, max(1, round(shards * inside.mean())))
        self._grow(2 * node + 1, sample[inside], near, rng)
        self._grow(2 * node + 2, sample[~inside], shards - near, rng)

    def route(self, fps: np.ndarray, max_bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, positions, whether they live there) of every shard that some of ``fps`` live in or visit."""
        todo = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
        while todo:
            node, at, home = todo.pop()
            if not len(at):
                continue
            if node in self.shards:
                yield self.shards[node], at, home
                continue
            point, radius = self.points[node]
            ball, rest = sides(np.bitwise_count(fps[at] ^ np.uint64(point)), radius, home, max_bits)
            for child, (picked, lives) in ((2 * node + 1, ball), (2 * node + 2, rest)):
                todo.append((child, at[picked], lives))


def vantage(fps: np.ndarray, rng, tries: int = 8) -> tuple[int, int, np.ndarray] | None:
    """Of a few random members the one whose distances spread widest, its median distance, all distances."""
    best = None
    for point in rng.choice(fps, min(tries, len(fps)), replace=False) if len(fps) else ():
        distance = np.bitwise_count(fps ^ point).astype(np.int64)
        spread = distance.var()
        if best is None or spread > best[0]:
            best = (spread, int(point), distance)
    if best is None:
        return None
    radius = int(np.median(best[2]))
    radius -= int(radius >= best[2].max())
    return (best[1], radius, best[2]) if (best[2] <= radius).any() else None


def sides(distance: np.ndarray, radius: int, home: np.ndarray, max_bits: int):
    """Who goes into the ball and who outside it: (positions, lives there) of each side.

    A resident of the outside visits the ball if its distance allows a neighbour there; the pairs over the
    border are thus found once. A visitor goes wherever a resident could be close.
    """
    distance = distance.astype(np.int64)
    inside = distance <= radius
    ball = np.flatnonzero(distance <= radius + max_bits)
    rest = np.flatnonzero(np.where(home, ~inside, distance > radius - max_bits))
    return (ball, (home & inside)[ball]), (rest, home[rest])


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of a[i] and b[i], in place; a class is named by its smallest position."""
    while True:
        x, y = labels[a], labels[b]
        open_ = x != y
        if not open_.any():
            return
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def shard_classes(fps: np.ndarray, home: np.ndarray, max_bits: int, leaf: int = LEAF_SIZE) -> np.ndarray:
    """For every position the smallest position of its class, by the links with at least one resident."""
    labels = np.arange(len(fps))
    rng = np.random.default_rng(SEED)
    todo = [(labels.copy(), home)]
    while todo:
        at, lives = todo.pop()
        if not lives.any() or len(at) < 2:
            continue
        split = vantage(fps[at[lives]], rng) if len(at) > leaf else None
        if split is not None:
            point, radius, _ = split
            parts = sides(np.bitwise_count(fps[at] ^ np.uint64(point)), radius, lives, max_bits)
            if max(len(p) for p, _ in parts) < 0.95 * len(at):
                todo += [(at[picked], own) for picked, own in parts]
                continue
        residents = at[lives]
        for a in range(0, len(residents), 256):
            block = residents[a : a + 256]
            x, y = np.nonzero(np.bitwise_count(fps[block][:, None] ^ fps[at][None, :]) <= max_bits)
            join_labels(labels, block[x], at[y])
    return labels


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE) -> DataFrame:
    """(u, v): every close fingerprint u and the smallest v of its class in some shard.

    ``distinct`` is a stored table of distinct fp. Linked in chains over all shards, these are the classes of
    all pairs that differ in at most ``max_bits`` bits.
    """
    import pyarrow as pa

    count = distinct.count()
    every = max(1, math.ceil(count / sample))
    picked = distinct.where(F.pmod(F.xxhash64(F.col("fp"), F.lit(1)), F.lit(every)) == 0)
    fitted = np.array([r[0] for r in picked.select("fp").collect()], np.int64).view(np.uint64)
    fitted.sort()
    tree = Tree(fitted, min(MAX_SHARDS, max(1, math.ceil(count / SHARD_SIZE))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for shard, at, home in tree.route(fps, max_bits):
                columns = [pa.array(np.full(len(at), shard)), pa.array(fps[at].view(np.int64)), pa.array(home)]
                yield pa.RecordBatch.from_arrays(columns, names=["shard", "fp", "home"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps, home in _by_shard(batches):
            order = np.argsort(fps)
            fps, home = fps[order], home[order]
            labels = shard_classes(fps.view(np.uint64), home, max_bits)
            linked = np.flatnonzero(labels != np.arange(len(fps)))
            columns = [pa.array(fps[linked]), pa.array(fps[labels[linked]])]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    placed = materialize(distinct.select("fp").mapInArrow(place, "shard long, fp long, home boolean"), "vp-placed")
    tasks = max(1, math.ceil(placed.count() / ROWS_PER_TASK))
    return placed.repartition(tasks, "shard").sortWithinPartitions("shard").mapInArrow(link, "u long, v long")


def _by_shard(batches) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(fp, home) of one shard at a time from batches sorted by shard."""
    held, parts = None, []
    for batch in batches:
        shard, fp, home = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        edges = np.flatnonzero(np.diff(shard)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shard)]):
            if a == b:
                continue
            if shard[a] != held and parts:
                yield tuple(map(np.concatenate, zip(*parts)))
                parts = []
            held = shard[a]
            parts.append((fp[a:b], home[a:b].astype(bool)))
    if parts:
        yield tuple(map(np.concatenate, zip(*parts)))


def fingerprint_classes(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(class_fp, root, component_id) of every fingerprint in the stored table ``fps`` (doc_id, fp).

    ``root`` names the class of linked fingerprints, ``component_id`` is its smallest doc_id. Stored.
    """
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected(fingerprint_links(distinct, max_bits))
    rooted = distinct.join(roots, F.col("fp") == F.col("u"), "left").select(
        "fp", "first_id", F.coalesce("v", "fp").alias("root")
    )
    rooted = materialize(rooted, "simhash-rooted")
    named = materialize(rooted.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id")), "simhash-named")
    return materialize(
        rooted.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("class_fp"), "root", "component_id"),
        "simhash-classes",
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text; other columns ignored).

    A null or wordless text has fingerprint zero and is linked like any other. ``component_id`` is the smallest doc_id
    in the class of linked texts, null ids left aside (null only where the whole class has none). Repeated rows
    give repeated rows. Texts may be of any length; an empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, words_each), "simhash")
    joined = fps.join(fingerprint_classes(fps, max_bits), F.col("fp") == F.col("class_fp"))
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, words_each: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs``, with all its columns, of every class of linked texts: that with the smallest doc_id.

    Rows are told apart by their contents, not their ids: of rows that share an id, or have none (they come last), the
    smallest 128-bit hash of all columns decides, and of rows equal in all columns one stays. So an id that stands on two
    different texts loses neither, and copies without an id are still copies.
    """
    columns = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind]
    marked = [x for c in columns for x in (F.isnull(c), c)]
    row = ["row__a", "row__b"]
    keyed = docs.withColumns({"row__a": F.xxhash64(*marked), "row__b": F.xxhash64(F.lit(1), *marked)})
    fps = materialize(fingerprints(keyed, words_each, tuple(row)), "simhash")
    classed = fps.join(fingerprint_classes(fps, max_bits), F.col("fp") == F.col("class_fp"))
    members = classed.groupBy("root", *row).agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    members = materialize(members, "simhash-members")
    first = F.min(F.struct(F.isnull("id").alias("none"), "id", *row))
    best = members.groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    apart = (F.col("first.row__a") != F.col("row__a")) | (F.col("first.row__b") != F.col("row__b"))
    dropped = materialize(members.join(best, "root").where(apart).select(*row).distinct(), "simhash-dropped")
    few = dropped.count() <= BROADCAST_NAMES
    left = keyed.join(F.broadcast(dropped) if few else dropped, row, "left_anti")
    again = materialize(members.where("n > 1").select(*row).distinct().join(dropped, row, "left_anti"), "simhash-again")
    if not again.isEmpty():
        left = left.join(again, row, "left_anti").unionByName(left.join(again, row, "left_semi").dropDuplicates(row))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def op9_simhash_vp(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document."""
    return near_duplicates(read(spark, sf_dir, "documents"))
