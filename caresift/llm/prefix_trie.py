"""Prefix trie of conversations by vertical bitmaps.

A shard holds the conversations of a run of ids. Its index maps (position, turn) to the bitset of the conversations that have that
turn there. Depth first, the bitset of a node is intersected with the postings of the next position: every non-empty result is a
child, its bits are its members, and those that are over at that depth are its end list. Very long conversations are
cut into bands of positions, each with an index of its own that starts from the prefixes reached there.

Nodes of different shards are one node if their prefixes are equal. A prefix is named by 128 bits: the exclusive or over its
positions of a hash of the position and the turn's digest, so that a band knows the names it starts from without the turns
before it. Sums over subtrees are made for shared prefixes only, by doubling the distance to the ancestor that a node reports to.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.operators.ordering import with_row_index
from caresift.session import materialize

#: Turns whose conversations make a shard, about, and positions that one index covers.
SHARD_TURNS, BAND = 8192, 256
#: Turns that one task is given.
ROWS_PER_TASK = 65_536
#: Turns a rebuilt conversation takes over at most, and conversations that share their head.
MOST_SHARED, FAMILY = 8, 5

LOCAL_SCHEMA = (
    "kx long, ky long, px long, py long, depth long, n long, conv_id long, size long, x long, y long, shard long, ends string"
)


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, x, y, size) of every turn with a conv_id: 128 bits of the SHA-256 of role and text, UTF-8 bytes of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = (F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for at in (1, 17))
    rows = narrow(conversations, conv_id="conv_id", turn="turn", role="role", text="text").where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("long"), "turn", *[h.alias(n) for h, n in zip(half, "xy")], F.octet_length(text).cast("long").alias("size"))


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, convs): turns (conv_id, pos, n, shard, x, y, size) with positions from 1, and (conv_id, n, shard).

    Turns go by ``turn``, nulls first, ties by the digest of role and text. The whole table is sorted by ranges, so a
    conversation of any length is numbered by many tasks; a shard is a run of conversations.
    """
    low = F.lit(-(1 << 63))
    order = ["conv_id", F.asc_nulls_first("turn"), F.col("x").bitwiseXOR(low), F.col("y").bitwiseXOR(low)]
    hashed = materialize(hashed_turns(conversations), "trie-hashed")
    placed = materialize(with_row_index(hashed, order, "place"), "trie-placed")
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    convs = materialize(convs.withColumn("shard", F.floor(F.col("first") / SHARD_TURNS).cast("long")), "trie-convs")
    turns = placed.join(convs, "conv_id").withColumn("pos", F.col("place") - F.col("first") + 1)
    return turns.select("conv_id", "pos", "n", "shard", "x", "y", "size"), convs.select("conv_id", "n", "shard")


def rebuilt(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that share heads, in the form of ``numbered``.

    Conversation c starts with the first h turns of conversation c - c % 5 (all if fewer, none if there is none), followed by
    its own turns after its first h; h is the unsigned crc32 of c in decimal, modulo 9.
    """
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST_SHARED + 1))
    plan = convs.withColumns({"base": base, "h": h})
    bases = convs.where(F.pmod("conv_id", F.lit(FAMILY)) == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = plan.withColumn("new_n", F.col("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    plan = materialize(plan.select("conv_id", "base", "h", "head", "new_n", "shard"), "trie-plan")
    own = turns.join(plan.select("conv_id", "h", "head", "new_n"), "conv_id").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).alias("pos"), F.col("new_n").alias("n"), "shard", "x", "y", "size")
    first = turns.where((F.pmod("conv_id", F.lit(FAMILY)) == 0) & (F.col("pos") <= MOST_SHARED))
    heads = first.select(F.col("conv_id").alias("base"), "pos", "x", "y", "size").join(plan, "base").where("pos <= h")
    heads = heads.select("conv_id", "pos", F.col("new_n").alias("n"), "shard", "x", "y", "size")
    return own.unionByName(heads), plan.select("conv_id", F.col("new_n").alias("n"), "shard")


def _indexed(turns: DataFrame, convs: DataFrame, band: int) -> DataFrame:
    """Turns and, at position band * k of every conversation that goes on there, a mark with the name of its prefix."""
    name = {f"k{c}": F.xxhash64("pos", "x", "y", F.lit(seed)) for seed, c in enumerate("xy", 1)}
    rows = turns.withColumns(name).withColumn("band", F.floor((F.col("pos") - 1) / band).cast("long"))
    nothing = F.lit(0).cast("long")
    columns = ["shard", "band", "conv_id", "pos", "n", "kx", "ky", "x", "y", "size"]
    start = convs.select("shard", "conv_id", "n", *[nothing.alias(c) for c in columns if c not in ("shard", "conv_id", "n")])
    whole = rows.where(F.col("n") > band).groupBy("shard", "conv_id", "n", "band").agg(F.bit_xor("kx").alias("kx"), F.bit_xor("ky").alias("ky"))
    along = W.partitionBy("shard", "conv_id").orderBy("band").rowsBetween(W.unboundedPreceding, W.currentRow)
    marks = whole.select(
        "shard", "conv_id", "n", F.bit_xor("kx").over(along).alias("kx"), F.bit_xor("ky").over(along).alias("ky"), (F.col("band") + 1).alias("band")
    )
    marks = marks.withColumn("pos", F.col("band") * band).where("pos < n")
    marks = marks.withColumns({c: nothing for c in ("x", "y", "size")})
    return rows.select(*columns).unionByName(start.select(*columns)).unionByName(marks.select(*columns))


def _bits(places: np.ndarray) -> int:
    out = 0
    for p in places.tolist():
        out |= 1 << p
    return out


def _members(bits: int) -> Iterator[int]:
    while bits:
        low = bits & -bits
        yield low.bit_length() - 1
        bits ^= low


class Shard:
    """The vertical index of one band of positions of one shard."""

    def __init__(self, start: int, band: int, conv: np.ndarray, pos: np.ndarray, n: np.ndarray, turns: list[np.ndarray]):
        self.start, self.end = start, start + band
        ids, place = np.unique(conv, return_inverse=True)
        self.ids = ids.tolist()
        self.over: dict[int, int] = {}
        for depth in np.unique(pos[pos == n]).tolist():
            self.over[depth] = _bits(place[(pos == n) & (pos == depth)])
        mark = pos == start
        self.roots: dict[tuple[int, int], int] = {}
        for p, kx, ky in zip(place[mark].tolist(), turns[0][mark].tolist(), turns[1][mark].tolist()):
            self.roots[kx, ky] = self.roots.get((kx, ky), 0) | 1 << p
        body = np.flatnonzero(~mark)
        kx, ky = turns[0][body], turns[1][body]
        order = np.lexsort((place[body], ky, kx, pos[body]))
        body, kx, ky = body[order], kx[order], ky[order]
        where = pos[body]
        fresh = np.append(True, (where[1:] != where[:-1]) | (kx[1:] != kx[:-1]) | (ky[1:] != ky[:-1]))[: len(body)]
        group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        self.postings = [_bits(x) for x in np.split(place[body], first[1:])] if len(body) else []
        self.turns = list(zip(*(t[body][first].tolist() for t in turns)))
        # the turn of conversation p at position q is at[begins[p] + q - start - 1]
        by_conv = np.lexsort((where, place[body]))
        self.at = group[by_conv].tolist()
        self.begins = np.searchsorted(place[body][by_conv], np.arange(len(ids))).tolist()

    def nodes(self) -> Iterator[tuple]:
        """(kx, ky, px, py, depth, members, smallest id, size, x, y, end list) of every node below the starting prefixes."""
        if self.start == 0:
            for bits in self.roots.values():
                yield (0, 0, None, None, 0, bits.bit_count(), self.ids[0], 0, None, None, self._ends(bits, 0))
        todo = [(bits, self.start, *name) for name, bits in self.roots.items()]
        while todo:
            bits, depth, px, py = todo.pop()
            left = bits & ~self.over.get(depth, 0) if depth < self.end else 0
            while left:
                lowest = (left & -left).bit_length() - 1
                turn = self.at[self.begins[lowest] + depth - self.start]
                child = left & self.postings[turn]
                left ^= child
                x, y, size, dx, dy = self.turns[turn]
                kx, ky = px ^ x, py ^ y
                yield kx, ky, px, py, depth + 1, child.bit_count(), self.ids[lowest], size, dx, dy, self._ends(child, depth + 1)
                todo.append((child, depth + 1, kx, ky))

    def _ends(self, bits: int, depth: int) -> str | None:
        bits &= self.over.get(depth, 0)
        return ",".join(str(self.ids[p]) for p in _members(bits)) if bits else None


def local_nodes(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """The nodes of every shard (``LOCAL_SCHEMA``), by its vertical index. Stored."""
    import pyarrow as pa

    rows = materialize(_indexed(turns, convs, band), "trie-rows")
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, math.ceil(rows.count() / ROWS_PER_TASK))
    dealt = rows.repartition(tasks, "shard", "band").sortWithinPartitions("shard", "band")
    schema = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in LOCAL_SCHEMA.split(", ")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, k, (conv, pos, n, kx, ky, x, y, size) in _units(batches):
            found = []
            for node in Shard(k * band, band, conv, pos, n, [kx, ky, size, x, y]).nodes():
                found.append((*node[:-1], shard, node[-1]))
                if len(found) == 16_384:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
                    found = []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return materialize(dealt.mapInArrow(work, LOCAL_SCHEMA), "trie-local")


def _units(batches) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(shard, band, columns) of one index at a time from batches sorted by both."""
    held, parts = None, []
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
        edges = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(columns[0])]):
            if a == b:
                continue
            key = int(columns[0][a]), int(columns[1][a])
            if key != held and parts:
                yield *held, [np.concatenate(c) for c in zip(*parts)]
                parts = []
            held = key
            parts.append([c[a:b] for c in columns[2:]])
    if parts:
        yield *held, [np.concatenate(c) for c in zip(*parts)]


def _subtrees(shared: DataFrame) -> DataFrame:
    """(kx, ky, leaves, saved) summed over subtrees, of (kx, ky, px, py, leaves, saved) with each node's own.

    After round k a node has the sums over its descendants less than 2^k levels below it, and reports to its ancestor 2^k levels
    above. Rounds grow with the logarithm of the depth.
    """
    state = materialize(shared.withColumnsRenamed({"px": "jx", "py": "jy"}), "trie-sums")
    while not state.where("jx IS NOT NULL").isEmpty():
        told = state.where("jx IS NOT NULL")
        more = told.groupBy(F.col("jx").alias("kx"), F.col("jy").alias("ky")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        up = state.select(F.col("kx").alias("jx"), F.col("ky").alias("jy"), F.col("jx").alias("ux"), F.col("jy").alias("uy"))
        next_ = state.join(more, ["kx", "ky"], "left").join(up.where("ux IS NOT NULL"), ["jx", "jy"], "left")
        state = materialize(
            next_.select(
                "kx",
                "ky",
                F.col("ux").alias("jx"),
                F.col("uy").alias("jy"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-sums",
        )
    return state.select("kx", "ky", "leaves", "saved")


def trie(local: DataFrame) -> DataFrame:
    """(kx, ky, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, x, y) of every node, from all shards'.

    ``kx, ky`` name the node, ``x, y`` are the digest of its last turn.
    """
    own = [F.max(c).alias(c) for c in ("px", "py", "depth", "size", "x", "y")]
    nodes = local.groupBy("kx", "ky").agg(F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), *own)
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("px IS NOT NULL").groupBy(F.col("px").alias("kx"), F.col("py").alias("ky"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"), F.sum((F.col("n") == 1).cast("long")).alias("single"))
    nodes = materialize(nodes.join(children, ["kx", "ky"], "left").fillna(0, ["n_children", "single"]), "trie-children")
    # a node of one conversation is a chain to one leaf and saves nothing; its parent counts it as that leaf
    leaf = (F.col("n_children") == 0).cast("long") + F.col("single")
    shared = nodes.where("n > 1").select("kx", "ky", "px", "py", leaf.alias("leaves"), ((F.col("n") - 1) * F.col("size")).alias("saved"))
    parents = nodes.where("n_children > 0").select(F.col("kx").alias("px"), F.col("ky").alias("py"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(_subtrees(shared), ["kx", "ky"], "left").join(parents, ["px", "py"], "left")
    return found.select(
        "kx",
        "ky",
        "conv_id",
        "depth",
        "parent_conv_id",
        F.col("n").alias("n_convs"),
        "n_children",
        F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
        "x",
        "y",
    )


def end_digests(local: DataFrame) -> DataFrame:
    """(kx, ky, ends_sha256) of the nodes at which conversations end: their ids ascending, comma-joined.

    Shards are runs of ids, so their lists follow each other; a list of any length is hashed piece by piece.
    """
    import pyarrow as pa

    names = ["kx", "ky", "ends_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            done = []
            for kx, ky, ends in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (kx, ky) != held:
                    if held is not None:
                        done.append((*held, digest.hexdigest()))
                    held, digest = (kx, ky), hashlib.sha256(ends.encode())
                else:
                    digest.update(b"," + ends.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*held, digest.hexdigest())], names=names)

    lists = local.where("ends IS NOT NULL").select("kx", "ky", "shard", "ends")
    dealt = lists.repartition("kx", "ky").sortWithinPartitions("kx", "ky", "shard").select("kx", "ky", "ends")
    return dealt.mapInArrow(work, "kx long, ky long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of whole conversations (conv_id, turn, role, text; other columns are ignored), a row for every node.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, role, text, ends): the smallest member, the node's level,
    its parent's smallest member, members, children, childless nodes below, bytes saved by keeping shared turns once, the last turn, and the ends
    as an array of lists of ids, one list for a shard. Null roles and texts are empty, rows without conv_id are left out, repeated rows
    are turns each. Without conversations there is no root.
    """
    turns, convs = numbered(conversations)
    local = local_nodes(turns, convs)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    hashed = narrow(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select("*", role.alias("r"), text.alias("t"))
    digest = F.sha2(F.concat(F.length("r").cast("string"), F.lit(":"), "r", "t"), 256)
    half = [F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(n) for at, n in ((1, "x"), (17, "y"))]
    texts = hashed.select(*half, "r", "t").groupBy("x", "y").agg(F.first("r").alias("role"), F.first("t").alias("text"))
    ends = local.where("ends IS NOT NULL").groupBy("kx", "ky").agg(F.sort_array(F.collect_list(F.struct("shard", "ends"))).alias("ends"))
    found = trie(local).join(texts, ["x", "y"], "left").join(ends, ["kx", "ky"], "left")
    return found.withColumn("ends", F.coalesce(F.col("ends.ends"), F.array().cast("array<string>"))).drop("kx", "ky", "x", "y")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' trie."""
    local = local_nodes(*rebuilt(*numbered(read(spark, sf_dir, "conversations"))))
    found = trie(local).join(end_digests(local), ["kx", "ky"], "left").drop("kx", "ky", "x", "y")
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))


OP11_SQL = """
    WITH RECURSIVE raw AS (
        SELECT conv_id, turn, sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
            strlen(coalesce(text, ''))::BIGINT AS size
        FROM conversations WHERE conv_id IS NOT NULL
    ), turns AS (
        SELECT conv_id, digest, size, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM raw
    ), crc AS (
        SELECT DISTINCT conv_id, conv_id::VARCHAR AS name, 0 AS k, 4294967295::BIGINT AS v FROM raw
        UNION ALL
        SELECT conv_id, name, k + 1, CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END
        FROM (SELECT *, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(name, (k // 8 + 1)::INT, 1))::BIGINT) ELSE v END AS u FROM crc) WHERE k < 8 * length(name)
    ), plan AS (
        SELECT conv_id, conv_id - ((conv_id % 5) + 5) % 5 AS base, xor(v, 4294967295) % 9 AS h FROM crc WHERE k = 8 * length(name)
    ), heads AS (
        SELECT p.conv_id, t.pos, t.digest, t.size FROM plan p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.h
    ), taken AS (
        SELECT conv_id, count(*) AS head FROM heads GROUP BY conv_id
    ), whole AS (
        SELECT * FROM heads
        UNION ALL
        SELECT t.conv_id, t.pos - p.h + coalesce(head, 0), digest, size
        FROM turns t JOIN plan p ON t.conv_id = p.conv_id LEFT JOIN taken k ON k.conv_id = t.conv_id WHERE t.pos > p.h
    ), prefixes AS (
        SELECT conv_id, 0::BIGINT AS depth, '' AS name, NULL::VARCHAR AS parent, 0::BIGINT AS size FROM plan
        UNION ALL
        SELECT conv_id, pos, sha256(string_agg(digest, '') OVER upto),
            CASE WHEN pos = 1 THEN '' ELSE sha256(string_agg(digest, '') OVER before) END, size
        FROM whole
        WINDOW upto AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
            before AS (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), nodes AS (
        SELECT name, max(parent) AS parent, max(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size
        FROM prefixes GROUP BY name
    ), children AS (
        SELECT parent AS name, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent
    ), known AS (
        SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.name = c.name
    ), sums AS (
        SELECT p.name, sum((k.n_children = 0)::INT) AS n_leaves, sum((k.n_convs - 1) * k.size) AS saved_tokens
        FROM known k JOIN prefixes p ON p.conv_id = k.conv_id AND p.depth <= k.depth GROUP BY p.name
    ), last_turns AS (
        SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id
    ), ends AS (
        SELECT p.name, sha256(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)) AS ends_sha256
        FROM prefixes p JOIN last_turns l ON p.conv_id = l.conv_id AND p.depth = l.depth GROUP BY p.name
    )
    SELECT k.conv_id, k.depth, parents.conv_id AS parent_conv_id, k.n_convs, k.n_children, n_leaves::BIGINT AS n_leaves,
        saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
    FROM known k JOIN sums s ON k.name = s.name LEFT JOIN ends e ON k.name = e.name LEFT JOIN known parents ON k.parent = parents.name
"""
