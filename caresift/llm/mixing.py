"""Mixing overlapping sources to target weights as a minimum-cost flow.

Documents are counted by the set of sources they belong to (their pattern). A flow sends the words of
patterns to the quotas of sources: a pattern offers its words once at no cost, a second time at cost 1,
a third at cost 2 and so on, so repetition is convex and spread before it is deepened. The flow is solved on patterns and sources,
never on documents. Documents then follow it in a seeded order: each pattern's order, gone through once for each repetition,
is one long line of words, and the flow cuts that line into the shares of the sources.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresift.llm.tables import read
from caresift.session import materialize

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Words to take over all sources, as a share of all words; the most often a document may be taken.
SHARE, MAX_REPEAT = 1.5, 2
SEED = "mix-1"
WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int], share: float = SHARE, most: int = MAX_REPEAT) -> list[float]:
    """Quotas by weight, none above ``most`` times its source; what is cut off is shared out again by weight.

    Sources fill up in the order of room per weight, so the level at which the rest shares out is found
    in one pass. All zero if there are no words.
    """
    order = sorted(range(len(sizes)), key=lambda i: (most * sizes[i] / weights[i], i))
    left_words, left_weight = share * sum(sizes), sum(weights)
    out, level = [0.0] * len(sizes), math.inf
    for i in order:
        if level == math.inf and left_words / left_weight * weights[i] < most * sizes[i]:
            level = left_words / left_weight
        out[i] = min(float(most * sizes[i]), level * weights[i])
        left_words -= most * sizes[i]
        left_weight -= weights[i]
    return out


class Flow:
    """Minimum-cost flow by successive cheapest paths, with whole capacities and costs."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = [[] for _ in range(nodes)]
        self.head: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def add(self, tail: int, head: int, room: int, cost: int) -> int:
        for a, b, r, c in ((tail, head, room, cost), (head, tail, 0, -cost)):
            self.arcs[a].append(len(self.head))
            self.head.append(b)
            self.room.append(r)
            self.cost.append(c)
        return len(self.head) - 2

    def solve(self, source: int, sink: int) -> int:
        """Sends as much as fits; the flow on an arc is then the room of its twin."""
        potential = [0] * len(self.arcs)
        sent = 0
        while True:
            distance, by = {source: 0}, {}
            heap = [(0, source)]
            while heap:
                d, node = heapq.heappop(heap)
                if d > distance[node]:
                    continue
                for arc in self.arcs[node]:
                    if self.room[arc] > 0:
                        reach = d + self.cost[arc] + potential[node] - potential[self.head[arc]]
                        if reach < distance.get(self.head[arc], math.inf):
                            distance[self.head[arc]] = reach
                            by[self.head[arc]] = arc
                            heapq.heappush(heap, (reach, self.head[arc]))
            if sink not in distance:
                return sent
            furthest = max(distance.values())
            for node in range(len(potential)):
                potential[node] += distance.get(node, furthest)
            path, node = [], sink
            while node != source:
                path.append(by[node])
                node = self.head[by[node] ^ 1]
            push = min(self.room[arc] for arc in path)
            for arc in path:
                self.room[arc] -= push
                self.room[arc ^ 1] += push
            sent += push


def allocate(
    patterns: Mapping[tuple, int], quotas: Mapping, most: int = MAX_REPEAT
) -> dict[tuple, list[tuple[object, int]]]:
    """For every pattern the (source, words) it gives, by the cheapest flow into the quotas."""
    names, kinds = list(quotas), list(patterns)
    place = {s: 2 + len(kinds) + i for i, s in enumerate(names)}
    flow, gives = Flow(2 + len(kinds) + len(names)), {}
    for i, kind in enumerate(kinds):
        for again in range(most):
            flow.add(0, 2 + i, patterns[kind], again)
        gives[kind] = [(s, flow.add(2 + i, place[s], most * patterns[kind], 0)) for s in kind if s in place]
    for s in names:
        flow.add(place[s], 1, int(math.floor(quotas[s] + 0.5)), 0)
    flow.solve(0, 1)
    return {k: [(s, flow.room[arc ^ 1]) for s, arc in arcs] for k, arcs in gives.items()}


def _positions(sized: DataFrame) -> DataFrame:
    """Adds ``before``: the words of the pattern's documents that come earlier in the seeded order.

    The order is cut into about as many cells as a cell holds rows, so neither the sums over the cells of one
    pattern nor the rows of one cell outgrow a task.
    """
    count = sized.count()
    cells = 1 << max(0, math.ceil(math.log2(max(1, count)) / 2))
    celled = sized.withColumn("cell", F.floor(F.col("draw") / F.lit((1 << 60) // cells)))
    own = celled.groupBy("pattern", "cell").agg(F.sum("size").alias("cell_size"))
    earlier = Window.partitionBy("pattern").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    own = own.select(
        F.col("pattern").alias("p"), F.col("cell").alias("c"), F.coalesce(F.sum("cell_size").over(earlier), F.lit(0)).alias("base")
    )
    inside = Window.partitionBy("pattern", "cell").orderBy("draw", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    numbered = celled.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = numbered.join(own, (F.col("pattern") == F.col("p")) & (F.col("cell") == F.col("c")))
    return joined.withColumn("before", F.col("base") + F.col("inner")).drop("p", "c", "base", "inner", "cell")


NULL_SOURCE = "~"


def _marked(sources):
    """Sources as one text: a mark before each, as null entries cannot be compared."""
    names = F.transform(F.array_distinct(sources), lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit(NULL_SOURCE)))
    return F.coalesce(F.array_join(F.array_sort(names), "\x01"), F.lit(""))


def _draw(seed: str):
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _sized(sources: Column, seed: str) -> list[Column]:
    """Of every document its size, its pattern and its place in the seeded order."""
    return [word_count().alias("size"), _marked(sources).alias("pattern"), _draw(seed).alias("draw")]


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MAX_REPEAT, seed: str = SEED
) -> DataFrame:
    """(doc_id, size, memberships, copies, taken, by_source) for every row of ``docs`` (doc_id, text, sources).

    ``sources`` is the array of sources a document belongs to; a null entry is a source of its own, named last. ``size`` counts
    words, a null text has none. ``memberships`` has each source with its size and target, ``copies`` is how often the mix takes the
    document (0 to ``most``), ``taken`` the words this makes, ``by_source`` for which source each copy is taken. A document without words or without
    sources is taken no times. Repeated rows are separate documents, null ids are allowed; an empty table gives an empty result.
    Weights go by the order of the source names, repeating. One row per pattern comes to the driver.
    """
    taken = _taken(docs, F.col("sources"), weights, share, most, seed)
    return taken.select("doc_id", "size", "memberships", "copies", "taken", "by_source")


def _taken(docs: DataFrame, sources: Column, weights: Sequence[int], share: float, most: int, seed: str) -> DataFrame:
    """The rows of ``mix`` with their pattern and place in the order."""
    sized = materialize(docs.select("doc_id", *_sized(sources, seed)), "mix-sizes")
    patterns = {r["pattern"]: r["size"] for r in sized.groupBy("pattern").agg(F.sum("size").alias("size")).collect()}
    kinds = {p: tuple(p.split("\x01")) if p else () for p in patterns}
    totals: dict[str, int] = {}
    for p, members in kinds.items():
        for s in members:
            totals[s] = totals.get(s, 0) + patterns[p]
    names = sorted(totals, key=lambda s: (s == NULL_SOURCE, s))
    wanted = targets([totals[s] for s in names], [weights[i % len(weights)] for i in range(len(names))], share, most)
    quotas = dict(zip(names, wanted))
    given = allocate({kinds[p]: n for p, n in patterns.items()}, quotas, most)

    def label(s: str) -> str | None:
        return None if s == NULL_SOURCE else s[1:]

    plan = []
    for p, members in kinds.items():
        gives = [(s, n) for s, n in given[members] if n]
        cuts = [(label(s), sum(n for _, n in gives[: i + 1])) for i, (s, _) in enumerate(gives)]
        plan.append((p, patterns[p], cuts, [(label(s), totals[s], quotas[s]) for s in members]))
    table = docs.sparkSession.createDataFrame(
        plan,
        "p string, words long, cuts array<struct<source: string, until: long>>, "
        "memberships array<struct<source: string, size: long, target: double>>",
    )

    def cuts_after(copy):
        """The cuts behind the middle of a copy on the pattern's line of words; it belongs to the first of them."""
        middle = 2 * ((copy - 1) * F.col("words") + F.col("before")) + F.col("size")
        return F.filter("cuts", lambda c: middle <= 2 * c["until"])

    goes = F.filter(F.transform(F.sequence(F.lit(1), F.lit(most)), cuts_after), lambda x: F.size(x) > 0)
    none = F.array().cast("array<string>")
    by_source = F.when(F.col("size") > 0, F.transform(goes, lambda x: x[0]["source"])).otherwise(none)
    placed = _positions(sized).join(table, F.col("pattern") == F.col("p")).withColumn("by_source", by_source)
    copies = F.size("by_source")
    return placed.withColumns({"copies": copies, "taken": F.col("size") * copies})


def repeated(
    docs: DataFrame, sources: Column, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MAX_REPEAT, seed: str = SEED
) -> DataFrame:
    """The rows of ``docs`` (doc_id, text and any more), each as often as the mix of its ``sources`` (an array) takes it.

    What a pass over a pattern takes is a beginning of the seeded order, so the last document it takes decides
    for all: one row per pattern meets the documents, and no text is moved. Rows equal in id and size share a place in the
    order and are taken alike.
    """
    place = F.struct("draw", "doc_id", "size")
    chosen = _taken(docs, sources, weights, share, most, seed).where("copies > 0")
    lasts = [F.max(F.when(F.col("copies") >= r, place)).alias(f"last__{r}") for r in range(1, most + 1)]
    lasts = materialize(chosen.groupBy(F.col("pattern").alias("last__pattern")).agg(*lasts), "mix-lasts")
    keyed = docs.withColumns(dict(zip(("mix__size", "mix__pattern", "mix__draw"), _sized(sources, seed))))
    own = F.struct(F.col("mix__draw").alias("draw"), F.col("doc_id"), F.col("mix__size").alias("size"))
    passes = [F.coalesce((own <= F.col(f"last__{r}")).cast("int"), F.lit(0)) for r in range(1, most + 1)]
    copies = F.when(F.col("mix__size") > 0, sum(passes)).otherwise(0)
    joined = keyed.join(lasts, F.col("mix__pattern") == F.col("last__pattern")).withColumn("mix__copies", copies)
    again = joined.where("mix__copies > 0").withColumn("mix__again", F.explode(F.sequence(F.lit(1), F.col("mix__copies"))))
    return again.select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words the mix takes of it."""
    docs = read(spark, sf_dir, "documents").withColumn("sources", F.array("source"))
    home = F.col("memberships")[0]
    return mix(docs).select("doc_id", "size", home["size"].alias("source_size"), home["target"].alias("target"), "taken")


OP5_SQL = r"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
            ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS draw
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            [2, 3, 1][(row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) % 3 + 1)::INT] AS weight
        FROM sized GROUP BY source
    ), ranked AS (
        SELECT *, row_number() OVER (ORDER BY 2 * source_size / weight, source COLLATE "C" NULLS LAST) AS place FROM sources
    ), levels AS (
        SELECT a.*, (1.5 * (SELECT sum(source_size) FROM sources)::DOUBLE
                - 2 * coalesce((SELECT sum(b.source_size) FROM ranked b WHERE b.place < a.place), 0))
            / (SELECT sum(b.weight) FROM ranked b WHERE b.place >= a.place) AS level
        FROM ranked a
    ), found AS (
        SELECT arg_min(level, place) AS level FROM levels WHERE level * weight < 2 * source_size
    ), quotas AS (
        SELECT r.source, source_size, least(2.0::DOUBLE * source_size, coalesce(level, 'inf'::DOUBLE) * weight) AS target
        FROM ranked r, found
    ), lines AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized
    )
    SELECT doc_id, size, source_size, target,
        (size * ((2 * before + size <= 2 * floor(target + 0.5))::INT
            + (2 * (source_size + before) + size <= 2 * floor(target + 0.5))::INT))::BIGINT AS taken
    FROM lines l JOIN quotas q ON l.source IS NOT DISTINCT FROM q.source
"""
