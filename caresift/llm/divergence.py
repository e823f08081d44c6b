"""Source divergence audit by count-cell ranking.

How far a source's use of words is from that of the other sources and of its language. What a term contributes depends on two
counts only: its own in the source and in the language. Terms are therefore grouped by that pair of counts, the contribution is
computed once per cell, cells are ranked by how many terms the better ones hold, equal values are merged, and only the cells that
reach the wanted ranks are spelled out as terms.

Words are counted in tasks, a source's terms never meet in one place, and the sums over all kept terms of two sources are
made in blocks of terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.session import checked_broadcast, materialize

#: Documents of a language a term must be in, and ranks that the term part reports.
LEAST_DOCS, RANKS = 10, 10
#: Shares are whole numbers of this many parts.
PARTS = 1_000_000_000
TERM = re.compile(rb"[a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^a-z\x80-\xff]")
#: Distinct terms a task holds before it hands its counts on, and bytes of one text that are split at once.
HELD_TERMS, PIECE_BYTES = 300_000, 1 << 20
#: Counts that one task of the pair sums is given; sources whose sums one task makes; cells of a block of shares.
ROWS_PER_TASK, STRIPE, BLOCK_CELLS = 200_000, 1024, 1 << 19


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, A-Z lower-cased, in portions: runs of letters and of characters beyond ASCII."""
    text = (text or b"").lower()
    begin = 0
    while len(text) - begin > PIECE_BYTES:
        cut = NO_TERM.search(text, begin + PIECE_BYTES)
        end = cut.start() if cut else len(text)
        yield TERM.findall(text, begin, end)
        begin = end
    yield TERM.findall(text, begin)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term, counted in tasks and added up."""
    import pyarrow as pa

    def table(held: dict) -> pa.RecordBatch:
        langs, sources, found, n, docs_ = [], [], [], [], []
        for (lang, source), (count, docs_of) in held.items():
            langs += [lang] * len(count)
            sources += [source] * len(count)
            found += count.keys()
            n += count.values()
            docs_ += map(docs_of.__getitem__, count)
        columns = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(found, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(n, pa.int64()), pa.array(docs_, pa.int64())], names=["lang", "source", "term", "n", "docs"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for k, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                count, docs_of = held.setdefault(group, (Counter(), Counter()))
                seen: set[bytes] = set()
                for part in terms(texts[k].as_py()):
                    count.update(part)
                    seen.update(part)
                docs_of.update(seen)
                if k % 64 == 63 and sum(len(c) for c, _ in held.values()) > HELD_TERMS:
                    yield table(held)
                    held = {}
        if held:
            yield table(held)

    found = _named(docs).mapInArrow(work, "lang string, source string, term string, n long, docs long")
    # tasks have added up already; one exchange serves these sums and those over the sources of a term
    found = found.repartition("lang", "term")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(docs: DataFrame) -> DataFrame:
    rows = narrow(docs, lang="lang", source="source", text="text")
    return rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def share_of(count: str, size: str, kept: str) -> Column:
    """The smoothed share of a count, in whole parts: 1 + floor(PARTS * (count + 2) / (size + 2 * kept)), exactly."""
    number = f"(CAST({count} AS DECIMAL(20,0)) + 2) * CAST({PARTS} AS DECIMAL(10,0))"
    return F.expr(f"1 + ({number}) DIV (CAST({size} AS DECIMAL(20,0)) + 2 * CAST({kept} AS DECIMAL(19,0)))")


def distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / (p + q)) of two shares; at most PARTS^2 on the way, which a long holds."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def kept_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(lang, source, term, n, total, first): counts of the terms in at least ``least_docs`` documents of their language.

    ``total`` is the count in the language; ``first`` marks one row of every (lang, term). Stored.
    """
    whole = W.partitionBy("lang", "term")
    counted = term_counts(docs).withColumns(
        {"total": F.sum("n").over(whole), "in_lang": F.sum("docs").over(whole), "first": F.min("source").over(whole) == F.col("source")}
    )
    return materialize(counted.where(F.col("in_lang") >= least_docs).drop("docs", "in_lang"), "audit-kept")


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, size, lang_size, terms) of every occurring group, with or without kept terms. Stored."""
    groups = _named(docs).select("lang", "source").distinct()
    by_group = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.sum(F.when(F.col("first"), F.col("total"))).alias("tot"), F.sum(F.col("first").cast("long")).alias("firsts")
    )
    joined = groups.join(by_group, ["lang", "source"], "left")
    lang = W.partitionBy("lang")
    sizes = {"lang_size": F.coalesce(F.sum("tot").over(lang), F.lit(0)), "terms": F.coalesce(F.sum("firsts").over(lang), F.lit(0))}
    return materialize(joined.withColumns(sizes).withColumn("size", F.coalesce("size", F.lit(0))).drop("tot", "firsts"), "audit-groups")


def leading_terms(kept: DataFrame, groups: DataFrame, ranks: int = RANKS) -> DataFrame:
    """(lang, source, item, value, rank) of the terms a group uses more than its language, the first ``ranks`` of each group.

    Ranked by cells: (group count, language count) cells get their value once; the best ``ranks`` different values of a group
    hold all ranks there are; those whose better values hold fewer terms than ``ranks`` are spelled out, smallest terms first.
    """
    cells = kept.groupBy("lang", "source", "n", "total").agg(F.count(F.lit(1)).alias("many"))
    sized = cells.join(checked_broadcast(groups), ["lang", "source"])
    shares = sized.withColumns({"p": share_of("n", "size", "terms"), "q": share_of("total", "lang_size", "terms")})
    cells = shares.where("p > q").select("lang", "source", "n", "total", "many", distance("p", "q").alias("value"))
    cells = materialize(cells, "audit-cells")
    group = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("many").alias("many"))
    best = values.withColumn("place", F.row_number().over(group)).where(F.col("place") <= ranks)
    before = F.coalesce(F.sum("many").over(group.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    wanted = best.withColumn("before", before).where(F.col("before") < ranks).drop("many", "place")
    spelled = checked_broadcast(cells.join(wanted, ["lang", "source", "value"]).drop("many"))
    rows = kept.select("lang", "source", "term", "n", "total").join(spelled, ["lang", "source", "n", "total"])
    inside = F.row_number().over(W.partitionBy("lang", "source", "value", "before").orderBy("term"))
    placed = rows.withColumn("inside", inside).where(F.col("inside") <= ranks)
    ranked = placed.withColumn("rank", (F.col("before") + F.col("inside")).cast("int")).where(F.col("rank") <= ranks)
    return ranked.select("lang", "source", F.col("term").alias("item"), "value", "rank")


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the distance of every two sources of a language, summed over all its kept terms.

    Every task gets some of the terms of a language with all their counts, and ahead of them the language's sources and the
    share of a term that a source lacks. It sums in blocks and hands on one number a pair. Beyond STRIPE sources in a
    language a task sums for a stripe of them only.
    """
    import pyarrow as pa

    widest = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    stripes = max(1, math.ceil(widest / STRIPE))
    tasks = max(1, math.ceil(kept.count() * stripes / ROWS_PER_TASK))
    of = groups.where("terms > 0")
    none = of.withColumn("none", F.lit(0))
    heads = none.select("lang", "source", F.lit(None).cast("string").alias("term"), share_of("none", "size", "terms").alias("p"))
    heads = heads.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    rows = kept.join(checked_broadcast(of), ["lang", "source"]).select("lang", "source", "term", share_of("n", "size", "terms").alias("p"))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("lang", "term"), F.lit(tasks)).cast("int"))
    both = heads.unionByName(rows).withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    dealt = both.repartition(tasks, "slot").sortWithinPartitions("slot", "stripe", "lang", F.asc_nulls_first("term"), "source")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, stripe, lang), parts in _runs(batches):
            sums = _Sums(stripe)
            for term, source, p in parts:
                sums.add(term, source, p)
            a, b, value = sums.result()
            names = np.array(sums.sources, object)
            columns = [pa.array([lang] * len(a), pa.string()), pa.array(names[a], pa.string()), pa.array(names[b], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])

    columns = dealt.select("slot", "stripe", "lang", "term", "source", "p")
    found = columns.mapInArrow(work, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _runs(batches) -> Iterator[tuple[tuple, Iterator]]:
    """(key, parts) of every run of equal (slot, stripe, lang) in sorted batches; a part is (terms, sources, shares) of one batch."""
    import itertools

    def cut():
        for batch in batches:
            slot, stripe = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            lang, term, source = (np.array(batch.column(k).to_pylist(), object) for k in (2, 3, 4))
            p = batch.column(5).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((slot[1:] != slot[:-1]) | (stripe[1:] != stripe[:-1]) | (lang[1:] != lang[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(slot)]):
                if a < b:
                    yield (int(slot[a]), int(stripe[a]), lang[a]), (term[a:b], source[a:b], p[a:b])

    for key, parts in itertools.groupby(cut(), key=lambda x: x[0]):
        yield key, (part for _, part in parts)


class _Sums:
    """The sums of one language's pairs (a, b), a in one stripe of its sources, over the terms of one task."""

    def __init__(self, stripe: int):
        self.stripe, self.sources, self.zero = stripe, [], []
        self.place: dict[str, int] = {}
        self.held: list[tuple] = []
        self.last, self.columns = None, 0
        self.total = None

    def add(self, term: np.ndarray, source: np.ndarray, p: np.ndarray) -> None:
        heads = int(np.count_nonzero(term == None))  # noqa: E711 - an array of objects
        for name, share in zip(source[:heads], p[:heads].tolist()):
            self.place[name] = len(self.sources)
            self.sources.append(name)
            self.zero.append(share)
        if heads == len(term):
            return
        term, at = term[heads:], np.fromiter(map(self.place.__getitem__, source[heads:]), np.int64, len(term) - heads)
        fresh = np.append(term[0] != self.last, term[1:] != term[:-1])
        column = self.columns - 1 + np.cumsum(fresh)
        self.last, self.columns = term[-1], int(column[-1]) + 1
        self.held.append((at, column, p[heads:]))
        if self.columns * len(self.sources) > BLOCK_CELLS:
            self._flush(keep=True)

    def _flush(self, keep: bool) -> None:
        """Sums the terms held; with ``keep`` the last one waits for more of its counts."""
        if not self.held:
            return
        at, column, p = map(np.concatenate, zip(*self.held))
        n = len(self.sources)
        first, end = self.stripe * STRIPE, min(n, (self.stripe + 1) * STRIPE)
        if self.total is None:
            self.total = np.zeros((max(0, end - first), n), np.int64)
        done = self.columns - int(keep)
        step = max(1, BLOCK_CELLS // max(1, n))
        for a in range(0, done, step):
            b = min(done, a + step)
            inside = (column >= a) & (column < b)
            shares = np.repeat(np.array(self.zero, np.int64)[:, None], b - a, axis=1)
            shares[at[inside], column[inside] - a] = p[inside]
            for k in range(first, end):
                apart, sum_ = shares - shares[k], shares + shares[k]
                self.total[k - first] += (apart * apart // sum_).sum(axis=1)
        left = column >= done
        self.held = [(at[left], column[left] - done, p[left])] if left.any() else []
        self.columns -= done

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self._flush(keep=False)
        if self.total is None:
            return np.empty(0, int), np.empty(0, int), np.empty(0, np.int64)
        a, b = np.nonzero(np.arange(len(self.sources))[None, :] != np.arange(len(self.total))[:, None] + self.stripe * STRIPE)
        return a + self.stripe * STRIPE, b, self.total[a, b]


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) of ``docs`` (text, lang, source; other columns are ignored).

    Null text, lang and source are read as ''. Part ``pair`` has each other source of the language, part ``term`` the terms used
    more than in the language, to ``ranks``. Rank by value, largest first, then item by UTF-8 order. A language without kept
    terms has pairs of value 0. Repeated rows count each for itself; an empty table gives an empty result.
    """
    kept = kept_counts(docs, least_docs)
    groups = group_sizes(docs, kept)
    bare = groups.where("terms = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("item"))
    apart = bare.join(others, "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    pairs = pair_sums(kept, groups).unionByName(apart)
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    found = pairs.unionByName(leading_terms(kept, groups, ranks).withColumn("part", F.lit("term")))
    return found.select("lang", "source", "part", "item", "value", "rank")


def op13_divergence(spark, sf_dir: str) -> DataFrame:
    """How every source differs from the others and from its language."""
    return audit(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    ), w AS (
        SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), t AS (
        SELECT lang, source, term, count(*)::BIGINT AS n, count(DISTINCT k)::BIGINT AS docs FROM w GROUP BY lang, source, term
    ), v AS (
        SELECT lang, term, sum(n)::BIGINT AS total FROM t GROUP BY lang, term HAVING sum(docs) >= 10
    ), kept AS (
        SELECT t.lang, t.source, t.term, t.n FROM t JOIN v ON t.lang = v.lang AND t.term = v.term
    ), langs AS (
        SELECT lang, count(*)::BIGINT AS vv, sum(total)::BIGINT AS nl FROM v GROUP BY lang
    ), own AS (
        SELECT lang, source, sum(n)::BIGINT AS ng FROM kept GROUP BY lang, source
    ), g AS (
        SELECT o.lang, o.source, coalesce(vv, 0) AS vv, coalesce(nl, 0) AS nl, coalesce(ng, 0) AS ng
        FROM (SELECT DISTINCT lang, source FROM d) o LEFT JOIN langs l ON o.lang = l.lang LEFT JOIN own w ON o.lang = w.lang AND o.source = w.source
    ), f AS (
        SELECT g.lang, g.source, v.term, coalesce(kept.n, 0) AS n, 1 + (1000000000 * (coalesce(kept.n, 0) + 2)) // (ng + 2 * vv) AS p,
            1 + (1000000000 * (total + 2)) // (nl + 2 * vv) AS q
        FROM g JOIN v ON g.lang = v.lang LEFT JOIN kept ON g.lang = kept.lang AND g.source = kept.source AND v.term = kept.term
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
        FROM f a JOIN f b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
        UNION ALL
        SELECT a.lang, a.source, b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source WHERE a.vv = 0
    ), both_parts AS (
        SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL
        SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM f WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM both_parts
    )
    SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
