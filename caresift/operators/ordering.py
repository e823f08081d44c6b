"""Ordered computations that never put a whole group into one task.

Running sums, exact quantiles, row numbers and rank cuts are all built the same
way: cut the order into cells of bounded size, work inside the cells in
parallel, and carry the totals of earlier cells over as offsets. A group that
holds a third of all rows is therefore spread over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caresift.functions.draws import hash_cell, hashed
from caresift.session import checked_broadcast, materialize

#: Rows a cell of the order is meant to hold.
CELL_ROWS = 1_000_000
#: Rows of one tied score that are ranked together.
TIED_ROWS = 65_536
#: Rows of one cell that are sorted, and hex digits by which a level of counts cuts a cell.
CELL_SORTED, LEVEL_DIGITS = 100_000, 3

_COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


def join_groups(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right``'s row of its group; a null in ``by`` finds a null.

    The keys are compared as structs: those with equal nulls are equal, and the join stays a plain equi-join.
    """
    others = [F.col(f"`{c}`") for c in right.columns if c not in by]
    keyed = right.select(F.struct(*by).alias("right__key"), *others)
    joined = left.withColumn("left__key", F.struct(*by)).join(keyed, F.col("left__key") == F.col("right__key"))
    return joined.drop("left__key", "right__key")


def order_cuts(df: DataFrame, column: str, parts: int | None = None) -> list[float]:
    """Cut points that split the rows into about ``parts`` cells of equal size.

    Only the sketch quantiles (at most ``parts`` numbers) reach the driver. They
    steer the balance of the work, never the result.
    """
    if parts is None:
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / CELL_ROWS))
    if parts < 2:
        return []
    probabilities = [i / parts for i in range(1, parts)]
    values = df.select(F.col(column).cast("double").alias("v")).approxQuantile(
        "v", probabilities, 1.0 / (4 * parts)
    )
    return sorted({v for v in values if not math.isnan(v)})


def with_range_cell(df: DataFrame, column: str, cuts: Sequence[float], name: str = "cell") -> DataFrame:
    """Number the range cell of each value; values in one cell stay contiguous."""
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    return Bucketizer(
        splits=[-math.inf, *cuts, math.inf], inputCol=column, outputCol=name, handleInvalid="keep"
    ).transform(df)


def prefix_aggregates(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    aggregates: dict[str, tuple[str, str]],
    cell: str = "cell",
    descending: bool = False,
) -> DataFrame:
    """Running aggregates over ``order`` within ``by``, one row per (by, order).

    ``aggregates`` maps a name to (sum|min|max, column). Each gives three
    columns: ``name`` up to and with the row, ``name_before`` strictly before
    it, and ``name_total`` of the group. ``cell`` must rise with ``order``.
    A null in ``by`` is a group like any other.
    """
    # One exchange serves the rows and the cell totals, so ``df`` is computed once.
    # A struct of the keys is never null, and structs with equal nulls are equal.
    keys = ["group__key"] if by else []
    df = df.withColumn("group__key", F.struct(*by)) if by else df
    df = df.repartition(*keys, cell)
    arrow = F.desc if descending else F.asc
    inside = W.partitionBy(*keys, cell).orderBy(arrow(order))
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    before = inside.rowsBetween(W.unboundedPreceding, -1)
    local, totals, offsets = [], [], []
    across = W.partitionBy(*keys).orderBy(arrow(cell)).rowsBetween(W.unboundedPreceding, -1)
    for name, (kind, column) in aggregates.items():
        fn = _COMBINE[kind]
        local += [
            fn(column).over(upto).alias(f"{name}__in"),
            fn(column).over(before).alias(f"{name}__pre"),
        ]
        totals.append(fn(column).alias(f"{name}__cell"))
        offsets += [
            fn(f"{name}__cell").over(across).alias(f"{name}__offset"),
            fn(f"{name}__cell").over(W.partitionBy(*keys)).alias(f"{name}_total"),
        ]
    cells = df.groupBy(*keys, cell).agg(*totals).select(*keys, cell, *offsets)
    joined = df.select("*", *local).join(cells, [*keys, cell])
    out = [F.col(c) for c in df.columns if c not in (cell, *keys)]
    for name, (kind, _) in aggregates.items():
        inn, pre, off = F.col(f"{name}__in"), F.col(f"{name}__pre"), F.col(f"{name}__offset")
        if kind == "sum":
            zero = F.lit(0)
            upto_v, before_v = (
                F.coalesce(off, zero) + F.coalesce(inn, zero),
                F.coalesce(off, zero) + F.coalesce(pre, zero),
            )
        else:
            pick = F.least if kind == "min" else F.greatest
            upto_v, before_v = pick(off, inn), pick(off, pre)
        out += [upto_v.alias(name), before_v.alias(f"{name}_before"), F.col(f"{name}_total")]
    return joined.select(*out)


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    column: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group.

    Values are counted first, so copies collapse before any shuffle; the counts
    are then summed along the order and the two neighbours of every position
    are read off.
    """
    by = list(by)
    values = df.select(*by, F.col(column).cast("double").alias("value")).filter(
        F.col("value").isNotNull()
    )
    counted = values.groupBy(*by, "value").agg(F.count("*").alias("n"))
    if cuts is None:
        counted = materialize(counted, "value-counts")
        cuts = order_cuts(counted, "value")
    counted = with_range_cell(counted, "value", cuts)
    ranked = prefix_aggregates(counted, by, "value", {"upto": ("sum", "n")})
    picks, result = [], []
    for i, (p, name) in enumerate(zip(probabilities, names)):
        position = (F.col("upto_total") - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("upto_before") <= index) & (index < F.col("upto"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"{side}{i}"))
        share = (F.col("n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"lo{i}"), F.col(f"hi{i}")
        result.append((lo + (hi - lo) * (share - F.floor(share))).alias(name))
    merged = ranked.groupBy(*by).agg(F.max("upto_total").alias("n"), *picks)
    return merged.select(*by, *result)


def with_row_index(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """Number all rows along ``order`` without a single-task window.

    The rows are range-sorted and written once; a row's number is its place in
    its sorted partition plus the sizes of the partitions before it (one number
    per partition reaches the driver).
    """
    mark = "row__mark"
    stored = materialize(
        df.orderBy(*order).withColumn(mark, F.monotonically_increasing_id()), "row-index"
    )
    part = F.shiftright(F.col(mark), 33).cast("int")
    sizes = sorted(
        (r["p"], r["n"]) for r in stored.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()
    )
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    firsts = df.sparkSession.createDataFrame(offsets, "row__part int, row__first bigint")
    place = F.col(mark).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.withColumn("row__part", part)
        .join(F.broadcast(firsts), "row__part")
        .withColumn(name, F.col("row__first") + place + F.lit(start))
        .drop(mark, "row__part", "row__first")
    )


def order_key(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One text a row that sorts like ``order``, nulls first, then by a hash of the whole row; None for types it does not know.

    Texts become the hex digits of their bytes, whole numbers, dates and times fixed digits; a blank, below all digits, ends each.
    """
    kinds = dict(df.dtypes)
    parts = []
    for name in order:
        c, kind = F.col(f"`{name}`"), kinds[name]
        if kind == "string":
            digits = F.hex(F.encode(c, "utf-8"))
        elif kind in ("tinyint", "smallint", "int", "bigint", "date", "timestamp", "boolean"):
            number = F.unix_date(c) if kind == "date" else F.unix_micros(c) if kind == "timestamp" else c.cast("bigint")
            digits = F.lpad(F.hex(number.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        else:
            return None
        parts.append(F.coalesce(F.concat(F.lit("1"), digits), F.lit("0")))
    plain = [F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind]
    return F.concat_ws(" ", *parts, F.lpad(F.hex(F.xxhash64(*plain)), 16, "0"))


def rows_at(df: DataFrame, order: Sequence[str], start: int, stop: int, name: str, rows: int) -> DataFrame:
    """The rows at positions ``start`` to ``stop`` (0-based, without it) of ``order``, numbered in ``name``; ``rows`` is all there are.

    Nothing is sorted as a whole: rows are counted by the leading digits of an order-preserving key, the cells that
    hold the first and the last wanted position are counted again by more digits, until they are small enough to be
    sorted. A count brings at most one number per cell to the driver.
    """
    key = order_key(df, order)
    if key is None:
        numbered = with_row_index(df, order, name)
        return numbered.filter((F.col(name) >= start) & (F.col(name) < stop))
    stop = min(stop, rows)
    keyed = df.withColumn("order__key", key)
    if stop <= start:
        return df.limit(0).withColumn(name, F.lit(0).cast("bigint"))
    counted: dict[tuple[str, int], list] = {}

    def cells(within: str, digits: int) -> list:
        """(leading digits, rows, longest key) in order, of the rows whose key starts with ``within``."""
        if (within, digits) not in counted:
            inside = keyed.filter(F.col("order__key").startswith(within)).groupBy(F.substring("order__key", 1, digits).alias("lead"))
            found = inside.agg(F.count("*").alias("n"), F.max(F.length("order__key")).alias("longest"))
            counted[within, digits] = sorted(tuple(r) for r in found.collect())
        return counted[within, digits]

    def cell_of(position: int) -> tuple[str, int]:
        """(leading digits, rows before) of a cell of few rows that holds the position."""
        lead, before, size, longest, step = "", 0, rows, 1, LEVEL_DIGITS
        while size > CELL_SORTED and len(lead) < longest:
            found = cells(lead, len(lead) + step)
            # digits that all keys share are passed over faster and faster
            step = 2 * step if len(found) == 1 else LEVEL_DIGITS
            for part, n, long in found:
                if position < before + n:
                    lead, size, longest = part, n, long
                    break
                before += n
        return lead, before

    first, before = cell_of(start)
    last, _ = cell_of(stop - 1)
    inside = (F.substring("order__key", 1, len(first)) >= first) & (F.substring("order__key", 1, len(last)) <= last)
    numbered = keyed.filter(inside).withColumn("order__place", F.row_number().over(W.orderBy("order__key")))
    # the rank limit is taken in every task, so rows equal in all columns do not crowd the last one
    numbered = numbered.filter(F.col("order__place") <= stop - before)
    numbered = numbered.withColumn(name, (F.col("order__place") - 1 + F.lit(before)).cast("bigint"))
    return numbered.filter(F.col(name) >= start).drop("order__key", "order__place")


def rank_cuts(
    df: DataFrame,
    stratum: str,
    digest: str,
    targets: dict[str, Column],
    step: int = 3,
    sortable: int = 1_000_000,
) -> DataFrame:
    """For each stratum, the digest found at some ranks of the digest order.

    ``targets`` maps a name to a rank expression over ``n``, the stratum size
    (rank 0 gives an empty digest, below all others). Rows are counted per
    leading digits of the digest; the cells that hold a target rank are counted
    again with more digits until they are small enough to be sorted. No other
    row is ever moved.
    """

    def located(counted: DataFrame, parent: list[str], wanted: DataFrame | None) -> DataFrame:
        along = W.partitionBy(*parent).orderBy("sub").rowsBetween(W.unboundedPreceding, W.currentRow)
        running = counted.select(
            *parent,
            "sub",
            "rows",
            F.sum("rows").over(along).alias("upto"),
            F.sum("rows").over(W.partitionBy(*parent)).alias("n"),
        ).withColumn("before", F.col("upto") - F.col("rows"))
        if wanted is None:
            ranks = F.array(
                *[F.struct(F.lit(k).alias("cut"), v.cast("long").alias("place")) for k, v in targets.items()]
            )
            placed = running.select("*", F.explode(ranks).alias("w")).select("*", "w.cut", "w.place")
        else:
            placed = running.join(wanted.drop("rows"), parent)
        inside = (F.col("place") > F.col("before")) & (F.col("place") <= F.col("upto"))
        lowest = (F.col("place") == 0) & (F.col("before") == 0)
        return checked_broadcast(
            placed.filter(inside | lowest).select(
                stratum, F.col("sub").alias("cell"), "cut", (F.col("place") - F.col("before")).alias("place"), "rows"
            )
        )

    depth = step
    first = df.select(stratum, hash_cell(F.col(digest), depth).alias("sub"))
    hits = located(first.groupBy(stratum, "sub").agg(F.count("*").alias("rows")), [stratum], None)
    while depth + step <= 30 and (hits.agg(F.max("rows")).first()[0] or 0) > sortable:
        cells = hits.select(stratum, "cell").distinct()
        rows = df.select(
            stratum, hash_cell(F.col(digest), depth).alias("cell"), hash_cell(F.col(digest), depth + step).alias("sub")
        ).join(cells, [stratum, "cell"], "left_semi")
        counted = rows.groupBy(stratum, "cell", "sub").agg(F.count("*").alias("rows"))
        hits = located(counted, [stratum, "cell"], hits)
        depth += step
    inside = (
        df.select(stratum, digest, hash_cell(F.col(digest), depth).alias("cell"))
        .join(hits.select(stratum, "cell").distinct(), [stratum, "cell"], "left_semi")
        .withColumn("place", F.row_number().over(W.partitionBy(stratum, "cell").orderBy(digest)).cast("bigint"))
    )
    found = hits.join(inside, [stratum, "cell", "place"], "left").select(
        stratum, "cut", F.coalesce(F.col(digest), F.lit("")).alias("edge")
    )
    return found.groupBy(stratum).pivot("cut", list(targets)).agg(F.first("edge"))


def positions_by_score(
    df: DataFrame, score: str, key: str, positions: Sequence[int], cuts: Sequence[float] | None = None
) -> DataFrame:
    """Rows at the given 0-based positions of the order (score, digest of key).

    Nothing is sorted as a whole: counts per score locate the scores, counts per
    digest cell locate the cells inside a tied score, and only those cells are
    ranked. Intermediate tables have at most one row per position.
    """
    spark = df.sparkSession
    keyed = df.withColumn("pick__digest", hashed(F.col(key)))
    if cuts is None:
        cuts = order_cuts(df, score)
    counted = with_range_cell(df.groupBy(score).agg(F.count("*").alias("n")), score, cuts)
    ranked = prefix_aggregates(counted, [], score, {"upto": ("sum", "n")})
    # a score keeps the positions that fall on it; scores without one give no row
    listed = F.array(*[F.lit(int(p)) for p in positions])
    held = F.filter(listed, lambda p: (F.col("upto_before") <= p) & (p < F.col("upto")))
    at_score = (
        ranked.select(score, "upto", "upto_before", F.explode(held).alias("position"))
        .select(
            score,
            "position",
            (F.col("position") - F.col("upto_before")).alias("skip"),
            (F.col("upto") - F.col("upto_before")).alias("n"),
        )
    ).collect()
    # digits that leave about TIED_ROWS rows of the largest tie in a cell
    most = max((r["n"] for r in at_score), default=1)
    digits = max(4, math.ceil(math.log(max(1, most / TIED_ROWS), 16)))
    scores = spark.createDataFrame([r[:3] for r in at_score], f"`{score}` double, position int, skip bigint")
    tied = keyed.join(F.broadcast(scores.select(score).distinct()), score, "left_semi").withColumn(
        "cell", hash_cell(F.col("pick__digest"), digits)
    )
    cells = tied.groupBy(score, "cell").agg(F.count("*").alias("n"))
    along = W.partitionBy(score).orderBy("cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    located = (
        cells.select(score, "cell", "n", F.sum("n").over(along).alias("upto"))
        .join(F.broadcast(scores), score)
        .filter((F.col("skip") >= F.col("upto") - F.col("n")) & (F.col("skip") < F.col("upto")))
        .select(score, "cell", "position", (F.col("skip") - F.col("upto") + F.col("n") + 1).alias("place"))
    ).collect()
    targets = spark.createDataFrame(located, f"`{score}` double, cell string, position int, place bigint")
    rows = tied.join(F.broadcast(targets.select(score, "cell").distinct()), [score, "cell"], "left_semi")
    placed = rows.withColumn(
        "place",
        F.row_number().over(W.partitionBy(score, "cell").orderBy("pick__digest", key)).cast("bigint"),
    )
    return placed.join(F.broadcast(targets), [score, "cell", "place"]).drop("cell", "place", "pick__digest")
