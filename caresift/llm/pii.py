"""Personal data: fixed forms first, then bootstrapped contextual extraction, all in Spark SQL.

The fixed forms give base spans. Their values are the seeds: the words that stand before them become patterns, and a graph of patterns and
values is scored in rounds. A pattern is trusted by the share of trusted values among all that follow it, a
value by the patterns it follows. Looser forms that follow a trusted pattern become further spans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.session import materialize

KINDS = ("email", "ip", "card", "phone")
# The forms, written so that no match is searched for twice: a run is entered at its beginning, or where the last match ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text may hold the form at all.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
#: Looser forms, taken only behind a trusted pattern.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9./])",
    "phone": r"(?<![0-9+(])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[.\x20-])[0-9]{3,4}[.-][0-9]{3,4}(?![0-9.-])",
}
LOOSE_HINTS = {"email": r"[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]", "card": r"[0-9]{4}[./][0-9]{4}[./]", "phone": r"[0-9]{3,4}[.-][0-9]{3,4}"}
IP_PARTS = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$"
#: Scoring rounds; distinct trusted values a pattern needs; the score that makes it trusted.
ROUNDS, LEAST_SUPPORT, TRUST = 3, 3, 0.8
#: Characters before a match that its pattern is cut from.
LEFT_CHARS = 80


def _found(form: str, hint: str) -> Column:
    """The matches of a form as (gap, value, left): characters since the last match, the match, the end of what stands before.

    Splitting and extracting walk the same matches, so the i-th piece is what lies before the i-th match.
    """
    walked = F.arrays_zip(
        F.split("text", form, -1).alias("piece"), F.regexp_extract_all("text", F.lit(form), F.lit(0)).alias("value")
    )
    cut = F.transform(
        F.filter(walked, lambda x: x["value"].isNotNull()),
        lambda x: F.struct(
            F.length(x["piece"]).alias("gap"), x["value"].alias("value"), F.right(x["piece"], F.lit(LEFT_CHARS)).alias("left")
        ),
    )
    none = F.array().cast("array<struct<gap: int, value: string, left: string>>")
    return F.when(F.col("text").rlike(hint), cut).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum is a multiple of ten: every second digit from the right doubled, nines cast out."""
    numbers = F.transform(F.split(F.reverse(digits), ""), lambda c, i: _luhn_part(c.cast("int"), i))
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x) % 10 == 0


def _luhn_part(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))


def _valid(kind: Column, value: Column) -> Column:
    count = F.length(_digits(value))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", value.rlike(IP_PARTS))
        .when(kind == "card", count.between(13, 19) & _luhn(_digits(value)))
        .otherwise(count.between(9, 15))
    )


def _pattern(left: Column) -> Column:
    """The last two words before a match on its line, in lower case with digits as 0; null if there is none."""
    words = F.regexp_extract(F.substring_index(left, "\n", -1), r"(?:[^\s]+[\x20\t]+)?[^\s]+[\x20\t]*$", 0)
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(words)), r"[0-9]", "0"), r"[\x20\t]+", " ")
    return F.when(F.length(plain) > 0, plain)


def matches(docs: DataFrame) -> DataFrame:
    """A stored row for every row of ``docs`` (doc_id, text): row, doc_id, and an array of matches for each form."""
    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("text", F.coalesce("text", F.lit("")))
    base = {f"base_{k}": _found(BASE[k], HINTS[k]) for k in KINDS}
    loose = {f"loose_{k}": _found(LOOSE[k], LOOSE_HINTS[k]) for k in KINDS}
    found = rows.select("doc_id", *[c.alias(n) for n, c in (base | loose).items()])
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "pii-matches")


def spans(found: DataFrame) -> DataFrame:
    """A stored row for every match that is valid: row, kind, base, start, end, value, pattern. Places are in code points, end exclusive."""
    parts = [
        found.where(F.size(f"{form}_{kind}") > 0).select(
            "row", F.lit(kind).alias("kind"), F.lit(form == "base").alias("base"), F.posexplode(f"{form}_{kind}").alias("n", "m")
        )
        for form in ("base", "loose")
        for kind in KINDS
    ]
    flat = reduce(DataFrame.unionByName, parts).select("row", "kind", "base", "n", "m.gap", "m.value", "m.left")
    upto = Window.partitionBy("row", "kind", "base").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.length("value")).over(upto)
    placed = flat.withColumn("end", end).withColumn("start", F.col("end") - F.length("value"))
    valid = placed.where(~F.col("base") | _valid(F.col("kind"), F.col("value")))
    return materialize(valid.select("row", "kind", "base", "start", "end", "value", _pattern(F.col("left")).alias("pattern")), "pii-spans")


def trusted_patterns(spots: DataFrame, rounds: int = ROUNDS, support: int = LEAST_SUPPORT, trust: float = TRUST) -> DataFrame:
    """(kind, pattern, score) of the patterns that end up trusted.

    Edges are the distinct (pattern, value) pairs of a kind, so copies of a text count once. A seed value is trusted
    from the start and stays so; each round scores patterns by their values, then the other values by their patterns.
    The tables of a round are stored, which also lets the skew join split a frequent pattern.
    """
    edges = spots.where("pattern IS NOT NULL").groupBy("kind", "pattern", "value").agg(F.max("base").alias("seed"))
    edges = materialize(edges, "pii-edges")
    values = edges.groupBy("kind", "value").agg(F.max("seed").alias("is_seed"))
    values = materialize(values.withColumn("belief", F.when(F.col("is_seed"), 1.0).otherwise(0.0)), "pii-values")
    patterns = None
    for again in range(rounds):
        rated = edges.join(values, ["kind", "value"])
        patterns = rated.groupBy("kind", "pattern").agg(
            F.sum("belief").alias("hits"), F.count(F.lit(1)).alias("n"), F.sum(F.col("is_seed").cast("int")).alias("seeds")
        )
        patterns = patterns.where(F.col("seeds") >= support).select("kind", "pattern", (F.col("hits") / F.col("n")).alias("score"))
        patterns = materialize(patterns, "pii-patterns")
        if again < rounds - 1:
            doubt = F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.99)))))
            beliefs = edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "value").agg((1 - doubt).alias("by_patterns"))
            values = values.drop("belief").join(beliefs, ["kind", "value"], "left")
            belief = F.when(F.col("is_seed"), 1.0).otherwise(F.coalesce("by_patterns", F.lit(0.0)))
            values = materialize(values.select("kind", "value", "is_seed", belief.alias("belief")), "pii-values")
    return patterns.where(F.col("score") >= trust)


def discovered(spots: DataFrame, patterns: DataFrame) -> DataFrame:
    """Loose matches behind a trusted pattern that touch no base span of their row."""
    loose = spots.where("NOT base").join(patterns.select("kind", "pattern"), ["kind", "pattern"])
    own = spots.where("base").select(F.col("row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    touches = (F.col("row") == F.col("r")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))
    return loose.join(own, touches, "left_anti")


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, base, added) for every row of ``docs`` (doc_id, text; other columns are ignored): arrays of (kind, start, end) spans.

    ``base`` are the fixed forms, ``added`` what trusted patterns discover; both by kind as listed, then start. A null text
    is empty; a row without spans has empty arrays; repeated rows and null ids keep their rows; texts may be of any length.
    """
    found = matches(docs)
    spots = spans(found)
    new = discovered(spots, trusted_patterns(spots, rounds)).select("row", "kind", "base", "start", "end")
    every = spots.where("base").select("row", "kind", "base", "start", "end").unionByName(new)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct(order.alias("order"), F.col("start"), F.col("end"), F.col("kind"))
    listed = every.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), entry))).alias("base"),
        F.array_sort(F.collect_list(F.when(~F.col("base"), entry))).alias("added"),
    )
    listed = materialize(listed.withColumnRenamed("row", "listed_row"), "pii-listed")
    joined = found.select("row", "doc_id").join(listed, F.col("row") == F.col("listed_row"), "left")
    none = F.array().cast(listed.schema["base"].dataType)
    return joined.select("doc_id", *[F.coalesce(c, none).alias(c) for c in ("base", "added")])


def _spelled(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of every document: counts and checksum of the fixed forms, and all spans spelled out."""
    listed = personal_data(read(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return listed.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"),
        _spelled(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
