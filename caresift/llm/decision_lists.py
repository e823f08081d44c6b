"""Quality rules: a decision list learned from labelled text statistics.

Sequential covering: a rule grows by the threshold condition with the best information gain until it covers good rows no
more, is pruned on rows set aside, and the rows it covers are taken out before the next rule grows. The rules, all of them
for low quality, become one ordered Spark conditional expression; what no rule covers is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.session import materialize

#: Labelled rows the list is learned from, about at most; more are thinned by a hash of the id.
FIT_ROWS = 20_000
#: Every so many of them are set aside for pruning.
PRUNE_EVERY = 3
#: A rule has at most so many conditions, covers at least so many rows, and is wrong on at most this share of them.
MOST_CONDITIONS, LEAST_COVER, MOST_WRONG, MOST_RULES = 4, 20, 0.1, 16
#: Thresholds tried for a statistic: quantiles of the rows left.
CUTS = 64
SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_marks", "n_distinct", "n_lines")
STATS_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
RATIOS = ("n_words", "mean_word", "symbol_share", "dup_share", "repeat_share", "upper_share", "letter_share", "mark_share", "distinct_share", "line_words")


def repeated_words(words: list[bytes], window: int = 5) -> int:
    """Words inside windows of ``window`` words that occur at least twice in the text, the first included."""
    n = len(words)
    if n <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    runs = ids
    # windows get numbers by pairing shorter runs: equal numbers, equal words
    for step in _halvings(window):
        runs = np.unique(runs[: len(runs) - step] * (len(runs) + len(numbers) + 1) + runs[step:], return_inverse=True)[1]
    twice = np.bincount(runs)[runs] > 1
    covered = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def _halvings(window: int) -> list[int]:
    """Shifts that build a window from overlapping shorter ones: 5 is 2, then 4, then 5."""
    steps, length = [], 1
    while length < window:
        step = min(length, window - length)
        steps.append(step)
        length += step
    return steps


def text_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    joined = b"".join(words)
    lines = [line for line in raw.split(b"\n") if line.split()]
    chars = len(joined) - int((np.frombuffer(joined, np.uint8) & 0xC0 == 0x80).sum())
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(joined) - len(joined.translate(None, _ASCII_LETTERS))
    upper = sum(map(str.isupper, text)) if not text.isascii() else len(joined) - len(joined.translate(None, _ASCII_UPPER))
    marks = len(joined) - len(joined.translate(None, b"!?"))
    return (
        len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), upper, letters, marks, len(set(words)), len(lines)
    )


_ASCII_UPPER = bytes(range(65, 91))
_ASCII_LETTERS = _ASCII_UPPER + bytes(range(97, 123))


def statistics(docs: DataFrame) -> DataFrame:
    """The counts of every row of ``docs`` (doc_id, text); a null text has zeros, other columns are left behind."""
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = [text_counts(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            columns = [pa.array([c[k] for c in counted], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *COUNTS])

    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, STATS_SCHEMA)


def with_ratios(stats: DataFrame) -> DataFrame:
    """The statistics rules are about; a share of nothing is zero."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    return stats.withColumns(
        {
            "mean_word": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "word_chars"),
            "dup_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "upper_share": share("n_upper", "n_letters"),
            "letter_share": share("n_letters", "word_chars"),
            "mark_share": share("n_marks", "word_chars"),
            "distinct_share": share("n_distinct", "n_words"),
            "line_words": share("n_words", "n_lines"),
        }
    )


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool
    cut: float

    def holds(self, rows: dict[str, np.ndarray]) -> np.ndarray:
        return rows[self.name] > self.cut if self.above else rows[self.name] <= self.cut

    def column(self) -> Column:
        return F.col(self.name) > self.cut if self.above else F.col(self.name) <= self.cut

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def covers(rule: Rule, rows: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(rows.values()))), bool)
    for c in rule:
        out &= c.holds(rows)
    return out


def _best_condition(rows: dict[str, np.ndarray], bad: np.ndarray, names: Sequence[str]) -> Condition | None:
    """The condition with the highest gain: bad rows kept, times the bits by which the share of bad rows rises."""
    total_bad, total = int(bad.sum()), len(bad)
    base, best = math.log2(total_bad / total), None
    for name in names:
        values = rows[name]
        cuts = np.unique(np.quantile(values, np.linspace(0, 1, CUTS + 1)[1:-1], method="lower"))
        order = np.argsort(values)
        seen_bad, seen = np.append(0, np.cumsum(bad[order])), np.searchsorted(values[order], cuts, "right")
        for above in (True, False):
            n = total - seen if above else seen
            p = total_bad - seen_bad[seen] if above else seen_bad[seen]
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(p > 0, p * (np.log2(p / n) - base), -1.0)
            k = int(gain.argmax())
            if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                best = (float(gain[k]), Condition(name, above, float(cuts[k])))
    return best[1] if best else None


def _grow(rows: dict[str, np.ndarray], bad: np.ndarray, names: Sequence[str]) -> Rule:
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS and bad.any() and not bad.all():
        condition = _best_condition(rows, bad, names)
        if condition is None:
            break
        keep = condition.holds(rows)
        rule.append(condition)
        rows, bad = {k: v[keep] for k, v in rows.items()}, bad[keep]
    return tuple(rule)


def _worth(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = covers(rule, rows)
    p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
    return (p - n) / (p + n) if p + n else -1.0


def _prune(rule: Rule, rows: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule with the best (p - n) / (p + n) on the rows set aside."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(r, rows, bad), -len(r)))


def learn(rows: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray, names: Sequence[str] = RATIOS) -> list[Rule]:
    """Ordered rules for bad rows; ``prune`` marks the rows set aside. Learning stops when a rule covers too few rows or errs too often."""
    out: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(out) < MOST_RULES:
        grow, held = left & ~prune, left & prune
        if not bad[grow].any():
            break
        rule = _grow({k: v[grow] for k, v in rows.items()}, bad[grow], names)
        if not rule:
            break
        if bad[held].any():
            rule = _prune(rule, {k: v[held] for k, v in rows.items()}, bad[held])
        hit = left & covers(rule, rows)
        if hit.sum() < LEAST_COVER or (hit & ~bad).sum() > MOST_WRONG * hit.sum():
            break
        out.append(rule)
        left &= ~hit
    return out


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules from ``labels`` (doc_id, quality 0 or 1); null ids and labels teach nothing, nor do labels without a document.

    About ``fit_rows`` labels are used at most, picked by a hash of their id, so what comes to the driver is bounded.
    """
    known = narrow(labels, label_id="doc_id", quality="quality").where("label_id IS NOT NULL AND quality IS NOT NULL")
    count = known.count()
    draw = F.pmod(F.xxhash64("label_id", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = known.where(draw < min(1.0, fit_rows / max(1, count)))
    joined = with_ratios(stats).join(picked, F.col("doc_id") == F.col("label_id")).select("doc_id", "quality", *RATIOS)
    got = sorted((tuple(r) for r in joined.collect()))
    if not got:
        return []
    bad = np.array([r[1] == 0 for r in got])
    rows = {name: np.array([r[2 + k] for r in got], float) for k, name in enumerate(RATIOS)}
    return learn(rows, bad, np.arange(len(got)) % PRUNE_EVERY == 0)


def verdict(rules: Sequence[Rule]) -> Column:
    """The number of the first rule that covers a row, from 1; 0 if none does."""
    out = F.lit(0)
    for k in range(len(rules), 0, -1):
        held = F.lit(True)
        for condition in rules[k - 1]:
            held = held & condition.column()
        out = F.when(held, F.lit(k)).otherwise(out)
    return out


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts, base verdict, the rule that covers (0: none) and ``kept`` for every row of ``docs`` (doc_id, text).

    The base drops texts of under 10 words, or with over a fifth of their words in repeated windows. A null text has no
    words and is dropped. Repeated rows are judged each; an empty table gives an empty result.
    """
    stats = materialize(statistics(docs), "text-stats")
    rules = fit(stats, labels)
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = with_ratios(stats).withColumns({"base_failed": base, "rule": verdict(rules)})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def op8_decision_list(spark, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", *COUNTS[1:5], "base_failed", "kept")
