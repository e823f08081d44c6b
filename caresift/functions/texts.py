"""Column expressions that render and check explanation texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from caresift.functions import constants as K
from caresift.functions import rates as R
from caresift.operators.present import percent_text
from caresift.operators.scoring import risk_band


def _prompt(exam: str, finding: str, rules: str, model, score, threshold, detected) -> Column:
    return F.concat(
        F.lit(K.PROMPT_OPENING),
        R.col(model),
        F.lit(f"\n- Tipo de exame: {exam}\n- Probabilidade estimada: "),
        percent_text(score),
        F.lit("\n- Limiar de decisão: "),
        percent_text(threshold),
        F.lit(f"\n- {finding}: "),
        F.when(R.col(detected), "sim").otherwise("não"),
        F.lit("\n- Nível de risco estimado: "),
        risk_band(score),
        F.lit(K.PROMPT_SECTIONS),
        F.lit(rules),
    )


def tabular_prompt(model="model", score="y_prob", threshold=None, detected="disease_detected") -> Column:
    return _prompt(K.TABULAR_EXAM, K.TABULAR_FINDING, K.TABULAR_RULES, model, score, threshold, detected)


def image_prompt(model="model", score="y_prob", threshold=None, detected="disease_detected") -> Column:
    return _prompt(K.IMAGE_EXAM, K.IMAGE_FINDING, K.IMAGE_RULES, model, score, threshold, detected)


def fallback_text(model="model", score="y_prob", details="details") -> Column:
    return F.concat(
        F.lit("O modelo "),
        R.col(model),
        F.lit(" indicou uma probabilidade estimada de "),
        percent_text(score),
        F.lit(", classificada como risco "),
        risk_band(score),
        F.lit(". " + K.FALLBACK_TAIL),
        R.col(details),
    )


def is_retryable(message) -> Column:
    return F.coalesce(F.lower(R.col(message)).rlike("|".join(K.RETRY_MARKERS)), F.lit(False))


def was_explained(text) -> Column:
    """False for rows that only carry the fixed notice; a missing text counts as explained."""
    return ~F.coalesce(R.col(text), F.lit("")).startswith(K.SKIPPED_PREFIX)


def lowered(text, low=None) -> Column:
    """The lower-cased text; ``low`` where a column holds it already, as lower-casing long texts is dear."""
    return F.lower(R.col(text)) if low is None else R.col(low)


def folded(text, low=None) -> Column:
    """Lower-cased text without accents."""
    return F.translate(lowered(text, low), K.ACCENTED, K.UNACCENTED)


def is_fallback(text, low=None) -> Column:
    """Finds the fallback sentence with or without its accents.

    The plain ending of the sentence is looked for first, so that accents are
    only folded in texts that have it.
    """
    ending = lowered(text, low).contains(K.FALLBACK_ENDING)
    return F.coalesce(ending & folded(text, low).contains(K.FALLBACK_MARKER), F.lit(False))


def has_section(text, stem: str) -> Column:
    """The section name starts some line."""
    return R.col(text).rlike(rf"(?imdU)^\s*{stem}\s*:?")


def section_heads(text) -> Column:
    """The section names that start lines, as written, one a line: all that ``has_section`` has to look at."""
    stems = "|".join(K.SECTION_STEMS.values())
    return F.array_join(F.regexp_extract_all(R.col(text), F.lit(rf"(?imdU)^\s*({stems})"), F.lit(1)), "\n")


def has_disclaimer(text, low=None) -> Column:
    low = lowered(text, low)
    who = reduce(lambda a, b: a | b, [low.contains(w) for w in K.DISCLAIMER_WHO])
    return low.contains(K.DISCLAIMER_CORE) & who


def has_banned_phrase(text, fold_accents: bool = False, low=None) -> Column:
    low = folded(text, low) if fold_accents else lowered(text, low)
    return reduce(lambda a, b: a | b, [low.contains(p) for p in K.BANNED_PHRASES])


def length_ok(text, low: int = K.MIN_CHARS, high: int = K.MAX_CHARS) -> Column:
    return F.length(R.col(text)).between(low, high)


def risk_line(text) -> Column:
    return F.lower(F.regexp_extract(R.col(text), r"(?imdU)^\s*risco\s*:?\s*(.+)$", 1))


def risk_consistent(text, expected) -> Column:
    """The risk line names the expected band and no other."""
    line, band = risk_line(text), R.col(expected)
    others = reduce(lambda a, b: a | b, [(band != w) & line.contains(w) for w in K.RISK_WORDS])
    return line.contains(band) & ~others


def all_checks(text, expected, low=None, heads=None) -> dict[str, Column]:
    """Every check of a text; columns that hold ``lowered`` and ``section_heads`` spare making them again."""
    checks = {name: has_section(text if heads is None else heads, stem) for name, stem in K.SECTION_STEMS.items()}
    checks["tem_disclaimer_medico"] = has_disclaimer(text, low)
    checks["sem_linguagem_categorica"] = ~has_banned_phrase(text, low=low)
    checks["tamanho_adequado"] = length_ok(text)
    checks["risco_consistente"] = risk_consistent(text, expected)
    return checks


def image_tags_rewritten(text) -> tuple[Column, Column]:
    """(text with Markdown images, number of tags replaced)."""
    return (
        F.regexp_replace(R.col(text), K.IMAGE_TAG, "![]($1)"),
        F.regexp_count(R.col(text), F.lit(K.IMAGE_TAG)),
    )


def scrubbed(text, patterns: list[tuple[str, str]]) -> Column:
    """Ordered regex replacements."""
    return reduce(lambda c, step: F.regexp_replace(c, step[0], step[1]), patterns, R.col(text))


def header_scrub_steps() -> list[tuple[str, str]]:
    """The fixed order: blocks, header lines (with and without line end), title parts."""
    steps = [(p, "") for p in K.BLOCK_PATTERNS]
    for p in K.HEADER_PATTERNS:
        steps += [(p + r"\n", "\n"), (p, "")]
    return steps + [(p, "") for p in K.TITLE_PATTERNS]
