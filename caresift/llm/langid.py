"""Language by rank-order profiles of character n-grams.

A language is the ranking of its most frequent n-grams. A document's own ranking is compared by the
out-of-place distance: how many places each of its n-grams is away from its place in the profile, and the length of the profile for
those that it lacks. The nearest profile wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read

#: n-grams in a profile.
PROFILE_SIZE = 400
#: Training documents a language is learned from, about; more are thinned by a hash of their id.
TRAIN_DOCS = 2_000
UNKNOWN = "und"
BLANK = 32


@cache
def letter_table() -> np.ndarray:
    points = np.arange(0x110000)
    return np.where([chr(c).isalpha() for c in points], points, BLANK)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram codes, counts) of the letter runs of a whole text, 1 to 3 letters, a blank for each border.

    Repeated tokens are spelled once and weighted. A code holds up to three code points of 21 bits, so
    different n-grams have different codes; a blank stands at the ends of an n-gram only.
    """
    tokens = Counter(text.lower().split())
    spelled = " " + " ".join(tokens) + " "
    letters = letter_table()[np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), "<u4")]
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    weights = np.append(np.repeat(np.fromiter(tokens.values(), np.int64, len(tokens)), sizes), 0)[: len(letters)]
    blank = letters == BLANK
    two = (letters[:-1] << 21) | letters[1:]
    three = (two[:-1] << 21) | letters[2:]
    keep = (~blank, ~(blank[:-1] & blank[1:]), ~blank[1:-1])
    codes = np.concatenate([letters[keep[0]], two[keep[1]], three[keep[2]]])
    if not keep[0].any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    counts = np.concatenate([weights[: len(k)][k] for k in keep])
    order = codes.argsort()
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(counts[order], first)


def ranking(codes: np.ndarray, counts: np.ndarray, size: int = PROFILE_SIZE) -> np.ndarray:
    """The most frequent codes, in order; equal counts in order of the code."""
    if len(codes) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    """The rankings of all languages, as one table of places."""

    def __init__(self, rankings: dict[str, np.ndarray], size: int = PROFILE_SIZE):
        self.size = size
        self.langs = sorted(rankings)
        ranked = [rankings[k] for k in self.langs]
        self.codes = np.unique(np.concatenate([np.empty(0, np.int64), *ranked]))
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int64)
        for k, codes in enumerate(ranked):
            self.places[np.searchsorted(self.codes, codes), k] = np.arange(len(codes))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, 1 minus the share of the largest possible distance); ties go to the first name."""
        codes = ranking(*gram_counts(text or ""), self.size)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, codes)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != codes)] = -1
        places = self.places[at]
        off = np.where(places < 0, self.size, np.abs(places - np.arange(len(codes))[:, None]))
        distance = off.sum(axis=0)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(codes)))


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS, size: int = PROFILE_SIZE) -> Profiles:
    """Profiles from (doc_id, text, lang) rows; rows without text or language teach nothing.

    Each language learns from about ``train_docs`` documents at most, picked by a hash of the id.
    Their n-grams are counted where they lie, and only the profiles come to the driver: at most ``size`` rows a language.
    """
    import pyarrow as pa
    from pyspark.sql import Window

    usable = narrow(labelled, doc_id="doc_id", text="text", lang="lang").where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return Profiles({}, size)
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, train_docs / n))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = usable.where(draw < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                codes, counts = gram_counts(text.as_py())
                totals.setdefault(lang, Counter()).update(dict(zip(codes.tolist(), counts.tolist())))
        for lang, grams in totals.items():
            columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.keys(), pa.int64()), pa.array(grams.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "code", "n"])

    counted = picked.select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    summed = counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = summed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    rankings: dict[str, list] = {}
    for r in sorted(top.collect(), key=lambda r: r["place"]):
        rankings.setdefault(r["lang"], []).append(r["code"])
    return Profiles({k: np.array(v, np.int64) for k, v in rankings.items()}, size)


def predict(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Adds lang_pred and score to (doc_id, text); other columns are left behind.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    """
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(batch.column(1)[i].as_py()) for i in range(batch.num_rows)]
            columns = [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, "doc_id long, lang_pred string, score double")


def known(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """The rows of ``docs``, all columns, whose language is not ``und``; no row is moved for it."""
    import pyarrow as pa

    place = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place)
            keep = [profiles.predict(texts[i].as_py())[0] != UNKNOWN for i in range(batch.num_rows)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of training: crc32 of its id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4)) == 2, F.lit(False))


def train_rows(docs: DataFrame) -> DataFrame:
    return narrow(docs, doc_id="doc_id", text="text", lang="lang").where(~held_out())


def op2_langid(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learned without those held out."""
    docs = read(spark, sf_dir, "documents")
    found = predict(docs, fit(train_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
