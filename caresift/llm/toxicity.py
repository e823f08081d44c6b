"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, an n-gram is a row of a hashed embedding table, a document is the average of its
words and a linear softmax reads the average. Table and softmax are trained together in numpy on a bounded sample. A misspelled
or inflected word that was never seen still has most of its n-grams, and so their vectors.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.session import checked_broadcast

#: Lengths of the n-grams; the ends of a word are letters of their own.
SHORTEST, LONGEST = 3, 5
#: Rows of the embedding table (a power of two) and their width.
BUCKET_BITS, WIDTH = 18, 4
#: Labelled documents the model learns from, about: at most half of them of each label, drawn by a hash of their id.
FIT_ROWS = 6_000
#: Texts with more characters teach nothing (they are scored whole); bounds what the fit holds.
FIT_CHARS = 100_000
#: Deviations from chance beyond which an n-gram's presence must tell the labels apart to get a vector; all others stay
#: zero, as they would only learn single documents by heart.
LEAST_SCORE = 4.5
#: Factor of the average: marked words are few among a document's words.
SCALE = 50.0
#: Full-batch steps, their size, and the pull of all weights towards zero.
EPOCHS, RATE, DECAY = 60, 0.1, 1e-4
SEED = 12
#: Documents are scored in portions of about this many characters; a worker remembers this many words.
PORTION_CHARS, CACHE_WORDS = 1 << 20, 200_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

#: Every ASCII character that is no letter becomes a blank.
_TO_BLANK = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The lower-cased words of a whole text, in UTF-8; ASCII characters other than letters part them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_BLANK).split()


def subwords(spelled: Sequence[bytes], bits: int = BUCKET_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): the table rows of all words' n-grams in a row, and where each word's begin.

    The n-grams of ``<word>`` are those of SHORTEST to LONGEST characters; the whole word is one more, so no word is without.
    """
    text = "".join(f"<{w.decode('utf-8', 'surrogatepass')}>" for w in spelled)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.cumsum(points == ord("<")) - 1
    code, found, owners = points + np.uint64(1), [], []
    for n in range(2, LONGEST + 1):
        code = code[:-1] * MIX[0] + points[n - 1 :]
        if n >= SHORTEST and len(code):
            own = owner[: len(code)]
            inside = own == owner[n - 1 :]
            found.append(code[inside] ^ np.uint64(n))
            owners.append(own[inside])
    found.append(np.fromiter(map(zlib.crc32, spelled), np.uint64, len(spelled)))
    owners.append(np.arange(len(spelled)))
    codes, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    buckets = ((codes[order] * MIX[1]) >> np.uint64(64 - bits)).astype(np.int64)
    return buckets, np.searchsorted(owner[order], np.arange(len(spelled)))


class Bags:
    """Documents as counts of distinct words, words as bags of n-grams; only n-grams that tell the labels apart have a table row."""

    def __init__(self, texts: Iterable[str | None], labels: np.ndarray, bits: int = BUCKET_BITS, least: float = LEAST_SCORE):
        number: dict[bytes, int] = {}
        docs, place, count, sizes = [], [], [], []
        for k, text in enumerate(texts):
            bag = Counter(words(text))
            docs += [k] * len(bag)
            place += [number.setdefault(w, len(number)) for w in bag]
            count += bag.values()
            sizes.append(sum(bag.values()))
        buckets, starts = subwords(list(number), bits)
        sizes_by_word = np.diff(np.append(starts, len(buckets)))
        self.doc, self.place = np.array(docs, np.int64), np.array(place, np.int64)
        self.weight = SCALE * np.array(count, float) / np.array(sizes, float)[self.doc]
        self.n_docs, self.n_words = len(sizes), len(number)
        told = telling(self._documents_of(buckets, starts, sizes_by_word, bits), labels, bits, least)
        kept = told[buckets]
        self.word = np.repeat(np.arange(self.n_words), sizes_by_word)[kept]
        self.share = 1.0 / sizes_by_word[self.word]
        self.rows, self.row = np.unique(buckets[kept], return_inverse=True)

    def _documents_of(self, buckets, starts, sizes, bits: int) -> Iterator[tuple[int, np.ndarray]]:
        """(document, its distinct table rows) of every document."""
        for k, at in enumerate(np.split(self.place, np.searchsorted(self.doc, np.arange(1, self.n_docs)))):
            spans = sizes[at]
            inner = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            yield k, np.unique(buckets[np.repeat(starts[at], spans) + inner])

    def average(self, table: np.ndarray) -> np.ndarray:
        """The documents' vectors: the mean over their words of the mean over the word's n-grams, times SCALE."""
        by_word = _sums(self.word, table[self.row] * self.share[:, None], self.n_words)
        return _sums(self.doc, by_word[self.place] * self.weight[:, None], self.n_docs)

    def spread(self, slope: np.ndarray) -> np.ndarray:
        """The slope of every table row, from those of the documents' vectors."""
        by_word = _sums(self.place, slope[self.doc] * self.weight[:, None], self.n_words)
        return _sums(self.row, by_word[self.word] * self.share[:, None], len(self.rows))


def telling(documents: Iterable[tuple[int, np.ndarray]], labels: np.ndarray, bits: int, least: float) -> np.ndarray:
    """Which table rows stand in documents of one label too often for chance: a 2 x 2 score test beyond ``least`` deviations."""
    seen = np.zeros((2, 1 << bits))
    for k, rows in documents:
        seen[labels[k], rows] += 1
    size = np.bincount(labels, minlength=2).astype(float)
    pooled = seen.sum(axis=0) / size.sum()
    spread = np.sqrt(pooled * (1 - pooled) * (1 / size[0] + 1 / size[1]))
    return np.abs(seen[1] / size[1] - seen[0] / size[0]) > least * np.maximum(spread, 1e-12)


def _sums(key: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(key, values[:, c], minlength=size) for c in range(values.shape[1])], axis=1)


class Model:
    """Log-odds of label 1 for every table row, and the bias; a document's log-odds are the average of its rows' plus the bias.

    The softmax is linear, so embeddings and softmax weights of two classes multiply out to one number a row.
    """

    def __init__(self, odds: np.ndarray, bias: float, bits: int = BUCKET_BITS):
        self.odds, self.bias, self.bits = odds.astype(np.float32), float(bias), bits

    def word_odds(self, spelled: Sequence[bytes]) -> np.ndarray:
        if not len(spelled):
            return np.empty(0)
        buckets, starts = subwords(spelled, self.bits)
        sizes = np.diff(np.append(starts, len(buckets)))
        return np.add.reduceat(self.odds[buckets].astype(float), starts) / sizes

    def scores(self, texts: Sequence[str | None], known: dict[bytes, float] | None = None) -> list[float]:
        """Probability of label 1 of every whole text; a text without words has the bias alone."""
        known = {} if known is None else known
        split = [words(t) for t in texts]
        fresh = list(set().union(*split) - known.keys())
        known.update(zip(fresh, self.word_odds(fresh).tolist()))
        odds = [self.bias + (sum(map(known.__getitem__, w)) / len(w) if w else 0.0) for w in split]
        return (1.0 / (1.0 + np.exp(-np.clip(odds, -500, 500)))).tolist()


def train(texts: Sequence[str | None], labels: Sequence[int], weights: Sequence[float] | None = None, seed: int = SEED) -> Model:
    """Embedding table and softmax of two classes, trained together by full-batch Adam on the weighted log loss.

    Without both labels there is nothing to tell apart: every text then gets the smoothed share of label 1.
    """
    y = np.array(labels, int)
    importance = np.ones(len(y)) if weights is None else np.array(weights, float)
    importance = importance / max(importance.sum(), 1e-300)
    share = (importance[y == 1].sum() * len(y) + 1) / (len(y) + 2)
    prior = np.log(share / (1 - share))
    if not (0 < y.sum() < len(y)):
        return Model(np.zeros(1 << BUCKET_BITS), prior)
    bags = Bags(texts, y)
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (len(bags.rows), WIDTH))
    softmax = rng.normal(0, 0.1, (WIDTH, 2))
    bias = np.array([0.0, prior])
    target = np.eye(2)[y]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in (table, softmax, bias)]
    for step in range(1, EPOCHS + 1):
        average = bags.average(table)
        z = average @ softmax + bias
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(axis=1, keepdims=True)
        slope = (p - target) * importance[:, None]
        slopes = (bags.spread(slope @ softmax.T) + DECAY * table / len(table), average.T @ slope + DECAY * softmax, slope.sum(axis=0))
        for param, grad, (m, v) in zip((table, softmax, bias), slopes, state):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
    odds = np.zeros(1 << BUCKET_BITS)
    odds[bags.rows] = SCALE * table @ (softmax[:, 1] - softmax[:, 0])
    return Model(odds, bias[1] - bias[0])


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether an id teaches nothing: crc32 of its text is divisible by 5. A null id is not held out, but teaches nothing either."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(5)) == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[list[str], list[int], list[float]]:
    """(texts, labels, weights) that the model is fitted on: about ``fit_rows`` documents at most, half of each label.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic (0 or 1, else the row says nothing). Of several labels of one id the
    majority counts, 0 on a tie; of several texts the first by code point. A weight is how many labelled documents a row stands for.
    Only these rows come to the driver, none over FIT_CHARS characters.
    """
    said = narrow(labels, id="doc_id", toxic="toxic").where(F.col("toxic").isin(0, 1) & F.col("id").isNotNull())
    said = said.withColumn("id", F.col("id").cast("long")).where(~held_out("id"))
    said = said.groupBy("id").agg((F.avg("toxic") > 0.5).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in said.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("toxic") == 1, F.lit(fit_rows / 2 / max(1, sizes.get(1, 0)))).otherwise(F.lit(fit_rows / 2 / max(1, sizes.get(0, 0))))
    picked = checked_broadcast(said.where(draw < share), 2 * fit_rows)
    rows = narrow(docs, doc_id="doc_id", text="text").where(F.length("text") <= FIT_CHARS)
    rows = rows.join(picked, F.col("doc_id").cast("long") == F.col("id")).groupBy("id", "toxic").agg(F.min("text").alias("text"))
    found = sorted((r["id"], r["toxic"], r["text"]) for r in rows.collect())
    stands = {k: sizes.get(k, 0) / max(1, sum(r[1] == k for r in found)) for k in (0, 1)}
    return [r[2] for r in found], [r[1] for r in found], [stands[r[1]] for r in found]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model of ``training_rows``; without both labels among them every text scores their smoothed share of label 1."""
    return train(*training_rows(docs, labels, fit_rows))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs`` (doc_id, text; other columns are ignored), whole texts of any length.

    Null, empty and wordless texts score the bias alone. Repeated rows score alike; an empty table gives an empty result.
    """
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        for batch in batches:
            found: list[float] = []
            for texts in _portions(batch.column(1)):
                if len(known) > CACHE_WORDS:
                    known.clear()
                found += model.scores(texts, known)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(work, "doc_id long, score double")


def _portions(column) -> Iterator[list[str | None]]:
    held, size = [], 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= PORTION_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def op12_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score and decision for every document, learned without those held out."""
    docs = read(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
