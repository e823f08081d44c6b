"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

A passage of m characters that occurs with at most k edits shares at least m + 1 - q - k*q of its q-grams with the
place where it occurs, and all of these lie on k + 1 neighbouring diagonals. So shared q-grams are counted
in overlapping diagonal bands, bands that reach the bound are kept, and only those are aligned.
"""

from __future__ import annotations

import itertools
import math
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caresift.llm.store import new_file, new_folder, open_store
from caresift.llm.tables import narrow, read

Q = 8
#: Edits allowed, as a share of a passage's characters.
EDIT_SHARE = 0.1
#: Passages up to WINDOW characters are looked for as a whole. Of longer ones windows of that many characters are, each
#: as much further as a window may be edited: a copied run of WINDOW + STRIDE - 1 characters holds a whole window
#: wherever it starts.
WINDOW, STRIDE = 200, 20
#: Characters of passages in one block; a worker has one block of them at a time.
BLOCK_CHARS = 2_000_000
#: Characters of documents that are searched at once.
BUFFER_CHARS = 1 << 20
TABLE_BITS = 22
MATCH_SCHEMA = "doc_id long, item_id long, start long, end long, edits long"


def normal(text: str | None) -> str:
    """Lower case, every run of white space one blank."""
    return " ".join((text or "").lower().split()).replace("\x00", " ")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def gram_codes(points: np.ndarray) -> np.ndarray:
    """A 64-bit code of every run of eight characters; equal runs have equal codes."""
    code = points
    for step, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F), (4, 0x165667B19E3779F9)):
        if len(code) <= step:
            return np.empty(0, np.uint64)
        code = code[:-step] * np.uint64(factor) + code[step:]
    return code


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def budget(length: int, edit_share: float = EDIT_SHARE) -> int:
    """Edits allowed: the share asked for, but no more than leaves the lemma a q-gram to count."""
    return min(int(edit_share * length), (length - Q) // Q) if length >= Q else -1


class PassageIndex:
    """The q-grams of a block of passages and where they stand.

    A passage carries one window (itself) or several. Its q-grams are posted once; hits are counted for the whole passage
    first, and for the windows only in bands where the passage has as many as a window needs.
    """

    def __init__(self, items: list[tuple[int, str | None]], edit_share: float = EDIT_SHARE):
        self.item_ids: list[int] = []
        self.carriers: list[str] = []
        starts: list[np.ndarray] = []
        for item_id, text in items:
            plain = normal(text)
            if len(plain) < Q:
                continue
            self.item_ids.append(item_id)
            self.carriers.append(plain)
            last = max(0, len(plain) - WINDOW)
            starts.append(np.array(sorted({*range(0, last, STRIDE), last}), np.int64))
        self.many = np.array([len(x) for x in starts], np.int64)
        self.first_window = np.cumsum(self.many) - self.many
        self.starts = np.concatenate([np.empty(0, np.int64), *starts])
        self.carrier = np.repeat(np.arange(len(starts)), self.many)
        self.lengths = np.array([min(len(t), WINDOW) for t in self.carriers], np.int64)
        self.budgets = np.array([budget(int(n), edit_share) for n in self.lengths], np.int64)
        self.bounds = self.lengths + 1 - Q - self.budgets * Q
        self.bands = self.budgets + 1
        codes = [gram_codes(code_points(t)) for t in self.carriers]
        all_codes = np.concatenate([np.empty(0, np.uint64), *codes])
        order = np.argsort(all_codes, kind="stable")
        self.codes, first = np.unique(all_codes[order], return_index=True)
        self.first = np.append(first, len(all_codes))
        self.passage = np.concatenate([np.empty(0, np.int64), *[np.full(len(c), i) for i, c in enumerate(codes)]])[order]
        self.offset = np.concatenate([np.empty(0, np.int64), *[np.arange(len(c)) for c in codes]])[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[_slot(self.codes)] = True
        self.least = int(self.bounds.min()) if codes else 0
        self.reach = int((self.lengths + self.budgets).max()) if codes else 0
        self.pad = max(map(len, self.carriers), default=0)

    def window(self, number: int) -> str:
        carrier, start = int(self.carrier[number]), int(self.starts[number])
        return self.carriers[carrier][start : start + WINDOW]

    def _hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, places in ``self.codes``) of known q-grams in neighbourhoods dense enough for any passage."""
        at = np.flatnonzero(self.table[_slot(codes)])
        place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        known = self.codes[place] == codes[at]
        at, place = at[known], place[known]
        # a passage within its budget has at least `least` hits inside `reach` characters
        after = np.searchsorted(at, at + self.reach) - np.arange(len(at))
        opens = np.flatnonzero(after >= self.least)
        marks = np.zeros(len(at) + 1, np.int64)
        np.add.at(marks, opens, 1)
        np.add.at(marks, opens + after[opens], -1)
        dense = np.cumsum(marks[:-1]) > 0
        return at[dense], place[dense]

    def candidates(self, points: np.ndarray) -> list[tuple[int, int, int]]:
        """(window, first, last diagonal) of the bands that hold as many shared q-grams as the lemma asks for."""
        if not self.carriers:
            return []
        at, place = self._hits(gram_codes(points))
        found: list[np.ndarray] = []
        counts = self.first[place + 1] - self.first[place]
        for a, b in _pieces(counts, 1 << 21, at, self.reach):
            n = counts[a:b]
            ends = np.cumsum(n)
            posting = np.repeat(self.first[place[a:b]] - (ends - n), n) + np.arange(n.sum())
            passage, offset = self.passage[posting], self.offset[posting]
            band = (np.repeat(at[a:b], n) - offset + self.pad) // self.bands[passage]
            # a hit counts in its band and in the one before, which reaches over it
            key = np.concatenate([(passage << 40) + band, (passage << 40) + np.maximum(band - 1, 0)])
            keys, which, shared = np.unique(key, return_inverse=True, return_counts=True)
            enough = shared >= self.bounds[keys >> 40]
            single = self.many[keys >> 40] == 1
            alone = keys[enough & single]
            found.append((self.first_window[alone >> 40] << 40) + (alone & ((1 << 40) - 1)))
            kept = np.flatnonzero((enough & ~single)[which])
            found.append(self._dense_windows(key[kept], np.concatenate([offset, offset])[kept]))
        keys = np.unique(np.concatenate([np.empty(0, np.int64), *found]))
        window = keys >> 40
        bands = self.bands[self.carrier[window]]
        first = (keys - (window << 40)) * bands - self.pad + self.starts[window]
        return list(zip(window.tolist(), first.tolist(), (first + 2 * bands - 1).tolist()))

    def _dense_windows(self, key: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """(window, band) keys of the windows with enough hits, from the (passage, band) keys and offsets of the hits."""
        passage, band = key >> 40, key & ((1 << 40) - 1)
        # the windows over an offset: of those every STRIDE characters, and the last one
        low = np.maximum(0, -((WINDOW - Q - offset) // STRIDE))
        high = np.minimum(offset // STRIDE + 1, self.many[passage] - 1)
        n = np.maximum(high - low + 1, 0)
        row = np.repeat(np.arange(len(key)), n)
        number = self.first_window[passage[row]] + low[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        last = self.first_window[passage] + self.many[passage] - 1
        far = last > self.first_window[passage] + high
        row, number = np.concatenate([row, np.flatnonzero(far)]), np.concatenate([number, last[far]])
        inside = (self.starts[number] <= offset[row]) & (offset[row] <= self.starts[number] + WINDOW - Q)
        keys, shared = np.unique((number[inside] << 40) + band[row[inside]], return_counts=True)
        return keys[shared >= self.bounds[self.carrier[keys >> 40]]]


def _pieces(counts: np.ndarray, most: int, at: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Cuts the hits into runs of about ``most`` postings, at gaps that no passage spans where there is one."""
    if not len(at):
        return
    gaps = np.flatnonzero(np.diff(at) > reach) + 1
    total, begin = np.append(0, np.cumsum(counts)), 0
    for g in [*gaps.tolist(), len(at)]:
        if total[g] - total[begin] >= most or g == len(at):
            yield begin, g
            begin = g


def aligned(
    points: np.ndarray, patterns: list[np.ndarray], first: list[int], last: list[int], begin: list[int], end: list[int], most: list[int]
) -> list[tuple[int, int, int] | None]:
    """For every pattern (edits, start, end) of its best place in its text ``points[begin:end]``, if within ``most`` edits.

    The whole pattern is aligned; only cells whose diagonal (place in ``points`` minus place in the pattern) lies in the
    band first..last, widened by the edits allowed, are computed. All patterns advance together, a letter a step. Of
    equal edits the earliest end counts.
    """
    order = np.array(sorted(range(len(patterns)), key=lambda c: -len(patterns[c])), np.int64)
    sizes = np.array([len(patterns[c]) for c in order])
    letters = np.zeros((len(order), int(sizes.max(initial=0))), np.uint32)
    for row, c in enumerate(order):
        letters[row, : len(patterns[c])] = patterns[c]
    low, high, a, b, k = (np.array([x[c] for c in order], np.int32)[:, None] for x in (first, last, begin, end, most))
    low, high = low - k, high + k
    shift = np.arange(int((high - low).max(initial=0)) + 1, dtype=np.int32)
    column, big = low + shift, np.int32(1 << 28)
    points = points.astype(np.uint32)
    cost, start = np.where((column >= a) & (column <= b), np.int32(0), big), column.copy()
    found: list[tuple[int, int, int] | None] = [None] * len(order)
    down, down_start = np.full_like(cost, big), np.zeros_like(cost)
    for i in range(letters.shape[1]):
        live = int(np.searchsorted(-sizes, -i))
        if i % 8 == 0:
            # what has used up its edits cannot get below them again
            kept = np.flatnonzero(cost[:live].min(axis=1) <= k[:live, 0])
            cost, start, column, letters, sizes, order = (x[kept] for x in (cost, start, column, letters, sizes, order))
            a, b, k, live = a[kept], b[kept], k[kept], len(kept)
            down, down_start = np.full_like(cost, big), np.zeros_like(cost)
        if not live:
            break
        cost, start, column = cost[:live], start[:live], column[:live]
        # from cell j of the last row: along the diagonal to cell j, down to cell j - 1
        read = points[np.clip(column, 0, len(points) - 1)]
        step = np.where((column >= a[:live]) & (column < b[:live]), cost + (read != letters[:live, i : i + 1]), big)
        down[:live, :-1], down_start[:live, :-1] = cost[:, 1:] + 1, start[:, 1:]
        take = down[:live] < step
        cost, start = np.where(take, down[:live], step), np.where(take, down_start[:live], start)
        column = column + 1
        cost = np.where((column >= a[:live]) & (column <= b[:live]), cost, big)
        slope = cost - shift
        run = np.minimum.accumulate(slope, axis=1)
        source = np.maximum.accumulate(np.where(slope == run, shift, 0), axis=1)
        cost, start = np.minimum(run + shift, big), np.take_along_axis(start, source, 1)
        for row in range(int(np.searchsorted(-sizes, -(i + 1))), live):
            best = int(cost[row].argmin())
            if cost[row, best] <= k[row, 0]:
                found[order[row]] = (int(cost[row, best]), int(start[row, best]), int(column[row, best]))
    return found


Best = dict[tuple[int, int], tuple[bool, int, int, int]]


def occurrences(index: PassageIndex, texts: list[str | None]) -> Best:
    """(text number, item_id): (by a window only, edits, start, end) of the best occurrence of every item found in each text.

    Places are in the normal form of the text. Best is a whole passage before a window, then fewest edits, then the earliest.
    """
    plain = [normal(t) for t in texts]
    begins = np.cumsum([0, *(len(p) + 1 for p in plain)])
    joined = "\x00".join(plain)
    points = code_points(joined)
    best: Best = {}

    def note(k: int, window: int, edits: int, start: int, end: int) -> None:
        carrier = index.carrier[window]
        _keep(best, (k, index.item_ids[carrier]), (bool(index.many[carrier] > 1), edits, start - int(begins[k]), end - int(begins[k])))

    open_: dict[tuple[int, int], list[tuple]] = {}
    for window, first, last in index.candidates(points):
        carrier = int(index.carrier[window])
        pattern, most = index.window(window), int(index.budgets[carrier])
        low, high = max(0, first - most), min(len(joined), last + len(pattern) + most)
        # the band may touch two texts: look in every one it reaches
        for k in range(int(np.searchsorted(begins, low, "right")) - 1, int(np.searchsorted(begins, high, "left"))):
            if 0 <= k < len(plain):
                begin, end = int(begins[k]), int(begins[k]) + len(plain[k])
                exact = joined.find(pattern, max(low, begin), min(high, end))
                if exact >= 0:
                    note(k, window, 0, exact, exact + len(pattern))
                elif most > 0 and min(high, end) - max(low, begin) >= len(pattern) - most:
                    open_.setdefault((k, carrier), []).append((k, window, first, last, begin, end, most))
    # an item found letter by letter needs no alignment
    waiting = [x for (k, c), places in open_.items() if best.get((k, index.item_ids[c]), (0, 1))[1] > 0 for x in places]
    for a in range(0, len(waiting), 512):
        part = waiting[a : a + 512]
        patterns = [code_points(index.window(x[1])) for x in part]
        for x, got in zip(part, aligned(points, patterns, *([x[c] for x in part] for c in range(2, 7)))):
            if got is not None:
                note(x[0], x[1], *got)
    return best


def _keep(best: Best, key: tuple[int, int], got: tuple[bool, int, int, int]) -> None:
    if key not in best or got < best[key]:
        best[key] = got


def search(index: PassageIndex, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text number, item_id, start, end, edits) of ``occurrences``, in order."""
    for (k, item_id), (_, edits, start, end) in sorted(occurrences(index, texts).items(), key=lambda x: (x[0][0], str(x[0][1]))):
        yield k, item_id, start, end, edits


def stored_blocks(benchmark: DataFrame, edit_share: float = EDIT_SHARE) -> list[str]:
    """The files of the indexes of all items, in blocks of about ``BLOCK_CHARS`` characters, built and written by tasks.

    Only the names reach the driver. Equal items are one.
    """
    import pyarrow as pa

    items = narrow(benchmark, item_id="item_id", text="text").withColumn("item_id", F.col("item_id").cast("long"))
    items = items.where(F.length("text") > 0).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if not size:
        return []
    blocks = math.ceil(size / BLOCK_CHARS)
    folder = new_folder(benchmark.sparkSession, "passages")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    dealt = dealt.repartition(blocks, "block").sortWithinPartitions("block").select("block", "item_id", "text")

    def write(items_: list[tuple[int, str]]) -> str:
        path = new_file(folder, ".index")
        store, name = open_store(path)
        with store.open_output_stream(name) as out:
            out.write(pickle.dumps(PassageIndex(sorted(items_, key=repr), edit_share), protocol=5))
        return path

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(batch.column(k).to_pylist() for k in range(3))))
        for _, part in itertools.groupby(rows, key=lambda r: r[0]):
            yield pa.RecordBatch.from_arrays([pa.array([write([r[1:] for r in part])])], names=["path"])

    return sorted(r["path"] for r in dealt.mapInArrow(work, "path string").collect())


@lru_cache(maxsize=1)
def _block(path: str) -> PassageIndex:
    store, name = open_store(path)
    with store.open_input_stream(name) as source:
        return pickle.loads(source.read())


def _search_column(paths: list[str], texts) -> Best:
    """``occurrences`` of the items of all blocks in an Arrow string array, block by block, in portions of about ``BUFFER_CHARS``."""
    best: Best = {}
    for path in paths:
        index, held, size = _block(path), [], 0
        for i in range(len(texts)):
            text = texts[i].as_py()
            held.append(text)
            size += len(text or "")
            if size >= BUFFER_CHARS or i == len(texts) - 1:
                for (k, item_id), got in occurrences(index, held).items():
                    _keep(best, (i + 1 - len(held) + k, item_id), got)
                held, size = [], 0
    return best


def clean(docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` occurs; no row is moved for it."""
    import pyarrow as pa

    place = docs.columns.index("text")
    paths = stored_blocks(benchmark, edit_share)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[k for k, _ in _search_column(paths, batch.column(place))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(work, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, edit_share: float = EDIT_SHARE) -> DataFrame:
    """(doc_id, item_id, start, end, edits): every document row and benchmark item that occurs in it.

    Occurs: the item (up to ``WINDOW`` characters), or one window of a longer item, stands in the document's normal form with at most
    ``edit_share`` of its characters edited. Null or empty texts and items shorter than ``Q`` characters match
    nothing; repeated rows match each for itself, items with one id count as one. A task searches its documents for the
    items of one stored block after the other, so a row meets all blocks in one place, however many there are.
    """
    import pyarrow as pa

    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    names = [c.split()[0] for c in MATCH_SCHEMA.split(", ")]
    paths = stored_blocks(benchmark, edit_share)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            found = sorted(_search_column(paths, batch.column(1)).items(), key=repr)
            out = [(doc_ids[k], item_id, start, end, edits) for (k, item_id), (_, edits, start, end) in found]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in range(5)], names=names)

    return rows.mapInArrow(work, MATCH_SCHEMA)


def op10_decontam(spark, sf_dir: str) -> DataFrame:
    """Where benchmark items stand in documents."""
    return contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
