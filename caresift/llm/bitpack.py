"""Token ids at fixed width: every id takes the fewest bits that the vocabulary needs.

File layout (little-endian): an 8-byte magic, then blocks of ``BLOCK_IDS`` ids
each, every block starting on a byte; a footer of the document table (doc_id, null flag, first id
in the file) and the block offsets; last a fixed tail with the counts and the place of the footer. Any
document is read by seeking to the blocks that hold it, and a block is unpacked by numpy at once.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from caresift.llm.store import new_file, new_folder, open_store
from caresift.llm.tables import narrow, read
from caresift.session import materialize

MAGIC = b"CSBITS01"
TAIL = struct.Struct("<QQQIIQ")  # footer offset, ids, documents, bits, ids a block, blocks
BLOCK_IDS = 1 << 16
#: A file is closed when it holds this many ids, or documents.
FILE_IDS, FILE_DOCS = 1 << 28, 1 << 20
#: Words in each of the two generations that a worker remembers the ids of.
CACHE_WORDS = 300_000
#: Bytes of texts encoded at once; a longer text is encoded alone.
ENCODE_BYTES = 2 << 20
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
FILE_SCHEMA = "file string, bytes long, first_doc long, documents long, ids long, bits int"
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` (below 2**bits) as a stream of ``bits``-wide fields, lowest bit first."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    fields = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(fields.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(block: bytes, count: int, bits: int) -> np.ndarray:
    if bits == 16:
        return np.frombuffer(block, "<u2", count).astype("<u4")
    flat = np.unpackbits(np.frombuffer(block, np.uint8), count=count * bits, bitorder="little")
    weights = (1 << np.arange(bits, dtype=np.uint64)).astype(np.uint64)
    return (flat.reshape(count, bits).astype(np.uint64) @ weights).astype("<u4")


class PackedWriter:
    """Appends documents to one file; holds at most one block of ids and the document table."""

    def __init__(self, stream, bits: int, block_ids: int = BLOCK_IDS):
        self.stream, self.bits, self.block_ids = stream, bits, block_ids
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.offsets: list[int] = []
        self.ids, self.position, self.waiting, self.waiting_ids = 0, len(MAGIC), [], 0
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.waiting_ids += len(ids)
        if self.waiting_ids >= self.block_ids:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        end = len(rest) if last else len(rest) - len(rest) % self.block_ids
        for a in range(0, end, self.block_ids):
            packed = pack(rest[a : min(a + self.block_ids, end)], self.bits)
            self.offsets.append(self.position)
            self.stream.write(packed)
            self.position += len(packed)
        self.waiting, self.waiting_ids = [rest[end:]], len(rest) - end

    def close(self) -> None:
        self._flush(True)
        self.offsets.append(self.position)
        docs = np.array([x or 0 for x in self.doc_ids], "<i8")
        nulls = np.array([x is None for x in self.doc_ids], np.uint8)
        for part in (docs, nulls, np.array(self.starts, "<u8"), np.array(self.offsets, "<u8")):
            self.stream.write(part.tobytes())
        self.stream.write(
            TAIL.pack(self.position, self.ids, len(self.doc_ids), self.bits, self.block_ids, len(self.offsets) - 1)
        )
        self.stream.close()
        self.position += 17 * len(docs) + 8 * len(self.offsets) + TAIL.size


class PackedReader:
    """Random access to the documents of one file."""

    def __init__(self, stream):
        self.stream = stream
        stream.seek(stream.size() - TAIL.size)
        footer, self.ids, n, self.bits, self.block_ids, blocks = TAIL.unpack(stream.read(TAIL.size))
        stream.seek(0)
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a packed id file")
        stream.seek(footer)
        self.doc_ids = np.frombuffer(stream.read(8 * n), "<i8")
        self.nulls = np.frombuffer(stream.read(n), np.uint8)
        self.starts = np.append(np.frombuffer(stream.read(8 * n), "<u8"), self.ids).astype(np.int64)
        self.offsets = np.frombuffer(stream.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self._held: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def __len__(self) -> int:
        return len(self.doc_ids)

    def block(self, k: int) -> np.ndarray:
        if self._held[0] != k:
            self.stream.seek(int(self.offsets[k]))
            count = min(self.block_ids, self.ids - k * self.block_ids)
            self._held = (k, unpack(self.stream.read(int(self.offsets[k + 1] - self.offsets[k])), count, self.bits))
        return self._held[1]

    def pieces(self, i: int) -> Iterator[np.ndarray]:
        """The ids of document ``i``, block by block."""
        start, end = int(self.starts[i]), int(self.starts[i + 1])
        for k in range(start // self.block_ids, -(-end // self.block_ids)):
            base = k * self.block_ids
            yield self.block(k)[max(0, start - base) : end - base]

    def document(self, i: int) -> np.ndarray:
        return np.concatenate([np.empty(0, "<u4"), *self.pieces(i)])


#: A piece that can be cut off: visible at both ends, but for one line break before it.
_APART = re.compile(r"\n?\S(?:.*\S)?", re.DOTALL)
_PLAIN = re.compile(r"\n?[^\s<]+")
#: Latin letters, then marks: the tokenizer cuts between them. A pattern for Arrow.
_LETTERS_MARKS = r"""\A(?P<word>\n?[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)(?P<mark>[!"#$%&()*+,./:;=?@|-]+)\z"""


class CachedEncoder:
    """Ids of whole texts, the same as the tokenizer's, with the ids of repeated words remembered.

    For the byte-level tokenizer a token never reaches over a single blank, or a single line break,
    between two visible characters: the blank belongs to the word after it, the break stands alone. So texts are cut
    there and marks cut off from the words before them, new words are encoded by the library, and
    the others looked up. A text in which white
    space meets white space, and every text under another tokenizer, goes to the library whole. The memory has two
    generations: when the younger is full it becomes the older, and words met again come back into the younger.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = cache_words
        kind = self.tokenizer.pre_tokenizer
        self.newline = self._whole("\n")
        self.by_word = (
            type(kind).__name__ == "ByteLevel"
            and not kind.add_prefix_space
            and self.tokenizer.normalizer is None
            and len(self.newline) == 1
        )
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}

    def forget(self) -> None:
        """Empties the memory of words, so that a worker does not hold it through later stages."""
        self.known, self.older, self.marks = {}, {}, {}

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn_plain(self, plain: list[str]) -> None:
        """Many pieces in one text: each begins with a line break, or with a blank and ends with a break."""
        for begins in (True, False):
            group = [p for p in plain if (p[0] == "\n") == begins]
            parts = [group[a : a + 512] for a in range(0, len(group), 512)]
            texts = ["".join(part) if begins else " " + "\n ".join(part) + "\n" for part in parts]
            for part, got in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(got.ids, "<u4")
                cuts = np.flatnonzero(ids == self.newline[0])
                if len(cuts) != len(part):
                    raise ValueError("the tokenizer does not keep line breaks apart")
                raw, at = ids.tobytes(), (4 * cuts).tolist()
                spans = map(slice, at, [*at[1:], len(raw)]) if begins else map(slice, [0, *(x + 4 for x in at)], at)
                self.known.update(zip(part, map(raw.__getitem__, spans)))

    def _recall(self, piece: str) -> bool:
        ids = self.older.get(piece)
        if ids is not None:
            self.known[piece] = ids
        return ids is not None

    def _learn(self, pieces: list[str]) -> None:
        pieces = [p for p in pieces if not self._recall(p)]
        self._learn_plain([p for p in pieces if _PLAIN.fullmatch(p)])
        for piece in pieces:
            if piece not in self.known and _APART.fullmatch(piece):
                self.known[piece] = self._whole(piece if piece[0] == "\n" else " " + piece).tobytes()

    def _ids(self, pieces) -> list[bytes | None]:
        """The ids of every piece of an Arrow array; none for a piece that cannot be cut off."""
        import pyarrow.compute as pc

        split = pc.extract_regex(pieces, _LETTERS_MARKS)
        mark = pc.struct_field(split, "mark")
        words = pc.coalesce(pc.struct_field(split, "word"), pieces).dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, names))
        if None in found:
            self._learn([p for p, f in zip(names, found) if f is None])
            found = [self.known.get(p) if f is None else f for p, f in zip(names, found)]
        out = list(map(found.__getitem__, words.indices.to_numpy().tolist()))
        marked = mark.is_valid().to_numpy(zero_copy_only=False)
        marks = mark.drop_null().dictionary_encode()
        names = marks.dictionary.to_pylist()
        self.marks.update((m, self._whole(m).tobytes()) for m in names if m not in self.marks)
        ends = list(map(self.marks.get, names))
        for i, k in zip(np.flatnonzero(marked).tolist(), marks.indices.to_numpy().tolist()):
            out[i] += ends[k]
        return out

    def encode(self, texts) -> list[np.ndarray]:
        """The ids of every text of an Arrow string array (null: none)."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = pc.fill_null(texts, "")
        if not self.by_word:
            whole = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return [np.array(e.ids, "<u4") for e in whole]
        if len(self.known) > self.limit:
            self.known, self.older, self.marks = {}, self.known, {}
        broken = pc.replace_substring(texts, "\n", " \n").cast(pa.large_string())
        ends = [pa.scalar(x, broken.type) for x in ("\n", "")]
        lists = pc.split_pattern(pc.binary_join_element_wise(ends[0], broken, ends[1]), " ")
        words = lists.flatten().dictionary_encode()
        found, index = self._ids(words.dictionary), words.indices.to_numpy()
        apart = np.array([f is not None for f in found], bool)
        flat = np.frombuffer(b"".join(f or b"" for f in found), "<u4")
        sizes = np.array([len(f or b"") // 4 for f in found], np.int64)
        counts, starts = sizes[index], (np.cumsum(sizes) - sizes)[index]
        ends = np.cumsum(counts)
        ids = flat[np.repeat(starts - (ends - counts), counts) + np.arange(counts.sum())]
        bounds = np.append(0, ends)[np.asarray(lists.offsets)]
        out = [ids[a + 1 : b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        if not apart.all():
            first = np.asarray(lists.offsets)
            for i in np.flatnonzero(np.logical_and.reduceat(apart[index], first[:-1]) == 0).tolist():
                out[i] = self._whole(texts[i].as_py())
        return out


def _portions(batch) -> Iterator:
    """A batch of (doc_id, text) in slices of about ``ENCODE_BYTES`` bytes of text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    portion = np.cumsum(sizes, dtype=np.int64) // ENCODE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(portion)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """One encoder for each worker process and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


def write_packed(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encodes every text, appends ``end_id`` and writes the ids in ascending doc_id order.

    ``docs`` has doc_id and text; other columns are ignored, a null text is empty, a
    null doc_id comes first, and repeated ids are ordered by a hash of their text. Rows are
    spread by ranges of both, so one repeated id can be spread too. Returns the table of files in
    order with ``base``, the number of ids in all files before; an empty table gives no file.
    """
    import pyarrow as pa

    rows = narrow(docs, doc_id="doc_id", text="text").withColumn("doc_id", F.col("doc_id").cast("long"))
    folder = new_folder(docs.sparkSession, "packed")
    names = [c.split()[0] for c in FILE_SCHEMA.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, done, writer, name = encoder(tokenizer_path), [], None, None
        bits, end = bits_for(max(coder.vocabulary, end_id + 1)), np.array([end_id], "<u4")

        def finish() -> None:
            writer.close()
            first = writer.doc_ids[0]
            done.append((name, writer.position, first, len(writer.doc_ids), writer.ids, bits))

        for batch in batches:
            for part in _portions(batch):
                for doc_id, ids in zip(part.column(0).to_pylist(), coder.encode(part.column(1))):
                    if writer is None:
                        name = new_file(folder, ".bits")
                        store, path = open_store(name)
                        writer = PackedWriter(store.open_output_stream(path), bits)
                    writer.add(doc_id, np.concatenate([ids, end]))
                    if writer.ids >= FILE_IDS or len(writer.doc_ids) >= FILE_DOCS:
                        finish()
                        writer = None
        if writer is not None:
            finish()
        coder.forget()
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(types)], names=names)

    ordered = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange("doc_id", "tie")
    ordered = ordered.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = ordered.mapInArrow(write, FILE_SCHEMA)
    files = files.withColumn("place", F.monotonically_increasing_id())
    return file_bases(materialize(files, "packed-files"))


def file_bases(files: DataFrame) -> DataFrame:
    """Adds the ids in all earlier files: a running sum over the files, of which there are few."""
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)).cast("long"))


def read_packed(files: DataFrame) -> DataFrame:
    """Every document of the files: its place among all ids, its length and the checksum of its ids."""
    import pyarrow as pa

    names = [c.split()[0] for c in DOC_SCHEMA.split(", ")]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = open_store(name)
                with store.open_input_file(path) as stream:
                    packed = PackedReader(stream)
                    for a in range(0, len(packed), 10_000):
                        yield _documents(packed, base, a, min(a + 10_000, len(packed)))

    def _documents(packed: PackedReader, base: int, a: int, b: int) -> pa.RecordBatch:
        sums = []
        for i in range(a, b):
            crc = 0
            for ids in packed.pieces(i):
                crc = zlib.crc32(ids.tobytes(), crc)
            sums.append(crc)
        doc_ids = pa.array(packed.doc_ids[a:b], pa.int64(), mask=packed.nulls[a:b].astype(bool))
        starts = packed.starts[a : b + 1]
        columns = [doc_ids, pa.array(base + starts[:-1]), pa.array(np.diff(starts)), pa.array(sums, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=names)

    count = max(1, files.count())
    return files.select("file", "base").repartition(count, "file").mapInArrow(fetch, DOC_SCHEMA)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode_table(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Written in the format and read back."""
    return read_packed(write_packed(docs, path or tokenizer_path()))


def op6_bitpack(spark, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, from the written files."""
    return encode_table(read(spark, sf_dir, "documents"))
