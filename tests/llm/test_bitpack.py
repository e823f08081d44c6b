"""Packed ids against the tokenizer itself, and the file format by random access."""

import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from caresift.llm import bitpack

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "\n", "a  b", " a", "a ", "a\nb c", "\na", "a\n", "x <|endoftext|> y", "<|endoftext|>", "a <|endoftext|>b c\n\nd  e",
    "don't it's I'll 'll", "日本 語 テ　スト a", "a \u0085b c", "é \x1c x", "a<b c< d", "x\x1dy\tz \t w", "word.'s foo!!!bar ###",
    "Ünïcode wörds, ÀÉ. \U0001f600 ok", "tail\n \nmore", "a" * 4000, "in, of the inanin. " * 2000,
]


@pytest.mark.parametrize("bits", [1, 5, 13, 16, 17, 20, 31])
def test_pack(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1001).astype("<u4")
    packed = bitpack.pack(ids, bits)
    assert len(packed) == -(-1001 * bits // 8)
    assert (bitpack.unpack(packed, 1001, bits) == ids).all()


def test_bits_for():
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


class Kept(io.BytesIO):
    def close(self):
        self.whole = self.getvalue()
        super().close()


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_random_access(block):
    draw = np.random.default_rng(block)
    docs = [(None if i == 3 else i, draw.integers(0, 5000, int(n)).astype("<u4")) for i, n in enumerate(draw.integers(0, 50, 40))]
    stream = Kept()
    writer = bitpack.PackedWriter(stream, 13, block)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    assert writer.position == len(stream.whole)
    reader = bitpack.PackedReader(pa.BufferReader(stream.whole))
    assert len(reader) == 40
    for i in draw.permutation(40):
        assert (reader.document(i) == docs[i][1]).all()
    assert reader.nulls.tolist() == [int(i == 3) for i in range(40)]


def test_encoder_is_the_tokenizer():
    plain = Tokenizer.from_file(PATH)
    coder = bitpack.CachedEncoder(PATH, cache_words=50)
    assert coder.by_word
    for _ in range(3):
        got = coder.encode(pa.array(TEXTS))
        assert [g.tolist() for g in got] == [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    assert coder.encode(pa.array([], pa.string())) == []


def test_a_word_is_remembered_once_whatever_marks_follow():
    plain = Tokenizer.from_file(PATH)
    coder = bitpack.CachedEncoder(PATH)
    texts = ["étude, étude. étude?! étude\nétude; (étude) étude'", "étude<, a\u00a0b, x\u0085. \u2003, ŉa, ɏ: ɐ: ×, ÷. a-b, --"]
    got = coder.encode(pa.array(texts))
    assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert "étude" in coder.known and not {"étude,", "étude.", "étude?!", "\nétude;"} & set(coder.known)


def test_drawn_texts_are_the_tokenizers():
    plain, draw = Tokenizer.from_file(PATH), np.random.default_rng(5)
    bits = [" ", " ", "\n", "  ", "\t", "word", "Zoë", "ß", "'s", "don't", ",", "...", "?!", "-", "<", "_", "7", "\u00a0", "\u200b", "\x00", "語", "ﬁ", "×"]
    texts = ["".join(bits[k] for k in draw.integers(0, len(bits), int(n))) for n in draw.integers(0, 30, 3000)]
    coder = bitpack.CachedEncoder(PATH, cache_words=200)
    for a in range(0, len(texts), 300):
        got = coder.encode(pa.array(texts[a : a + 300]))
        assert [g.tolist() for g in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts[a : a + 300]]


def test_other_tokenizer_goes_whole():
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = bitpack.CachedEncoder(path)
    assert not coder.by_word
    texts = ["Hello  World", None, "a\nb"]
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [g.tolist() for g in coder.encode(pa.array(texts))] == want


def test_files_against_plain_encoding(spark):
    rows = [(7 * (i % 23) - 20, t, f"s{i}", 0) for i, t in enumerate(TEXTS * 3)] + [(None, "no id", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start string, ids int").repartition(7)
    got = sorted((tuple(r) for r in bitpack.encode_table(docs).collect()), key=lambda r: r[1])
    plain = Tokenizer.from_file(PATH)
    order = [r[0] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    place, left = 0, {}
    for doc_id, text, *_ in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        left.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for doc_id, start, n, crc in got:
        assert start == place
        place += n
        left[doc_id].remove((n, crc))
    assert not any(left.values())


def test_empty_table(spark):
    assert bitpack.encode_table(spark.createDataFrame([], "doc_id long, text string")).count() == 0
