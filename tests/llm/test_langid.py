"""Language profiles on literal cases and on held-out documents."""

import zlib
from collections import Counter

import pytest
from tests.conftest import DATA

from caresift.llm import langid


def brute_counts(text):
    grams = Counter()
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    for word in letters.split():
        spelled = f" {word} "
        for n in (1, 2, 3):
            for k in range(len(spelled) - n + 1):
                if (g := spelled[k : k + n]).strip():
                    grams[g] += 1
    return grams


def spelled(code):
    out = ""
    while code:
        out = chr(code & 0x1FFFFF) + out
        code >>= 21
    return out


@pytest.mark.parametrize("text", ["", "1 2 3", "Don't stop. ÄÖ äö!", "a bb a bb", "日本 語x", "x" * 5000 + " y"])
def test_counts(text):
    codes, counts = langid.gram_counts(text)
    assert {spelled(c): n for c, n in zip(codes.tolist(), counts.tolist())} == {
        g: n for g, n in brute_counts(text).items() if not (len(g) == 3 and g[1] == " ")
    }


def test_distance_against_plain_python():
    size = 50
    texts = {"a": "the cat and the dog and that", "b": "der hund und die katze und das"}
    rankings = {k: langid.ranking(*langid.gram_counts(t), size) for k, t in texts.items()}
    profiles = langid.Profiles(rankings, size)
    for text in ("the dog", "die katze das", "zzz", "und and"):
        own = langid.ranking(*langid.gram_counts(text), size).tolist()
        far = {}
        for k, r in rankings.items():
            places = {g: i for i, g in enumerate(r.tolist())}
            far[k] = sum(abs(places[g] - i) if g in places else size for i, g in enumerate(own))
        best = min(sorted(far), key=far.get)
        assert profiles.predict(text) == (best, pytest.approx(1 - far[best] / (size * len(own))))


def test_no_letters_no_language(spark):
    rows = [(1, None, "en", 1), (2, "12 !", "en", 1), (3, "", None, 1), (4, "the and of", "en", 1), (None, "the", "en", 1), (4, "the and of", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = langid.predict(docs, langid.fit(docs)).collect()
    assert Counter((r["doc_id"], r["lang_pred"]) for r in got) == Counter(
        {(1, "und"): 1, (2, "und"): 1, (3, "und"): 1, (4, "en"): 2, (None, "en"): 1}
    )
    assert all(0 <= r["score"] <= 1 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in langid.predict(docs, langid.fit(docs)).collect()] == [(1, "und", 0.0)]
    assert langid.predict(docs.limit(0), langid.fit(docs.limit(0))).count() == 0


def test_held_out_rule(spark):
    ids = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long")
    for r in ids.select("doc_id", langid.held_out().alias("h")).collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)


def test_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    found = langid.op2_langid(spark, f"{DATA}/sf0.01")
    joined = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in joined) > 0.97 * len(joined)
