import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfweek.llm import langid, queries

SCHEMA = "doc_id bigint, text string, lang string, score string, vector int"
SYLLABLES = {"a": "ka lo mi ta ru", "b": "sch ung ein heit ver", "ç": "ção lh nh ões ém"}


def spoken(lang, words, chance):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(chance.choice(parts) for _ in range(chance.randint(1, 3))) for _ in range(words))


def test_learns_from_other_rows_only(spark):
    chance = random.Random(1)
    rows = [(i, spoken(lang, 30, chance), lang, "s", 1) for i, lang in enumerate("abç" * 30)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = langid.identify(docs, F.col("doc_id") < 45).collect()
    assert len(found) == 90 and all(r.lang_pred == r.lang for r in found)
    assert all(0 < r.score <= 1 for r in found)
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") < 45, F.col("lang")).otherwise("b"))
    again = langid.identify(wrong, F.col("doc_id") < 45).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in again) == sorted((r.doc_id, r.lang_pred) for r in found)


def test_odd_rows(spark):
    chance = random.Random(2)
    rows = [(i, spoken(lang, 50, chance), lang, "s", 1) for i, lang in enumerate("ab" * 5)]
    odd = [
        (100, None, "a", None, None), (101, "", "a", None, None), (102, "12 !? ́ ٣", "b", None, None),
        (None, "ka", None, None, None), (103, "x", None, None, None), (104, "ung ein " * 200_000, None, None, None),
        (105, "KALO MITA", None, None, None), (105, "KALO MITA", None, None, None),
    ]
    found = langid.identify(spark.createDataFrame(rows + odd, SCHEMA)).collect()
    assert len(found) == len(rows) + len(odd)
    got = {(r.doc_id, r.lang_pred) for r in found[len(rows) :]}
    assert got >= {(100, "und"), (101, "und"), (102, "und"), (None, "a"), (104, "b"), (105, "a")}
    assert all((r.score == 0) == (r.lang_pred == "und") or r.doc_id == 103 for r in found)
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.identify(empty).collect() == []
    unlabelled = spark.createDataFrame(odd[3:5], SCHEMA)
    assert {r.lang_pred for r in langid.identify(unlabelled).collect()} == {"und"}


def test_long_texts_are_sums_of_their_parts(monkeypatch):
    text = spoken("a", 3000, random.Random(3)) + " 12 " + spoken("ç", 10, random.Random(4))

    def total():
        sums = np.zeros((1, langid.DIMENSIONS))
        for _, pieces in langid._parts([text]):
            number, keys = langid.trigrams(pieces)
            sums += langid.bundle(np.zeros_like(number), keys, 1)
        return sums

    whole = total()
    monkeypatch.setattr(langid, "PART", 1000)
    parts = total()
    cosine = (whole @ parts.T).item() / np.linalg.norm(whole) / np.linalg.norm(parts)
    assert cosine > 0.9999


def test_trigrams_by_hand():
    number, keys = langid.trigrams(["ab c", "", "!", "d"])
    a, b, c, d = map(ord, "abcd")
    want = [(0, 0, a, b), (0, a, b, 0), (0, 0, c, 0), (3, 0, d, 0)]
    assert [(n, k >> 42, (k >> 21) & 0x1FFFFF, k & 0x1FFFFF) for n, k in zip(number.tolist(), keys.tolist())] == want


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = queries.op1_language_id(spark, "/root/testdata/sf0.01")
    held = found.where("held_out").join(docs, "doc_id").collect()
    assert len(held) > 200
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.99


@pytest.mark.parametrize("held_out", [2])
def test_fold_is_the_checksum_of_the_id(spark, held_out):
    found = queries.op1_language_id(spark, "/root/testdata/sf0.001").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == held_out) for r in found)


def plain_vector(text):
    """The sum of a text's trigram vectors, and their number, letter by letter."""
    symbols = [0]
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(ord(c))
        elif symbols[-1]:
            symbols.append(0)
    symbols += [0] if symbols[-1] else []
    times = Counter(t for t in zip(symbols, symbols[1:], symbols[2:]) if t[1])
    total = np.zeros(langid.DIMENSIONS)
    for (a, b, c), n in times.items():
        first, second, third = (langid.symbol(x).astype(int) for x in (a, b, c))
        total += n * np.roll(first, 2) * np.roll(second, 1) * third
    return total, sum(times.values())


def plain_languages(rows, learn):
    """(language, cosine) per text, from prototypes that add up texts of one weight each."""
    vectors = [plain_vector(text) for text, _ in rows]
    sums = {}
    for (vector, n), (_, lang), use in zip(vectors, rows, learn):
        if use and lang is not None and n:
            sums[lang] = sums.get(lang, 0) + vector / n
    names = sorted(sums, key=lambda s: s.encode())
    unit = np.array([sums[n] / np.linalg.norm(sums[n]) for n in names])
    shared = unit.mean(axis=0)
    shared /= np.linalg.norm(shared)
    own = [u - (u @ shared) * shared for u in unit]
    found = []
    for vector, n in vectors:
        if not n:
            found.append(("und", 0.0))
            continue
        rest = vector - (vector @ shared) * shared
        best = max(range(len(names)), key=lambda k: rest @ own[k] / np.linalg.norm(own[k]))
        found.append((names[best], max(0.0, vector @ unit[best] / np.linalg.norm(vector))))
    return found


def test_query_against_plain_vectors(spark):
    """Every row of the query, worked out letter by letter."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    learn = [zlib.crc32(str(d.doc_id).encode()) % 4 != 2 for d in docs]
    want = dict(zip((d.doc_id for d in docs), plain_languages([(d.text, d.lang) for d in docs], learn)))
    got = {r.doc_id: r for r in queries.op1_language_id(spark, folder).collect()}
    assert got.keys() == want.keys()
    for doc, (lang, cosine) in want.items():
        assert got[doc].lang_pred == lang and got[doc].score == pytest.approx(cosine, abs=1e-5)


def test_a_long_text_weighs_as_much_as_a_short_one(monkeypatch):
    """Whatever the number of its pieces."""
    chance = random.Random(5)
    texts = [spoken("a", 4000, chance), spoken("b", 20, chance), spoken("a", 30, chance)]
    monkeypatch.setattr(langid, "PART", 1000)
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(["l"] * 3)], names=["text", "lang"])
    (learnt,) = langid._learn([batch])
    want = sum(vector / n for vector, n in map(plain_vector, texts))
    got = np.array(learnt.column("vector").to_pylist()[0])
    # Pieces cut words, so a few trigrams at the cuts differ.
    assert np.linalg.norm(got - want) < 0.02 * np.linalg.norm(want)


def test_a_column_of_very_many_languages_is_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 5)
    docs = spark.createDataFrame([(i, "ka lo", f"l{i}", "s", 1) for i in range(6)], SCHEMA)
    with pytest.raises(ValueError, match="more than 5"):
        langid.identify(docs)
    assert langid.identify(docs.limit(5)).count() == 5
