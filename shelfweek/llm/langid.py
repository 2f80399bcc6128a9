"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the elementwise
product of its letters' vectors, rotated by their place; a text is the sum
of its trigrams' vectors, a language the sum of its texts, each divided by its
number of trigrams. A document gets the language whose prototype
has the largest cosine with the document's vector, once the sum of all
prototypes, which holds what the languages share, has been taken out of both.

Letters are lowered, and every run of other characters is one blank symbol.

A cosine cannot tell a text of no learnt language, as unlike vectors are only
nearly at right angles. For that the trigrams themselves are counted: see
``common_trigrams`` and ``Common.unlike``.
"""

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import plainly, quoted, renamed, small_batches

UNKNOWN = "und"
DIMENSIONS = 1024
# Characters handled at a time: a longer text is a sum over its parts.
PART = 1 << 18
# Trigrams whose vectors are held at a time.
TRIGRAMS = 4096
# Languages whose sums a task holds before it passes them on.
HELD = 256
MOST_LANGUAGES = 10_000
# Common trigrams of a language: they make up this share of its texts together, are in
# more than one text, and are this many at most, told apart by so many bits of a hash.
SHARE = 0.9
COMMON = 1 << 14
BITS = 20
# A text of a language has at least this share of the common trigrams that the language has
# on the whole; it is unlike if it has so many standard deviations less.
LEAST = 0.5
DEVIATIONS = 4.0


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """True for code points that are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=4096)
def symbol(code: int) -> np.ndarray:
    return np.random.default_rng([7, code]).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1


def bind(keys: np.ndarray) -> np.ndarray:
    """Vectors of the trigrams, as float rows."""
    codes, at = np.unique(
        np.stack([keys >> 42, (keys >> 21) & 0x1FFFFF, keys & 0x1FFFFF]), return_inverse=True
    )
    letters = np.stack([symbol(int(c)) for c in codes])
    first, second, third = at.reshape(3, -1)
    turned = np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second]
    return (turned * letters[third]).astype(np.float32)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, trigram) of every trigram; texts without letters have none."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    number = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(codes)]
    codes = np.where(letter_table()[codes], codes, 0)
    # One blank per gap; the joints give every text a blank at both ends.
    keep = (codes != 0) | np.append(codes[1:] != 0, False) | (np.append(number[1:], -1) != number)
    keep &= (codes != 0) | np.concatenate(([True], codes[:-1] != 0)) | keep
    codes, number = codes[keep], number[keep]
    codes = np.concatenate(([0], codes, [0]))
    middle = codes[1:-1] != 0
    key = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
    return number[middle], key[middle]


def _parts(texts: list[str | None]):
    """Groups of (text number, lowered piece).

    The pieces of a text longer than PART are groups of their own, which overlap
    by two characters.
    """
    numbers, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        if pieces and size + len(text) > PART:
            yield np.array(numbers), pieces
            numbers, pieces, size = [], [], 0
        for at in range(0, len(text), PART):
            piece = text[max(0, at - 2) : at + PART].lower()
            if len(text) > PART:
                yield np.array([i]), [piece]
                continue
            numbers.append(i)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield np.array(numbers), pieces


def bundle(number: np.ndarray, keys: np.ndarray, rows: int, weights=None) -> np.ndarray:
    """Sums of the trigram vectors, weighted if so wished, per number below ``rows``."""
    sums = np.zeros((rows, DIMENSIONS), np.float32)
    code, distinct = pd.factorize(keys)
    order = np.argsort(code, kind="stable") if len(distinct) > TRIGRAMS else None
    if order is not None:
        code, number = code[order], number[order]
        weights = None if weights is None else weights[order]
    for at in range(0, len(distinct), TRIGRAMS):
        to = min(at + TRIGRAMS, len(distinct))
        a, b = (0, len(code)) if order is None else np.searchsorted(code, [at, to])
        cell = number[a:b] * (to - at) + (code[a:b] - at)
        own = None if weights is None else weights[a:b]
        counts = np.bincount(cell, own, rows * (to - at)).reshape(rows, to - at)
        sums += counts.astype(np.float32) @ bind(distinct[at:to])
    return sums


def _learn(batches):
    sums: dict[str, np.ndarray] = {}

    def flush():
        names = list(sums)
        vectors = pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))
        sums.clear()
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), vectors], names=["lang", "vector"])

    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        # Sums and numbers of trigrams of the texts that come in several pieces.
        long: dict[int, np.ndarray] = {}
        total: dict[int, int] = {}
        for own, pieces in _parts(texts):
            number, keys = trigrams(pieces)
            if len(texts[own[-1]]) > PART and len(own) == 1:
                vector = bundle(number, keys, 1)[0].astype(np.float64)
                long[own[0]] = long.get(own[0], 0) + vector
                total[own[0]] = total.get(own[0], 0) + len(keys)
                continue
            names, code = np.unique([langs[i] for i in own], return_inverse=True)
            # Every text counts alike, so that long ones do not drown the others.
            weights = (1 / np.maximum(np.bincount(number, minlength=len(own)), 1))[number]
            for name, vector in zip(names, bundle(code[number], keys, len(names), weights)):
                sums[str(name)] = sums.get(str(name), 0) + vector.astype(np.float64)
            if len(sums) >= HELD:
                yield flush()
        for i, vector in long.items():
            sums[langs[i]] = sums.get(langs[i], 0) + vector / max(total[i], 1)
    if sums:
        yield flush()


def prototypes(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit vectors, from all rows (text, lang).

    One vector of DIMENSIONS numbers per distinct language reaches the driver, so
    more than MOST_LANGUAGES values, which no column of languages has, are an error.
    """
    if labelled.select("lang").distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"the language column has more than {MOST_LANGUAGES} values")
    sums = (
        labelled.mapInArrow(_learn, "lang string, vector array<double>")
        .select("lang", F.posexplode("vector").alias("at", "x"))
        .groupBy("lang", "at")
        .agg(F.sum("x").alias("x"))
        .groupBy("lang")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("vector"))
        .orderBy("lang")
        .collect()
    )
    if not sums:
        return [], np.zeros((0, DIMENSIONS))
    vectors = np.array([r["vector"] for r in sums])
    return [r["lang"] for r in sums], vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-30)[:, None]


def classify(sums: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best prototype per row and the cosine with it, without the part that all share."""
    shared = vectors.mean(axis=0)
    shared = shared / max(np.linalg.norm(shared), 1e-30)
    if len(vectors) > 1:
        own = vectors - np.outer(vectors @ shared, shared)
        rest = sums - np.outer(sums @ shared, shared)
        own = own / np.maximum(np.linalg.norm(own, axis=1), 1e-30)[:, None]
        best = (rest @ own.T).argmax(axis=1)
    else:
        best = np.zeros(len(sums), int)
    cosine = np.einsum("ij,ij->i", sums, vectors[best]) / np.maximum(np.linalg.norm(sums, axis=1), 1e-30)
    return best, np.clip(cosine, 0, 1)


def hashed(keys: np.ndarray) -> np.ndarray:
    return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)


def _counts(batches):
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        cells = times = np.zeros(0, np.int64)
        for own, pieces in _parts(batch.column("text").to_pylist()):
            number, keys = trigrams(pieces)
            cells = np.concatenate([cells, own[number] << BITS | hashed(keys)])
            cells, at = np.unique(cells, return_inverse=True)
            times = np.bincount(at, np.append(times, np.ones(len(keys), np.int64)), len(cells)).astype(np.int64)
            # The last text may go on in the next group.
            still = cells >> BITS == own[-1]
            yield from _counted(cells[~still], times[~still], langs)
            cells, times = cells[still], times[still]
        yield from _counted(cells, times, langs)


def _counted(cells, times, langs):
    """Per language and hash: texts that hold it, and the sum of its shares in them in units of 2^-30."""
    if len(cells):
        text = cells >> BITS
        shares = np.round(times / np.bincount(text, times)[text] * (1 << 30)).astype(np.int64)
        names, code = np.unique(langs, return_inverse=True)
        cell, at = np.unique(code[text] << BITS | cells & (1 << BITS) - 1, return_inverse=True)
        sums = np.zeros(len(cell), np.int64)
        np.add.at(sums, at, shares)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(names[cell >> BITS].tolist(), pa.string()), pa.array(cell & (1 << BITS) - 1),
                pa.array(np.bincount(at)), pa.array(sums),
            ],
            names=["lang", "hash", "texts", "share"],
        )


class Common:
    """The common trigrams of languages, as bits, and the share that they make up."""

    def __init__(self, names: list[str], rows):
        self.bits = np.zeros((len(names), 1 << BITS - 3), np.uint8)
        self.share = np.zeros(len(names))
        for name, hashes, share in rows:
            code, at = names.index(name), np.array(hashes)
            np.bitwise_or.at(self.bits[code], at >> 3, (1 << 7 - (at & 7)).astype(np.uint8))
            self.share[code] = share

    def has(self, code, keys: np.ndarray) -> np.ndarray:
        at = hashed(keys)
        return self.bits[code, at >> 3] >> (7 - (at & 7)) & 1

    def unlike(self, code, hits, total, distinct) -> np.ndarray:
        """Whether so few of a text's trigrams are common ones that chance does not explain it.

        The deviation is that of as many draws as the text has distinct trigrams.
        """
        least = LEAST * self.share[code]
        return hits / total < least - DEVIATIONS * np.sqrt(least * (1 - least) / distinct)


def common_trigrams(labelled: DataFrame, names: list[str]) -> Common:
    """Common trigrams of the languages, from all rows (text, lang); every text counts alike.

    COMMON hashes per language at most reach the driver. A language without a
    trigram that two texts share has none, and no text is unlike it.
    """
    counts = (
        labelled.mapInArrow(_counts, "lang string, hash long, texts long, share long")
        .groupBy("lang", "hash")
        .agg(F.sum("texts").alias("texts"), F.sum(F.col("share").cast("decimal(30,0)")).alias("share"))
    )
    own = Window.partitionBy("lang")
    order = own.orderBy((F.col("texts") > 1).desc(), F.desc("share"), "hash")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    kept = (
        counts.withColumn("all", F.sum("share").over(own))
        .withColumn("before", F.coalesce(F.sum("share").over(before), F.lit(0)))
        .withColumn("place", F.row_number().over(order))
        .where((F.col("texts") > 1) & (F.col("before") < F.lit(SHARE) * F.col("all")) & (F.col("place") <= COMMON))
        .groupBy("lang")
        .agg(F.collect_list("hash").alias("hashes"), F.sum(F.col("share").cast("double") / F.col("all").cast("double")).alias("share"))
    )
    return Common(names, [(r["lang"], r["hashes"], r["share"]) for r in kept.collect()])


def _predict(
    names: list[str], vectors: np.ndarray, keep: list[str], body: str, added: list[str],
    common: Common | None = None,
):
    """Adds the columns ``added``: language, cosine and, with ``common``, unlike."""
    table = np.array([*names, UNKNOWN], object)

    def predict(batches):
        for batch in batches:
            texts = batch.column(body).to_pylist()
            best = np.full(len(texts), len(names))
            score = np.zeros(len(texts))
            unlike = np.zeros(len(texts), bool)
            if names:
                long: dict[int, np.ndarray] = {}
                found: dict[int, tuple] = {}
                for own, pieces in _parts(texts):
                    number, keys = trigrams(pieces)
                    lettered = np.unique(number)
                    if not len(lettered):
                        continue
                    sums = bundle(np.searchsorted(lettered, number), keys, len(lettered))
                    rows = own[lettered]
                    whole = np.array([len(texts[i]) <= PART for i in rows])
                    if whole.any():
                        best[rows[whole]], score[rows[whole]] = classify(sums[whole], vectors)
                    for i, vector in zip(rows[~whole], sums[~whole]):
                        long[i] = long.get(i, 0) + vector.astype(np.float64)
                    if common and whole.any():
                        own_text = np.searchsorted(lettered, number)
                        mine = whole[own_text]
                        hits = np.bincount(
                            own_text[mine], common.has(best[own[number[mine]]], keys[mine]), len(lettered)
                        )
                        cells = np.unique(own_text << BITS | hashed(keys)) >> BITS
                        distinct = np.bincount(cells, minlength=len(lettered))
                        total = np.bincount(own_text, minlength=len(lettered))
                        unlike[rows[whole]] = common.unlike(
                            best[rows[whole]], hits[whole], total[whole], distinct[whole]
                        )
                    for n in lettered[~whole] if common else ():
                        # The language of a long text is known at its end only.
                        part, times = np.unique(keys[number == n], return_counts=True)
                        hits = np.array([common.has(code, part) @ times for code in range(len(names))])
                        sums_before, total, distinct = found.get(own[n], (0, 0, 0))
                        found[own[n]] = (sums_before + hits, total + times.sum(), max(distinct, len(part)))
                for i, vector in long.items():
                    (best[i],), (score[i],) = classify(vector[None], vectors)
                    if common:
                        hits, total, distinct = found[i]
                        unlike[i] = common.unlike(best[i], hits[best[i]], total, distinct)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in keep], pa.array(table[best].tolist(), pa.string()), pa.array(score),
                    *([pa.array(unlike)] if common else []),
                ],
                names=[*keep, *added],
            )

    return predict


def identify(
    docs: DataFrame,
    learn_from: Column | None = None,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    keep: list[str] | None = None,
    pred_col: str = "lang_pred",
    score_col: str = "score",
    unlike_col: str | None = None,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``pred_col`` and ``score_col`` added.

    Prototypes are learnt from all rows with a language that satisfy
    ``learn_from``; predictions see the text alone. The prediction is ``und``
    with score 0 where the text is null or has no letter, or nothing could be
    learnt. Equal cosines go to the first language by code point. The score is
    the cosine of text and prototype, negative ones as 0. Columns of the input
    with the names of the added ones are replaced. A task holds one vector per
    language and the trigrams of one part of the texts; a text of any length
    weighs as much as any other. Repeated rows are learnt from, and predicted,
    like all others. An empty table gives no rows.

    ``unlike_col``, if given, is added: true where the text has a letter but too
    few common trigrams of the predicted language to be a text of it.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in (keep or docs.columns) if c not in (pred_col, score_col, unlike_col)]
    text, lang = (F.col(quoted(c)) for c in (text_col, lang_col))
    labelled = docs.where(lang.isNotNull() & text.isNotNull())
    if learn_from is not None:
        labelled = labelled.where(learn_from)
    labelled = labelled.select(text.cast("string").alias("text"), lang.cast("string").alias("lang"))
    names, vectors = prototypes(labelled)
    common = common_trigrams(labelled, names) if unlike_col and names else None
    # The text goes to the Python tasks once, also where it is kept.
    plain, columns = plainly(keep)
    schema = docs.select(columns).schema.add("found", "string").add("cosine", "double")
    body = "body"
    if text_col in keep and dict(docs.dtypes)[text_col] == "string":
        body = plain[keep.index(text_col)]
    else:
        columns.append(text.cast("string").alias(body))
    added = ["found", "cosine"]
    if common:
        added.append("unlike")
        schema = schema.add("unlike", "boolean")
    work = _predict(names, vectors.astype(np.float32), plain, body, added, common)
    found = docs.select(columns).mapInArrow(work, schema)
    result = [*renamed(plain, keep), F.col("found").alias(pred_col), F.col("cosine").alias(score_col)]
    if unlike_col:
        result.append((F.col("unlike") if common else F.lit(False)).alias(unlike_col))
    return found.select(result)
