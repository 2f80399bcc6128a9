import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from shelfweek.llm import jaccard
from shelfweek.llm.shingles import shingle_sets, word_hashes

SCHEMA = "doc_id bigint, text string, size int, rep string"
BLANK = " \t\n\x0b\x0c\r"


def shingles(text, width=5):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in BLANK:
        lowered = lowered.replace(c, " ")
    words = lowered.split(" ")
    words = [w for w in words if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=75):
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
            elif rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]:
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), low.get(find(i))) for i, r in enumerate(rows)), key=str)


def edited(words, edits, chance, vocabulary):
    words = list(words)
    for _ in range(edits):
        at = chance.randrange(len(words) + 1)
        what = chance.randrange(3)
        if what == 0:
            words.insert(at, chance.choice(vocabulary))
        elif at < len(words) and len(words) > 1:
            if what == 1:
                del words[at]
            else:
                words[at] = chance.choice(vocabulary)
    return words


def corpus(seed, n=160):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éclair", "naïve", "ß", "日本"]
    passage = [chance.choice(vocabulary) for _ in range(60)]
    texts = []
    for _ in range(n):
        if texts and chance.random() < 0.6:
            base = chance.choice(texts)
            words = edited(base, max(1, int(len(base) * chance.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05]))), chance, vocabulary)
        else:
            words = [chance.choice(vocabulary) for _ in range(chance.choice([1, 3, 5, 7, 12, 40, 150, 600]))]
        if chance.random() < 0.3:
            words = passage + words
        texts.append(words)
    return [(i, chance.choice([" ", "\n", " \t"]).join(t), 1, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_like_all_pairs(spark, seed):
    rows = corpus(seed)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_odd_rows(spark):
    same = "one two three four five six seven eight"
    rows = [
        (1, None, 1, "x"), (2, "", 1, "x"), (3, " \t\n", 1, "x"), (4, "a b", 1, "x"), (5, "A  B", 1, "x"),
        (6, same, 1, "x"), (7, same, None, None), (7, same, 1, "x"), (None, same, 1, "x"), (None, "z", 1, "x"),
        (None, None, 1, "x"), (8, "É é", 1, "x"), (9, "é é", 1, "x"), (10, "x" * 3_000_000, 1, "x"),
        (11, "x" * 3_000_000, 1, "x"), (-5, "only one", 1, "x"), (0, "a\x00b", 1, "x"),
    ]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("percent", [60, 75, 90])
def test_similar_sets_share_an_entry(percent):
    """Sets right at the border, of all sizes, always meet."""
    bands, chance = jaccard.Bands(percent), np.random.default_rng(percent)
    for size in [*range(1, 60), 100, 257, 1000, 5000]:
        for _ in range(12):
            common = chance.integers(0, 1 << 63, size, dtype=np.uint64)
            differ = (100 - percent) * size // percent
            own = int(chance.integers(0, differ + 1))
            extra = chance.integers(0, 1 << 63, differ, dtype=np.uint64)
            a = np.unique(np.concatenate((common, extra[:own])))
            b = np.unique(np.concatenate((common, extra[own:])))
            assert 100 * size >= percent * (size + differ)
            if not np.array_equal(a, b):
                assert np.intersect1d(jaccard.entries(a, bands), jaccard.entries(b, bands)).size


def test_sketches_bound_the_difference():
    chance = np.random.default_rng(0)
    for n, m in [(10, 12), (300, 280), (3000, 900), (40, 40)]:
        a = chance.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate((a[: n // 2], chance.integers(0, 1 << 63, m, dtype=np.uint64)))
        x, y = jaccard.folded([jaccard.sketch(a), jaccard.sketch(b)])
        assert np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


def test_words_do_not_depend_on_the_cut(monkeypatch):
    text = " ".join(f"word{i % 37}é" for i in range(4000)) + " tail"
    whole = next(shingle_sets(pa.array([text]), 5))
    monkeypatch.setattr("shelfweek.llm.shingles.CHUNK", 1 << 10)
    assert np.array_equal(whole, next(shingle_sets(pa.array([text]), 5)))
    data = np.frombuffer(b"abc def", np.uint8)
    assert word_hashes(data, np.array([0]))[0].size == 2


def family(seed, n=70, apart=22):
    """Texts that share a part but mostly not enough of it, so that their lists are long and undecided."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = [chance.choice(vocabulary) for _ in range(120)]
    texts = []
    for _ in range(n):
        own = [chance.choice(vocabulary) for _ in range(chance.choice([apart, apart, 8]))]
        texts.append(common + own)
    return [(i, " ".join(t), 1, "x") for i, t in enumerate(texts)]


@pytest.mark.parametrize("tile", [3, 16])
def test_long_lists_are_compared_in_blocks(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "SMALL_TILE", tile)
    rows = family(tile) + [(1000 + i, t, s, r) for i, t, s, r in corpus(tile, 60)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_tiles_hold_every_pair_of_a_list_once():
    """Over the tiles of a list the pairs are those of the whole list."""
    chance = np.random.default_rng(1)
    n, bands = 60, jaccard.Bands(75)
    base = chance.integers(0, 1 << 63, 200, dtype=np.uint64)
    sets = [np.sort(np.concatenate((base, chance.integers(0, 1 << 63, int(k), dtype=np.uint64)))) for k in chance.integers(1, 60, n)]
    sketches, size = [jaccard.sketch(s) for s in sets], np.array([len(s) for s in sets])
    roots, block = np.arange(n), chance.integers(0, 4, n)

    def pairs(rows, blocks):
        found = jaccard._list_pairs(roots[rows], size[rows], [sketches[r] for r in rows], blocks, bands)
        return sorted(tuple(sorted((int(rows[i]), int(rows[j])))) for part in found for i, j, _ in part)

    whole = pairs(np.arange(n), np.zeros(n, int))
    tiled = []
    for a in range(4):
        for b in range(a, 4):
            rows = np.flatnonzero((block == a) | (block == b))
            tiled += pairs(rows, block[rows])
    assert len(whole) > 100 and sorted(tiled) == whole


def peak(work):
    """What ``work`` returns, and the most MB that it held at a time beyond what there was."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_range_is_compared_in_parts():
    """A task does not hold several copies of all entries of its range; keys keep all their ids."""
    chance = np.random.default_rng(5)
    common = chance.integers(0, 1 << 62, 40, dtype=np.uint64)
    rows = []
    for at in range(300):
        keys = np.concatenate([chance.integers(0, 1 << 62, 3960, dtype=np.uint64), common[at % 4 :: 4]])
        numbers = np.array([20] * 198 + [10], np.uint32)
        rows.append((keys.tobytes(), np.arange(at * 199, at * 199 + 199).tobytes(), numbers.tobytes()))
    table = pa.table({n: pa.array(c, pa.binary()) for n, c in zip(("keys", "ids", "numbers"), zip(*rows))})
    found, mb = peak(lambda: jaccard._share(table))
    want = {tuple(at * 199 + 198 for at in range(first, 300, 4)): 10 for first in range(4)}
    assert {tuple(m): n for m, n in zip(found["members"].to_pylist(), found["keys"].to_pylist())} == want
    assert len(set(found["list"].to_pylist())) == 4
    assert mb < 16


def test_range_without_a_shared_key():
    row = np.arange(6, dtype=np.uint64), np.arange(3), np.full(3, 2, np.uint32)
    table = pa.table({n: pa.array([x.tobytes()], pa.binary()) for n, x in zip(("keys", "ids", "numbers"), row)})
    assert jaccard._share(table).num_rows == 0


def test_long_sketches_are_compared_few_at_a_time():
    chance = np.random.default_rng(6)
    bands = jaccard.Bands(75)
    sets = [np.unique(chance.integers(0, 1 << 63, 8000, dtype=np.uint64)) for _ in range(40)]
    sets += [np.append(s[1:], np.uint64(n)) for n, s in enumerate(sets)]
    sets = [np.sort(s) for s in sets for _ in range(4)]
    rows = len(sets)
    sketches = [jaccard.sketch(s) for s in sets]
    table = pa.table(
        {
            "rep": np.arange(rows), "root": np.arange(rows), "size": np.array([len(s) for s in sets]),
            "bits": pa.array(sketches, pa.binary()), "block": np.zeros(rows, np.int32),
        }
    )
    key = tuple(pa.scalar(0) for _ in range(3))
    found, mb = peak(lambda: jaccard._tile_pairs(75)(key, table))
    got = set(zip(found["a"].to_pylist(), found["b"].to_pylist()))
    origin = [n // 4 % 40 for n in range(rows)]
    assert got == {(a, b) for a in range(rows) for b in range(a + 1, rows) if origin[a] == origin[b]}
    assert mb < 40
    roots, size, block = np.arange(rows), np.array([len(s) for s in sets]), np.zeros(rows, int)
    parts, mb = peak(lambda: list(jaccard._list_pairs(roots, size, sketches, block, bands)))
    assert {(int(a), int(b)) for p in parts for a, b, _ in p} == got
    assert mb < 40


def test_shingles_take_little_beside_the_texts():
    texts = pa.array([f"{n} {n + 1} {n + 2} some words of a text that has a few more " * 4 for n in range(4000)] * 2)
    _, mb = peak(lambda: sum(len(s) for s in shingle_sets(texts, 5)))
    assert mb < 16
