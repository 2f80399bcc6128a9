"""Periodic runs of words, found by their Lyndon roots.

A run is a stretch of words with smallest period q that cannot be extended. For
one of the two opposite orders of the words, each of its Lyndon roots (the
rotation of the period that is a Lyndon word) is the longest Lyndon word that
starts where it starts. Those lengths come straight from the first phase of
Baier's suffix sorting, which needs no suffix array: positions are grouped by a
context, first their word; groups are taken from the highest to the lowest; each
maximal chain of equal blocks is appended to the block before it, whose position
moves into a new group just above its old one, longer chains higher. When its
group is taken, a position's context is its longest Lyndon word.

Two neighbouring roots of one length are extended by their longest common
extensions to both sides into a run. This is linear in the words, the extensions
aside. A run repeats windows of words inside the document, so documents in which
no window does are done before the words are grouped; equal windows have equal
hashes, so none is missed.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bytes of text that an output batch gathers.
GATHER = 8 << 20
# Words compared at once by an extension, at first; later pieces double.
STEP = 16
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]


def lyndon_lengths(letters: list[int]) -> list[int]:
    """For each position the length of the longest Lyndon word that starts there.

    ``letters`` are numbers from 0 without large gaps; the end is below all of them.
    """
    n = len(letters)
    top = max(letters, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(top)]
    for i, letter in enumerate(letters):
        members[letter].append(i)
    group = list(letters)
    lower, higher = list(range(-1, top - 1)), list(range(1, top + 1))
    # The blocks tile the text; a block ends where the next one that is left starts.
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    lengths = [0] * n
    current = top - 1
    while current >= 0:
        mine = [i for i in members[current] if group[i] == current]
        members[current] = []
        if mine:
            length = right[mine[0]] - mine[0]
            chains: dict[int, int] = {}
            for i in mine:
                lengths[i] = length
                j, k = left[i], right[i]
                if j >= 0:
                    right[j] = k
                    chains[j] = chains.get(j, 0) + 1
                if k < n:
                    left[k] = j
            moved: dict[tuple[int, int], list[int]] = {}
            for j, repeats in chains.items():
                moved.setdefault((repeats, group[j]), []).append(j)
            # Each goes directly above its old group, so the longest chain goes first.
            for repeats, old in sorted(moved, reverse=True) if len(moved) > 1 else moved:
                new, above = len(members), higher[old]
                positions = moved[repeats, old]
                members.append(positions)
                lower.append(old)
                higher.append(above)
                lower[above] = higher[old] = new
                for j in positions:
                    group[j] = new
        current = lower[current]
    return lengths


def _forward(words: np.ndarray, i: int, j: int) -> int:
    """Length of the longest common extension of the suffixes at i < j."""
    length, step = 0, STEP
    while j + length < len(words):
        a, b = words[i + length : i + length + step], words[j + length : j + length + step]
        differs = a[: len(b)] != b
        if differs.any():
            return length + int(differs.argmax())
        length += len(b)
        step *= 2
    return length


def _repeats(words: np.ndarray, window: int) -> bool:
    """Whether windows of that many words may occur twice; never False if one does."""
    if len(words) <= window:
        return False
    sums, width = (words.astype(np.uint64) + np.uint64(1)) * MULTIPLIER, 1
    while width < window:
        shift = min(width, window - width)
        sums = (sums[:-shift] ^ (sums[:-shift] >> np.uint64(29))) * MULTIPLIER + sums[shift:]
        width += shift
    sums.sort()
    return bool((sums[1:] == sums[:-1]).any())


def runs_of(words: np.ndarray, least: int, exponent: int) -> list[Run]:
    """All runs (start, length, period) of length >= max(least, exponent * period).

    ``words`` are numbers from 0 without gaps. Sorted by start, then period.
    """
    # A run matches itself, one period on, over at least this many words.
    if not _repeats(words, max(1, least - least // exponent)):
        return []
    n, found = len(words), set()
    backward = words[::-1]
    for letters in (words, words.max() - words):
        length = np.array(lyndon_lengths(letters.tolist()))
        # Of exponent 2 there may be one whole root only; from 3 on there are two.
        at = np.flatnonzero(np.arange(n) + length < n)
        q = length[at]
        if exponent > 2:
            near = (length[at + q] == q) & (at + 2 * q <= n)
            at, q = at[near], q[near]
            alike = (words[at + q - 1] == words[at + 2 * q - 1]) & (words[at] == words[at + q])
            at, q = at[alike], q[alike]
        reached: dict[int, int] = {}
        for i, period in zip(at.tolist(), q.tolist()):
            if i + period <= reached.get(period, 0):
                continue
            end = i + period + _forward(words, i, i + period)
            start = i - _forward(backward, n - i - period, n - i)
            if end - start >= max(least, exponent * period):
                reached[period] = end
                found.add((start, end - start, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: Column) -> Column:
    """The run that repeats its period most often, of equals the first in the array; else null."""
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, none, better)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(drop)[:-1] == 0)
    return [words[i] for i in kept.tolist()]


def numbered(words: list[bytes]) -> np.ndarray:
    """Numbers for the words, equal where they are, in order of first appearance."""
    number = dict.fromkeys(words)
    for i, word in enumerate(number):
        number[word] = i
    return np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _analyse(least: int, exponent: int, rewrite: Callable | None):
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def batch(ids: list, runs: list, texts: list) -> pa.RecordBatch:
        columns = [
            pa.array(ids, pa.int64()),
            pa.array(
                [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs],
                pa.list_(run),
            ),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "runs", "collapsed"])

    def analyse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, runs, texts, size = [], [], [], 0
        for rows in batches:
            for row in range(rows.num_rows):
                doc, text = rows.column(0)[row].as_py(), rows.column(1)[row].as_py()
                # The white space of bytes.split() is the blank and \x09-\x0D.
                words = (text or b"").split()
                if rewrite is not None:
                    words = rewrite(doc, words)
                found = runs_of(numbered(words), least, exponent)
                ids.append(doc)
                runs.append(found)
                texts.append(b" ".join(collapsed(words, found)))
                size += len(texts[-1]) + 24 * len(found) + 64
                if size >= GATHER:
                    yield batch(ids, runs, texts)
                    ids, runs, texts, size = [], [], [], 0
        if ids:
            yield batch(ids, runs, texts)

    return analyse


def find_runs(
    docs: DataFrame,
    least: int = 24,
    exponent: int = 3,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row: id, runs (array of start, length, period, by start then period), collapsed text.

    Words are stretches without blanks and \\x09-\\x0D, numbered from 0. A run is
    a stretch of words with smallest period q, at least ``least`` words and
    ``exponent`` (2 or more) times q long, that no neighbouring word extends. The
    collapsed text holds the words that no run contains after its first q words,
    joined by one blank. ``rewrite`` may replace a document's words, given its id
    and words, before they are searched.

    A null or empty text, or one of white space, has no runs and an empty
    collapsed text. Texts of any length are searched whole, in memory in
    proportion to the longest; a row is one unit of work, so rows are not split.
    Repeated rows and ids, null ones included, give a row each; there are no ties
    to break. An empty table gives no rows. Other columns are not read.
    """
    if exponent < 2:
        raise ValueError("a run holds its period twice at least")
    columns = [docs[f"`{name}`"] for name in (id_col, text_col)]
    read = docs.select(columns[0].cast("bigint").alias("id"), columns[1].cast("binary").alias("text"))
    schema = "id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    found = read.mapInArrow(_analyse(least, exponent, rewrite), schema)
    return found.select(F.col("id").alias(id_col), "runs", "collapsed")
