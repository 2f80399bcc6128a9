"""Exact n-gram Jaccard join by parity sketches.

Two sets of sizes a and b with a Jaccard similarity of p percent or more differ
in at most (a + b)(100 - p) / (100 + p) tokens. Each set is laid out as a wide
bit sketch of 2^j segments: a token flips one bit, so the Hamming distance of two
sketches is at most the number of tokens in which the sets differ. By the
pigeonhole principle a pair within that distance d agrees in all but d segments.
A segment is kept as the XOR of the hashes of its bits and their number; j goes
by size band, and a set near the upper end of its band is also entered in the
next one, where larger partners are.

Of its non-empty segments a set need only enter the d + 1 that come first in an
order that all sets share: fullest segments first, as those are the rarest. Sets
with too few non-empty segments for this argument also enter their smallest
tokens, as in a prefix filter. Sets that share an entry become candidates, a
short sketch refutes most of the wrong ones, and the rest are compared whole.

Equal sets are one class throughout. The result needs components, not all
links: every set is first compared with the best connected set it met, then the
closest sets of every two components that met, and last all pairs of components
that met and are still apart.
"""

from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, components, few, quoted, small_batches
from shelfweek.llm.shingles import mix, shingle_sets

# Entries aimed at per range of the join, and gathered before they are dealt out.
RANGE_ENTRIES = 1_500_000
GATHER = 250_000
# Entries of a range that are compared at a time.
SHARED = 1 << 17
# Sets that a task remembers, so as not to enter their copies again.
REMEMBERED = 1 << 16
# Bits of a sketch at most, and of the short form that is sent to every list of a set.
SKETCH_BITS = 1 << 18
SHORT_BITS = 4096
# Bits per token of a sketch, and how many times shorter the short form is.
SHARP, SHORTER = 8, 4
# Classes without any id are numbered from here on.
UNNAMED = 1 << 62
# Members of a block of a long list, or of components that stay apart: two blocks meet in a task.
TILE = 1024
# Blocks of fewer members where there are no more than so many: more tasks share them.
SMALL_TILE, MANY = 256, 1 << 14
# Pairs that are compared at a time, and bytes of their sketches on either side at most.
COMPARED, COMPARED_BYTES = 1 << 15, 4 << 20
# Pairs of two components that are compared before all of them are.
CLOSEST = 2


def _texts(batches, width):
    for batch in batches:
        yield batch, shingle_sets(batch.column("text"), width)


def _signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def fingerprint(found: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    if not len(found):
        return 0, 0
    a = mix(np.array([np.sum(mix(found ^ np.uint64(0xA5A5A5A5)))], np.uint64) + np.uint64(len(found)))
    b = mix(np.array([np.bitwise_xor.reduce(mix(found + np.uint64(0x5A5A5A5A)))], np.uint64))
    return int(_signed(a)[0]), int(_signed(b)[0])


def unnamed(set_b: int) -> int:
    """The number of a set that no row with an id has, from its second fingerprint."""
    return UNNAMED + ((set_b & (1 << 64) - 1) >> 2)


def _profiles(width: int):
    def profile(batches):
        for batch, sets in _texts(batches, width):
            rows = [(len(s), *fingerprint(s)) for s in sets]
            size, a, b = (pa.array(c, pa.int64()) for c in zip(*rows)) if rows else ([], [], [])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), size, a, b], names=["id", "size", "set_a", "set_b"]
                )

    return profile


class Bands:
    """Size bands, segments and greatest differences for a similarity in percent."""

    def __init__(self, percent: int):
        self.percent = percent

    def top(self, level: int) -> int:
        """Largest size of a band: its greatest difference is two thirds of its segments."""
        return (1 << level) * (100 + self.percent) // (3 * (100 - self.percent))

    def partner(self, size: int) -> int:
        return size * 100 // self.percent

    def differ(self, a: int, b: int) -> int:
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def levels(self, size: int) -> list[tuple[int, int]]:
        """(level, greatest difference) for the set's own band and where larger partners are."""
        level = 1
        while self.top(level) < size:
            level += 1
        entered = [(level, self.differ(size, min(self.partner(size), self.top(level))))]
        if self.partner(size) > self.top(level):
            entered.append((level + 1, self.differ(size, self.partner(size))))
        return entered


def entries(found: np.ndarray, bands: Bands) -> np.ndarray:
    """The hashed segments and tokens under which a set is entered."""
    parts, few = [], False
    for level, differ in bands.levels(len(found)):
        if differ == 0:
            continue  # only an equal set could be a partner
        segment = found >> np.uint64(64 - level)
        first = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        count = np.diff(np.append(first, len(found)))
        parity = np.bitwise_xor.reduceat(mix(found), first)
        # The fullest segments sort first; the number is part of the entry.
        fullness = np.uint64(255) - np.minimum(count, 255).astype(np.uint64)
        key = mix(parity + segment[first] * np.uint64(64) + np.uint64(level))
        key = (fullness << np.uint64(56)) | (key >> np.uint64(8))
        if len(key) > differ + 1:
            key = np.partition(key, differ)[: differ + 1]
        few |= len(first) <= differ
        parts.append(key)
    if few:
        common = -(-bands.percent * len(found) // 100)
        parts.append(mix(found[: len(found) - common + 1] ^ np.uint64(0x0F0F0F0F)))
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _entered(width: int, percent: int, ranges: int):
    bands = Bands(percent)

    def deal(keys, ids):
        keys, counts = np.concatenate(keys), [len(k) for k in keys]
        ids = np.repeat(np.array(ids, np.int64), counts)
        place = (mix(keys) >> np.uint64(33)) % np.uint64(ranges)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(ranges + 1, dtype=np.uint64))
        rows = []
        for r in np.flatnonzero(np.diff(cuts)):
            at = order[cuts[r] : cuts[r + 1]]
            own = ids[at]
            first = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            number = np.diff(np.append(first, len(own))).astype(np.uint32)
            rows.append((int(r), keys[at].tobytes(), own[first].tobytes(), number.tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 3))],
            names=["range", "keys", "ids", "numbers"],
        )

    def enter(batches):
        seen, keys, ids, n = set(), [], [], 0
        for _, sets in _texts(batches, width):
            for found in sets:
                name = fingerprint(found)
                if not len(found) or name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()  # a copy that is entered again is left out later
                seen.add(name)
                own = entries(found, bands)
                if not len(own):
                    continue
                keys.append(own)
                ids.append(name[0])
                n += len(own)
                if n >= GATHER:
                    yield deal(keys, ids)
                    keys, ids, n = [], [], 0
        if n:
            yield deal(keys, ids)

    return enter


def shared_lists(keys: np.ndarray, ids: np.ndarray) -> dict[bytes, int]:
    """The distinct sorted lists of ids, two or more, that share a key, and by how many."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    again = keys[1:] == keys[:-1]
    twice = np.concatenate(([False], again)) | np.concatenate((again, [False]))
    keys, ids = keys[twice], ids[twice]
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])
    keys, ids = keys[new], ids[new]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
    lists: dict[bytes, int] = {}
    for a, b in zip(first, np.append(first[1:], len(keys))):
        if b - a > 1:
            name = ids[a:b].tobytes()
            lists[name] = lists.get(name, 0) + 1
    return lists


def _parts_of(rows: pa.Table, parts: int):
    """Keys and ids of a range, a part of the keys at a time: all entries of a key are in one part."""
    for part in range(parts):
        keys, ids = [], []
        for batch in rows.select(["keys", "ids", "numbers"]).to_batches(max_chunksize=64):
            for k, i, n in zip(*(batch.column(c) for c in range(3))):
                k, i, n = (np.frombuffer(x.as_buffer(), t) for x, t in ((k, np.uint64), (i, np.int64), (n, np.uint32)))
                own = k % np.uint64(parts) == part
                keys.append(k[own])
                ids.append(np.repeat(i, n)[own])
        if keys:
            yield np.concatenate(keys), np.concatenate(ids)


def _share(rows: pa.Table) -> pa.Table:
    size = pc.sum(pc.binary_length(rows.column("keys"))).as_py() or 0
    lists: dict[bytes, int] = {}
    for keys, ids in _parts_of(rows, size // (8 * SHARED) + 1):
        for name, number in shared_lists(keys, ids).items():
            lists[name] = lists.get(name, 0) + number
    members = [np.frombuffer(x, np.int64) for x in lists]
    names = [fingerprint(x.view(np.uint64))[0] for x in members]
    starts = np.cumsum([0, *map(len, members)])
    flat = pa.array(np.concatenate(members) if members else [], pa.int64())
    return pa.table(
        {
            "list": pa.array(names, pa.int64()),
            "members": pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), flat).cast(pa.list_(pa.int64())),
            "keys": pa.array(lists.values(), pa.int64()),
        }
    )


def sketch(found: np.ndarray) -> bytes:
    """Parities of the tokens on a number of bits that suits the size, a power of two."""
    bits = 64
    while bits < min(SKETCH_BITS, SHARP * len(found)):
        bits *= 2
    bit = (mix(found ^ np.uint64(0xC3C3C3C3)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=bits) & 1, bitorder="little").tobytes()


def folded(sketches: list[bytes], most: int = SKETCH_BITS) -> np.ndarray:
    """Sketches as rows of equal length; bits that meet in folding are added, mod 2."""
    short = min(most // 8, *map(len, sketches)) // 8
    rows = [np.frombuffer(x, np.uint64) for x in sketches]
    return np.stack([np.bitwise_xor.reduce(x.reshape(-1, short), axis=0) for x in rows])


def _set_values(width: int, value, named: bool):
    """Rows (rep, size, value) of a task's distinct sets; unnamed ones by their fingerprint."""

    def values(batches):
        seen = set()
        for batch, sets in _texts(batches, width):
            rows = []
            for rep, found in zip(batch.column("id").to_pylist(), sets):
                name = (rep, len(found), *fingerprint(found))
                if name not in seen:
                    seen.add(name)
                    rep = rep if named else unnamed(name[3])
                    rows.append((rep, len(found), value(found)))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["rep", "size", "value"]
                )

    return values


def _verified(percent: int):
    def similar(a: bytes, b: bytes) -> bool:
        left, right = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = np.sort(np.concatenate((left, right)))
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * common >= percent * (len(left) + len(right) - common)

    def verify(batches):
        for batch in batches:
            left, right = batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist()
            keep = pa.array([similar(a, b) for a, b in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    return verify


def _shorten(batches):
    for batch in batches:
        bits = batch.column("value").to_pylist()
        short = [folded([x], max(64, min(SHORT_BITS, 8 * len(x) // SHORTER))).tobytes() for x in bits]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("size"), pa.array(short, pa.binary())],
            names=["rep", "size", "bits"],
        )


def _at_once(bits: np.ndarray) -> int:
    """Pairs of rows of ``bits`` that are compared at a time."""
    return max(1, min(COMPARED, COMPARED_BYTES // (8 * bits.shape[1])))


def _near(bits, size, i, j, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (i, j) the sizes and sketches do not refute, and the sketches' distances."""
    low, high = np.minimum(size[i], size[j]), np.maximum(size[i], size[j])
    apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
    total = (low + high) * (100 - bands.percent)
    return (100 * low >= bands.percent * high) & (apart * (100 + bands.percent) <= total), apart


def _list_pairs(roots, size, sketches, block, bands: Bands):
    """Rows (i, j, distance) of one list in different components that may be similar.

    Of a list's two blocks only the pairs between them: those inside a block meet
    in another task.
    """
    bits = folded(sketches)
    most = _at_once(bits)
    between = block.min() != block.max()
    for a in range(0, len(roots), TILE):
        for b in range(a, len(roots), TILE):
            s, t = slice(a, a + TILE), slice(b, b + TILE)
            other = roots[s, None] != roots[None, t]
            if between:
                other &= block[s, None] != block[None, t]
            i, j = np.nonzero(np.triu(other, 1) if a == b else other)
            for at in range(0, len(i), most):
                x, y = i[at : at + most] + a, j[at : at + most] + b
                near, apart = _near(bits, size, x, y, bands)
                yield np.stack([x[near], y[near], apart[near]], axis=1)


def _closest(roots: np.ndarray, found: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of every two components the ``most`` closest pairs, and whether there are more."""
    ends = np.sort(roots[found[:, :2]], axis=1)
    order = np.lexsort((found[:, 2], ends[:, 1], ends[:, 0]))
    found, ends = found[order], ends[order]
    new = np.ones(len(found), bool)
    new[1:] = (ends[1:] != ends[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    number = np.diff(np.append(first, len(found)))
    rank = np.arange(len(found)) - np.repeat(first, number)
    return found[rank < most], np.repeat(number > most, number)[rank < most]


_CLOSEST = "a bigint, b bigint, root_a bigint, root_b bigint, more boolean"


def _closest_pairs(percent: int):
    bands = Bands(percent)

    def pairs(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("list")
        lists, reps, roots, size, block = (
            rows.column(c).to_numpy() for c in ("list", "rep", "root", "size", "block")
        )
        sketches = rows.column("bits").to_pylist()
        first = np.flatnonzero(np.concatenate(([True], lists[1:] != lists[:-1])))
        out = [np.empty((0, 5), np.int64)]
        for s, t in zip(first, np.append(first[1:], len(lists))):
            own = _list_pairs(roots[s:t], size[s:t], sketches[s:t], block[s:t], bands)
            parts = [p for p in own if len(p)]
            if parts:
                found, more = _closest(roots[s:t], np.concatenate(parts), CLOSEST)
                i, j = found[:, 0] + s, found[:, 1] + s
                turned = reps[i] > reps[j]
                i, j = np.where(turned, j, i), np.where(turned, i, j)
                out.append(np.stack([reps[i], reps[j], roots[i], roots[j], more], axis=1))
        columns = np.unique(np.concatenate(out), axis=0).T
        kinds = [pa.int64()] * 4 + [pa.bool_()]
        return pa.table(
            {n: pa.array(c).cast(t) for n, c, t in zip(("a", "b", "root_a", "root_b", "more"), columns, kinds)}
        )

    return pairs


def _tile_pairs(percent: int):
    bands = Bands(percent)

    def pairs(key: tuple, rows: pa.Table) -> pa.Table:
        _, a, b = (k.as_py() for k in key)
        reps, roots, size, block = (
            rows.column(c).to_numpy() for c in ("rep", "root", "size", "block")
        )
        bits = rows.column("bits").to_pylist()
        length = np.array([len(x) for x in bits])
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        out = [np.empty((2, 0), np.int64)]
        for short, long in product(np.unique(length[left]), np.unique(length[right])):
            l, r = left[length[left] == short], right[length[right] == long]
            all_ = np.concatenate((l, r))
            own = folded([bits[x] for x in all_])
            other = roots[l, None] != roots[None, r]
            if a == b:
                other &= reps[l, None] < reps[None, r]
            i, j = np.nonzero(other)
            most = _at_once(own)
            for at in range(0, len(i), most):
                x, y = i[at : at + most], j[at : at + most] + len(l)
                near, _ = _near(own, size[all_], x, y, bands)
                out.append(np.sort(np.stack([reps[all_[x[near]]], reps[all_[y[near]]]]), axis=0))
        x, y = np.concatenate(out, axis=1)
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return pairs


def _tiled(rows: DataFrame) -> DataFrame:
    """Rows with one of n blocks by their rep, copied to every pair of blocks (tile) with theirs."""
    block = F.pmod(F.xxhash64("rep"), F.col("n")).cast("int")
    tiles = "transform(sequence(0, n - 1), j -> struct(least(block, j) AS i, greatest(block, j) AS j))"
    return rows.withColumn("block", block).withColumn("tile", F.explode(F.expr(tiles)))


def _across(apart, n_apart: int, joined, sketches, percent: int) -> DataFrame:
    """Pairs (a, b) of sets in different components that their sketches do not refute.

    ``apart`` are pairs of components. Those that hang together by them are laid
    out in blocks, and every two blocks meet in a task.
    """
    groups = components(apart, n_apart).toDF("root", "group")
    own = F.coalesce("component", "rep")
    members = (
        sketches.join(joined, F.col("rep") == F.col("id"), "left")
        .select("rep", own.alias("root"), "size", F.col("value").alias("bits"))
        .join(few(checkpoint(groups)), "root")
    )
    members = checkpoint(members)
    tile = F.when(F.count("*") <= MANY, float(SMALL_TILE)).otherwise(float(TILE))
    blocks = members.groupBy("group").agg(F.ceil(F.count("*") / tile).cast("int").alias("n"))
    return (
        _tiled(members.join(few(checkpoint(blocks)), "group"))
        .select("group", "tile.i", "tile.j", "rep", "root", "size", "bits", "block")
        .groupBy("group", "i", "j")
        .applyInArrow(_tile_pairs(percent), "a bigint, b bigint")
        .distinct()
    )


def _sketched(percent: int):
    bands = Bands(percent)

    def refute(batches):
        for batch in batches:
            size = np.stack([batch.column(c).to_numpy() for c in ("size_a", "size_b")])
            pairs = zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())
            one, two = np.array([0]), np.array([1])
            keep = [bool(_near(folded(p), size[:, i], one, two, bands)[0][0]) for i, p in enumerate(pairs)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return refute


def near_duplicates(
    docs: DataFrame,
    percent: int = 75,
    width: int = 5,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: id, n_shingles and component_id of its shingle set at ``percent`` Jaccard or more.

    Whole texts are read. A null text and one without words have no shingles
    and link with nothing; one with fewer than ``width`` words is one shingle.
    A repeated row or id links like any other, so its rows share a component.
    A row with a null id is returned with its size; its text may connect others,
    and its component is the smallest id among them, null if there is none.
    Different texts under one id are one node: a link of any of them counts.
    Ids lie below 2^62, ``percent`` between 1 and 99. An empty table gives no
    rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    id_, text = (F.col(quoted(c)) for c in (id_col, text_col))
    texts = docs.select(id_.cast("bigint").alias("id"), text.cast("string").alias("text"))
    profile = checkpoint(
        texts.mapInArrow(_profiles(width), "id bigint, size bigint, set_a bigint, set_b bigint")
    )
    total = profile.agg(F.sum("size")).first()[0] or 0
    name = ["size", "set_a", "set_b"]
    classes = checkpoint(
        profile.where("size > 0").groupBy(*name).agg(F.min("id").alias("rep"))
        .withColumn("rep", F.coalesce("rep", F.shiftrightunsigned("set_b", 2) + F.lit(UNNAMED)))
    )
    spark = docs.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (2 * RANGE_ENTRIES))
    entered = texts.select("text").mapInArrow(
        _entered(width, percent, ranges), "range int, keys binary, ids binary, numbers binary"
    )
    lists = entered.groupBy("range").applyInArrow(
        _share, "list bigint, members array<bigint>, keys bigint"
    )
    lists = checkpoint(
        lists.groupBy("list").agg(F.first("members").alias("members"), F.sum("keys").alias("keys"))
    )
    named = classes.select(F.col("set_a").alias("member"), "rep")
    met = checkpoint(
        lists.select("list", "keys", F.explode("members").alias("member"))
        .join(named, "member")
        .select("list", "keys", "rep")
    )
    live = checkpoint(met.groupBy("rep").agg(F.sum("keys").alias("keys")))
    n_live = live.count()
    live = checkpoint(live, n_live)
    sketches = checkpoint(_values_of(live, texts, width, sketch))
    short = checkpoint(sketches.mapInArrow(_shorten, "rep bigint, size bigint, bits binary"))
    # Everyone's hub is the best connected set of its lists, by the most keys in common.
    hubs = (
        met.select("list", "rep")
        .join(live, "rep")
        .groupBy("list")
        .agg(F.max_by("rep", F.struct("keys", "rep")).alias("hub"))
    )
    first = (
        met.join(hubs, "list")
        .where("rep <> hub")
        .groupBy("rep", "hub")
        .agg(F.sum("keys").alias("keys"))
        .groupBy("rep")
        .agg(F.max_by("hub", F.struct("keys", "hub")).alias("hub"))
        .select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b"))
        .distinct()
    )
    first = checkpoint(first, n_live)

    def compare(pairs, most):
        near = _not_refuted(pairs, sketches, percent)
        return _compared(near, most, texts, width, percent)

    links = checkpoint(compare(first, n_live))
    roots = components(links, n_live)
    placed = met.join(roots, F.col("rep") == F.col("id"), "left").select(
        "list", "rep", F.coalesce("component", "rep").alias("root")
    )
    placed = checkpoint(placed)
    mixed = (
        placed.groupBy("list")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low <> high")
        .select("list")
    )
    # The closest pairs of every two components of a list are compared; mostly that joins them.
    # Short lists share a task by range, long ones are cut into blocks of which two meet in a task.
    undecided = checkpoint(placed.join(mixed, "list"))
    long = undecided.groupBy("list").agg(F.ceil(F.count("*") / float(TILE)).cast("int").alias("n"))
    long = few(checkpoint(long.where("n > 1")))
    closest = checkpoint(
        _tiled(undecided.join(long, "list", "left").withColumn("n", F.coalesce("n", F.lit(1))))
        .join(short, "rep")
        .withColumn("range", F.when(F.col("n") > 1, F.col("list")).otherwise(F.pmod("list", F.lit(ranges))))
        .select("range", "n", "tile.i", "tile.j", "list", "rep", "root", "size", "bits", "block")
        .groupBy("range", "n", "i", "j")
        .applyInArrow(_closest_pairs(percent), _CLOSEST)
    )
    n_closest = closest.count()
    untried = closest.select("a", "b").distinct().join(first, ["a", "b"], "left_anti")
    links = checkpoint(links.union(compare(untried, n_closest)))
    joined = components(links, n_live + n_closest)
    # Where it did not, and there were more pairs, the components are compared whole.
    more = closest.where("more").select("root_a", "root_b").distinct()
    below = joined.select(F.col("id").alias("root"), "component")
    apart = checkpoint(
        more.join(below.toDF("root_a", "now_a"), "root_a", "left")
        .join(below.toDF("root_b", "now_b"), "root_b", "left")
        .select(F.coalesce("now_a", "root_a").alias("a"), F.coalesce("now_b", "root_b").alias("b"))
        .where("a <> b"),
        n_closest,
    )
    if not apart.isEmpty():
        rest = checkpoint(_across(apart, n_closest, joined, sketches, percent))
        n_rest = rest.count()
        found = checkpoint(_compared(rest, n_rest, texts, width, percent))
        if not found.isEmpty():
            joined = components(links.union(found), n_live + n_closest + n_rest)
    named = (
        classes.join(joined, F.col("rep") == F.col("id"), "left")
        .select(*name, F.coalesce("component", "rep").alias("component"))
    )
    return profile.join(named, name, "left").select(
        F.col("id").alias(id_col),
        F.col("size").alias("n_shingles"),
        F.coalesce(F.when(F.col("component") < UNNAMED, F.col("component")), "id").alias("component_id"),
    )


def _values_of(reps: DataFrame, texts: DataFrame, width: int, value) -> DataFrame:
    """(rep, size, value) of the sets of ``reps``, from the text of one member each."""
    kinds = "rep bigint, size bigint, value binary"
    found = texts.join(few(reps.select(F.col("rep").alias("id"))), "id").select("id", "text")
    found = found.mapInArrow(_set_values(width, value, True), kinds)
    nameless = reps.where(F.col("rep") >= UNNAMED)
    if nameless.isEmpty():
        return found
    others = texts.where("id IS NULL").mapInArrow(_set_values(width, value, False), kinds)
    return found.union(others.join(few(nameless.select("rep")), "rep", "left_semi"))


def _not_refuted(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    left = sketches.select("rep", "value", "size").toDF("a", "bits_a", "size_a")
    right = sketches.select("rep", "value", "size").toDF("b", "bits_b", "size_b")
    return pairs.join(left, "a").join(right, "b").mapInArrow(
        _sketched(percent), "a bigint, b bigint"
    )


def _compared(pairs: DataFrame, most: int, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``most`` pairs at most whose whole sets are similar."""
    pairs = checkpoint(pairs)
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    ends = checkpoint(ends, 2 * most)
    tokens = checkpoint(
        _values_of(ends, texts, width, np.ndarray.tobytes).select("rep", "value")
    )
    left, right = tokens.toDF("a", "tokens_a"), tokens.toDF("b", "tokens_b")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b").mapInArrow(
        _verified(percent), "a bigint, b bigint"
    )
