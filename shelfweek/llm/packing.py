"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents are cut into pieces of at most ``capacity`` tokens; full pieces are
sequences of their own. The others are dealt to islands of a bounded number of
pieces. An island keeps a small population of packings, the first by best fit
in order of decreasing length. A child takes whole well-filled sequences of one
parent into a copy of the other, drops the copy's sequences that would then hold
a piece twice, and puts their remaining pieces where they fit best. Between
epochs the best-filled sequences of an island migrate, as lists of lengths, to
the islands of its archipelago, which inject them where they own pieces of those
lengths. At the end the worst-filled sequences of all islands are pooled and
packed again, so that islands leave no remainders of their own.
"""

import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm.common import checkpoint, quoted, small_batches

CAPACITY = 1024
END = 2
ISLAND = 4096
# Islands that exchange elites, packings per island, children per epoch, epochs.
ARCHIPELAGO = 8
POPULATION = 4
CHILDREN = 16
EPOCHS = 2
# Sequences that an elite passes on, and that a child takes over, at most.
ELITES = 32
INJECTED = 24
# Sequences filled less than this are pooled and packed again.
POOLED_BELOW = 0.97
# Characters encoded at once; longer texts are cut where no token can cross.
ENCODED = 1 << 20
# Slots of an island: its packed sequences, then its full pieces.
SLOTS = 1 << 13


def byte_bpe(ranks_path: str | None = None, vocabulary_path: str | None = None):
    """Encoder of a byte-level BPE vocabulary and its added tokens, as ``tokenizers`` encodes.

    The first file holds the ranks of the second, ``byte_bpe_50k.json`` (the
    defaults are the copies in ``public_tokenizers``), which names the added
    tokens. A text is split at those, leftmost and then longest first, and what
    lies between is encoded by itself.
    """
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    with open(vocabulary_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        declared = json.load(file)["added_tokens"]
    for token in declared:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or re.search(r"\s", token["content"]):
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    added = {token["content"]: token["id"] for token in declared}
    coder = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    if not added:
        return coder.encode_ordinary
    split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode(text: str) -> list[int]:
        ids = []
        for part in split.split(text):
            ids += [added[part]] if part in added else coder.encode_ordinary(part)
        return ids

    return encode


def token_ids(text: str | None, encode) -> np.ndarray:
    """Ids of the text and the end id. A single blank between two others begins a token."""
    ids, at = [], 0
    text = text or ""
    while at < len(text):
        cut = re.compile(r"(?<=\S) (?=\S)").search(text, at + ENCODED)
        to = cut.start() if cut else len(text)
        ids += encode(text[at:to])
        at = to
    return np.array([*ids, END], "<u4")


def cut_points(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the capacity."""
    first = (length - 1) % capacity + 1
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def _cut(encoder, capacity: int):
    columns = ("doc_id", "piece", "start", "length", "ids_crc32", "island", "item")

    def cut(batches):
        encode = encoder()
        task = TaskContext.get()
        island, item = (task.partitionId() if task else 0) << 32, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = token_ids(text, encode)
                    for piece, (start, length) in enumerate(cut_points(len(ids), capacity)):
                        check = zlib.crc32(ids[start : start + length].tobytes())
                        rows.append((doc, piece, start, length, check, island, item))
                        item += 1
                        if item == ISLAND:
                            island, item = island + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*rows)], names=list(columns)
                )

    return cut


class Packing:
    """Sequences as lists of pieces, with the room left in each."""

    def __init__(self, lengths, capacity: int, bins=()):
        self.lengths, self.capacity = lengths, capacity
        self.bins = [list(b) for b in bins]
        self.room = [capacity - sum(lengths[i] for i in b) for b in self.bins]
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0
        for b, room in enumerate(self.room):
            self._offer(b, room)

    def _offer(self, b: int, room: int):
        if room:
            self.by_room.setdefault(room, []).append(b)
            self.rooms |= 1 << room

    def best_fit(self, items):
        """Puts each piece into the sequence it fills best, or a new one."""
        for i in items:
            size = self.lengths[i]
            fits = self.rooms >> size
            if fits:
                room = size + (fits & -fits).bit_length() - 1
                b = self.by_room[room].pop()
                if not self.by_room[room]:
                    self.rooms ^= 1 << room
                self.bins[b].append(i)
            else:
                b, room = len(self.bins), self.capacity
                self.bins.append([i])
                self.room.append(room)
            self.room[b] = room - size
            self._offer(b, room - size)

    def fitness(self) -> tuple[int, float]:
        """Few sequences first, then well-filled ones beside nearly empty ones."""
        return -len(self.bins), sum((self.capacity - r) ** 2 for r in self.room)

    def without(self, dropped: set[int]) -> tuple["Packing", list[int]]:
        """A copy without the numbered sequences, and the pieces set free."""
        kept = [b for n, b in enumerate(self.bins) if n not in dropped]
        return (
            Packing(self.lengths, self.capacity, kept),
            [i for n in dropped for i in self.bins[n]],
        )


def injected(packing: Packing, groups: list[list[int]]) -> Packing:
    """The packing with whole sequences taken in, duplicates dropped, the rest best-fitted."""
    taken = {i for g in groups for i in g}
    hit = {n for n, b in enumerate(packing.bins) if not taken.isdisjoint(b)}
    child, free = packing.without(hit)
    for group in groups:
        child.bins.append(list(group))
        child.room.append(packing.capacity - sum(packing.lengths[i] for i in group))
        child._offer(len(child.bins) - 1, child.room[-1])
    free = [i for i in free if i not in taken]
    child.best_fit(sorted(free, key=lambda i: -packing.lengths[i]))
    return child


def matched(lengths, patterns: list[list[int]]) -> list[list[int]]:
    """Disjoint groups of pieces whose lengths are those of the patterns, where there are any."""
    own: dict[int, list[int]] = {}
    for i, size in enumerate(lengths):
        own.setdefault(size, []).append(i)
    groups = []
    for pattern in patterns:
        group = []
        for size in pattern:
            if not own.get(size):
                break
            group.append(own[size].pop())
        if len(group) == len(pattern):
            groups.append(group)
        else:
            for i in group:
                own[lengths[i]].append(i)
    return groups


def evolve(lengths, capacity: int, seed, start=None, migrants=()) -> Packing:
    """The best packing after one epoch; ``start`` is that of the epoch before."""
    chance = random.Random(repr(seed))
    lowest = -(-sum(lengths) // capacity)
    decreasing = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    population = [Packing(lengths, capacity, start or ())]
    if start is None:
        population[0].best_fit(decreasing)
    while len(population) < POPULATION and len(population[0].bins) > lowest:
        # Nearly decreasing orders give other, nearly as good packings.
        noise = {i: -lengths[i] * chance.uniform(0.9, 1.0) for i in decreasing}
        other = Packing(lengths, capacity)
        other.best_fit(sorted(decreasing, key=noise.get))
        population.append(other)
    groups = matched(lengths, list(migrants))
    if groups and len(population[0].bins) > lowest:
        population.append(injected(population[0], groups))
    for _ in range(CHILDREN):
        population.sort(key=Packing.fitness, reverse=True)
        if len(population[0].bins) <= lowest:
            break
        mother, father = population[0], chance.choice(population)
        full = sorted(chance.sample(range(len(father.bins)), min(len(father.bins), 4 * INJECTED)),
                      key=lambda b: father.room[b])[:INJECTED]
        child = injected(mother, [father.bins[b] for b in full])
        # Mutation: empty the worst-filled sequences and a few others.
        worst = sorted(range(len(child.bins)), key=lambda b: -child.room[b])[:8]
        child, free = child.without({*worst, *chance.sample(range(len(child.bins)), min(4, len(child.bins)))})
        chance.shuffle(free)
        child.best_fit(free)
        if child.fitness() >= population[-1].fitness() or len(population) < POPULATION:
            population = population[: POPULATION - 1] + [child]
    return max(population, key=Packing.fitness)


def _epoch(capacity: int, epoch: int):
    def run(batches):
        for rows in batches:
            out = []
            for island, lengths, start, migrants in zip(
                rows["island"], rows["lengths"], rows["bins"], rows["migrants"]
            ):
                lengths = [int(x) for x in lengths]
                begun = None if start is None else [b.tolist() for b in start]
                visitors = [] if migrants is None else [m.tolist() for m in migrants]
                best = evolve(lengths, capacity, (island, epoch), begun, visitors)
                full = sorted(range(len(best.bins)), key=lambda b: (best.room[b], len(best.bins[b])))
                elites = [sorted(lengths[i] for i in best.bins[b]) for b in full[:ELITES]]
                out.append((island, lengths, best.bins, elites, best.room))
            yield pd.DataFrame(out, columns=["island", "lengths", "bins", "elites", "room"])

    return run


_STATE = "island bigint, lengths array<int>, bins array<array<int>>, elites array<array<int>>, room array<int>"


def _islands(items: DataFrame, capacity: int, epochs: int) -> DataFrame:
    """Rows (island, bins, room) from rows (island, item, length); items count from 0."""
    by_item = F.array_sort(F.collect_list(F.struct("item", "length")))
    islands = items.groupBy("island").agg(
        F.transform(by_item, lambda x: x["length"].cast("int")).alias("lengths")
    )
    state = islands.select(
        "island", "lengths",
        F.lit(None).cast("array<array<int>>").alias("bins"),
        F.lit(None).cast("array<array<int>>").alias("migrants"),
    )
    for epoch in range(epochs):
        now = checkpoint(state.mapInPandas(_epoch(capacity, epoch), _STATE))
        if epoch + 1 == epochs:
            break
        groups = -(-now.count() // ARCHIPELAGO)
        if not groups:
            break
        home = F.pmod(F.xxhash64("island", F.lit(epoch)), F.lit(groups))
        elites = now.select(home.alias("home"), "elites").groupBy("home").agg(
            F.flatten(F.collect_list("elites")).alias("migrants")
        )
        state = now.withColumn("home", home).join(elites, "home").select(
            "island", "lengths", "bins", "migrants"
        )
    return now


def _sequences(state: DataFrame) -> DataFrame:
    """Rows (island, bin, room, item)."""
    bins = state.select(
        "island", F.posexplode(F.arrays_zip("bins", "room")).alias("bin", "x")
    )
    return bins.select("island", "bin", F.col("x.room").alias("room"), F.explode("x.bins").alias("item"))


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    *,
    encoder=byte_bpe,
    id_col: str = "doc_id",
    text_col: str = "text",
    epochs: int = EPOCHS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    A document is its ids and the end id; a null or empty text is the end id
    alone. Only documents longer than ``capacity`` (at least 2) are cut. Every
    row is packed, also repeated rows and rows with a null id, each by itself.
    A sequence's pieces lie without gaps from offset 0, longest first. Other
    columns are not read. ``encoder`` is called once per task and returns the
    function from text to ids. An island is bounded in pieces and a task holds
    the ids of one document at a time. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    id_, text = (F.col(quoted(c)) for c in (id_col, text_col))
    rows = docs.select(id_.cast("bigint").alias("doc_id"), text.cast("string").alias("text"))
    pieces = checkpoint(
        rows.mapInArrow(
            _cut(encoder, capacity),
            "doc_id bigint, piece bigint, start bigint, length bigint, ids_crc32 bigint, "
            "island bigint, item bigint",
        )
    )
    full = F.col("length") == capacity
    # An island's items are numbered anew, without the full pieces.
    loose = pieces.where(~full).select("island", "item", "length")
    first = _sequences(_islands(loose, capacity, epochs))
    numbers = loose.groupBy("island").agg(F.array_sort(F.collect_list("item")).alias("items"))
    first = first.join(numbers, "island").select(
        "island", "bin", "room", F.element_at("items", F.col("item") + 1).alias("item")
    )
    first = checkpoint(first)
    poor = F.col("room") > capacity * (1 - POOLED_BELOW)
    pooled = first.where(poor).join(loose, ["island", "item"]).select("island", "item", "length")
    pools = -(-pooled.count() // (ISLAND // 2)) or 1
    pooled = checkpoint(
        pooled.withColumn("pool", F.pmod(F.xxhash64("island", "item"), F.lit(pools)))
    )
    second = _sequences(
        _islands(
            pooled.select(
                F.col("pool").alias("island"), F.struct("island", "item").alias("item"), "length"
            ),
            capacity,
            1,
        )
    )
    names = pooled.groupBy("pool").agg(F.array_sort(F.collect_list(F.struct("island", "item"))).alias("items"))
    second = second.join(names, F.col("island") == F.col("pool")).select(
        F.element_at("items", F.col("item") + 1).alias("x"),
        (-1 - F.col("pool") * SLOTS - F.col("bin")).alias("sequence_id"),
    )
    placed = (
        first.where(~poor)
        .select("island", "item", (F.col("island") * SLOTS + F.col("bin")).alias("sequence_id"))
        .union(second.select("x.island", "x.item", "sequence_id"))
        .join(pieces.where(~full), ["island", "item"])
    )
    whole = pieces.where(full).withColumn(
        "sequence_id", F.col("island") * SLOTS + ISLAND + F.col("item")
    )
    return _offsets(placed.unionByName(whole))


def _offsets(placed: DataFrame) -> DataFrame:
    """Pieces of a sequence one after the other; a sequence is bounded by its capacity."""
    order = F.array_sort(
        F.collect_list(F.struct(-F.col("length"), "island", "item", "doc_id", "piece", "start", "length", "ids_crc32"))
    )
    begin = F.struct(
        F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("offsets")
    )
    offsets = F.aggregate(
        "pieces", begin,
        lambda s, x: F.struct((s["at"] + x["length"]).alias("at"), F.concat(s["offsets"], F.array(s["at"])).alias("offsets")),
        lambda s: s["offsets"],
    )
    return (
        placed.groupBy("sequence_id")
        .agg(order.alias("pieces"))
        .select("sequence_id", F.explode(F.arrays_zip("pieces", offsets.alias("offset"))).alias("x"))
        .select(
            "x.pieces.doc_id", "x.pieces.piece", "x.pieces.start", "x.pieces.length",
            "x.pieces.ids_crc32", "sequence_id", "x.offset",
        )
    )
