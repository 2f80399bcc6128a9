"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents fall into blocks by a hash of id and text; read in hash
order the blocks are a random permutation. A source that is taken e times and a
bit has e passes over all its blocks and one over the first of them, cut inside
its last block, so that the words taken end next to the target. The blocks of
all passes are dealt to the output shards by a binary tree: every node draws,
without replacement and down to the exact count, how many blocks of each source
go to its left half. Those counts are multivariate hypergeometric, as if all
blocks had been shuffled and cut into shards. A shard then reads its own,
disjoint ranges of each source's blocks and shuffles their documents: a document
is taken as often as its block lies in the ranges of the shards.

All draws are hashes of seed and place, so reruns agree. What is decided per
source fits one small row per source; documents are only read, never sorted
together.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.llm.common import WORD, checkpoint, few, named, quoted, uniform

WEIGHTS = (3, 1, 2)
# Shards at least, and words that one is aimed to have beyond that; both powers of two.
SHARDS = 64
SHARD_WORDS = 1 << 29
MOST = 2
# Blocks after the cut whose documents may fill the gap, which is smaller than a document.
NEXT_BLOCKS = 8


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def _targets(sizes: DataFrame, weights, share: float) -> DataFrame:
    """Sizes per source with ``ord`` (by code point, null last) and ``target``.

    Capped targets are the solution of sum(min(level * weight, cap)) = total.
    In order of cap / weight, the level is the first that leaves all later
    sources below their caps.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("ord") - 1, F.lit(len(weights))) + 1).cast("int"),
    )
    ratio = F.col("cap") / F.col("weight")
    by_ratio = Window.orderBy(ratio, "ord")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    return (
        sizes.withColumn("ord", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * float(MOST))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(fits, F.struct(ratio, "ord", "level"))).over(everything)["level"])
        .withColumn("target", F.coalesce(F.least(F.col("level") * F.col("weight"), "cap"), F.lit(0.0)))
        .drop("weight", "cap", "level")
    )


def split(nodes: DataFrame, level: int, seed: int) -> DataFrame:
    """Rows (node, quotas) with every node replaced by its left and right half.

    ``quotas`` holds a number of blocks per source. Blocks are drawn one after
    the other: the next one goes left with the chance room / rest.
    """
    draw = f"(shiftrightunsigned(xxhash64({seed}, {level}, node, i, k), 11) + 0.5D) / 9007199254740992D"
    inner = f"""aggregate(filter(sequence(0L, quotas[i]), k -> k < quotas[i]),
        named_struct('rest', s.rest, 'room', s.room, 'got', 0L),
        (t, k) -> IF({draw} * t.rest < t.room,
            named_struct('rest', t.rest - 1, 'room', t.room - 1, 'got', t.got + 1),
            named_struct('rest', t.rest - 1, 'room', t.room, 'got', t.got)))"""
    left = f"""aggregate(sequence(0, size(quotas) - 1),
        named_struct('rest', total, 'room', total DIV 2, 'left', CAST(array() AS array<bigint>)),
        (s, i) -> transform(array({inner}), t -> named_struct(
            'rest', t.rest, 'room', t.room, 'left', concat(s.left, array(t.got))))[0],
        s -> s.left)"""
    halves = (
        nodes.withColumn("total", F.aggregate("quotas", F.lit(0).cast("bigint"), lambda s, x: s + x))
        .withColumn("left", F.expr(left))
        .withColumn("right", F.zip_with("quotas", "left", lambda q, x: q - x))
    )
    return halves.select(F.posexplode(F.array("left", "right")).alias("side", "half"), "node").select(
        (F.col("node") * 2 + F.col("side")).alias("node"), F.col("half").alias("quotas")
    )


def shard_number(words: int, share: float = 1.5) -> int:
    """Shards of a mix of so many words: SHARDS, doubled while one has more than SHARD_WORDS."""
    shards = SHARDS
    while shards * SHARD_WORDS < words * share:
        shards *= 2
    return shards


def plan(slim: DataFrame, weights=WEIGHTS, share: float = 1.5, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """One row per source from rows (source, key, size): passes, cut and shard borders."""
    sizes = slim.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.ceil(F.sqrt(F.count("*"))).cast("bigint").alias("blocks"),
    )
    sources = (
        _targets(sizes, weights, share)
        .withColumn(
            "passes",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0),
        )
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    )
    sources = checkpoint(sources)
    block = F.pmod("key", "blocks")
    rows = slim.join(few(sources), slim["source"].eqNullSafe(sources["source"])).select(
        "ord", block.alias("block"), "key", "size", "rest"
    )
    in_order = Window.partitionBy("ord").orderBy("block")
    # The block in which the rest ends, and what is left of it there.
    last = (
        rows.groupBy("ord", "block", "rest")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(in_order))
        .where(F.col("upto") > F.col("rest"))
        .groupBy("ord")
        .agg(F.min_by(F.struct("block", (F.col("rest") - F.col("upto") + F.col("words")).alias("left")), "block").alias("last"))
        .select("ord", "last.block", "last.left")
    )
    last = checkpoint(last)
    by_key = Window.partitionBy("ord").orderBy("key")
    # Documents of that block are taken in order of key as long as they fit.
    cuts = (
        rows.drop("rest")
        .join(few(last), ["ord", "block"])
        .groupBy("ord", "block", "key", "left")
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(by_key))
        .where(F.col("upto") > F.col("left"))
        .withColumn("left", F.col("left") - F.col("upto") + F.col("words"))
        .groupBy("ord", F.col("block").alias("last"))
        .agg(F.min_by(F.struct("key", "left"), "key").alias("cut"))
        .select("ord", "last", F.col("cut.key").alias("cut"), "cut.left")
    )
    cuts = checkpoint(cuts)
    # Of the next blocks' documents, those that still fit, the largest first.
    later = (F.col("block") > F.col("last")) & (F.col("block") < F.col("last") + NEXT_BLOCKS)
    fits = F.aggregate(
        F.sort_array(F.collect_list(F.struct("size", "key")), asc=False),
        F.struct(F.first("left").alias("left"), F.array().cast("array<bigint>").alias("keys")),
        lambda s, x: F.when(
            x["size"] <= s["left"],
            F.struct((s["left"] - x["size"]).alias("left"), F.concat(s["keys"], F.array(x["key"])).alias("keys")),
        ).otherwise(s),
        lambda s: s["keys"],
    )
    fillers = (
        rows.drop("rest")
        .join(few(cuts), "ord")
        .where(later | ((F.col("block") == F.col("last")) & (F.col("key") >= F.col("cut"))))
        .groupBy("ord", "key", "left")
        .agg(F.sum("size").alias("size"))
        .where((F.col("size") > 0) & (F.col("size") <= F.col("left")))
        .groupBy("ord")
        .agg(fits.alias("fillers"))
    )
    cut = sources.join(cuts.drop("left"), "ord", "left").join(fillers, "ord", "left")
    # Blocks of a source: its whole passes, and those begun by the last one.
    begun = F.when(F.col("rest") > 0, F.coalesce(F.col("last") + 1, F.col("blocks"))).otherwise(0)
    cut = checkpoint(cut.withColumn("quota", (F.col("passes") * F.col("blocks") + begun).cast("bigint")))
    nodes = cut.agg(F.array_sort(F.collect_list(F.struct("ord", "quota"))).alias("q")).select(
        F.lit(0).cast("bigint").alias("node"), F.transform("q", lambda x: x["quota"]).alias("quotas")
    ).where(F.size("quotas") > 0)
    for level in range(shards.bit_length() - 1):
        nodes = split(nodes, level, seed)
    ends = F.sum("quota").over(Window.partitionBy("ord").orderBy("node"))
    borders = (
        nodes.select("node", F.posexplode("quotas").alias("at", "quota"))
        .select("node", (F.col("at") + 1).alias("ord"), "quota")
        .withColumn("end", ends)
        .groupBy("ord")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("node", "end"))), lambda x: x["end"]).alias("ends"))
    )
    return checkpoint(cut.join(borders, "ord").drop("quota"))


def mixture(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    shards: int | None = None,
    seed: int = 0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Rows (doc, size, source_size, target, taken, shards_of): what the mix takes of each row.

    ``doc`` is the whole input row. Size is the number of words (null text: 0).
    Sources in order of code point, null as one source and last, weigh
    ``weights``, repeating, and share ``share`` times all words; a target stops
    at twice its source's size and the excess is shared out again. ``shards_of``
    names the shard of each draw of the row, ``taken`` is its size times their
    number (0, 1 or 2). A source's sum of ``taken`` stops before the document that
    would pass its target, and documents of the next NEXT_BLOCKS blocks that still
    fit fill the gap; rows that repeat id and text are taken together.

    ``shards`` is a power of two, by default ``shard_number`` of all words. One row
    per source (with a number per shard) is held by a task. Texts of any length
    are counted whole. An empty table gives no rows.
    """
    names = id_col, text_col, source_col
    return _mixed(docs, weights, share, shards, seed, *names)[0]


def _mixed(docs, weights, share, shards, seed, id_col, text_col, source_col) -> tuple[DataFrame, int]:
    """``mixture`` and its number of shards."""
    id_, text, source = (F.col(quoted(c)) for c in (id_col, text_col, source_col))
    row = docs.select(
        F.struct(*named(docs.columns)).alias("doc"),
        source.cast("string").alias("source"),
        F.xxhash64(F.lit(seed), id_, text).alias("key"),
        word_count(text).alias("size"),
    )
    slim = checkpoint(row.select("source", "key", "size"))
    if shards is None:
        shards = shard_number(slim.agg(F.sum("size")).first()[0] or 0, share)
    sources = plan(slim, weights, share, shards, seed).withColumnRenamed("source", "name")
    block = F.pmod("key", "blocks")
    # What the shards draw: the places of a document's block in each pass, up to their last end.
    place = lambda i: i * F.col("blocks") + block
    drawn = F.col("ends")[F.size("ends") - 1]
    before_cut = F.coalesce((block < F.col("last")) | (F.col("key") < F.col("cut")), F.lit(True))
    fills = F.coalesce(F.array_contains("fillers", F.col("key")), F.lit(False))
    passes = F.sequence(F.lit(0), F.lit(MOST))
    read = F.filter(
        passes,
        lambda i: (i < F.col("passes")) & (place(i) < drawn)
        | (i == F.col("passes")) & ((place(i) < drawn) & before_cut | fills),
    )
    # A filler's block need not be in a range; it goes to the last shard then.
    shard = F.transform(
        read,
        lambda i: F.least(F.size(F.filter("ends", lambda end: end <= place(i))), F.size("ends") - 1),
    )
    mixed = (
        row.join(few(sources), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("shards_of", shard)
        .select(
            "doc", "size", "source_size", "target",
            (F.col("size") * F.size("shards_of")).alias("taken"), "shards_of", "key",
        )
    )
    return mixed, shards


def draw(
    docs: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    shards: int | None = None,
    seed: int = 0,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mixed rows themselves, as often as they are taken, one shard after the other.

    Options are those of ``mixture``. Each shard is a partition, its rows in a
    random order that depends on ``seed`` only.
    """
    mixed, number = _mixed(docs, weights, share, shards, seed, id_col, text_col, source_col)
    copies = mixed.select("doc", "key", F.posexplode("shards_of").alias("copy", "shard"))
    place = uniform(F.lit(seed), F.col("key"), F.col("copy"))
    return (
        copies.withColumn("place", place)
        .repartitionById(number, "shard")
        .sortWithinPartitions("shard", "place")
        .select("doc.*")
    )
