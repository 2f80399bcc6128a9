"""Documents to packed training sequences, one operator after the other.

Every stage gets what its predecessor kept, with the columns of documents, and
is written and read again between stages:

1. language ID drops documents without any letter or without likeness to any language;
2. of each group of near-duplicates the document with the smallest id stays;
3. secrets in the text are replaced by a mark, the documents stay;
4. sources are mixed to their targets: a document is left out, taken or repeated;
5. what is left is packed into sequences.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweek.llm import jaccard, langid, mixing, packing, secret_scan
from shelfweek.llm.common import checkpoint, few, fresh, named
from shelfweek.sinks.scratch import removed, scratch_folder


def identify_language(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the languages the documents state; a null language is filled in.

    Rejected are texts without a letter and those with significantly too few of
    the common trigrams of the most similar language; the fewer trigrams a text
    has, the more it takes, so that short clean texts stay.
    """
    pred, score, unlike = (fresh(c, docs.columns) for c in ("lang_pred", "score", "unlike"))
    found = langid.identify(docs, pred_col=pred, score_col=score, unlike_col=unlike)
    known = (F.col(pred) != langid.UNKNOWN) & ~F.col(unlike)
    return (
        found.where(known)
        .withColumn("lang", F.coalesce("lang", pred))
        .select(named(docs.columns))
    )


def drop_near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose id is the smallest of its component; of rows that repeat an id one stays.

    Rows without an id cannot be named and stay.
    """
    groups = jaccard.near_duplicates(docs).where("doc_id IS NOT NULL")
    copies = checkpoint(groups.where("doc_id <> component_id").select("doc_id").distinct())
    again = checkpoint(groups.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    kept = docs.join(few(copies), "doc_id", "left_anti")
    if again.limit(1).count():
        once = kept.join(few(again), "doc_id", "left_semi").dropDuplicates(["doc_id"])
        kept = kept.join(few(again), "doc_id", "left_anti").unionByName(once)
    return kept.select(named(docs.columns))


def replace_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    spans = fresh("found", docs.columns)
    found = secret_scan.find_secrets(docs, found_col=spans)
    text = secret_scan.redacted(F.col("text"), F.col(spans)["spans"])
    return (
        found.withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        .select(named(docs.columns))
    )


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.draw(docs)


def pack_sequences(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("secret scan", replace_secrets),
    ("source mixing", mix_sources),
    ("best-fit packing", pack_sequences),
]

# Hyperdimensional profiles, hashed draws and the genetic algorithm are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """The stages over the documents, each result written as Parquet and read again.

    What a stage has read is removed once its own result is written. The last
    stage keeps all it needs in checkpoints.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        path = None
        if number < len(STAGES):
            path = scratch_folder(spark, f"pipeline-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        if before:
            removed(spark, before)
        before = path
    return docs
