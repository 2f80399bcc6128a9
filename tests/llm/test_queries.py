"""The registered queries against their SQL, over whole tables, and the pipeline's stages."""

import random
import re
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from shelfweek.llm import mixing
from shelfweek.llm.queries import oracle_sql, queries
from tests.llm import test_jaccard, test_packing, test_secret_scan

SF_DIR = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert Counter(tuple(r) for r in result.select(columns).collect()) == theirs


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_return_every_row(spark, name):
    found = queries()[name](spark, SMALL)
    if "doc_id" in found.columns:
        ids = {r.doc_id for r in found.select("doc_id").collect()}
        assert ids == {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
    else:
        assert found.count() > 0


@pytest.mark.parametrize("name", ["op8_source_mixing", "op10_secret_scan"])
def test_native_queries_run_no_python(spark, name):
    plan = queries()[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage was given and returned."""
    folder = tmp_path_factory.mktemp("stages")
    docs, seen = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{n}")
        out = spark.read.parquet(f"{folder}/{n}")
        seen.append((docs, out))
        docs = out
    return seen


def rows(df):
    return Counter(map(tuple, df.collect()))


def test_stages_return_the_columns_of_documents(stages):
    assert len(stages) == 5
    for given, out in stages[:-1]:
        assert out.columns == given.columns and dict(out.dtypes) == dict(given.dtypes)


def test_language_stage_drops_texts_without_language(stages, spark):
    given, out = stages[0]
    assert rows(out) == rows(given)  # all documents of the table are in a language
    odd = spark.createDataFrame([(9001, "1234 !!", None, "s", 7), (9002, None, None, "s", 0)], given.schema)
    found = corpus_pipeline.identify_language(spark, given.union(odd), SMALL)
    assert rows(found) == rows(given)


def test_language_stage_drops_unlearnt_scripts_and_gibberish(stages, spark):
    given, _ = stages[0]
    chance = random.Random(5)

    def words(letters, n):
        return " ".join("".join(chance.choices(letters, k=chance.randint(2, 9))) for _ in range(n))

    georgian, latin = "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "abcdefghijklmnopqrstuvwxyz"
    odd = [words(letters, n) for letters in (georgian, latin) for n in (15, 100, 1000) for _ in range(10)]
    odd += [words(latin, 60_000), "zqx " * 100 + words(georgian, 50)]
    clean = [r.text[:60].rsplit(" ", 1)[0] for r in given.limit(20).collect()] + ["ok", "the end"]
    texts = [(9000 + i, t, "en" if i % 20 == 0 else None, "s", len(t)) for i, t in enumerate(odd)]
    short = [(20_000 + i, t, None, "s", len(t)) for i, t in enumerate(clean)]
    more = spark.createDataFrame(texts + short, given.schema)
    found = corpus_pipeline.identify_language(spark, given.union(more), SMALL)
    ids = Counter(r.doc_id for r in given.collect()) + Counter(i for i, *_ in short)
    got = Counter(r.doc_id for r in found.collect())
    assert got - ids == Counter() and ids - got == Counter()


def test_near_duplicate_stage_keeps_the_smallest_id(stages, spark):
    given, out = stages[1]
    texts = [(r.doc_id, r.text) for r in given.collect()]
    first = {i for i, _, low in test_jaccard.brute(texts) if i == low}
    assert {r.doc_id for r in out.collect()} == first and out.count() == len(first)
    again = corpus_pipeline.drop_near_duplicates(spark, out.union(out.limit(5)), SMALL)
    assert rows(again) == rows(out)


def test_secret_stage_redacts_and_keeps_all(stages):
    given, out = stages[2]
    before = {r.doc_id: r for r in given.collect()}
    after = {r.doc_id: r for r in out.collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        spans = test_secret_scan.base(before[i].text)
        assert ("[SECRET]" in r.text) >= bool(spans) and not test_secret_scan.base(r.text)
        assert r.n_chars == len(r.text)
        if not spans and "[SECRET]" not in r.text:
            assert r.text == before[i].text


def test_mixing_stage_takes_what_the_mixture_says(stages):
    given, out = stages[3]
    want = Counter()
    for r in mixing.mixture(given).collect():
        want[tuple(r.doc)] += len(r.shards_of)
    assert rows(out) == +want


def test_packing_stage_packs_every_row(stages):
    from tokenizers import Tokenizer
    import public_tokenizers

    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given, out = stages[4]
    texts = [(r.doc_id, r.text) for r in given.collect()]
    test_packing.checked(texts, out.collect(), lambda t: coder.encode(t, add_special_tokens=False).ids)


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL)
    assert rows(got.select(columns)) == rows(stages[-1][1].select(columns))


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_odd_rows_and_clashing_columns(spark):
    """Nulls in every column, empty and long texts, repeated rows, and names the stages use inside."""
    clash = ["id", "rep", "size", "key", "doc", "found", "taken", "target", "score", "lang_pred", "count", "island"]
    clash += ["body", "cosine", "unlike", "__body", "__found", "__cosine", "__text", "__lang_pred", "a.b", "ends", "shards_of"]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"`{c}` string" for c in clash
    )
    more = ["x"] * len(clash)
    odd = [
        (None, None, None, None, None, *[None] * len(clash)), (None, "words of no id", None, "a", 4, *more),
        (1, "one two three four five six", "en", None, 27, *more), (1, "one two three four five six", "en", None, 27, *more),
        (2, "one two three four five six", "en", "b", 27, *more), (3, "", "en", "b", 0, *more),
        (4, None, "en", "b", None, *more), (5, "password=abcdefgh of mine", None, "c", None, *more),
        (6, "long words " * 100_000, "en", "a", 1_100_000, *more), (7, "!!! 123", "en", "a", 7, *more),
    ]
    docs = spark.createDataFrame(odd, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.count() > 0
        assert stage(spark, docs.limit(0), SMALL).collect() == []
    kept = corpus_pipeline.identify_language(spark, docs, SMALL)
    assert rows(kept.select("doc_id")) == Counter([(None,), (1,), (1,), (2,), (5,), (6,)])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    assert rows(kept.select("doc_id")) == Counter([(None,), (None,), (1,), (3,), (4,), (5,), (6,), (7,)])
    clean = corpus_pipeline.replace_secrets(spark, docs, SMALL)
    assert {(r.text, r.n_chars) for r in clean.where("doc_id = 5").collect()} == {("[SECRET] of mine", 16)}
    assert corpus_pipeline.pack_sequences(spark, docs, SMALL).count() > len(odd)
