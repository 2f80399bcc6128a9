"""The registered queries of the operators, and SQL for those that SQL can express."""

import zlib

from pyspark.sql import functions as F

from shelfweek.llm import (
    clustering,
    html_text,
    jaccard,
    langid,
    mixing,
    multi_index,
    neardup,
    packing,
    pii,
    quality,
    runs,
    secret_scan,
    topk,
)
from shelfweek.llm.common import table


def op1_language_id(spark, sf_dir):
    """Learnt from three of four documents, told by a checksum of the id."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold)
    found = langid.identify(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_embedding_neardup(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_topk_inner_product(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op4_quality_resampling(spark, sf_dir):
    """Target: documents labelled good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.resample(docs, labels, "quality = 1")


def op5_bestfit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_html_text(spark, sf_dir):
    return html_text.extract_text(table(spark, sf_dir, "pages"), keep=["page_id"])


def op7_ngram_jaccard(spark, sf_dir):
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark, sf_dir):
    mixed = mixing.mixture(table(spark, sf_dir, "documents"))
    return mixed.select(
        F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken", "shards_of"
    )


def op9_personal_data(spark, sf_dir):
    found = pii.find_personal_data(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.withColumn("n_spans", written_spans(F.col("spans")))


def written_spans(spans):
    """The number of spans, of all kinds, in a list joined by commas."""
    return F.when(spans == "", 0).otherwise(F.size(F.split(spans, ","))).cast("bigint")


def op10_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_digest(secret_scan.find_secrets(docs))


def secret_digest(found):
    """Counts, digest and written spans from the spans of each document."""
    base, spans = F.col("found")["base"], F.col("found")["spans"]
    counts = [
        F.size(secret_scan.of_kind(base, name)).cast("bigint").alias(f"n_{name}")
        for name in secret_scan.KINDS[:3]
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"),
        F.size(spans).cast("bigint").alias("n_spans"),
    )


def op11_inverted_multi_index(spark, sf_dir):
    return multi_index.nearest_neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op12_ns_bounds_clustering(spark, sf_dir):
    found = clustering.cluster(table(spark, sf_dir, "embeddings"))
    written = F.array_join(F.col("centroid").cast("array<string>"), ",")
    return found.withColumn("centroid_sha256", F.sha2(written, 256)).drop("centroid")


def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return run_digest(runs.find_runs(docs, rewrite=with_repeats))


def with_repeats(doc_id, words):
    """One document of ten, told by a checksum of its id, repeats a part of itself to its end."""
    checksum = zlib.crc32(str(doc_id).encode())
    if doc_id is None or checksum % 10 or not words:
        return words
    n, g = len(words), checksum // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % period] for i in range(n - a)]


def run_digest(found):
    """Number and digests of the runs, and the one that repeats its period most often."""
    best = F.col("best")
    line = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    return found.withColumn("best", runs.strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries():
    return {
        f.__name__: f
        for f in (
            op1_language_id,
            op2_embedding_neardup,
            op3_topk_inner_product,
            op4_quality_resampling,
            op5_bestfit_packing,
            op6_html_text,
            op7_ngram_jaccard,
            op8_source_mixing,
            op9_personal_data,
            op10_secret_scan,
            op11_inverted_multi_index,
            op12_ns_bounds_clustering,
            op13_periodic_runs,
        )
    }


OP2_SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v,
           label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
    FROM embeddings),
norms AS (SELECT *, sqrt(list_dot_product(v, v)) AS norm FROM vectors WHERE usable),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM norms a JOIN norms b
      ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id,
       (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links,
       (SELECT min(b) FROM reach WHERE reach.a = vec_id) AS component_id,
       vec_id = (SELECT min(b) FROM reach WHERE reach.a = vec_id) AS kept
FROM vectors
"""

OP3_SQL = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Words are listed one by one; a shingle is the list of its words.
OP7_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(w[i:i + 4], ' ') END AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
lowest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sizes USING (doc_id) JOIN lowest ON a = doc_id
"""


# Tables of up to multi_index.LEAST vectors are searched whole; beyond that the search is approximate.
OP11_SQL = """
WITH usable AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER () AS row
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
ranked AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_distance(q.v, c.v) AS score,
           CAST(row_number() OVER (PARTITION BY q.row ORDER BY list_distance(q.v, c.v), c.vec_id)
                AS INTEGER) AS rank
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.row <> c.row AND len(q.v) = len(c.v))
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

# Sums of whole numbers in doubles are exact here; a vector's centroid is the first of its nearest.
OP12_START = """
WITH kept AS (
    SELECT vec_id, row_number() OVER () AS row,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(embedding) = 64
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
centroids0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v) - 1 AS k, v
    FROM kept QUALIFY k < 40)"""
OP12_ASSIGN = """,
assigned{n} AS (
    SELECT kept.row, kept.vec_id, kept.v, k,
           list_dot_product(kept.v, kept.v) - 2 * list_dot_product(kept.v, c.v)
           + list_dot_product(c.v, c.v) AS distance
    FROM kept CROSS JOIN centroids{n} c
    QUALIFY row_number() OVER (PARTITION BY kept.row ORDER BY distance, k) = 1)"""
OP12_MOVE = """,
sums{n} AS (
    SELECT k, i, floor(sum(x) / count(*)) AS x
    FROM (SELECT k, unnest(v) AS x, unnest(range(64)) AS i FROM assigned{n}) GROUP BY k, i),
centroids{next} AS (
    SELECT k, coalesce(m.v, c.v) AS v
    FROM centroids{n} c LEFT JOIN (SELECT k, list(x ORDER BY i) AS v FROM sums{n} GROUP BY k) m USING (k))"""
OP12_END = """
SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(CAST(c.v AS BIGINT[]), ',')) AS centroid_sha256
FROM assigned5 JOIN centroids5 c USING (k)
"""
OP12_SQL = OP12_START + "".join(
    OP12_ASSIGN.format(n=n) + (OP12_MOVE.format(n=n, next=n + 1) if n < 5 else "") for n in range(6)
) + OP12_END

# A run of period q is a stretch of positions whose windows of 16 words repeat q words on.
OP13_SQL = r"""
WITH checked AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                   string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(unicode(c) AS BIGINT))),
               lambda crc, byte: list_reduce(
                   [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                   lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END
               ))) AS h
    FROM documents),
starts AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a
    FROM checked),
periods AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM starts),
texts AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(
        range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w
    FROM periods),
windows AS (
    SELECT doc_id, n, i, array_to_string(w[i + 1:i + 16], ' ') AS s
    FROM (SELECT *, unnest(range(greatest(n - 15, 0))) AS i FROM texts)),
pairs AS (
    SELECT a.doc_id, b.i - a.i AS q, a.i
    FROM windows a JOIN windows b
      ON a.doc_id = b.doc_id AND a.s = b.s AND a.i < b.i AND 3 * (b.i - a.i) <= a.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs),
stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length FROM islands GROUP BY doc_id, q, island),
runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
found AS (
    SELECT doc_id, count(*) AS n_runs,
           list(struct_pack(start, length, period)
                ORDER BY CAST(length AS DOUBLE) / period DESC, start, period)[1] AS best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM runs GROUP BY doc_id),
dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM texts),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text
    FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length,
       best.period AS period, 1000 * best.length // best.period AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(text, '')) AS collapsed_sha256
FROM texts LEFT JOIN found USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def oracle_sql():
    return {
        "op2_embedding_neardup": OP2_SQL,
        "op3_topk_inner_product": OP3_SQL,
        "op7_ngram_jaccard": OP7_SQL,
        "op11_inverted_multi_index": OP11_SQL,
        "op12_ns_bounds_clustering": OP12_SQL,
        "op13_periodic_runs": OP13_SQL,
    }
