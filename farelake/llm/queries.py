"""The queries of the operators, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.llm import (
    alignment,
    collocations,
    decontam,
    exact,
    language,
    licences,
    mixture,
    neardup,
    nearvectors,
    quality,
    repeats,
    scoring,
    surrogates,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontamination(spark, sf_dir):
    return decontam.contaminated(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


#: The query of near duplicates: three-word shingles, 85 %.
LINKED = neardup.Similarity(words=3, percent=85)


@query
def op3_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), LINKED)


@query
def op4_exact_duplicates(spark, sf_dir):
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


ORACLE["op4_exact_duplicates"] = r"""
WITH body AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
    FROM documents
), grouped AS (
    SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM body GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
    sha256(body) AS text_sha256
FROM body JOIN grouped USING (body)
"""


#: Texts with this score or more pass the quality classifier.
PASS = 0.3


@query
def op6_quality(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_from_labels(docs, _table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        F.coalesce(quality.held_out("doc_id", 5), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PASS).cast("int").alias("predicted"),
    )


@query
def op8_mixture(spark, sf_dir):
    mixed = mixture.mix_sources(_table(spark, sf_dir, "documents"), with_text=False)
    return mixture.taken_by_document(mixed)


@query
def op9_repeats(spark, sf_dir):
    kept = repeats.remove_repeats(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_licences(spark, sf_dir):
    return licences.licences(_table(spark, sf_dir, "documents"))


@query
def op5_language(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held = language.held_out("doc_id", 4, 2)
    model = language.learn(docs.where(~held), "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        held.alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
        "languages",
        "proportions",
    )


@query
def op2_surrogates(spark, sf_dir):
    # Whoever uses the operator gives a key that is kept secret; the check's is not.
    how = surrogates.Surrogates(key=b"of the check only")
    return surrogates.replace_entities(_table(spark, sf_dir, "documents"), how).select(
        "doc_id", "text", "n_entities", F.to_json("kinds").alias("kinds")
    )


@query
def op10_lm_score(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held = scoring.held_out("doc_id", 10)
    return scoring.score_texts(docs, ~held).withColumn("held_out", held)


@query
def op11_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLE["op11_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, size, list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' ')) AS g
    FROM words, unnest([1, 2, 3]) AS sizes(size)
), counts AS (
    SELECT lang, size, phrase, count(*) AS f
    FROM (SELECT lang, size, unnest(g) AS phrase FROM grams) GROUP BY ALL
), candidates AS (
    SELECT lang, size, phrase, f AS a FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = c.first
    JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), covers AS (
    SELECT lang, phrase, max(a) AS cover FROM (
        SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a
        FROM (SELECT lang, a, string_split(phrase, ' ') AS w FROM candidates WHERE size = 3)
    ) GROUP BY ALL
), ranked AS (
    SELECT l.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM lowest l LEFT JOIN covers c USING (lang, phrase)
    WHERE c.cover IS NULL OR 100 * c.cover < 50 * l.a
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query
def op12_near_vectors(spark, sf_dir):
    return nearvectors.near_vectors(_table(spark, sf_dir, "embeddings"))


#: All pairs; for tables as small as the ones it is checked on.
ORACLE["op12_near_vectors"] = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), sound AS MATERIALIZED (
    SELECT vec_id, list_transform(e, lambda x: coalesce(x, 0)) AS e FROM vectors
    WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)
        AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
    WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached AS (
    SELECT vec_id, vec_id AS other FROM vectors
    UNION
    SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), counted AS (
    SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
), component AS (
    SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)
"""


@query
def op13_alignment(spark, sf_dir):
    found = alignment.align_tokens(_table(spark, sf_dir, "documents"))
    return found.withColumn("doc_id", F.col("doc_id").cast("bigint"))
