import hashlib
import re
from collections import defaultdict

import corpus
import duckdb
from pyspark.sql import functions as F

from farelake.llm import exact
from farelake.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def fold(rows):
    groups = defaultdict(list)
    for key, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for key, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        ids = [k for k in groups[body] if k is not None]
        keep = min(ids) if ids else None
        digest = hashlib.sha256(body.encode()).hexdigest()
        out.append((key, keep, len(groups[body]), key == keep, digest))
    return sorted(out, key=repr)


def test_odd_rows(spark):
    got = exact.exact_duplicates(corpus.odd(spark))
    assert sorted(map(tuple, got.collect()), key=repr) == fold([r[:2] for r in corpus.ODD])


def test_kept_rows_keep_their_columns(spark):
    docs = corpus.odd(spark)
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    # 1, 2 are equal to each other but not to 3, which is a single space.
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-9, 0, 1, 3, 4, 8]


def test_empty_table(spark):
    assert exact.exact_duplicates(corpus.empty(spark)).count() == 0
    assert exact.drop_exact_duplicates(corpus.empty(spark)).count() == 0


def test_a_crowded_group(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "the  same").otherwise(F.col("id").cast("string")).alias("text"),
    )
    got = exact.exact_duplicates(docs)
    assert got.where("kept").count() == 2001
    assert {tuple(r) for r in got.where("doc_id % 3 = 0").select("keep_id", "group_size").collect()} == {
        (0, 1000)
    }


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    expected = con.sql(ORACLE["op4_exact_duplicates"])
    got = QUERIES["op4_exact_duplicates"](spark, SF_DIR).select(*expected.columns)
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


def test_no_python_runs(spark):
    plan = exact.exact_duplicates(corpus.empty(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
