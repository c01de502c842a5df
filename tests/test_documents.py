"""JSON arrays read by ranges give what Spark's own reader gives for whole files."""

import json
import random

import pytest
from helpers import rows

from farelake.sources import json_elements, read_json_arrays, read_json_documents

SCHEMA = "id bigint, name string, tags array<string>, deep struct<a: bigint, b: struct<c: string>>"

ODD = [
    "", "plain", "}", "{", "[]", '"', "\\", '\\"', '"}', '{"id": 7}', "é}ü", "東京{", "line\nbreak", "tab\t}",
    "\\\\", '\\\\"}', "}" * 40, '"' * 33, "\\" * 17, "🙂",
]


def elements(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        row = {"id": i, "name": rng.choice(ODD) * rng.randint(0, 3)}
        if rng.random() < 0.7:
            row["tags"] = [rng.choice(ODD) for _ in range(rng.randint(0, 4))]
        if rng.random() < 0.5:
            row["deep"] = {"a": i, "b": rng.choice([None, {"c": rng.choice(ODD)}])}
        out.append(row)
    return out


def written(path, name, value, **layout):
    path.mkdir(exist_ok=True)
    (path / name).write_text(value if isinstance(value, str) else json.dumps(value, **layout), "utf-8")
    return str(path)


@pytest.fixture
def spark(session):
    """Results do not depend on ANSI mode."""
    session.conf.set("spark.sql.ansi.enabled", "true")
    return session


@pytest.mark.parametrize("size", [61, 700])
@pytest.mark.parametrize(
    "layout",
    [{"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False}],
    ids=str,
)
def test_same_rows_as_whole_files(spark, conf, tmp_path, size, layout):
    path = written(tmp_path / "in", "a.json", elements(size, 40), **layout)
    written(tmp_path / "in", "b.json", elements(size + 1, 7), **layout)
    want = rows(read_json_documents(spark, path, SCHEMA))
    conf("spark.sql.files.maxPartitionBytes", str(size))
    conf("spark.sql.files.openCostInBytes", "1")
    got = read_json_arrays(spark, path, SCHEMA)
    assert rows(got) == want and len(want) == 47


def test_many_tasks_read_one_file(spark, conf, tmp_path):
    path = written(tmp_path / "in", "one.json", elements(3, 200))
    whole = rows(read_json_documents(spark, path))
    conf("spark.sql.files.maxPartitionBytes", "2000")
    conf("spark.sql.files.openCostInBytes", "1")
    found = json_elements(spark, path)
    ranges = spark.read.text(path, lineSep="}").rdd.getNumPartitions()
    busy = found.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert ranges > 5 and sum(n > 0 for n in busy) > 5 and sum(busy) == 200
    assert rows(read_json_arrays(spark, path)) == whole


@pytest.mark.parametrize(
    ("text", "values"),
    [
        ("", []),
        ("[]", []),
        (" [ ] \n", []),
        ("﻿[{}]", ["{}"]),
        ('{"id": 1}', ['{"id": 1}']),
        ('{"id": 1}\n\n', ['{"id": 1}']),
        ('{"id": 1, "deep": {"a": 2}}', ['{"id": 1, "deep": {"a": 2}}']),
        ('{"id": 1}\n{"id": 2}\n', ['{"id": 1}', '{"id": 2}']),
        ('[1, "}", {"id": 1}, null, [{"id": 9}, [{"id": 8}]], {"id": 2}, "{"]', ['{"id": 1}', '{"id": 2}']),
        ('[{"a": "\\\\"}, {"a": "\\""}]', ['{"a": "\\\\"}', '{"a": "\\""}']),
    ],
)
@pytest.mark.parametrize("size", [7, 1000])
def test_odd_documents(spark, conf, tmp_path, text, values, size):
    path = written(tmp_path / "in", "a.json", text)
    conf("spark.sql.files.maxPartitionBytes", str(size))
    conf("spark.sql.files.openCostInBytes", "1")
    assert sorted(r.value for r in json_elements(spark, path).collect()) == sorted(values)


@pytest.mark.parametrize("text", ['[{"id": 1}, {"id": ', '[{"id": "1}, 2]', '[{"id": 1}, {"a": [1]'])
def test_a_file_that_ends_early_is_an_error(spark, tmp_path, text):
    with pytest.raises(ValueError, match="ends inside"):
        json_elements(spark, written(tmp_path / "in", "a.json", text))


def test_other_ranges_than_scanned_are_an_error(spark, conf, tmp_path):
    path = written(tmp_path / "in", "a.json", elements(1, 50))
    found = json_elements(spark, path)
    conf("spark.sql.files.maxPartitionBytes", "100")
    conf("spark.sql.files.openCostInBytes", "1")
    with pytest.raises(Exception, match="not those of the first scan"):
        found.collect()
