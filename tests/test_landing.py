"""Landing files are written without a table in one row, and by all tasks where a file may have parts."""

import json
from pathlib import Path

import pytest
from helpers import SF_DIR, rows
from pyspark.sql import functions as F

from farelake.checks import landing
from farelake.config import FARE_COLUMNS
from farelake.sources import read_headerless, read_json_arrays

ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"


@pytest.mark.parametrize("n", [0, 1, 950])
def test_an_array_is_written_in_batches(spark, conf, tmp_path, n):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    orders = [(i if i % 7 else None, i % 5, i / 4, None if i % 11 == 0 else f'{i % 3}-"X"}}') for i in range(n)]
    spark.createDataFrame(orders, ORDERS).repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    path = landing.write_json_array(spark, str(tmp_path), f"{tmp_path}/array")
    (file,) = Path(path).glob("*.txt")
    text = file.read_text()
    found = json.loads(text)
    assert sorted((e.get("o_orderkey", -1), e["of"]["total"]["price"]) for e in found) == sorted(
        (-1 if k is None else k, p) for k, _, p, _ in orders
    )
    assert max(len(json.loads(f"[{line.strip('[],')}]")) for line in text.split("\n")) <= 100
    if n:
        assert read_json_arrays(spark, path).count() == n


def test_a_month_is_rewritten_by_several_tasks(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    path = landing.write_month_files(spark, SF_DIR, f"file://{tmp_path}/price")
    landing.rewrite_month(spark, SF_DIR, path, 1997, 3, F.lit("7"))
    assert len(list((tmp_path / "price" / "period=199703.CSV").glob("part-*"))) > 1
    got = read_headerless(spark, f"{path}/period=199703.CSV", FARE_COLUMNS)
    want = landing.fare_rows(spark, SF_DIR).where("period = '199703.CSV'").withColumn("seats", F.lit("7"))
    assert rows(got) == rows(want.drop("period"))


def test_month_files_hold_the_lines_of_a_csv_writer(spark, tmp_path):
    origins = ["N", "", None, " a b ", "x;y", 'q"r', '"', "#z", "-", "é", "a\\b", "\\", "l\nm", "\t", "0"]
    kinds = ", ".join(f"{name} string" for name in (*FARE_COLUMNS, "period"))
    cells = [("1997", "3", "12", origin, "7", "1,50", "9", "199703.CSV") for origin in origins]
    cells += [(None,) * 7 + ("199704.CSV",), (None,) * 8, ("1997", None, "1", "A", None, "1.234,56", None, "199704.CSV")]
    fares = spark.createDataFrame(cells, kinds)
    fares.write.partitionBy("period").csv(f"{tmp_path}/csv", sep=";")
    lines = landing.fare_lines(fares)
    assert lines.columns == ["line", "period"]
    lines.write.partitionBy("period").text(f"{tmp_path}/text")

    def held(path):
        return sorted((f.parent.name, line) for f in path.glob("*/part-*") for line in f.read_text().split("\n") if line)

    assert held(tmp_path / "text") == held(tmp_path / "csv")


def test_months_are_open_side_by_side_while_they_are_written(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    with landing._months_open(spark):
        assert int(spark.conf.get(name)) >= 12 * len(landing.proxy.YEARS)
    path = landing.write_month_files(spark, SF_DIR, f"file://{tmp_path}/price")
    assert spark.conf.get(name) == "0"
    assert {f.suffix for f in (tmp_path / "price").glob("*/part-*")} == {".txt"}
    got = read_headerless(spark, path, FARE_COLUMNS).where(f"price != '{landing.PRICE_SENTINEL}'")
    want = landing.fare_rows(spark, SF_DIR).where(f"price != '{landing.PRICE_SENTINEL}'")
    assert rows(got.select(*FARE_COLUMNS)) == rows(want.select(*FARE_COLUMNS))
