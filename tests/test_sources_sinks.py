import json
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from farelake.config import FARE_COLUMNS
from farelake.operators import blank_values
from farelake.sinks import publish_table, write_curated_csv, write_processing, write_sorted
from farelake.sources import (
    month_paths,
    read_headered,
    read_headerless,
    read_json_documents,
    read_zone,
    register,
)


def put(path: Path, text: str, encoding: str = "utf-8") -> Path:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return path


def test_month_paths():
    paths = month_paths("s3a://lake/landing/", [2019, 2020])
    assert len(paths) == 24
    assert paths[0] == "s3a://lake/landing/price2019/201901.CSV"
    assert paths[-1] == "s3a://lake/landing/price2020/202012.CSV"
    assert month_paths("x", [2021], [3], "{year}-{month}") == ["x/2021-3"]


def test_headerless_files_carry_their_header_lines(spark, tmp_path):
    for month in (1, 2):
        put(
            tmp_path / f"20190{month}.CSV",
            f"ANO;MES;EMPRESA;ORIGEM;DESTINO;Tarifa-N;ASSENTOS\n2019;{month};AZU;SBMO;SBRF;312,90;5\n",
        )
    header = ("ANO", "MES", "EMPRESA", "ORIGEM", "DESTINO", "Tarifa-N", "ASSENTOS")
    expected = sorted(
        [header, header]
        + [("2019", str(m), "AZU", "SBMO", "SBRF", "312,90", "5") for m in (1, 2)],
        key=repr,
    )
    by_glob = read_headerless(spark, f"{tmp_path}/*.CSV", FARE_COLUMNS)
    assert by_glob.columns == list(FARE_COLUMNS)
    assert {f.dataType.simpleString() for f in by_glob.schema} == {"string"}
    assert rows(by_glob) == expected
    paths = month_paths(str(tmp_path), [2019], [1, 2], "{year}{month:02d}.CSV")
    assert rows(read_headerless(spark, paths, FARE_COLUMNS)) == expected


def test_headerless_rows_of_other_lengths(spark, tmp_path):
    path = put(tmp_path / "a.csv", "1;2\n1;2;3;4\n\n;;x\n")
    assert rows(read_headerless(spark, str(path), ["a", "b", "c"])) == sorted(
        [("1", "2", None), ("1", "2", "3"), (None, None, "x")], key=repr
    )


def test_headerless_options_reach_the_reader(spark, tmp_path):
    path = put(tmp_path / "a.csv", "São Paulo;1\n", encoding="iso-8859-1")
    df = read_headerless(spark, str(path), ["a", "b"], encoding="ISO-8859-1")
    assert rows(df) == [("São Paulo", "1")]


def test_missing_month_fails(spark, tmp_path):
    put(tmp_path / "price2019/201901.CSV", "2019;1;AZU;SBMO;SBRF;1,0;5\n")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_headerless(spark, month_paths(str(tmp_path), [2019]), FARE_COLUMNS).count()


AIRPORTS = '"icao","airport","city","state"\n"SBMO","AÇUDE","PONTE ALTA","ZZ"\n,"b","c","d"\n"  ","e","f","g"\n"","h","i","j"\n'


def test_headered_text(spark, tmp_path):
    put(tmp_path / "icao/icao.csv", AIRPORTS)
    df = read_headered(spark, f"{tmp_path}/icao")
    assert df.columns == ["icao", "airport", "city", "state"]
    assert rows(df.where("icao = 'SBMO'")) == [("SBMO", "AÇUDE", "PONTE ALTA", "ZZ")]
    assert df.where("icao = ''").count() == 0
    assert rows(blank_values(df, "icao").select("airport")) == [("b",), ("e",), ("h",)]


def test_headered_with_schema(spark, tmp_path):
    path = put(tmp_path / "a.csv", "x;y\n1;2,5\n")
    df = read_headered(spark, str(path), sep=";", schema="x int, y string")
    assert rows(df) == [(1, "2,5")]


def test_json_documents(spark, tmp_path):
    put(tmp_path / "a.json", '[\n  {"city": "Recife",\n   "km": 202},\n  {"city": "Natal"}\n]\n')
    put(tmp_path / "b.json", '{\n "city": "Aracaju",\n "km": 201\n}\n')
    df = read_json_documents(spark, str(tmp_path))
    assert df.schema.simpleString() == "struct<city:string,km:bigint>"
    expected = [("Aracaju", 201), ("Natal", None), ("Recife", 202)]
    assert rows(df) == expected
    assert rows(read_json_documents(spark, str(tmp_path), "city string, km int")) == expected


@pytest.fixture
def fares(spark):
    return spark.createDataFrame(
        [(2019, "a", 1), (2019, "b", 2), (2020, "c", 3)], "year int, k string, seats int"
    )


def test_zone_by_directory_and_by_glob(spark, fares, tmp_path):
    path = str(tmp_path / "zone")
    write_processing(fares, path, ["year"])
    columns = ["year", "k", "seats"]
    assert rows(read_zone(spark, path).select(columns)) == rows(fares)
    by_glob = read_zone(spark, f"{path}/*/*.parquet", base_path=path)
    assert rows(by_glob.select(columns)) == rows(fares)
    typed = read_zone(spark, path, schema="k string, year int, seats int")
    assert typed.columns == ["k", "year", "seats"] and typed.count() == 3


def test_zone_without_partitions(spark, fares, tmp_path):
    path = str(tmp_path / "zone")
    write_processing(fares, path)
    assert rows(read_zone(spark, path)) == rows(fares)
    assert rows(read_zone(spark, f"{path}/*.parquet")) == rows(fares)


@pytest.mark.parametrize("compact", [False, True])
def test_replacing_all_or_some_partitions(spark, fares, tmp_path, compact):
    path = str(tmp_path / "zone")
    columns = ["year", "k", "seats"]
    write_processing(fares, path, ["year"], compact=compact)
    changed = spark.createDataFrame([(2020, "d", 9)], fares.schema)
    write_processing(changed, path, ["year"], replace="partitions", compact=compact)
    assert rows(read_zone(spark, path).select(columns)) == [
        (2019, "a", 1),
        (2019, "b", 2),
        (2020, "d", 9),
    ]
    write_processing(changed, path, ["year"], compact=compact)
    assert rows(read_zone(spark, path).select(columns)) == [(2020, "d", 9)]


def test_replace_all_ignores_the_session_mode(spark, fares, tmp_path, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    path = str(tmp_path / "zone")
    write_processing(fares, path, ["year"])
    write_processing(fares.where("year = 2020"), path, ["year"])
    assert read_zone(spark, path).count() == 1


def test_empty_relation_reads_as_empty(spark, fares, tmp_path):
    path = str(tmp_path / "zone")
    write_processing(fares.where("year = 1"), path, ["year"], compact=True)
    empty = read_zone(spark, path, schema=fares.schema)
    assert empty.count() == 0 and empty.columns == fares.columns


def test_write_processing_rejects_bad_options(fares, tmp_path):
    with pytest.raises(ValueError):
        write_processing(fares, str(tmp_path), ["year"], replace="some")
    with pytest.raises(ValueError):
        write_processing(fares, str(tmp_path), replace="partitions")


def test_curated_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [(2019, 'Say "x", y', None, 1.5), (2020, None, "É", 100.0)],
        "year int, a string, b string, p double",
    )
    path = tmp_path / "2019.csv"
    write_curated_csv(df, str(path))
    assert path.is_dir()
    parts = sorted(path.glob("part-*.csv"))
    assert all(part.read_text().startswith("year,a,b,p\n") for part in parts)
    back = read_headered(spark, str(path))
    assert rows(back) == [("2019", 'Say "x", y', None, "1.5"), ("2020", None, "É", "100.0")]
    assert rows(read_headered(spark, str(path), schema=df.schema)) == rows(df)
    write_curated_csv(df.where("year = 2020"), str(path))
    assert read_headered(spark, str(path)).count() == 1


def test_register(spark, fares):
    assert register(fares, "2019View") is fares
    assert rows(spark.sql("SELECT * FROM 2019View;")) == rows(fares)


def test_publish_to_the_catalogue(spark, fares, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS published LOCATION '{tmp_path}'")
    try:
        publish_table(fares, "published.data2019")
        publish_table(fares.where("year = 2019"), "published.data2019")
        assert spark.table("published.data2019").count() == 2
    finally:
        spark.sql("DROP DATABASE published CASCADE")


class NotingSource(DataSource):
    """A connector that notes what it is asked to write."""

    @classmethod
    def name(cls):
        return "noting"

    def writer(self, schema, overwrite):
        return NotingWriter(dict(self.options), schema.simpleString(), overwrite)


class NotingWriter(DataSourceWriter):
    def __init__(self, options, schema, overwrite):
        self.options, self.schema, self.overwrite = options, schema, overwrite

    def write(self, iterator):
        message = WriterCommitMessage()
        message.rows = [tuple(row) for row in iterator]
        return message

    def commit(self, messages):
        note = {
            "options": self.options,
            "schema": self.schema,
            "overwrite": self.overwrite,
            "rows": sorted(row for m in messages if m for row in m.rows),
        }
        target = Path(self.options["folder"]) / f"{self.options['dbtable']}.json"
        target.write_text(json.dumps(note))


def test_publish_through_a_connector(spark, fares, tmp_path):
    # Worker processes cannot import this file, so the class travels whole.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(NotingSource)
    publish_table(fares, "data2019", "noting", {"folder": str(tmp_path), "role": "etl"})
    note = json.loads((tmp_path / "data2019.json").read_text())
    assert note["overwrite"] is True
    assert note["options"]["dbtable"] == "data2019"
    assert note["options"]["role"] == "etl"
    assert note["schema"] == fares.schema.simpleString()
    assert [tuple(row) for row in note["rows"]] == rows(fares)


def test_a_sorted_zone_skips_row_groups(spark, conf, tmp_path):
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.adaptive.enabled", "false")
    path = str(tmp_path / "sorted")
    rows_ = spark.range(200_000).select((F.col("id") * 7919 % 12 + 1).cast("int").alias("month"), F.hash("id").alias("k"), F.uuid().alias("filler"))
    write_sorted(rows_, path, ["month", "k"], group_mb=1)
    groups = []
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for i in range(meta.num_row_groups):
            own = meta.row_group(i).column(0).statistics
            groups.append((own.min, own.max, meta.row_group(i).num_rows))
    wanted = [g for g in groups if g[0] <= 5 <= g[1]]
    assert len(groups) >= 8 and sum(n for *_, n in wanted) < 0.35 * 200_000
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in Path(path).glob("*.parquet")]
    assert max(sizes) < 2 * 200_000 / len(sizes)
    read = read_zone(spark, path).where("month = 5")
    assert read.count() == rows_.where("month = 5").count()
    assert "PushedFilters: [IsNotNull(month), EqualTo(month,5)]" in read._jdf.queryExecution().executedPlan().toString()
