from dataclasses import replace
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql.types import StructType
from test_sources_sinks import put

from farelake import LakeConfig
from farelake.config import CURATED_COLUMNS, CURATED_SCHEMA, FARE_SCHEMA, OPERATION_SCHEMA
from farelake.plans import jobs
from farelake.sources import read_headered

HEADER = "ANO;MES;EMPRESA;ORIGEM;DESTINO;Tarifa-N;ASSENTOS"
OPS_HEADER = (
    "EMPRESA_SIGLA;EMPRESA_NOME;EMPRESA_NACIONALIDADE;ANO;MES;AEROPORTO_DE_ORIGEM_SIGLA;"
    "AEROPORTO_DE_DESTINO_SIGLA;DECOLAGENS;DISTANCIA_VOADA_KM;ASSENTOS;HORAS_VOADAS;"
    "PASSAGEIROS_PAGOS;PASSAGEIROS_GRATIS;EXTRA"
)


@pytest.fixture
def lake(spark, tmp_path):
    """Landing files of 2019 and 2020 with every odd row the jobs must cope with."""
    fares = {
        (2019, 1): [
            "2019;1;AZU;SBMO;SBRF;312,90;5",
            "2019;1;AZU;SBMO;SBRF;100,10;10",
            "2019;1;AZU;SBMO;SBRF;;3",
            "2019;1;AZU;SBMO;SBRF;1.234,56;2",
            "2019;1;AZU;SBGR;SBRF;999,99;1",
            "2019;1;GLO;SBMO;XXXX;50,00;4",
            "2019;1;GLO;SBMO;SBXX;70,00;x",
        ],
        (2019, 2): ["2019;2;AZU;SBMO;SBRF;200,00;0", "2019;2;GLO;SBMO;SBXX;80,005;5"],
        (2020, 1): ["2020;1;AZU;SBMO;SBRF;500,00;5.7", "2020;1;AZU;SBMO;SBGR;410,50;3"],
    }
    for year in (2019, 2020):
        for month in range(1, 13):
            # One month spells the price's title differently; its line goes with the origin.
            header = HEADER.replace("Tarifa-N", "TARIFA") if month == 3 else HEADER
            lines = [header, *fares.get((year, month), [])]
            put(
                tmp_path / f"landing/price{year}/{year}{month:02d}.CSV",
                "\n".join(lines) + "\n",
            )
    ops = [
        "AZU;AZUL;BRASILEIRA;2019;1;SBMO;SBRF;10;2000;900;15,5;700;3;x",
        "AZU;AZUL;BRASILEIRA;2019;1;SBMO;SBRF;2;400;180;3,25;150;0;x",
        "AZU;AZUL;BRASILEIRA;2019;2;SBMO;SBRF;1;200;90;;50;0;x",
        "GLO;GOL;BRASILEIRA;2019;1;SBMO;XXXX;4;800;400;6;300;1;x",
        "GLO;GOL;BRASILEIRA;2019;2;SBMO;SBXX;5;900;bad;7,5;300;1;x",
        "AZU;AZUL;BRASILEIRA;2020;1;SBMO;SBGR;6;1900;500;9,0;400;2;x",
        "AZU;AZUL;BRASILEIRA;2020;1;SBGR;SBGR;6;1900;500;9,0;400;2;x",
        "AZU;AZUL;BRASILEIRA;2018;1;SBMO;SBRF;6;1900;500;9,0;400;2;x",
        "AZU;AZUL;BRASILEIRA;2021;1;SBMO;SBRF;6;1900;500;9,0;400;2;x",
    ]
    put(tmp_path / "landing/statistics/all.csv", "\n".join([OPS_HEADER, *ops]) + "\n")
    put(
        tmp_path / "landing/icao/icao.csv",
        '"icao","airport","city","state"\n"SBRF","a","RECIFE","PE"\n"SBXX","b","NORTE","MS"\n'
        '"SBXX","c","SUL","MT"\n"SBGR","d","GUARULHOS","SP"\n',
    )
    put(tmp_path / "landing/dist/dist.json", '[\n {"city": "RECIFE",\n "km": 202}\n]\n')
    spark.sql(f"CREATE DATABASE IF NOT EXISTS lake LOCATION '{tmp_path}/warehouse'")
    yield LakeConfig(
        landing=str(tmp_path / "landing"),
        processing=str(tmp_path / "processing"),
        curated=str(tmp_path / "curated"),
        years=(2019, 2020),
        table="lake.data{year}",
    )
    spark.sql("DROP DATABASE lake CASCADE")


# Recife 2019-1: (312.90*5 + 100.10*10) / (5 + 10 + 2) = 150.9118; the cell that
# does not parse still counts its two seats, the empty one was dropped.
CURATED = sorted(
    [
        (2019, 1, "AZU", "AZUL", "RECIFE", "PE", "SBRF", 150.91, 17, 10, 2000, 900, "15.5"),
        (2019, 1, "AZU", "AZUL", "RECIFE", "PE", "SBRF", 150.91, 17, 2, 400, 180, "3.25"),
        (2019, 1, "GLO", "GOL", None, None, "XXXX", 50.0, 4, 4, 800, 400, "6"),
        (2019, 2, "GLO", "GOL", "NORTE", "MS", "SBXX", 80.01, 5, 5, 900, None, "7.5"),
        (2019, 2, "GLO", "GOL", "SUL", "MT", "SBXX", 80.01, 5, 5, 900, None, "7.5"),
        (2020, 1, "AZU", "AZUL", "GUARULHOS", "SP", "SBGR", 410.5, 3, 6, 1900, 500, "9.0"),
    ],
    key=repr,
)


def test_process_fares(spark, lake):
    fares = jobs.process_fares(spark, lake)
    assert fares.schema == StructType.fromDDL(FARE_SCHEMA)
    assert rows(fares) == sorted(
        [
            (2019, 1, "AZU", "SBMO", "SBRF", 312.9, 5, 2019, None),
            (2019, 1, "AZU", "SBMO", "SBRF", 100.1, 10, 2019, None),
            (2019, 1, "AZU", "SBMO", "SBRF", None, 2, 2019, "price"),
            (2019, 1, "GLO", "SBMO", "XXXX", 50.0, 4, 2019, None),
            (2019, 1, "GLO", "SBMO", "SBXX", 70.0, None, 2019, "seats"),
            (2019, 2, "AZU", "SBMO", "SBRF", 200.0, 0, 2019, None),
            (2019, 2, "GLO", "SBMO", "SBXX", 80.005, 5, 2019, None),
            (2020, 1, "AZU", "SBMO", "SBRF", 500.0, None, 2020, "seats"),
            (2020, 1, "AZU", "SBMO", "SBGR", 410.5, 3, 2020, None),
        ],
        key=repr,
    )


def test_odd_cells_are_counted(spark, lake):
    with open(f"{lake.landing}/price2020/202002.CSV", "a") as file:
        file.write("2018;2;AZU;SBMO;SBRF;77,00;1\n;2;AZU;SBMO;SBRF;n/a;one\n")
    counted = jobs.odd_cells(jobs.process_fares(spark, lake), jobs.process_operations(spark, lake))
    assert rows(counted) == sorted(
        [
            ("fares", 2019, 7, 2, 0),
            ("fares", 2020, 4, 2, 2),
            ("statistics", 2019, 5, 1, None),
            ("statistics", 2020, 1, 0, None),
        ],
        key=repr,
    )


@pytest.mark.parametrize("mode", ["all", "years"])
def test_a_fare_belongs_to_the_year_of_its_file(spark, lake, mode):
    """Whatever its own cell says, and in either mode."""
    with open(f"{lake.landing}/price2020/202002.CSV", "a") as file:
        file.write("2019;2;AZU;SBMO;SBRF;77,00;1\n;2;AZU;SBMO;SBRF;79,00;1\n")
    with open(f"{lake.landing}/statistics/more.csv", "w") as file:
        file.write(f"{OPS_HEADER}\nAZU;AZUL;BRASILEIRA;2020;2;SBMO;SBRF;1;2;3;4,0;5;6;x\n")
    curated = jobs.run(spark, replace(lake, replace=mode))
    added = (2020, 2, "AZU", "AZUL", "RECIFE", "PE", "SBRF", 78.0, 2, 1, 2, 3, "4.0")
    assert rows(curated) == sorted([*CURATED, added], key=repr)
    zone = Path(lake.processing_path(jobs.FARES))
    assert {p.name for p in zone.glob("year=*")} == {"year=2019", "year=2020"}


def test_process_fares_options(spark, lake):
    cfg = replace(lake, price_grouping=".", lenient_ints=True)
    fares = jobs.process_fares(spark, cfg)
    assert rows(fares.where("price = 1234.56").select("seats")) == [(2,)]
    assert rows(fares.where("price = 500").select("seats")) == [(5,)]


def test_process_operations(spark, lake):
    ops = jobs.process_operations(spark, lake)
    assert ops.schema == StructType.fromDDL(OPERATION_SCHEMA)
    assert ops.count() == 6
    assert rows(ops.where("destination = 'SBXX'")) == [
        ("GLO", "GOL", "BRASILEIRA", 2019, 2, "SBMO", "SBXX", 5, 900, None, "7.5", 300, 1, "seats")
    ]


def test_process_airports_and_distances(spark, lake):
    assert jobs.process_airports(spark, lake).count() == 4
    assert rows(jobs.process_distances(spark, lake)) == [("RECIFE", 202)]
    given = replace(lake, distances_schema="km int, city string")
    assert rows(jobs.process_distances(spark, given)) == [(202, "RECIFE")]


def test_run(spark, lake):
    for _ in range(2):  # A second run replaces what the first one left.
        curated = jobs.run(spark, lake)
        assert curated.schema == StructType.fromDDL(CURATED_SCHEMA)
        assert rows(curated) == CURATED
        for year in lake.years:
            mine = [row for row in CURATED if row[0] == year]
            assert rows(spark.table(f"lake.data{year}").select(*CURATED_COLUMNS)) == mine
            back = read_headered(spark, lake.curated_path(f"{year}.csv"), schema=CURATED_SCHEMA)
            assert rows(back) == mine


def test_run_into_one_table(spark, lake, tmp_path):
    one = replace(lake, table="lake.data")
    jobs.run(spark, one)
    assert rows(spark.table("lake.data").select(*CURATED_COLUMNS)) == CURATED

    def files(year):
        found = (tmp_path / f"warehouse/data/year={year}").glob("*.parquet")
        return {(p.name, p.stat().st_mtime_ns) for p in found}

    before = files(2019)
    month = Path(f"{lake.landing}/price2020/202001.CSV")
    put(month, f"{HEADER}\n2020;1;AZU;SBMO;SBGR;10,00;3\n")
    jobs.run(spark, replace(one, years=(2020,), replace="years"))
    got = {r.year: r.priceAVG for r in spark.table("lake.data").collect()}
    assert got[2020] == 10.0 and files(2019) == before and before
    put(month, f"{HEADER}\n")
    jobs.run(spark, replace(one, years=(2020,), replace="years"))
    assert {r.year for r in spark.table("lake.data").collect()} == {2019}
    assert files(2019) == before


def test_refreshing_one_year_keeps_the_others(spark, lake):
    jobs.run(spark, lake)
    month = f"{lake.landing}/price2020/202002.CSV"
    with open(month, "a") as file:
        file.write("2020;2;AZU;SBMO;SBRF;77,00;1\n")
    with open(f"{lake.landing}/statistics/more.csv", "w") as file:
        file.write(f"{OPS_HEADER}\nAZU;AZUL;BRASILEIRA;2020;2;SBMO;SBRF;1;2;3;4,0;5;6;x\n")
    jobs.run(spark, replace(lake, years=(2020,), replace="years"))
    added = (2020, 2, "AZU", "AZUL", "RECIFE", "PE", "SBRF", 77.0, 1, 1, 2, 3, "4.0")
    assert rows(spark.table("lake.data2020").select(*CURATED_COLUMNS)) == sorted(
        [row for row in CURATED if row[0] == 2020] + [added], key=repr
    )
    assert spark.table("lake.data2019").count() == 5
    assert spark.read.parquet(lake.processing_path(jobs.FARES)).where("year = 2019").count() == 7


def test_refreshing_a_year_that_became_empty(spark, lake):
    jobs.run(spark, lake)
    for month in range(1, 13):
        put(Path(f"{lake.landing}/price2020/2020{month:02d}.CSV"), f"{HEADER}\n")
    curated = jobs.run(spark, replace(lake, years=(2020,), replace="years"))
    assert rows(curated) == [row for row in CURATED if row[0] == 2019]
    assert spark.table("lake.data2020").count() == 0
    fares = spark.read.schema(FARE_SCHEMA).parquet(lake.processing_path(jobs.FARES))
    assert {row.year for row in fares.collect()} == {2019}


def test_years_need_not_follow_each_other(spark, lake):
    cfg = replace(lake, years=(2018, 2020))
    assert {row.year for row in jobs.process_operations(spark, cfg).collect()} == {2018, 2020}


@pytest.mark.parametrize("mode", ["all", "years"])
def test_all_origins(spark, lake, mode):
    cfg = replace(lake, origin=None, replace=mode)
    month = f"{lake.landing}/price2020/202001.CSV"
    with open(month, "a") as file:
        file.write("2020;1;AZU;SBGR;SBGR;20,00;2\n")
    # Without the origin's test, a header under another title is a row of no year.
    for year in (2019, 2020):
        put(Path(f"{lake.landing}/price{year}/{year}03.CSV"), f"{HEADER}\n")
    added = (2020, 1, "AZU", "AZUL", "GUARULHOS", "SP", "SBGR", 20.0, 2, 6, 1900, 500, "9.0")
    assert rows(jobs.run(spark, cfg)) == sorted([*CURATED, added], key=repr)


def test_rejects_bad_configuration(lake):
    with pytest.raises(ValueError):
        replace(lake, replace="some")
    with pytest.raises(ValueError):
        replace(lake, years=())
    with pytest.raises(ValueError, match="table per year"):
        replace(lake, replace="years", table="data", warehouse_format="jdbc")


def test_an_origin_without_rows_gives_empty_tables(spark, lake):
    jobs.run(spark, replace(lake, origin="ZZZZ"))
    assert spark.table("lake.data2019").count() == 0
    assert spark.table("lake.data2019").columns == list(CURATED_COLUMNS)


def test_secrets_stay_out_of_the_representation(lake):
    assert "hunter2" not in repr(replace(lake, warehouse_options={"password": "hunter2"}))
