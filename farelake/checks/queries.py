"""One query per operator, over whole check tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelake.checks import landing, proxy
from farelake.config import (
    CURATED_COLUMNS,
    FARE_COLUMNS,
    FARE_KEYS,
    MEAN_SCHEMA,
    OPERATION_COLUMNS,
    LakeConfig,
)
from farelake.functions import normalize_decimal_text, parse_int, parse_locale_decimal
from farelake.operators import (
    blank_values,
    cast_columns,
    drop_sentinel,
    duplicate_keys,
    lookup_place,
    match_coverage,
    match_operations,
    promote_names,
    reduce_to_keys,
    require_non_null,
    route_frequency,
    row_counts,
    select_as,
    slice_period,
    sort_by,
    top_keys,
    top_routes,
    unmatched,
    weighted_mean,
)
from farelake.plans import branches, checked, committed, jobs
from farelake.plans.colocated import Colocated
from farelake.plans.curate import curate_means, written_means
from farelake.plans.curate import curate_yearly as curate_in_year
from farelake.session import scratch_path
from farelake.sinks import (
    publish_table,
    publish_years,
    write_curated_csv,
    write_processing,
    write_sorted,
)
from farelake.sources import (
    month_paths,
    read_headered,
    read_headerless,
    read_json_arrays,
    read_json_documents,
    read_zone,
    register,
)

Query = Callable[[SparkSession, str], DataFrame]

YEAR = 1997
DATABASES = "farelake_check"
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _database(spark: SparkSession) -> str:
    """A new database of the session catalogue, kept in the scratch folder."""
    path = scratch_path(spark, DATABASES)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def drop_databases(spark: SparkSession) -> None:
    """Drop what the checks have left in the catalogue; files lie in the scratch folder."""
    for row in spark.sql(f"SHOW DATABASES LIKE '{DATABASES}_*'").collect():
        spark.sql(f"DROP DATABASE {row.namespace} CASCADE")


def _means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_means(proxy.fare(spark, sf_dir), scratch_path(spark, "means"))


def _curated(spark: SparkSession, sf_dir: str, **options: bool) -> DataFrame:
    """Curated from written means, as the jobs do."""
    return curate_means(
        _means(spark, sf_dir), proxy.ops(spark, sf_dir), proxy.airport(spark, sf_dir), **options
    )


# Curated relation


@query
def curate_all_years(spark, sf_dir):
    return _curated(spark, sf_dir)


@query
def curate_reduced(spark, sf_dir):
    """The same, with operations cut down to the keys of the means before they are matched."""
    return _curated(spark, sf_dir, reduce=True)


@query
def curate_yearly(spark, sf_dir):
    return curate_in_year(
        proxy.fare(spark, sf_dir, None),
        proxy.ops(spark, sf_dir, None),
        proxy.airport(spark, sf_dir),
        YEAR,
        proxy.ORIGIN,
    )


@query
def join_chain_unguarded(spark, sf_dir):
    """Every mean fare, matched or not."""
    return _curated(spark, sf_dir, guard=False)


@query
def quality_chain_coverage(spark, sf_dir):
    return match_coverage(_curated(spark, sf_dir, guard=False), "time")


@query
def quality_curated_unmatched(spark, sf_dir):
    """Rows of the curated files that have no city."""
    path = scratch_path(spark, "curated")
    write_curated_csv(_curated(spark, sf_dir), path)
    return unmatched(read_headered(spark, path), "city")


# Measures and orderings


@query
def agg_weighted_mean(spark, sf_dir):
    return weighted_mean(proxy.fare(spark, sf_dir), FARE_KEYS)


@query
def agg_weighted_mean_exclude_null(spark, sf_dir):
    return weighted_mean(proxy.fare(spark, sf_dir), FARE_KEYS, null_weight="exclude")


@query
def agg_weighted_mean_all_origins(spark, sf_dir):
    return weighted_mean(proxy.fare(spark, sf_dir, None), FARE_KEYS)


@query
def agg_weighted_mean_large(spark, sf_dir):
    """Prices of up to ten digits before the point."""
    return weighted_mean(proxy.priced(spark, sf_dir, "large"), FARE_KEYS)


@query
def agg_weighted_mean_places(spark, sf_dir):
    """Prices with seven places."""
    return weighted_mean(proxy.priced(spark, sf_dir, "places"), FARE_KEYS, digits=4)


@query
def agg_route_frequency(spark, sf_dir):
    return route_frequency(proxy.fare(spark, sf_dir))


@query
def topk_routes(spark, sf_dir):
    return top_routes(proxy.fare(spark, sf_dir), 10)


@query
def topk_customers(spark, sf_dir):
    """The most frequent values of a key that has many."""
    return top_keys(proxy.table(spark, sf_dir, "orders"), 25, by="o_custkey", counted="o_orderstatus")


@query
def sort_by_month(spark, sf_dir):
    return sort_by(proxy.avg_fare(spark, sf_dir), "month", FARE_KEYS)


@query
def agg_row_counts(spark, sf_dir):
    return row_counts(
        {
            name: relation(spark, sf_dir)
            for name, relation in {
                "fare_raw": proxy.fare_raw,
                "fare": proxy.fare,
                "ops": proxy.ops,
                "airport": proxy.airport,
                "avg_fare": proxy.avg_fare,
                "curated": _curated,
            }.items()
        }
    )


# Joins


@query
def join_left_multi_key(spark, sf_dir):
    return match_operations(proxy.avg_fare(spark, sf_dir), proxy.ops(spark, sf_dir))


@query
def join_left_multi_key_all_origins(spark, sf_dir):
    means = weighted_mean(proxy.fare(spark, sf_dir, None), FARE_KEYS)
    return match_operations(means, proxy.ops(spark, sf_dir, None))


@query
def join_colocated(spark, sf_dir):
    """The same from buckets: one year is written again, another emptied and refilled."""
    kept = Colocated(_database(spark), scratch_path(spark, "colocated"), buckets=8, part=200, least=5)
    means = weighted_mean(proxy.fare(spark, sf_dir, None), FARE_KEYS)
    kept.keep_means(means, proxy.YEARS)
    ops = proxy.ops(spark, sf_dir, None)
    kept.keep_operations(ops, proxy.YEARS)
    kept.keep_operations(ops.where("seats > 10"), [YEAR])
    kept.keep_operations(ops.where("false"), [YEAR + 1])
    kept.keep_operations(ops, [YEAR, YEAR + 1])
    return kept.match(spark, proxy.YEARS)


@query
def join_reduced(spark, sf_dir):
    """Operations cut down to the keys of the dearest fares before they are matched."""
    means = _means(spark, sf_dir).where(F.col("priceAVG") > 80_000)
    ops = reduce_to_keys(proxy.ops(spark, sf_dir), means, FARE_KEYS)
    return match_operations(means, ops, how="inner")


@query
def join_left_lookup(spark, sf_dir):
    return lookup_place(proxy.fare(spark, sf_dir), proxy.airport(spark, sf_dir))


@query
def join_left_lookup_repeated_codes(spark, sf_dir):
    """A list in which some codes stand twice, under different places."""
    return lookup_place(proxy.fare(spark, sf_dir, None), proxy.repeated_airport(spark, sf_dir))


# Filters


@query
def filter_sentinel(spark, sf_dir):
    return drop_sentinel(proxy.fare_raw(spark, sf_dir), "price_t", "Tarifa-N")


@query
def filter_origin(spark, sf_dir):
    return proxy.fare_raw(spark, sf_dir).where(F.col("origin") == proxy.ORIGIN)


@query
def filter_period_origin(spark, sf_dir):
    return slice_period(proxy.operation_source(spark, sf_dir), 1996, 1998, proxy.ORIGIN)


@query
def filter_conjunction(spark, sf_dir):
    return proxy.ops(spark, sf_dir).where(
        (F.col("month") == 3) & (F.col("year") == YEAR) & (F.col("company") == 0)
    )


@query
def filter_year(spark, sf_dir):
    return proxy.ops(spark, sf_dir).where(F.col("year") == YEAR)


@query
def filter_require_non_null(spark, sf_dir):
    return require_non_null(proxy.ops(spark, sf_dir), ["time"])


# Projections and scalar functions


@query
def proj_promote_names(spark, sf_dir):
    raw = proxy.fare_raw(spark, sf_dir)
    headerless = raw.toDF(*[f"_c{i}" for i in range(len(raw.columns))])
    # The raw projection has company before the price, as the files do.
    return promote_names(headerless, FARE_COLUMNS)


@query
def proj_select_as(spark, sf_dir):
    return select_as(landing.operation_rows(spark, sf_dir), OPERATION_COLUMNS)


@query
def proj_subset(spark, sf_dir):
    return proxy.fare_raw(spark, sf_dir).select("company", "origin", "destination")


@query
def proj_cast_columns(spark, sf_dir):
    return cast_columns(
        proxy.fare_raw(spark, sf_dir),
        {"year_t": "int", "month_t": "int", "price_t": parse_locale_decimal, "seats_t": "int"},
    )


@query
def scalar_parse_int(spark, sf_dir):
    raw = proxy.fare_raw(spark, sf_dir)
    return raw.select(
        "seats_t",
        parse_int("seats_t").alias("seats"),
        "price_t",
        parse_int("price_t").alias("price_as_int"),
    )


@query
def scalar_parse_int_lenient(spark, sf_dir):
    raw = proxy.fare_raw(spark, sf_dir).select(normalize_decimal_text("price_t").alias("price_t"))
    return raw.select("price_t", parse_int("price_t", lenient=True).alias("price_as_int"))


@query
def scalar_parse_locale_decimal(spark, sf_dir):
    raw = proxy.fare_raw(spark, sf_dir)
    return raw.select(
        "price_t",
        parse_locale_decimal("price_t").alias("price"),
        parse_locale_decimal("price_t", grouping=".").alias("price_grouped"),
    )


@query
def scalar_normalize_decimal_text(spark, sf_dir):
    source = proxy.operation_source(spark, sf_dir)
    return source.select(
        F.col("time").alias("time_t"), normalize_decimal_text("time").alias("time")
    )


@query
def sql_view_scan(spark, sf_dir):
    register(proxy.ops(spark, sf_dir), "operations_view")
    return spark.sql("SELECT * FROM operations_view")


# Sources


@query
def src_headerless_csv(spark, sf_dir):
    base = landing.write_month_files(spark, sf_dir, scratch_path(spark, "headerless"))
    return read_headerless(spark, f"{base}/*.CSV", FARE_COLUMNS)


@query
def src_month_files(spark, sf_dir):
    base = landing.write_month_files(spark, sf_dir, scratch_path(spark, "months"))
    paths = month_paths(base, proxy.YEARS, pattern=landing.MONTH_FILE)
    return read_headerless(spark, paths, FARE_COLUMNS)


@query
def src_headered_csv(spark, sf_dir):
    path = landing.write_customers(spark, sf_dir, scratch_path(spark, "headered"))
    return read_headered(spark, path)


@query
def src_headered_csv_semicolon(spark, sf_dir):
    path = landing.write_operations(spark, sf_dir, scratch_path(spark, "semicolon"))
    return read_headered(spark, path, sep=";")


@query
def src_multiline_json(spark, sf_dir):
    path = landing.write_json_documents(spark, sf_dir, scratch_path(spark, "json"))
    return read_json_documents(spark, path)


@query
def src_json_array_ranges(spark, sf_dir):
    """One array in one file, read by as many tasks as the file has ranges."""
    path = landing.write_json_array(spark, sf_dir, scratch_path(spark, "array"))
    read = read_json_arrays(spark, path)
    return read.select(
        "o_orderkey", "note", F.element_at("marks", 2).alias("mark"), "of.o_custkey",
        F.col("of.total.price").alias("price"),
    )


# Zones and sinks


@query
def zone_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "zone")
    write_processing(proxy.fare(spark, sf_dir), path, ["year"])
    by_directory = read_zone(spark, path).withColumn("via", F.lit("directory"))
    by_glob = read_zone(spark, f"{path}/*/*.parquet", base_path=path)
    return by_directory.unionByName(by_glob.withColumn("via", F.lit("glob")))


@query
def zone_partition_overwrite(spark, sf_dir):
    path = scratch_path(spark, "partitions")
    fares = proxy.fare(spark, sf_dir)
    write_processing(fares, path, ["year"])
    changed = fares.where(F.col("year") == YEAR).withColumn("seats", F.col("seats") + 1)
    write_processing(changed, path, ["year"], replace="partitions", compact=True)
    return read_zone(spark, path, schema=fares.schema)


@query
def zone_sorted(spark, sf_dir):
    """Mean fares in the order of the months, of which two are read."""
    path = scratch_path(spark, "sorted")
    order = ["month", *[key for key in FARE_KEYS if key != "month"]]
    write_sorted(proxy.avg_fare(spark, sf_dir), path, order)
    return read_zone(spark, path).where(F.col("month").isin(3, 4))


@query
def sink_curated_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "curated")
    write_curated_csv(_curated(spark, sf_dir), path)
    return read_headered(spark, path)


@query
def sink_publish_table(spark, sf_dir):
    table = f"{_database(spark)}.curated"
    publish_table(_curated(spark, sf_dir), table)
    return spark.table(table)


@query
def sink_publish_one_table(spark, sf_dir):
    """One table by year, of which one year is refreshed with other seats and one emptied."""
    table = f"{_database(spark)}.curated"
    rows = _curated(spark, sf_dir)
    publish_years(rows, table, proxy.OPERATION_YEARS)
    changed = rows.where(F.col("year") == YEAR).withColumn("seatsAll", F.col("seatsAll") + 1)
    publish_years(changed, table, [YEAR, YEAR + 1])
    return spark.table(table).select(*CURATED_COLUMNS)


# Quality


@query
def quality_unmatched_lookup(spark, sf_dir):
    placed = lookup_place(proxy.fare(spark, sf_dir), proxy.airport(spark, sf_dir))
    return unmatched(placed, "city")


@query
def quality_blank_keys(spark, sf_dir):
    return blank_values(proxy.fare_raw(spark, sf_dir), "price_t")


@query
def quality_match_coverage(spark, sf_dir):
    return match_coverage(
        match_operations(proxy.avg_fare(spark, sf_dir), proxy.ops(spark, sf_dir)), "time"
    )


@query
def quality_duplicate_keys(spark, sf_dir):
    return duplicate_keys(proxy.ops(spark, sf_dir), FARE_KEYS)


# Jobs


def _lake(spark: SparkSession) -> LakeConfig:
    root = scratch_path(spark, "lake")
    return LakeConfig(
        landing=f"{root}/landing",
        processing=f"{root}/processing",
        curated=f"{root}/curated",
        years=proxy.YEARS,
        origin=proxy.ORIGIN,
        month_file=f"price/{landing.MONTH_FILE}",
    )


@query
def job_process_fares(spark, sf_dir):
    cfg = _lake(spark)
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"))
    return jobs.process_fares(spark, cfg)


@query
def job_process_airports(spark, sf_dir):
    cfg = _lake(spark)
    landing.write_customer_places(spark, sf_dir, cfg.landing_path(cfg.airports_dir))
    return jobs.process_airports(spark, cfg)


@query
def job_process_operations(spark, sf_dir):
    cfg = replace(_lake(spark), years=proxy.OPERATION_YEARS)
    landing.write_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    return jobs.process_operations(spark, cfg)


@query
def job_process_distances(spark, sf_dir):
    cfg = _lake(spark)
    landing.write_json_documents(spark, sf_dir, cfg.landing_path(cfg.distances_path))
    return jobs.process_distances(spark, cfg)


@query
def job_process_distances_ranges(spark, sf_dir):
    """The same documents, each file read by ranges."""
    cfg = replace(_lake(spark), split_documents=True)
    landing.write_json_documents(spark, sf_dir, cfg.landing_path(cfg.distances_path))
    return jobs.process_distances(spark, cfg)


def _landed(spark: SparkSession, sf_dir: str, **options) -> LakeConfig:
    """A lake of which only the landing zone is there."""
    table = _database(spark) + ".data{year}"
    cfg = replace(_lake(spark), years=proxy.OPERATION_YEARS, table=table, **options)
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"))
    landing.write_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    landing.write_airports(spark, sf_dir, cfg.landing_path(cfg.airports_dir))
    return cfg


def _run(spark: SparkSession, sf_dir: str, **options) -> LakeConfig:
    """Landing files to warehouse tables."""
    cfg = _landed(spark, sf_dir, **options)
    jobs.run(spark, cfg)
    return cfg


def _published(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    tables = [spark.table(cfg.table.format(year=year)) for year in cfg.years]
    return reduce(DataFrame.unionByName, tables).select(*CURATED_COLUMNS)


@query
def job_run(spark, sf_dir):
    """Landing files to warehouse tables; the rows are read from the tables."""
    return _published(spark, _run(spark, sf_dir))


@query
def job_run_branches(spark, sf_dir):
    """The same with the three branches side by side, started twice."""
    cfg = _landed(spark, sf_dir)
    branches.run(spark, cfg, "first")
    return branches.run(spark, cfg, "first").select(*CURATED_COLUMNS)


@query
def job_run_all_origins(spark, sf_dir):
    return _published(spark, _run(spark, sf_dir, origin=None))


@query
def job_run_stray_years(spark, sf_dir):
    """Fares whose year cell is empty or of another year still belong to their file's year."""
    cfg = _lake(spark)
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"), stray=True)
    return jobs.process_fares(spark, cfg)


@query
def job_odd_cells(spark, sf_dir):
    cfg = replace(_lake(spark), years=proxy.OPERATION_YEARS)
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"), stray=True)
    landing.write_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    return jobs.odd_cells(jobs.process_fares(spark, cfg), jobs.process_operations(spark, cfg))


@query
def job_refresh_years(spark, sf_dir):
    """After a run, one year's files are changed, another's emptied, and only these refreshed."""
    cfg = _run(spark, sf_dir)
    changed, emptied = YEAR, YEAR + 1
    root = f"{cfg.landing}-again"
    landing.write_month_files(
        spark, sf_dir, f"{root}/price", seats=F.when(F.col("year") == str(changed), "7")
        .when(F.col("year") != str(emptied), F.col("seats"))
    )
    refresh = replace(cfg, years=(changed, emptied), replace="years")
    jobs.process_fares(spark, replace(refresh, landing=root))
    jobs.curate_and_publish(spark, refresh)
    return _published(spark, cfg)


def _versions(spark: SparkSession, sf_dir: str) -> LakeConfig:
    """A first version from landing files, then another one after a month's file has changed."""
    table = _database(spark) + ".curated"
    cfg = replace(_lake(spark), years=proxy.OPERATION_YEARS, table=table)
    landing.write_month_files(spark, sf_dir, cfg.landing_path("price"))
    landing.write_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    landing.write_airports(spark, sf_dir, cfg.landing_path(cfg.airports_dir))
    jobs.process_operations(spark, cfg)
    jobs.process_airports(spark, cfg)
    committed.refresh(spark, cfg)
    landing.rewrite_month(spark, sf_dir, cfg.landing_path("price"), YEAR, 3, F.lit("7"))
    committed.refresh(spark, cfg)
    return cfg


@query
def job_committed_refresh(spark, sf_dir):
    """The curated relation through the manifest, after a refresh that has read one month's file."""
    return committed.read(spark, _versions(spark, sf_dir))


@query
def sink_publish_view(spark, sf_dir):
    """The same version through the catalogue, where one statement shows it."""
    return spark.table(_versions(spark, sf_dir).table)


@query
def job_versions(spark, sf_dir):
    """The version before the last one, which is kept whole."""
    cfg = _versions(spark, sf_dir)
    log = committed.versions(spark, cfg)
    return log.read(committed.MEANS, MEAN_SCHEMA, log.snapshot(log.numbers()[-2]))


def _checked(spark: SparkSession, sf_dir: str) -> LakeConfig:
    cfg = replace(_lake(spark), years=proxy.OPERATION_YEARS)
    landing.write_odd_month_files(spark, sf_dir, cfg.landing_path("price"))
    landing.write_odd_operations(spark, sf_dir, cfg.landing_path(cfg.operations_dir))
    return cfg


@query
def job_rejects(spark, sf_dir):
    """Lines that are in no relation, and those with cells that cannot be read."""
    cfg = _checked(spark, sf_dir)
    rejects = checked.process(spark, cfg)[1].where(F.col("relation") == jobs.FARES)
    month = F.regexp_extract("file", "period=([0-9]{6})", 1)
    return rejects.select(month.alias("month"), "line", "reasons", "kept")


@query
def job_line_counts(spark, sf_dir):
    """What became of all lines, noted while the relations were written."""
    return checked.process(spark, _checked(spark, sf_dir))[0]


@query
def job_zone_counts(spark, sf_dir):
    """Rows of the zones, from the footers of their files."""
    cfg = _checked(spark, sf_dir)
    checked.process(spark, cfg)
    return checked.zone_counts(spark, cfg)
