"""Every line is accounted for."""

import pytest
from helpers import SF_DIR, rows

from farelake import LakeConfig
from farelake.checks import landing, proxy
from farelake.plans import checked, jobs


@pytest.fixture
def lake(spark, tmp_path):
    cfg = LakeConfig(
        landing=f"file://{tmp_path}/landing", processing=f"file://{tmp_path}/processing",
        curated=f"file://{tmp_path}/curated", years=(1996, 1997), origin=proxy.ORIGIN,
        month_file=f"price/{landing.MONTH_FILE}",
    )
    landing.write_odd_month_files(spark, SF_DIR, cfg.landing_path("price"))
    landing.write_odd_operations(spark, SF_DIR, cfg.landing_path(cfg.operations_dir))
    return cfg


def test_lines_in_are_rows_out_and_rejects_and_lines_not_asked_for(spark, lake):
    counts, rejects = checked.process(spark, lake)
    by = {r.relation: r for r in counts.collect()}
    for name in (jobs.FARES, jobs.OPERATIONS):
        r = by[name]
        assert r.rowsIn == r.rowsOut + r.rejected + r.filtered and min(r[1:]) > 0
        assert spark.read.parquet(lake.processing_path(name)).count() == r.rowsOut
        assert rejects.where(f"relation = '{name}' and not kept").count() == r.rejected
    lines = spark.read.text([f"{lake.landing}/price/period={y}{m:02d}.CSV" for y in lake.years for m in range(1, 13)])
    assert by[jobs.FARES].rowsIn == lines.count()


def test_a_reject_names_its_file_and_its_text(spark, lake):
    rejects = checked.process(spark, lake)[1].where("relation = 'fares'").collect()
    files = {}
    for r in rejects:
        assert r.block == 0
        if r.file not in files:
            files[r.file] = set(open(r.file.removeprefix("file:").replace("///", "/")).read().split("\n"))
        assert r.line in files[r.file]
    assert {r.reasons for r in rejects} >= {"cells", "seats", "price", "price,seats"}
    assert all(r.kept == ("cells" not in r.reasons) for r in rejects)


def test_kept_rows_are_those_of_the_plain_job(spark, lake):
    checked.process(spark, lake)
    got = rows(spark.read.parquet(lake.processing_path(jobs.FARES)))
    plain = rows(jobs.process_fares(spark, lake).where("company % 5 <> 0").select(
        *spark.read.parquet(lake.processing_path(jobs.FARES)).columns))
    assert [r for r in got] == plain


def test_counts_of_zones_read_no_column(spark, lake):
    checked.process(spark, lake)
    plan = checked.zone_counts(spark, lake)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == 3


def test_clean_files_have_no_rejects(spark, lake):
    root = f"{lake.landing}-clean"
    cfg = LakeConfig(**{**vars(lake), "landing": root})
    landing.write_month_files(spark, SF_DIR, cfg.landing_path("price"), seats=None)
    landing.write_operations(spark, SF_DIR, cfg.landing_path(cfg.operations_dir))
    counts, rejects = checked.process(spark, cfg)
    assert {r.rejected for r in counts.collect()} == {0}
    assert rejects.where("not kept").count() == 0 and {r.reasons for r in rejects.collect()} == {"price"}


def test_a_cell_is_parsed_for_its_filter_and_its_reason_only(spark, lake, monkeypatch):
    """Conditions inside conditions made the filter's code too long to be compiled."""
    plans = {}
    write = checked.write_processing

    def noted(df, path, *args, **options):
        plans[path] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, path, *args, **options)

    monkeypatch.setattr(checked, "write_processing", noted)
    checked.process(spark, lake)
    text = plans[lake.processing_path(checked.REJECTS)]
    assert text.count("cast(DECOLAGENS#") <= 2 and text.count("cast(seats#") <= 2
