import csv
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from sheets import as_grid, authorities, sheet, write_csv

from peerline.plans.clean import clean
from peerline.plans.job import duplicate_keys, load_fresh, run_all, run_table
from peerline.plans.publish import append_rows, refresh_quarters, refresh_summary
from peerline.specs import SPECS
from peerline.streaming.incremental import load_arrivals


def read_csv(folder) -> tuple[list[str], list[dict]]:
    header, out = None, []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with open(part, newline="", encoding="utf8") as f:
            reader = csv.DictReader(f)
            out += list(reader)
            header = reader.fieldnames
    return header, out


def put(root, spec, quarter, shift=0, suffix=""):
    records = authorities(spec, lambda k, j: str(100 + 10 * k + j + shift))
    write_csv(root / spec.sheet, f"Detailed_LA_{quarter}{suffix}.csv", sheet(spec, records))


@pytest.fixture
def clean_catalog(spark):
    def drop():
        for name in ("public", "core", "staging"):
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")

    drop()
    yield
    drop()


def test_first_load_second_load_revision(spark, tmp_path, clean_catalog):
    spec = SPECS["tab_p1"]
    source, target = tmp_path / "in", tmp_path / "out"
    put(source, spec, 202403)
    put(source, spec, 202406)
    run = lambda n, **kw: run_table(spark, spec, str(source), str(target / n), **kw)

    first = run("1", model_file="Detailed_LA_202406.csv")
    assert (first.cleaned, first.fresh, first.redundant) == (72, 72, 0)
    assert first.per_quarter == {202403: 36, 202406: 36}
    header, cleaned = read_csv(target / "1" / "tab_p1_cleaned.csv")
    assert header == spec.staging_columns and len(cleaned) == 72
    header, summary = read_csv(target / "1" / "prevention_duty_ending_summary.csv")
    assert header == [
        "quarter_ending", "qtr_year", "qtr_month", "year_qtr", "hackney_la", "neighbouring_la", "metrics", "difference",
    ]
    assert len(summary) == 2 * 19
    assert [r["quarter_ending"] for r in summary] == sorted(r["quarter_ending"] for r in summary)
    total = next(r for r in summary if r["metrics"] == "prevention_duty_ended" and r["year_qtr"] == "q1")
    assert (total["hackney_la"], total["neighbouring_la"], total["difference"]) == ("100.00", "150.00", "-50.00")

    again = run("2")
    assert (again.cleaned, again.fresh, again.redundant) == (72, 0, 0)
    assert read_csv(target / "2" / "tab_p1_cleaned.csv")[1] == []

    put(source, spec, 202409)
    (source / "P1" / "Detailed_LA_202406.csv").unlink()
    put(source, spec, 202406, shift=1, suffix="_revised")
    third = run("3")
    # 36 rows of a new quarter, 35 revised rows (the anchor's stay the same), the old ones reported.
    assert (third.cleaned, third.fresh, third.redundant) == (108, 71, 35)
    staging = spark.table("staging.tab_p1")
    assert staging.count() == 72 + 71
    both = spark.table("public.prevention_duty_ending_summary").filter(
        "quarter_ending = 202406 and metrics = 'prevention_duty_ended'"
    ).first()
    assert both["hackney_la"] == Decimal("101.00")  # the larger of old and revised

    replaced = run("4", replace=True)
    assert replaced.fresh == 108 and spark.table("staging.tab_p1").count() == 108
    for quarter in ("202403", "202406_revised"):
        (source / "P1" / f"Detailed_LA_{quarter}.csv").unlink()
    put(source, spec, 202409, shift=7)
    only = run("5", replace=True, count_redundant=False)
    assert (only.fresh, only.redundant) == (36, None)
    kept = {(r[0], r[1]) for r in spark.table("staging.tab_p1").groupBy("quarter_ending").count().collect()}
    assert kept == {(202403, 36), (202406, 36), (202409, 36)}  # other quarters are left alone
    with pytest.raises(FileNotFoundError):
        run("6", model_file="Detailed_LA_202406.csv")


def test_replacing_quarters_needs_the_option(spark, clean_catalog):
    spark.sql("CREATE DATABASE staging")
    spark.sql("CREATE TABLE staging.plain (x int, quarter_ending int) USING parquet PARTITIONED BY (quarter_ending)")
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        append_rows(spark.sql("SELECT 1 AS x, 202403 AS quarter_ending"), "staging.plain", replace=True)


def test_original_and_revised_file_of_one_quarter(spark, tmp_path, clean_catalog):
    spec = SPECS["tab_ta2"]
    put(tmp_path / "in", spec, 202403)
    put(tmp_path / "in", spec, 202403, shift=5, suffix="_revised")
    report = run_table(spark, spec, str(tmp_path / "in"), str(tmp_path / "out"))
    assert report.per_quarter == {202403: 72}
    assert duplicate_keys(spark.table("staging.tab_ta2"), spec).count() == 36


def test_all_tables_side_by_side(spark, tmp_path, clean_catalog):
    for spec in SPECS.values():
        put(tmp_path / "in", spec, 202412)
    reports = run_all(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert [r.table for r in reports] == list(SPECS)
    assert {r.fresh for r in reports} == {36}
    for spec in SPECS.values():
        names = {r["metrics"] for r in spark.table(f"public.{spec.summary}").collect()}
        assert names == set(spec.metric_names)
        assert len(read_csv(tmp_path / "out" / f"{spec.summary_file}.csv")[1]) == len(spec.metric_names)
    header, cleaned = read_csv(tmp_path / "out" / "tab_a1_cleaned.csv")
    assert header == [*SPECS["tab_a1"].staging_columns, "delta_id"] and len(cleaned) == 36


def working_tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    return sorted(p.name for p in folder.glob("tab_*")) if folder.exists() else []


def test_the_same_target_again(spark, tmp_path, clean_catalog):
    spec = SPECS["tab_r1"]
    source, target = tmp_path / "in", tmp_path / "out"
    left = working_tables(spark)
    put(source, spec, 202403)
    run_table(spark, spec, str(source), str(target))
    put(source, spec, 202406)
    (source / "R1" / "Detailed_LA_202403.csv").unlink()
    report = run_table(spark, spec, str(source), str(target))
    assert (report.fresh, report.redundant) == (36, 36)
    assert {r[0] for r in spark.table("staging.tab_r1").select("quarter_ending").distinct().collect()} == {202403, 202406}
    assert {r[0] for r in spark.table(f"public.{spec.summary}").select("quarter_ending").collect()} == {202403, 202406}
    assert {r["quarter_ending"] for r in read_csv(target / f"{spec.summary_file}.csv")[1]} == {"202403", "202406"}
    assert {r["quarter_ending"] for r in read_csv(target / "tab_r1_cleaned.csv")[1]} == {"202406"}
    assert {r["quarter_ending"] for r in read_csv(target / "tab_r1_redundant.csv")[1]} == {"202403"}
    write_csv(source / "R1", "broken_202409.csv", [["title"], ["header"], ["x"]])
    with pytest.raises(Exception, match="no header"):
        run_table(spark, spec, str(source), str(target))
    assert working_tables(spark) == left  # dropped after success and after failure


def test_arriving_files_are_loaded_once(spark, tmp_path, clean_catalog):
    spec = SPECS["tab_r1"]
    source = tmp_path / "in"
    put(source, spec, 202403)
    load = lambda: load_arrivals(spark, spec, str(source), str(tmp_path / "progress"), files_at_once=1)
    load()
    put(source, spec, 202406)
    put(source, spec, 202409)
    load()
    load()
    staging = spark.table("staging.tab_r1")
    assert {(r[0], r[1]) for r in staging.groupBy("quarter_ending").count().collect()} == {
        (202403, 36), (202406, 36), (202409, 36),
    }
    assert spark.table("public.relief_duty_ending_summary").count() == 3 * 21
    # A batch replayed after a failure adds nothing: its rows are already held.
    load_arrivals(spark, spec, str(source), str(tmp_path / "progress-lost"))
    assert staging.count() == 108


def stored(spark, spec):
    return sorted(map(tuple, spark.table(f"core.{spec.summary}").select(*sorted(spark.table(f"core.{spec.summary}").columns)).collect()), key=repr)


def test_a_load_of_one_quarter_reads_one_quarter(spark, tmp_path, clean_catalog):
    """The summary after each load is that of all of staging, though the other quarters' files are out of reach."""
    spec = SPECS["tab_ta2"]
    wide = {q: clean(as_grid(spark, {f"Detailed_LA_{q}.csv": sheet(spec, authorities(spec, lambda k, j: str(q % 100 + 9 * k + j)))}), spec) for q in (202403, 202406, 202409)}
    for q in (202403, 202406):
        fresh, _ = load_fresh(wide[q], spec)
        refresh_quarters(spark, spec, fresh, [q])
    location = spark.sql("DESCRIBE TABLE EXTENDED staging.tab_ta2").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    hidden = [p for p in Path(location, "quarter_ending=202403").glob("*.parquet")]
    held = {p: p.read_bytes() for p in hidden}
    for p in hidden:
        p.write_bytes(b"not a table")
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
    try:
        revised = wide[202406].withColumn("households_in_ta", F.col("households_in_ta") + 50)
        for q, rows in ((202409, wide[202409]), (202406, revised)):
            fresh, _ = load_fresh(rows, spec)
            refresh_quarters(spark, spec, fresh, [q])
    finally:
        for p, content in held.items():
            p.write_bytes(content)
    spark.catalog.refreshTable("staging.tab_ta2")
    by_load = stored(spark, spec)
    assert len(by_load) == 3 * 17
    refresh_summary(spark, spec)
    assert stored(spark, spec) == by_load


def test_a_load_cut_off_before_the_refresh_is_made_up_for(spark, tmp_path, clean_catalog):
    spec = SPECS["tab_p1"]
    put(tmp_path, spec, 202403)
    run_table(spark, spec, str(tmp_path), str(tmp_path / "out"))
    held = spark.table("staging.tab_p1").select(*spec.staging_columns)
    rows = spark.createDataFrame(held.collect(), held.schema)
    more = rows.withColumn("prevention_duty_ended", F.col("prevention_duty_ended") + 1)
    load_fresh(more, spec)  # appended, and then the job is lost
    before = stored(spark, spec)
    fresh, _ = load_fresh(more, spec)
    assert fresh.count() == 0 and spark.table("staging.tab_p1").count() == 72
    refresh_quarters(spark, spec, fresh, [202403])
    assert stored(spark, spec) != before
    by_load = stored(spark, spec)
    refresh_summary(spark, spec)
    assert stored(spark, spec) == by_load
    refresh_quarters(spark, spec, fresh, [])
    assert stored(spark, spec) == by_load
