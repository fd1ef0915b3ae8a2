from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sheets import as_grid, authorities, header_row, positions, sheet

from peerline.plans.clean import _profile, clean
from peerline.specs import SPECS

A1, P1 = SPECS["tab_a1"], SPECS["tab_p1"]


def by_name(df):
    return {r["local_authority"]: r for r in df.collect()}


def number(k, j):
    return str(100 + 10 * k + j)


@pytest.mark.parametrize("table", sorted(SPECS))
def test_every_table_is_read_by_its_header(spark, table):
    spec = SPECS[table]
    grid = as_grid(spark, {"Detailed_LA_202406_revised.csv": sheet(spec, authorities(spec, number))})
    got = clean(grid, spec)
    assert got.columns == spec.staging_columns
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in spec.staging_schema]
    rows = by_name(got)
    assert len(rows) == 36
    camden = rows["Camden"]
    k = [spec.focal, *spec.peers].index("Camden")
    assert [camden[c] for c in spec.measure_columns] == [
        Decimal(number(k, j)) if m.in_thousands else int(number(k, j)) for j, m in enumerate(spec.measures)
    ]
    assert (camden["quarter_ending"], camden["is_neighbouring_la"]) == (202406, 1)
    assert sum(r["is_neighbouring_la"] for r in rows.values()) == 9
    assert rows["ENGLAND"]["is_neighbouring_la"] == 0


def test_cells(spark):
    def value(k, j):
        return {0: "..", 1: "1,234", 2: "-", 3: " 12 ", 4: "1e3", 5: "7..", 6: None}.get(k, "5") if j == 0 else "3"

    rows = by_name(clean(as_grid(spark, {"X_202406.csv": sheet(A1, authorities(A1, value))}), A1))
    names = [A1.focal, *A1.peers]
    assert [rows[n]["initial_assessments"] for n in names[:8]] == [None, None, None, 12, 1000, 7, None, 5]
    assert rows["Hackney"]["households_in_area_000s"] == Decimal("3.000")


def test_not_whole_is_an_error(spark):
    grid = as_grid(spark, {"X_202406.csv": sheet(A1, authorities(A1, lambda k, j: "12.5" if j == 1 else "3"))})
    with pytest.raises(Exception, match="owed_prevention_or_relief_duty: not a whole number"):
        clean(grid, A1).collect()


def test_files_with_different_column_order(spark):
    header = header_row(P1)
    turned = header[:2] + header[2:][::-1]
    files = {
        "X_202403.csv": sheet(P1, authorities(P1, number)),
        "X_202406.csv": sheet(P1, authorities(P1, number), header=turned),
    }
    rows = {(r["quarter_ending"], r["local_authority"]): r for r in clean(as_grid(spark, files), P1).collect()}
    assert len(rows) == 72
    old, new = rows[202403, "Newham"], rows[202406, "Newham"]
    assert [old[c] for c in P1.measure_columns] == [new[c] for c in P1.measure_columns]
    assert positions(P1, header) != positions(P1, turned)


def test_duplicates_and_anchor(spark):
    copy = ("E00000000", "Copied", *["1"] * 5)
    records = [*authorities(A1, number), copy, copy]
    # The same row above the anchor is the first occurrence: the copies below go with it.
    above = sheet(A1, records, above=[copy])
    rows = by_name(clean(as_grid(spark, {"X_202406.csv": above}), A1))
    assert "Copied" not in rows and "ENGLAND" in rows and len(rows) == 36
    rows = clean(as_grid(spark, {"X_202406.csv": sheet(A1, records)}), A1)
    assert rows.filter("local_authority = 'Copied'").count() == 1


def test_rows_equal_only_in_wanted_columns_are_both_kept(spark):
    records = authorities(A1, number) + [("E1", "Same", *["1"] * 5)] * 2
    rows = sheet(A1, records, extra=1)
    for i, r in enumerate(rows[2:]):  # an unwanted, well-filled column tells the two apart
        r[-1] = str(i)
    grid = as_grid(spark, {"X_202406.csv": rows})
    assert clean(grid, A1).filter("local_authority = 'Same'").count() == 2
    for r in rows[5:]:  # nearly empty it does not count
        r[-1] = None
    rows[-1][-1] = "note"
    assert clean(as_grid(spark, {"X_202406.csv": rows}), A1).filter("local_authority = 'Same'").count() == 1


def test_rows_without_id_or_cells_are_dropped(spark):
    below = [(None, "No id", *["1"] * 5), ("Note: figures are rounded.",), ("E3", "Bare"), ("E4", "Enough", "1")]
    rows = by_name(clean(as_grid(spark, {"X_202406.csv": sheet(A1, authorities(A1, number), below=below)}), A1))
    assert "Enough" in rows and len(rows) == 37


def test_misspelt_header(spark):
    header = [h.replace("Homeless - R", "Homeles - R") if h else h for h in header_row(A1)]
    at = positions(A1, header_row(A1))
    rows = sheet(A1, authorities(A1, number))
    rows[1] = header
    assert at
    with pytest.raises(Exception, match="tab_a1: no header Homeless - Relief duty owed in X_202406.csv"):
        clean(as_grid(spark, {"X_202406.csv": rows}), A1)


@pytest.mark.parametrize("filled,fine", [(19, False), (20, True)])
def test_nearly_empty_wanted_column(spark, filled, fine):
    records = authorities(A1, lambda k, j: None if j == 1 and k >= filled - 2 else "4")  # sub-header and total count too
    grid = as_grid(spark, {"X_202406.csv": sheet(A1, records)})
    if fine:
        assert clean(grid, A1).count() == 36
    else:
        with pytest.raises(Exception, match="fewer than 20 cells under Total households assessed as owed a duty"):
            clean(grid, A1)


def test_no_quarter_in_the_name(spark):
    with pytest.raises(Exception, match="tab_a1: no quarter in the name of X_1999.csv"):
        clean(as_grid(spark, {"X_1999.csv": sheet(A1, authorities(A1, number))}), A1)


def test_sheet_wider_than_allowed(spark):
    with pytest.raises(Exception, match="more than 10 columns"):
        clean(as_grid(spark, {"X_202406.csv": sheet(A1, authorities(A1, number))}), A1, width=10)


def test_sheet_without_anchor_or_header(spark):
    rows = sheet(A1, authorities(A1, number))
    good = {"X_202403.csv": rows}
    lost = [r for r in rows if A1.anchor not in r]
    with pytest.raises(ValueError, match="no row named ENGLAND in X_202406.csv"):
        clean(as_grid(spark, {**good, "X_202406.csv": lost}), A1)
    with pytest.raises(Exception, match="no header row"):
        clean(as_grid(spark, {**good, "X_202406.csv": rows[:1]}), A1)


def test_a_stray_cell_tells_no_rows_apart_and_a_wide_line_widens_no_other(spark):
    """A nearly empty column between full ones does not count, nor do 5,000 cells of one line."""
    lines = [[*line, "full"] for line in sheet(P1, authorities(P1, number), extra=1)]
    spare = len(lines[1]) - 2
    body = next(i for i, line in enumerate(lines) if line[1] == "Camden")
    copy = list(lines[body])
    copy[spare] = "a remark"
    wide = [*lines[body], *(["z"] * 5000)]
    grid = as_grid(spark, {"Detailed_LA_202406.csv": [*lines, copy, wide]})
    profile = {r["place"]: r["n"] for r in _profile(grid).select(F.explode("filled").alias("place", "n")).collect()}
    assert 1 <= profile[spare] < 20 and profile[len(lines[body]) + 4999] == 1 and profile[1] >= 36
    got = clean(grid, P1).collect()
    assert len(got) == 36 and sum(r["local_authority"] == "Camden" for r in got) == 1


def test_profile_counts_filled_cells_only(spark):
    rows = [("a", 5, ["x", None, "y"]), ("a", 7, []), ("a", 6, [None, "z"]), ("b", 9, [None])]
    got = _profile(spark.createDataFrame(rows, "file string, row_no bigint, cells array<string>"))
    assert {r["file"]: (r["first_row"], r["filled"]) for r in got.collect()} == {"a": (5, {0: 1, 1: 1, 2: 1}), "b": (9, {})}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "partial_min" in plan
