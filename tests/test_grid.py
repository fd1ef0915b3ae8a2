import random
import re
from contextlib import contextmanager

import pytest
from conftest import rows
from pyspark.sql import functions as F
from sheets import write_csv

from peerline.sources.grid import cells_of, list_sources, read_grid, require_source


def test_listing_filters_by_extension_anywhere_in_the_name(spark, tmp_path):
    for name in ("a_202403.xls", "b_202406.xlsx", "c.ods", "d.csv", "xls.txt"):
        (tmp_path / name).write_text("x")
    names = lambda ext: [r[0] for r in rows(list_sources(spark, str(tmp_path), ext).select("name"))]
    assert names(["xls", "ods"]) == ["a_202403.xls", "b_202406.xlsx", "c.ods"]
    assert names("csv") == ["d.csv"]
    assert len(names(None)) == 5
    listing = list_sources(spark, str(tmp_path))
    assert "content" not in listing._jdf.queryExecution().executedPlan().toString()
    require_source(listing, "c.ods")
    with pytest.raises(FileNotFoundError, match="e.ods"):
        require_source(listing, "e.ods")


def test_cells_quotes_and_empty_marks(spark, tmp_path):
    lines = [["title", None, None], ['say "hi"', "a,b", " x "], [None, None, None], ["N/A", "nan", "0"], ["..", "é", "None"]]
    path = write_csv(tmp_path, "s_202403.csv", lines)
    got = [r["cells"] for r in read_grid(spark, path, width=4).orderBy("row_no").collect()]
    assert got == [
        ["title", None, None, None], ['say "hi"', "a,b", " x ", None], [None] * 4, [None, None, "0", None],
        ["..", "é", None, None],
    ]


def test_row_order_across_splits_and_files(spark, tmp_path):
    """Files cut into many splits, several files per task: row order is the order of lines."""
    n = 60_000
    for name, size in (("big_202403.csv", n), ("small_202406.csv", 50), ("other_202409.csv", 3000)):
        write_csv(tmp_path, name, [[str(i), "x" * 40] for i in range(size)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1MB")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 20))
    try:
        grid = read_grid(spark, str(tmp_path), width=2)
        assert grid.rdd.getNumPartitions() >= 3
        got = grid.withColumn("line", F.get("cells", F.lit(0)).cast("int")).select("file", "row_no", "line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    by_file = {}
    for r in sorted(got, key=lambda r: (r["file"], r["row_no"])):
        by_file.setdefault(r["file"].rsplit("/", 1)[1], []).append(r["line"])
    assert {k: len(v) for k, v in by_file.items()} == {"big_202403.csv": n, "small_202406.csv": 50, "other_202409.csv": 3000}
    assert all(lines == sorted(lines) for lines in by_file.values())
    assert len({(r["file"], r["row_no"]) for r in got}) == len(got)


def test_blank_lines_count_as_rows(spark, tmp_path):
    (tmp_path / "b_202403.csv").write_text("\nh1,h2\n\n1,2\n")
    got = [r["cells"] for r in read_grid(spark, str(tmp_path), width=2).orderBy("row_no").collect()]
    assert got == [[None, None], ["h1", "h2"], [None, None], ["1", "2"]]


def test_too_wide_a_line_is_an_error(spark, tmp_path):
    path = write_csv(tmp_path, "w_202403.csv", [["a", "b", "c"]])
    with pytest.raises(Exception, match="more than 2 cells"):
        read_grid(spark, path, width=2).collect()


def test_cells_over_several_lines(spark, tmp_path):
    text = 'h1,"Two\nlines, ""so"" said",h3\n1,2,3\n"a\n\nb",c,"d\n"\n'
    (tmp_path / "m_202403.csv").write_text(text)
    (tmp_path / "n_202406.csv").write_text("x,y\n")
    got = [r["cells"] for r in read_grid(spark, str(tmp_path)).orderBy("file", "row_no").collect()]
    assert [[c for c in row if c is not None] for row in got] == [
        ["h1", 'Two\nlines, "so" said', "h3"], ["1", "2", "3"], ["a\n\nb", "c", "d\n"], ["x", "y"],
    ]
    (tmp_path / "o_202409.csv").write_text('a,"b\nc\n')
    with pytest.raises(Exception, match="never closed in .*o_202409.csv"):
        read_grid(spark, str(tmp_path)).collect()


def test_any_width(spark, tmp_path):
    write_csv(tmp_path, "w_202403.csv", [[str(i) for i in range(300)], ["," * 200, "x"]])
    got = [r["cells"] for r in read_grid(spark, str(tmp_path)).orderBy("row_no").collect()]
    # Each row has its own length: the widest line fills up no other.
    assert got[0] == [str(i) for i in range(300)] and got[1] == ["," * 200, "x"]


def test_row_numbers_with_small_splits(spark, tmp_path):
    write_csv(tmp_path, "s_202403.csv", [[str(i), "x" * 20] for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64KB")
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        got = read_grid(spark, str(tmp_path)).orderBy("row_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r["cells"][0] for r in got] == [str(i) for i in range(20_000)]
    assert len({r["row_no"] for r in got}) == 20_000


@contextmanager
def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1KB")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(4))
def test_records_over_splits_agree_with_a_csv_reader(spark, tmp_path, seed):
    """Quoted cells that hold many lines, or more than a split, in files cut into splits of 16 KB."""
    some = random.Random(seed)
    signs = ["a", "b,", '"', '""', "\n", "\n\n", " ", "é", "\x01", "\x02", "\x02a", "x" * 30]
    want = {}
    for name in ("one_202403.csv", "two_202406.csv"):
        lines = []
        for _ in range(1500):
            cells = ["".join(some.choice(signs) for _ in range(some.randint(1, 6))) for _ in range(some.randint(1, 5))]
            lines.append([f"r{len(lines)}", *cells])
        for at in (3, 700, 1499):
            lines[at].append("\n".join(f"line {k} of {at}" for k in range(4000)))
        write_csv(tmp_path, name, lines)
        want[name] = lines
    with small_splits(spark, "16KB"):
        got = read_grid(spark, str(tmp_path)).orderBy("file", "row_no").collect()
    for name, lines in want.items():
        assert [r["cells"] for r in got if r["file"].endswith(name)] == [[c or None for c in line] for line in lines]


def test_splits_that_no_open_cell_reaches_are_not_moved(spark, tmp_path):
    """One line break in a long file: its lines are cut in as many tasks as there are splits, none by a window over the file."""
    write_csv(tmp_path, "l_202403.csv", [[str(i), "two\nlines" if i == 20_000 else "x" * 30] for i in range(40_000)])
    with small_splits(spark, "64KB"):
        grid = read_grid(spark, str(tmp_path))
        plan = grid._jdf.queryExecution().executedPlan().toString()
        got = grid.withColumn("task", F.spark_partition_id()).collect()
    # What is summed along a file is one row a split; lines are neither sorted nor dealt by file.
    along_files = [line for line in plan.splitlines() if re.search(r"Window .*\], \[file#\d+\], \[", line)]
    assert along_files and not any("row_no" in line or "value" in line for line in along_files), plan
    assert len({r["task"] for r in got}) >= 20
    assert sorted(int(r["cells"][0]) for r in got) == list(range(40_000))
    assert [r["cells"][1] for r in got if r["cells"][0] == "20000"] == ["two\nlines"]


def test_an_unclosed_quote_is_found_before_lines_move(spark, tmp_path):
    (tmp_path / "o_202403.csv").write_text('a,b\n"never,closed\n' + "x,y\n" * 50_000)
    with small_splits(spark, "64KB"), pytest.raises(Exception, match="never closed in .*o_202403.csv"):
        read_grid(spark, str(tmp_path))


@pytest.mark.parametrize(
    "line, cells",
    [
        ("a,b", ["a", "b"]), ("", [""]), (",", ["", ""]), ('"a,b",c', ["a,b", "c"]), ('""', [""]), ('"""a"""', ['"a"']), ('"a""b","c"', ['a"b', "c"]),
        ('say "hi, you" now,d', ['say "hi, you" now', "d"]), ('"a\nb",c', ["a\nb", "c"]), ('"\x01,\x02a","\x02b"', ["\x01,\x02a", "\x02b"]),
        ("\x01,\x02", ["\x01", "\x02"]), ('"\\",x', ["\\", "x"]),
    ],
)
def test_cells_of_a_line(spark, line, cells):
    (row,) = spark.createDataFrame([(line,)], "line string").select(cells_of(F.col("line"))).collect()
    assert row[0] == cells


def test_one_wide_line_leaves_the_others_alone(spark, tmp_path):
    write_csv(tmp_path, "w_202403.csv", [["x"] * 20_000, *([["a", "b"]] * 100)])
    got = read_grid(spark, str(tmp_path)).select(F.size("cells").alias("n")).groupBy("n").count().collect()
    assert {(r["n"], r["count"]) for r in got} == {(20_000, 1), (2, 100)}
