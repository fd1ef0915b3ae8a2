"""Sheets for tests: as grid rows, and as CSV files."""

import csv
from pathlib import Path

from peerline.specs import TableSpec


def header_row(spec: TableSpec, extra: int = 0) -> list[str | None]:
    """Named headers keep clear of the fixed positions."""
    fixed = {int(h.split()[-1]): c for c, h in zip(columns(spec), spec.headers) if h.startswith("Unnamed")}
    free = (i for i in range(2, 500) if i not in fixed)
    place = {next(free): h for h in spec.headers if not h.startswith("Unnamed")}
    width = max([*fixed, *place]) + 1 + extra
    return [place.get(i) for i in range(width)]


def columns(spec: TableSpec) -> list[str]:
    return [*spec.key_columns, *spec.measure_columns]


def positions(spec: TableSpec, header: list[str | None]) -> list[int]:
    return [int(h.split()[-1]) if h.startswith("Unnamed") else header.index(h) for h in spec.headers]


def sheet(spec: TableSpec, records: list[tuple], header=None, above=(), below=(), extra=0) -> list[list]:
    """Title, header, rows above the anchor, the anchor's row and records, notes."""
    header = header or header_row(spec, extra)
    at = positions(spec, header)

    def line(values):
        cells = [None] * len(header)
        for i, v in zip(at, values):
            cells[i] = v
        return cells

    title = [f"Table {spec.sheet}"] + [None] * (len(header) - 1)
    blank = [None] * len(header)
    sub = [None, None] + ["count"] * (len(header) - 2)
    total = line(["E92000001", spec.anchor] + ["100"] * len(spec.measures))
    return [title, header, sub, blank, *map(line, above), total, blank, *map(line, records), *map(line, below)]


def write_csv(folder: Path, name: str, rows: list[list]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w", newline="", encoding="utf8") as f:
        csv.writer(f, lineterminator="\n").writerows([["" if c is None else c for c in r] for r in rows])
    return str(folder / name)


def as_grid(spark, files: dict[str, list[list]]):
    data = [(name, i, r) for name, rows in files.items() for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "file string, row_no bigint, cells array<string>")


def authorities(spec: TableSpec, value, outsiders=25) -> list[tuple]:
    """A record per focal, peer and outsider authority; `value(entity number, measure number)` fills it."""
    names = [spec.focal, *spec.peers, *(f"Town {i}" for i in range(outsiders))]
    return [(f"E{k:08d}", n, *(value(k, j) for j in range(len(spec.measures)))) for k, n in enumerate(names)]
