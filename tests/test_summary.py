import random
from dataclasses import replace
from decimal import ROUND_HALF_UP, Decimal

import pytest

from peerline.operators import benchmark as B
from peerline.plans.publish import public_columns, public_view
from peerline.plans.summary import peer_summary, peer_summary_stepwise
from peerline.specs import SPECS, TableSpec, build_measures

SPEC = TableSpec(
    name="tab_x", sheet="X", summary="x_summary", summary_file="x", focal="F", peers=tuple(f"P{i}" for i in range(9)),
    anchor="ENGLAND", group_id="N001", group_name="Neighbouring LA",
    measures=build_measures({"T": "total", "A": "part_a", "B": "part_b"}, "total", "x_", no_ratio=["part_b"]),
)


def relation(spark, data, spec=SPEC):
    full = [(f"id-{r[0]}", *r, 1 if r[0] in spec.peers else 0) for r in data]
    columns = [*spec.key_columns, *spec.measure_columns, "quarter_ending", "is_neighbouring_la"]
    types = dict((f.name, f.dataType.simpleString()) for f in spec.staging_schema)
    return spark.createDataFrame(full, ", ".join(f"{c} {types[c]}" for c in columns))


def result(df, spec=SPEC):
    return {
        (r["quarter_ending"], r["metrics"]): (r[spec.focal_column], r[spec.peer_column], r["difference"])
        for r in df.collect()
    }


def half_up(value, digits):
    return value.quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)


def brute_force(data, spec=SPEC):
    """The comparison row by row in exact arithmetic; data rows: (entity, *measures, quarter)."""
    out = {}
    cols = spec.measure_columns
    units = lambda m, v: None if v is None else Decimal(v) * (1000 if m.in_thousands else 1)
    recs = [(r[0], {m.column: units(m, v) for m, v in zip(spec.measures, r[1:-1])}, r[-1]) for r in data]

    def metrics(values):
        found = {}
        for m in spec.measures:
            found[m.label] = values[m.column]
            if m.base:
                a, b = values[m.column], values[m.base]
                found[m.ratio_label] = None if a is None or not b else half_up(a / b, 2)
        return found

    for quarter in {r[2] for r in recs if r[0] == spec.focal or r[0] in spec.peers}:
        peers = [v for e, v, q in recs if q == quarter and e in spec.peers]
        means = {}
        for c in cols:
            known = [v[c] for v in peers if v[c] is not None]
            means[c] = half_up(sum(known) / len(known), 0) if known else None
        group = metrics(means)
        own = [metrics(v) for e, v, q in recs if q == quarter and e == spec.focal]
        for name in spec.metric_names:
            known = [o[name] for o in own if o[name] is not None]
            f = max(known) if known else None
            p = group[name]
            out[quarter, name] = (f, p, None if f is None or p is None else f - p)
    return out


def test_peer_mean_skips_missing_and_rounds_halves_up(spark):
    data = [(f"P{i}", 10 * i, i if i else None, 1, 202403) for i in range(9)] + [("F", 100, 40, 2, 202403)]
    got = result(peer_summary(relation(spark, data), SPEC))
    # total: 360 / 9 = 40; part_a over eight peers: 36 / 8 = 4.5 -> 5; ratio from the rounded means: 5 / 40
    assert got[202403, "total"] == (Decimal(100), Decimal(40), Decimal(60))
    assert got[202403, "x_part_a"][1] == Decimal(5)
    assert got[202403, "perc_x_part_a"] == (Decimal("0.40"), Decimal("0.13"), Decimal("0.27"))
    assert (202403, "perc_x_part_b") not in got


def test_missing_everywhere_keeps_its_row(spark):
    data = [("P0", 5, None, 1, 202403), ("P1", 7, None, 1, 202403), ("F", 4, 2, 1, 202403)]
    got = result(peer_summary(relation(spark, data), SPEC))
    assert got[202403, "x_part_a"] == (Decimal(2), None, None)
    assert got[202403, "perc_x_part_a"] == (Decimal("0.50"), None, None)


def test_one_side_only_and_outsiders(spark):
    data = [("F", 4, 2, 1, 202403), ("P0", 8, 2, 1, 202406), ("Z", 8, 2, 1, 202409), ("ENGLAND", 9, 9, 9, 202403)]
    got = result(peer_summary(relation(spark, data), SPEC))
    assert {q for q, _ in got} == {202403, 202406}
    assert got[202403, "total"] == (Decimal(4), None, None)
    assert got[202406, "total"] == (None, Decimal(8), None)


def test_zero_denominator(spark):
    df = relation(spark, [("F", 0, 2, 1, 202403), ("P0", 8, 2, 1, 202403)])
    assert result(peer_summary(df, SPEC))[202403, "perc_x_part_a"] == (None, Decimal("0.25"), None)
    for strict in (peer_summary, peer_summary_stepwise):
        with pytest.raises(Exception, match="division by zero"):
            strict(df, SPEC, strict=True).collect()


def test_several_focal_rows_take_the_larger_value_of_each_metric(spark):
    data = [("F", 100, 10, 1, 202403), ("F", 20, 9, 1, 202403), ("P0", 1, 1, 1, 202403)]
    got = result(peer_summary(relation(spark, data), SPEC))
    assert got[202403, "total"][0] == Decimal(100)
    assert got[202403, "perc_x_part_a"][0] == Decimal("0.45")


def test_period_columns_and_public_order(spark):
    summary = peer_summary(relation(spark, [("F", 1, 1, 1, 202407), ("F", 1, 1, 1, 202412)]), SPEC)
    assert summary.columns == [
        "quarter_ending", "qtr_year", "year_qtr", "qtr_month", "metrics", "focal", "peer_group", "difference",
    ]
    view = public_view(summary, SPEC, "x_public")
    assert view.columns == public_columns(SPEC) == [
        "quarter_ending", "qtr_year", "qtr_month", "year_qtr", "focal", "peer_group", "metrics", "difference",
    ]
    got = {(r.quarter_ending, r.qtr_year, r.qtr_month, r.year_qtr) for r in spark.table("x_public").collect()}
    assert got == {(202407, 2024, 7, "q0"), (202412, 2024, 12, "q4")}


def test_result_types(spark):
    types = dict(peer_summary(relation(spark, [("F", 1, 1, 1, 202407)]), SPEC).dtypes)
    assert {types[c] for c in ("focal", "peer_group", "difference")} == {"decimal(18,2)"}
    assert {types[c] for c in ("quarter_ending", "qtr_year", "qtr_month")} == {"int"}


@pytest.mark.parametrize("table", sorted(SPECS))
def test_every_table_against_brute_force(spark, table):
    spec = SPECS[table]
    rnd = random.Random(table)
    value = lambda m: rnd.choice([None, 0, rnd.randint(0, 999)]) if not m.in_thousands else rnd.choice(
        [None, Decimal(rnd.randint(1, 99999)) / 1000]
    )
    names = [spec.focal, *spec.peers, "Elsewhere", spec.anchor]
    data = [
        (n, *(value(m) for m in spec.measures), q)
        for q in (202403, 202406, 202409, 202412)
        for n in names
        if rnd.random() < 0.85
    ]
    data += [(spec.focal, *(value(m) for m in spec.measures), 202403)]  # a revised focal row
    df = relation(spark, data, spec)
    want = brute_force(data, spec)
    assert len(want) % len(spec.metric_names) == 0
    assert result(peer_summary(df, spec), spec) == want
    if table in ("tab_a1", "tab_ta2"):
        assert result(peer_summary_stepwise(df, spec), spec) == want


def test_unpivot_and_pivot_sizes(spark):
    data = [(n, 5, 3, 1, q) for n in ("F", "P0", "P1") for q in (202403, 202406)]
    rows = B.add_ratios(B.focal_with_peers(B.to_units(relation(spark, data), SPEC), SPEC), SPEC)
    long = B.unpivot_metrics(rows, SPEC)
    assert rows.count() == 4 and long.count() == 4 * len(SPEC.metric_names)
    assert B.pivot_entities(long, SPEC).count() == 2 * len(SPEC.metric_names)


def test_union_drops_duplicates(spark):
    data = [("F", 5, 3, 1, 202403)] * 2 + [("P0", 1, 1, 1, 202403)]
    got = B.focal_with_peers(B.to_units(relation(spark, data), SPEC), SPEC).collect()
    assert {r.system_id for r in got} == {"id-F", "N001"} and len(got) == 2


def test_spec_names():
    assert sum(len(s.metric_names) for s in SPECS.values()) == 160
    assert sum(1 for s in SPECS.values() for m in s.measures if m.base) == 76
    names = {n for s in SPECS.values() for n in s.metric_names}
    assert "perc_bnb_ta_with_children_exceeding_6wks_awaiting_review_or_app" in names
    assert {"pdo_from_family_or_friend_terminations", "perc_pdo_from_family_friend_terminations"} <= names
    assert "perc_children_headcount_in_ta" not in names
    long = {f"h{i}": "x" * 58 + str(i) for i in range(2)}
    assert len({m.ratio_label for m in build_measures(long | {"t": "total"}, "total")} - {None}) == 2
    with pytest.raises(ValueError, match="used twice"):
        replace(SPECS["tab_a1"], measures=SPECS["tab_a1"].measures * 2)


def test_summary_shuffles_once_and_scans_once(spark, tmp_path):
    spec = SPECS["tab_ta1"]
    path = str(tmp_path / "staging")
    relation(spark, [("Hackney", *[1] * 21, 202403), ("Camden", *[2] * 21, 202403)], spec).write.parquet(path)
    plan = peer_summary(spark.read.parquet(path), spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    assert "PushedFilters: [Or(EqualTo(local_authority,Hackney),EqualTo(is_neighbouring_la,1))]" in plan
