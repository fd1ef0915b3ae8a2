"""Declarative description of each quarterly table and its summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

QUARTER = "quarter_ending"
PEER_FLAG = "is_neighbouring_la"


@dataclass(frozen=True)
class Measure:
    """One metric column.

    `base` is the column it is divided by in the summary (None: no ratio).
    A measure in thousands is held with three decimals and shown in units.
    """

    column: str
    header: str
    label: str
    base: str | None = None
    ratio_label: str | None = None
    in_thousands: bool = False

    @property
    def data_type(self) -> T.DataType:
        return T.DecimalType(18, 3) if self.in_thousands else T.LongType()


@dataclass(frozen=True)
class TableSpec:
    """A source sheet, its staging table and its summary."""

    name: str
    sheet: str
    summary: str
    summary_file: str
    measures: tuple[Measure, ...]
    focal: str
    peers: tuple[str, ...]
    anchor: str
    group_id: str
    group_name: str
    focal_column: str = "focal"
    peer_column: str = "peer_group"
    id_column: str = "system_id"
    entity_column: str = "local_authority"
    id_header: str = "Unnamed: 0"
    entity_header: str = "Unnamed: 1"
    export_all_rows: bool = False  # cleaned CSV: every row with its fingerprint, or fresh rows only

    def __post_init__(self) -> None:
        names = self.metric_names
        twice = sorted({n for n in names if names.count(n) > 1})
        if twice:
            raise ValueError(f"{self.name}: metric names used twice: {', '.join(twice)}")

    @property
    def measure_columns(self) -> list[str]:
        return [m.column for m in self.measures]

    @property
    def key_columns(self) -> list[str]:
        return [self.id_column, self.entity_column]

    @property
    def staging_columns(self) -> list[str]:
        return [*self.key_columns, *self.measure_columns, QUARTER, PEER_FLAG]

    @property
    def headers(self) -> list[str]:
        """Source header text of each key and measure column, in staging order."""
        return [self.id_header, self.entity_header, *(m.header for m in self.measures)]

    @property
    def staging_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType(), False) for c in self.key_columns]
        fields += [T.StructField(m.column, m.data_type, True) for m in self.measures]
        fields += [T.StructField(c, T.IntegerType(), True) for c in (QUARTER, PEER_FLAG)]
        return T.StructType(fields)

    @property
    def metric_names(self) -> list[str]:
        """Every name the summary's `metrics` column can hold."""
        names = []
        for m in self.measures:
            names.append(m.label)
            if m.base:
                names.append(m.ratio_label)
        return names

    def for_entities(self, focal: str, peers: Sequence[str], **changes: object) -> TableSpec:
        """The same table compared for another focal entity and peer group."""
        return replace(self, focal=focal, peers=tuple(peers), **changes)


def build_measures(
    headers: Mapping[str, str],
    total: str,
    prefix: str = "",
    no_ratio: Sequence[str] = (),
    ratio_names: Mapping[str, str] | None = None,
) -> tuple[Measure, ...]:
    """Measures from a {header: column} map where `total` divides all the others.

    Labels carry `prefix`, ratio labels `perc_` + prefix; `ratio_names` holds the ratio names that differ.
    """
    ratio_names = ratio_names or {}
    out = []
    for header, column in headers.items():
        if column == total:
            out.append(Measure(column, header, column))
            continue
        if column in no_ratio:
            out.append(Measure(column, header, prefix + column))
            continue
        ratio = f"perc_{prefix}{ratio_names.get(column, column)}"
        out.append(Measure(column, header, prefix + column, total, ratio))
    return tuple(out)


# ---------------------------------------------------------------------------
# Source texts, table and metric names, entities. They must stay
# exactly as they are for the results to match.
# ---------------------------------------------------------------------------

FOCAL = "Hackney"
PEERS = (
    "Southwark",
    "Islington",
    "Haringey",
    "Lambeth",
    "Tower Hamlets",
    "Camden",
    "Waltham Forest",
    "Hammersmith & Fulham",
    "Newham",
)
ANCHOR = "ENGLAND"
GROUP_ID = "N001"
GROUP_NAME = "Neighbouring LA"
FOCAL_COLUMN = "hackney_la"
PEER_COLUMN = "neighbouring_la"

A1_HEADERS = {
    "Total number of households assessed1,2": "initial_assessments",
    "Total households assessed as owed a duty": "owed_prevention_or_relief_duty",
    "Threatened with homelessness - Prevention duty owed": "prevention_duty_owed",
    "Homeless - Relief duty owed": "relief_duty_owed",
    "Unnamed: 15": "households_in_area_000s",
}

A2_REASON_HEADERS = {
    "Family or friends no longer willing or able to accommodate": "family_or_friend_terminations",
    "End of private rented tenancy - assured shorthold": "ast_private_rented_terminations",
    "Domestic abuse": "domestic_abuse_terminations",
    "Non-violent relationship breakdown with partner": "non_violent_relationship_breakdown_terminations",
    "End of social rented tenancy": "social_rented_tenancy_terminations",
    "Eviction from supported housing": "supported_housing_terminations",
    "End of private rented tenancy - not assured shorthold": "non_ast_private_rented_terminations",
    "Other violence or harrassment": "other_violence_or_harassment_terminations",
    "Left institution with no accommodation available": "institution_departures",
    "Required to leave accommodation provided by Home Office as asylum support": "home_office_asylum_support_terminations",
    "Home no longer suitable - disability / ill health": "new_home_for_illness_or_disability",
    "Unnamed: 56": "loss_of_placement_or_sponsorship",
    "Other reasons / not known6": "for_other_or_unknown_reasons",
}

# The ratio of this reason is named without the "or".
TA1_RATIO_NAMES = {
    "bnb_ta_with_children_exceeding_6wks_awaiting_review_or_appeal": "bnb_ta_with_children_exceeding_6wks_awaiting_review_or_app",
}
A2_RATIO_NAMES = {"family_or_friend_terminations": "family_friend_terminations"}

P1_HEADERS = {
    "Total number of households where prevention duty ended1,2": "prevention_duty_ended",
    "Secured accommodation for 6+ months": "secured_accommodation",
    "Homeless (including intentionally homeless)": "homelessness",
    "Contact lost": "contact_lost",
    "56 days elapsed and no further action": "no_further_action_after_56days",
    "Withdrew application / applicant deceased": "applicant_withdrew_or_deceased",
    "No longer eligible": "no_longer_eligible",
    "Refused suitable accommodation offer": "rejected_offered_accommodation",
    "Refused to cooperate": "uncooperative",
    "Not known6": "not_known",
}

R1_HEADERS = {
    "Total number of households where relief duty ended1,2": "relief_duty_ended",
    "Secured accommodation for 6+ months": "secured_accommodation",
    "56 days elapsed": "after_56days_deadline",
    "Contact lost": "contact_lost",
    "Withdrew application / applicant deceased": "applicant_withdrew_or_deceased",
    "Refused final accommodation": "rejected_final_accommodation_offered",
    "Intentionally homeless from accommodation provided": "intentionally_homeless_from_accommodation_provided",
    "Local connection referral accepted by other LA": "accepted_by_another_la",
    "No longer eligible": "no_longer_eligible",
    "Notice served due to refusal to cooperate": "uncooperative_and_served_notice",
    "Not known": "not_known",
}

TA1_HEADERS = {
    "Households in temporary accommodation at end of quarter1": "households_in_ta",
    "Households in temporary accommodation at end of quarter1 children": "ta_households_with_children",
    "Unnamed: 8": "children_headcount_in_ta",
    "Bed and breakfast hotels (including shared annexes)": "bnb_ta_households",
    "Bed and breakfast hotels (including shared annexes) children": "bnb_ta_with_children",
    "Unnamed: 12": "bnb_ta_with_children_exceeding_6wks",
    "Unnamed: 13": "bnb_ta_with_children_exceeding_6wks_awaiting_review_or_appeal",
    "Unnamed: 14": "bnb_ta_with_16yo_17yo_main_applicant",
    "Nightly paid, privately managed accommodation, self-contained": "nightly_paid_ta_households",
    "Nightly paid, privately managed accommodation, self-contained children": "nightly_paid_ta_with_children",
    "Hostels (including reception centres, emergency units and refuges)": "hostel_ta_households",
    "Hostels (including reception centres, emergency units and refuges) children": "hostel_ta_with_children",
    "Private sector accommodation leased by authority or by a registered provider": "private_sector_ta",
    "Private sector accommodation leased by authority or by a registered provider children": "private_sector_ta_with_children",
    "Local authority or Housing association (LA/HA) stock": "la_ha_owned_managed_ta_households",
    "Local authority or Housing association (LA/HA) stock children": "la_ha_owned_managed_ta_with_children",
    "Any other type of temporary accommodation (including private landlord and not known)2": "any_other_type_ta",
    "Any other type of temporary accommodation (including private landlord and not known)2 children": "any_other_type_ta_with_children",
    "In TA in another local authority district": "in_another_la_ta",
    "Duty owed, no accommodation secured3": "no_secured_accommodation_ta",
    "Duty owed, no accommodation secured3 children": "no_secured_accommodation_ta_with_children",
}

TA2_HEADERS = {
    "Unnamed: 4": "households_in_ta",
    "Couple with dependent children": "couple_with_children_ta",
    "Single parent with dependent children  -  Male": "single_father_with_children_ta",
    "Single parent with dependent children  -  Female": "single_mother_with_children_ta",
    "Single parent with dependent children  -  Other/gender not known": "single_parent_of_other_unknown_gender_with_children_ta",
    "Single adult  -  Male": "single_man_ta",
    "Single adult  -  Female": "single_woman_ta",
    "Single adult  -  Other/gender not known": "single_other_gender_ta",
    "All other household types4": "all_other_household_types_ta",
}

# ---------------------------------------------------------------------------


def _spec(name: str, sheet: str, summary: str, measures: tuple[Measure, ...], **extra: object) -> TableSpec:
    settings = dict(
        summary_file=summary,
        focal=FOCAL,
        peers=PEERS,
        anchor=ANCHOR,
        group_id=GROUP_ID,
        group_name=GROUP_NAME,
        focal_column=FOCAL_COLUMN,
        peer_column=PEER_COLUMN,
    )
    settings.update(extra)
    return TableSpec(name=name, sheet=sheet, summary=summary, measures=measures, **settings)


def _assessment_measures() -> tuple[Measure, ...]:
    """Assessments per household in the area; duties per assessment; area shown in units."""
    base = {
        "initial_assessments": "households_in_area_000s",
        "owed_prevention_or_relief_duty": "initial_assessments",
        "prevention_duty_owed": "initial_assessments",
        "relief_duty_owed": "initial_assessments",
    }
    return tuple(
        Measure(column, header, column, base[column], f"perc_{column}")
        if column in base
        else Measure(column, header, column.removesuffix("_000s"), in_thousands=True)
        for header, column in A1_HEADERS.items()
    )


def _reason_measures(duty: str, prefix: str) -> tuple[Measure, ...]:
    total = f"{duty}_duty_owed"
    headers = {"Unnamed: 4": total, **A2_REASON_HEADERS}
    return build_measures(headers, total, prefix, ratio_names=A2_RATIO_NAMES)


SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in (
        _spec(
            "tab_a1", "A1", "initial_asmt_summary", _assessment_measures(),
            summary_file="initial_assessment_summary", export_all_rows=True,
        ),
        _spec("tab_a2p", "A2P", "prevention_duty_summary", _reason_measures("prevention", "pdo_from_")),
        _spec("tab_a2r", "A2R", "relief_duty_summary", _reason_measures("relief", "rdo_from_")),
        _spec(
            "tab_p1", "P1", "prevention_duty_ending_summary",
            build_measures(P1_HEADERS, "prevention_duty_ended", "pde_by_"),
        ),
        _spec(
            "tab_r1", "R1", "relief_duty_ending_summary",
            build_measures(R1_HEADERS, "relief_duty_ended", "rde_by_"),
        ),
        _spec(
            "tab_ta1", "TA1", "temp_accommodation_summary",
            build_measures(TA1_HEADERS, "households_in_ta", no_ratio=["children_headcount_in_ta"], ratio_names=TA1_RATIO_NAMES),
        ),
        _spec(
            "tab_ta2", "TA2", "temp_accommodation_households_summary",
            build_measures(TA2_HEADERS, "households_in_ta"),
        ),
    )
}
