"""What results must show, written out: the SQL and the test sheets hold the specs to these texts and take nothing from them."""

from __future__ import annotations

# Fixed values, in sheet order: header text and staging column of every measure.
SHEETS: dict[str, dict[str, str]] = {
    "tab_a1": {
        "Total number of households assessed1,2": "initial_assessments",
        "Total households assessed as owed a duty": "owed_prevention_or_relief_duty",
        "Threatened with homelessness - Prevention duty owed": "prevention_duty_owed",
        "Homeless - Relief duty owed": "relief_duty_owed",
        "Unnamed: 15": "households_in_area_000s",
    },
    "tab_a2p": {
        "Unnamed: 4": "prevention_duty_owed",
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
    },
    "tab_a2r": {
        "Unnamed: 4": "relief_duty_owed",
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
    },
    "tab_p1": {
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
    },
    "tab_r1": {
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
    },
    "tab_ta1": {
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
    },
    "tab_ta2": {
        "Unnamed: 4": "households_in_ta",
        "Couple with dependent children": "couple_with_children_ta",
        "Single parent with dependent children  -  Male": "single_father_with_children_ta",
        "Single parent with dependent children  -  Female": "single_mother_with_children_ta",
        "Single parent with dependent children  -  Other/gender not known": "single_parent_of_other_unknown_gender_with_children_ta",
        "Single adult  -  Male": "single_man_ta",
        "Single adult  -  Female": "single_woman_ta",
        "Single adult  -  Other/gender not known": "single_other_gender_ta",
        "All other household types4": "all_other_household_types_ta",
    },
}

# What stands before a count's name in the summary, and the ratio names that are not `perc_` and that name.
PREFIXES = {"tab_a2p": "pdo_from_", "tab_a2r": "rdo_from_", "tab_p1": "pde_by_", "tab_r1": "rde_by_"}
RATIO_NAMES = {
    ("tab_a2p", "family_or_friend_terminations"): "perc_pdo_from_family_friend_terminations",
    ("tab_a2r", "family_or_friend_terminations"): "perc_rdo_from_family_friend_terminations",
    ("tab_ta1", "bnb_ta_with_children_exceeding_6wks_awaiting_review_or_appeal"): (
        "perc_bnb_ta_with_children_exceeding_6wks_awaiting_review_or_app"
    ),
}
NO_RATIO = {("tab_ta1", "children_headcount_in_ta")}
ANCHOR = "ENGLAND"


def columns(table: str) -> list[str]:
    return list(SHEETS[table].values())


def metrics(table: str) -> list[tuple[str, str | None, str, str | None]]:
    """(column, what divides it, name of the count, name of the ratio) of every measure."""
    first, *rest = columns(table)
    if table == "tab_a1":
        divisors = {first: rest[-1], **{c: first for c in rest[:-1]}}
        named = [(c, divisors.get(c), c.removesuffix("_000s")) for c in (first, *rest)]
    else:
        prefix = PREFIXES.get(table, "")
        named = [(first, None, first)]
        named += [(c, None if (table, c) in NO_RATIO else first, prefix + c) for c in rest]
    return [(c, base, name, (RATIO_NAMES.get((table, c)) or f"perc_{name}") if base else None) for c, base, name in named]
