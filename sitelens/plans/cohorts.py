"""Derived tables that the checks read.

Inputs are DataFrames with the usual clinical column names plus ``site``; the concepts that
select rows are parameters. Every result keeps ``site``, so one run serves all sites. A fact
or visit is tied to the person by site and person_id together wherever both sides carry them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import (
    any_present,
    blank_to_null,
    days_between,
    not_in,
    pasted,
    without_letters,
    years_between,
)
from sitelens.operators.groups import rows_at_minimum
from sitelens.operators.joins import join_code_set, natural_join, site_keys
from sitelens.operators.sets import union_all, union_distinct
from sitelens.plans import fixed
from sitelens.plans.checks.common import matching_rows


def payer_with_date(
    payers: DataFrame, visits: DataFrame, uninformative: str = "Other/Unknown"
) -> DataFrame:
    """Payers with 0/1 flags for an informative class and type, and the visit's start date."""
    flags = {
        "payer_class": F.when(F.col("plan_class") == uninformative, 0).when(
            F.col("plan_class").isNotNull(), 1
        ),
        "payer_type": F.when(F.col("plan_type") == uninformative, 0).when(
            F.col("plan_type").isNotNull(), 1
        ),
    }
    keys = site_keys(payers, visits, "visit_occurrence_id")
    return natural_join(payers.withColumns(flags), visits.select(*keys, "visit_start_date"))


def gestational_age_cohort(
    visits: DataFrame,
    persons: DataFrame,
    max_years: float = 2,
    strict_reference: bool = False,
) -> DataFrame:
    """Persons first seen at max_years or younger, with a gestational age band.

    By default the expected band means 20 to 45 weeks. With strict_reference it takes every
    known age other than 0, which leaves the two outer bands empty.
    """
    firsts = rows_at_minimum(
        visits.select("site", "person_id", "visit_start_date"),
        ["site", "person_id"],
        "visit_start_date",
    ).distinct()
    weeks = F.col("pn_gestational_age")
    expected = weeks.isNotNull() if strict_reference else weeks.between(20, 45)
    band = (
        F.when((weeks == 0) | weeks.isNull(), fixed.GESTATION_UNKNOWN)
        .when(expected, fixed.GESTATION_EXPECTED)
        .when(weeks < 20, fixed.GESTATION_SHORT)
        .when(weeks > 45, fixed.GESTATION_LONG)
    )
    keys = site_keys(firsts, persons, "person_id")
    people = persons.select(*keys, "birth_date", "pn_gestational_age")
    return (
        firsts.join(people, keys)
        .withColumn("age_first_visit", years_between("birth_date", "visit_start_date"))
        .filter(F.col("age_first_visit") <= max_years)
        .withColumn("ga_group", band)
    )


LAB_COLUMNS = (
    "site",
    "person_id",
    "visit_occurrence_id",
    "measurement_concept_id",
    "measurement_source_concept_id",
    "value_as_number",
    "value_as_concept_id",
    "value_source_value",
    "measurement_source_value",
    "measurement_date",
)


def facts_in_code_set(
    facts: DataFrame, codes: DataFrame, field: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Facts whose concept belongs to a code set, optionally cut to some columns."""
    found = join_code_set(facts, codes, field)
    return found.select(*columns) if columns else found


def visits_with_specialty(
    visits: DataFrame,
    dimension: DataFrame,
    key: str,
    visit_concepts: Sequence = fixed.OUTPATIENT_VISITS,
) -> DataFrame:
    """Visits of some classes with the specialty of their provider or care site."""
    chosen = visits.filter(F.col("visit_concept_id").isin(list(visit_concepts)))
    keys = site_keys(chosen, dimension, key)
    return chosen.join(dimension.select(*keys, "specialty_concept_id"), keys)


def persons_seen_with_diagnosis(
    visits: DataFrame,
    conditions: DataFrame,
    visit_concepts: Sequence = fixed.FACE_TO_FACE_VISITS,
) -> DataFrame:
    """Persons with a face-to-face visit that carries a condition, once each.

    Conditions are made distinct per visit before the join, in partial aggregation, so a visit
    with very many of them costs no more than any other.
    """
    chosen = visits.filter(F.col("visit_concept_id").isin(list(visit_concepts)))
    keys = site_keys(chosen, conditions, "person_id", "visit_occurrence_id")
    return (
        chosen.select("site", "person_id", "visit_occurrence_id")
        .join(conditions.select(*keys).distinct(), keys, "leftsemi")
        .select("site", "person_id")
        .distinct()
    )


def geocode_cohort(
    persons: DataFrame,
    seen: DataFrame,
    uninformative_sex: Sequence = fixed.UNINFORMATIVE_SEX,
) -> DataFrame:
    """Those persons with a birth date and an informative sex, with their location."""
    return (
        persons.join(seen.select("site", "person_id"), ["site", "person_id"], "leftsemi")
        .filter(
            F.col("birth_date").isNotNull() & not_in("gender_concept_id", uninformative_sex)
        )
        .select("site", "person_id", "location_id")
        .distinct()
    )


TRACT_PARTS = ("geocode_state", "geocode_county", "geocode_tract")
BLOCK_GROUP_PARTS = (*TRACT_PARTS, "geocode_group")


def _with_geocodes(df: DataFrame) -> DataFrame:
    cleaned = blank_to_null(df)
    codes = {
        "fips_code_tct": without_letters(pasted(*TRACT_PARTS)),
        "fips_code_bg": without_letters(pasted(*BLOCK_GROUP_PARTS)),
    }
    lengths = {
        "ndigit_fips_tct": F.char_length("fips_code_tct"),
        "ndigit_fips_bg": F.char_length("fips_code_bg"),
    }
    return cleaned.withColumns(codes).withColumns(lengths)


def person_geocodes(persons: DataFrame, fips: DataFrame) -> DataFrame:
    """Current location of each person with its tract and block group codes (loc_fips)."""
    return _with_geocodes(persons.join(fips, "location_id", "left"))


def location_history_counts(
    history: DataFrame, fips: DataFrame, persons: DataFrame
) -> DataFrame:
    """Distinct complete locations per site, person and geocode year (lohis_fips).

    ngeo_lohis_tct counts locations with a full tract code, ngeo_lohis_bg with a full block
    group code. A person's repeated stays at a location are removed before anything is joined,
    so a very long history shrinks to its locations first.
    """
    located = (
        history.filter(F.lower("domain_id") == "person")
        .select("site", F.col("entity_id").alias("person_id"), "location_id")
        .distinct()
        .join(persons.select("site", "person_id").distinct(), ["site", "person_id"], "leftsemi")
        .join(fips, "location_id", "left")
    )
    coded = _with_geocodes(located).select(
        "site",
        "person_id",
        "geocode_year",
        "location_id",
        (F.col("ndigit_fips_tct") == fixed.TRACT_DIGITS).alias("tract"),
        (F.col("ndigit_fips_bg") == fixed.BLOCK_GROUP_DIGITS).alias("block"),
    )
    keys = ["site", "person_id", "geocode_year"]
    locations = (
        coded.filter(F.col("tract") | F.col("block"))
        .groupBy(*keys, "location_id")
        .agg(F.bool_or("tract").alias("tract"), F.bool_or("block").alias("block"))
    )
    present = F.col("location_id").isNotNull()
    return locations.groupBy(*keys).agg(
        F.count_if(F.col("tract") & present).alias("ngeo_lohis_tct"),
        F.count_if(F.col("block") & present).alias("ngeo_lohis_bg"),
    )


def persons_in_all(*facts: DataFrame) -> DataFrame:
    """Persons that occur in every one of the fact tables.

    Each table is reduced to its distinct persons first; the semi joins reuse that partitioning.
    """
    keys = ["site", "person_id"]
    people = facts[0].select(*keys).distinct()
    for other in facts[1:]:
        people = people.join(other.select(*keys).distinct(), keys, "leftsemi")
    return people


def persons_with_visit(
    visits: DataFrame, visit_concepts: Sequence = fixed.INPATIENT_VISITS
) -> DataFrame:
    chosen = visits.filter(F.col("visit_concept_id").isin(list(visit_concepts)))
    return chosen.select("site", "person_id").distinct()


def person_visits(*facts: DataFrame) -> DataFrame:
    """Distinct person and visit pairs over several fact tables."""
    return union_distinct(f.select("site", "person_id", "visit_occurrence_id") for f in facts)


def icu_transfers(transfers: DataFrame, services: Sequence = fixed.ICU_SERVICES) -> DataFrame:
    chosen = transfers.filter(F.col("service_concept_id").isin(list(services)))
    return chosen.select("site", "person_id", "visit_occurrence_id").distinct()


def payer_persons(payers: DataFrame, visits: DataFrame) -> DataFrame:
    """Person and visit of every payer record."""
    keys = site_keys(payers, visits, "visit_occurrence_id")
    found = payers.select(*keys).join(
        visits.select("site", "person_id", "visit_occurrence_id"), keys
    )
    return found.select("site", "person_id", "visit_occurrence_id")


def long_visits(
    visits: DataFrame,
    visit_concepts: Sequence = fixed.INPATIENT_VISITS,
    more_than_days: int = 2,
) -> DataFrame:
    """Visits of some classes that last longer than a number of days."""
    return (
        visits.filter(F.col("visit_concept_id").isin(list(visit_concepts)))
        .withColumn("los", days_between("visit_start_date", "visit_end_date").cast("double"))
        .filter(F.col("los") > more_than_days)
    )


def specialty_visits(
    visits: DataFrame,
    providers: DataFrame,
    care_sites: DataFrame,
    codes: DataFrame,
    general: int = fixed.GENERAL_SPECIALTY,
) -> DataFrame:
    """Visits whose provider or care site has a specialty of the code set.

    The provider's specialty is preferred unless it is the general one, then the care site's,
    then the general one.
    """
    provider_keys = site_keys(visits, providers, "provider_id")
    care_site_keys = site_keys(visits, care_sites, "care_site_id")
    provider_side = join_code_set(providers, codes, "specialty_concept_id").select(
        *provider_keys, F.col("specialty_concept_id").alias("prov_specialty")
    )
    site_side = join_code_set(care_sites, codes, "specialty_concept_id").select(
        *care_site_keys, F.col("specialty_concept_id").alias("cs_specialty")
    )
    return (
        visits.join(provider_side, provider_keys, "left")
        .join(site_side, care_site_keys, "left")
        .filter(any_present("prov_specialty", "cs_specialty"))
        .withColumn("visit_specialty_concept_id", _preferred(general))
        .drop("prov_specialty", "cs_specialty")
    )


def _preferred(general: int) -> Column:
    provider, care_site = F.col("prov_specialty"), F.col("cs_specialty")
    return (
        F.when(provider != general, provider)
        .when(care_site != general, care_site)
        .when((provider == general) | (care_site == general), F.lit(general))
        .otherwise(F.lit(0))
    )


def visits_by_specialty(
    visits: DataFrame,
    providers: DataFrame,
    care_sites: DataFrame,
    specialties: Mapping[str, DataFrame],
    visit_concepts: Mapping[str, object] | None = None,
    general: int = fixed.GENERAL_SPECIALTY,
    label: str = "specialty",
) -> DataFrame:
    """What specialty_visits gives for each of several code sets, told apart by a label, from one pass
    over the visits.

    Providers and care sites get the list of labelled specialties that are theirs. A visit meets each
    side once, is repeated for the labels of either, and the preference is resolved per label.
    visit_concepts restricts a label to visits of one class.
    """
    listed = union_all(
        codes.select("concept_id", F.lit(name).alias("__label")) for name, codes in specialties.items()
    )

    def side(dimension: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
        coded = join_code_set(dimension, listed, "specialty_concept_id", keep=["__label"])
        entry = F.struct("__label", "specialty_concept_id")
        # As many entries as there are labels for one specialty.
        return coded.groupBy(*keys).agg(F.collect_list(entry).alias(name))

    provider_keys = site_keys(visits, providers, "provider_id")
    care_site_keys = site_keys(visits, care_sites, "care_site_id")
    met = visits.join(side(providers, provider_keys, "__provider"), provider_keys, "left").join(
        side(care_sites, care_site_keys, "__care_site"), care_site_keys, "left"
    )
    entries = [F.coalesce(F.col(x), F.array()) for x in ("__provider", "__care_site")]
    labels = F.array_distinct(F.concat(*[F.transform(e, lambda x: x["__label"]) for e in entries]))
    labelled = met.withColumn(label, F.explode(labels))
    for name, concept in (visit_concepts or {}).items():
        labelled = labelled.filter((F.col(label) != name) | (F.col("visit_concept_id") == concept))

    def of_label(name: str) -> Column:
        own = F.filter(F.col(name), lambda x: x["__label"] == F.col(label))
        return F.explode_outer(F.transform(own, lambda x: x["specialty_concept_id"]))

    return (
        labelled.withColumn("prov_specialty", of_label("__provider"))
        .withColumn("cs_specialty", of_label("__care_site"))
        .withColumn("visit_specialty_concept_id", _preferred(general))
        .drop("prov_specialty", "cs_specialty", "__provider", "__care_site")
    )


def general_practice_visits(
    visits: DataFrame,
    providers: DataFrame,
    care_sites: DataFrame,
    codes: DataFrame,
    visit_concept=fixed.OFFICE_VISIT,
    general: int = fixed.GENERAL_SPECIALTY,
) -> DataFrame:
    office = visits.filter(F.col("visit_concept_id") == visit_concept)
    return specialty_visits(office, providers, care_sites, codes, general)


def coded_visits(
    facts: Sequence[tuple[DataFrame, str]],
    codes: DataFrame,
    visits: DataFrame,
    visit_concept=fixed.OFFICE_VISIT,
) -> DataFrame:
    """Visits of one class that carry a concept of the code set in any of the fact tables.

    facts pairs each table with its concept column. Used for well-care visits.
    """
    columns = ["site", "person_id", "visit_occurrence_id"]
    coded = union_distinct(
        join_code_set(table, codes, field).select(*columns) for table, field in facts
    )
    keys = site_keys(coded, visits, "visit_occurrence_id")
    office = visits.filter(F.col("visit_concept_id") == visit_concept).select(
        *keys, "visit_concept_id", "visit_start_date"
    )
    return (
        coded.join(office, keys)
        .select(*columns, "visit_concept_id", "visit_start_date")
        .distinct()
    )


def facts_at_visits(
    facts: DataFrame,
    visits: DataFrame,
    visit_concepts: Sequence,
    type_field: str | None = None,
    type_concept=None,
) -> DataFrame:
    """Facts, optionally of one record type, at visits of some classes."""
    if type_field is not None:
        facts = facts.filter(F.col(type_field) == type_concept)
    chosen = visits.filter(F.col("visit_concept_id").isin(list(visit_concepts)))
    keys = site_keys(facts, visits, "visit_occurrence_id")
    return facts.join(chosen.select(*keys, "visit_concept_id"), keys)


@dataclass(frozen=True)
class Setting:
    """Where facts are looked for: classes of visits, and a record type if it matters."""

    visit_concepts: Sequence
    type_concept: object = None


def facts_by_setting(
    facts: DataFrame,
    visits: DataFrame,
    settings: Mapping[str, Setting],
    type_field: str,
    label: str = "setting",
) -> DataFrame:
    """What facts_at_visits gives for each of several settings, told apart by a label.

    Facts and visits are read and joined once; a row is repeated only for the settings it belongs to.
    """
    every = sorted({c for s in settings.values() for c in s.visit_concepts}, key=str)
    keys = site_keys(facts, visits, "visit_occurrence_id")
    chosen = visits.filter(F.col("visit_concept_id").isin(every))
    met = facts.join(chosen.select(*keys, "visit_concept_id"), keys)

    def belongs(setting: Setting) -> Column:
        at = F.col("visit_concept_id").isin(list(setting.visit_concepts))
        if setting.type_concept is None:
            return at
        return at & (F.col(type_field) == setting.type_concept)

    items = [(name, belongs(setting), {}) for name, setting in settings.items()]
    return matching_rows(met, items, met.columns).withColumnRenamed("check_name", label)


def persons_with_code_and_lab(
    conditions: DataFrame,
    dx_codes: DataFrame,
    labs: DataFrame,
    lab_codes: DataFrame,
    condition_field: str = "condition_concept_id",
    lab_field: str = "measurement_concept_id",
) -> DataFrame:
    """Persons with a condition of one code set and a measurement of another."""
    diagnosed = join_code_set(conditions, dx_codes, condition_field).select("site", "person_id")
    tested = join_code_set(labs, lab_codes, lab_field).select("site", "person_id")
    return persons_in_all(diagnosed, tested)


def with_descendants(codes: DataFrame, ancestors: DataFrame) -> DataFrame:
    """Concepts of a code set and everything below them in the vocabulary's hierarchy.

    Our definition: the closure table lists ancestor and descendant pairs; a code is kept
    itself even when the table does not pair it with itself.
    """
    extra = [name for name in codes.columns if name != "concept_id"]
    below = codes.join(
        ancestors, codes["concept_id"] == ancestors["ancestor_concept_id"]
    ).select(F.col("descendant_concept_id").alias("concept_id"), *extra)
    return codes.select("concept_id", *extra).unionByName(below).distinct()
