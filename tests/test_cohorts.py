"""Hand-made clinical frames for the cohort builders."""

import datetime

import pytest
from pyspark.sql import functions as F

from sitelens.plans import cohorts, fixed

D = datetime.date


def visits_of(spark, *rows):
    return spark.createDataFrame(
        [("a", p, v, c, s, d) for p, v, c, s, d in rows],
        "site string, person_id bigint, visit_occurrence_id bigint, visit_concept_id bigint,"
        " visit_source_concept_id bigint, visit_start_date date",
    )


def gestation(spark, strict):
    ages = [0.0, None, 10.0, 30.0, 50.0, 30.0]
    persons = spark.createDataFrame(
        [(i, D(2010, 1, 1), age) for i, age in enumerate(ages)],
        "person_id bigint, birth_date date, pn_gestational_age double",
    )
    # Person 5 is first seen at three years; the others at one year, and again later.
    rows = [(i, 10 + i, 9202, 1, D(2011, 1, 1) if i < 5 else D(2013, 1, 1)) for i in range(6)]
    rows += [(i, 20 + i, 9202, 1, D(2015, 1, 1)) for i in range(6)]
    return cohorts.gestational_age_cohort(
        visits_of(spark, *rows), persons, strict_reference=strict
    )


@pytest.mark.parametrize("strict", [False, True])
def test_gestational_age_bands(spark, rows, strict):
    found = rows(gestation(spark, strict), "person_id", "ga_group")
    low = fixed.GESTATION_EXPECTED if strict else fixed.GESTATION_SHORT
    high = fixed.GESTATION_EXPECTED if strict else fixed.GESTATION_LONG
    assert found == [
        (0, fixed.GESTATION_UNKNOWN),
        (1, fixed.GESTATION_UNKNOWN),
        (2, low),
        (3, fixed.GESTATION_EXPECTED),
        (4, high),
    ]


FIPS = "location_id bigint, geocode_state string, geocode_county string, geocode_tract string, geocode_group string, geocode_year int"
PLACES = [
    (1, "42", "101", "000100", "1", 2020),
    (2, "42", "101", "", "1", 2020),
    (3, "42", " ", "000100", "1", 2020),
    (4, "42", "101", None, "1", 2020),
    (5, "PA42", "101", "T000100", "1", 2020),
    (6, "42", "101", "000100", None, 2020),
    (6, "42", "101", "000100", "2", 2010),
]


def test_geocodes(spark, rows):
    people = spark.createDataFrame(
        [("a", i, i) for i in range(1, 8)], "site string, person_id bigint, location_id bigint"
    )
    coded = cohorts.person_geocodes(people, spark.createDataFrame(PLACES, FIPS))
    assert rows(coded, "person_id", "fips_code_tct", "ndigit_fips_tct", "ndigit_fips_bg") == [
        (1, "42101000100", 11, 12),
        (2, "42101", 5, 6),
        (3, "42000100", 8, 9),
        (4, "42101", 5, 6),
        (5, "42101000100", 11, 12),
        (6, "42101000100", 11, 11),
        (6, "42101000100", 11, 12),
        (7, "", 0, 0),
    ]


def test_location_history_counts_distinct_complete_locations(spark, rows):
    stays = [
        (1, "Person", 1),
        (1, "PERSON", 1),
        (1, "person", 5),
        (1, "person", 6),
        (1, "person", 2),
        (1, "care_site", 1),
        (2, "person", 4),
        (9, "person", 1),
    ]
    history = spark.createDataFrame(
        [("a", p, d, loc, D(2020, 1, 1), None) for p, d, loc in stays],
        "site string, entity_id bigint, domain_id string, location_id bigint, start_date date,"
        " end_date date",
    )
    people = spark.createDataFrame([("a", 1), ("a", 2)], "site string, person_id bigint")
    counted = cohorts.location_history_counts(history, spark.createDataFrame(PLACES, FIPS), people)
    assert rows(counted, "person_id", "geocode_year", "ngeo_lohis_tct", "ngeo_lohis_bg") == [
        (1, 2010, 1, 1),
        (1, 2020, 3, 2),
    ]


def test_specialty_choice(spark, rows):
    general = fixed.GENERAL_SPECIALTY
    visits = spark.createDataFrame(
        [(1, 1, None), (2, None, 1), (3, 1, 1), (4, 2, 1), (5, 2, 2), (6, 3, 3)],
        "visit_occurrence_id bigint, provider_id bigint, care_site_id bigint",
    )
    providers = spark.createDataFrame(
        [(1, 100), (2, general), (3, 999)], "provider_id bigint, specialty_concept_id bigint"
    )
    care_sites = spark.createDataFrame(
        [(1, 200), (2, general), (3, 999)], "care_site_id bigint, specialty_concept_id bigint"
    )
    codes = spark.createDataFrame([(100,), (200,), (general,)], "concept_id bigint")
    found = cohorts.specialty_visits(visits, providers, care_sites, codes)
    assert rows(found, "visit_occurrence_id", "visit_specialty_concept_id") == [
        (1, 100),
        (2, 200),
        (3, 100),
        (4, 200),
        (5, general),
    ]


def test_payer_flags_keep_null(spark, rows):
    payers = spark.createDataFrame(
        [(1, "Other/Unknown", None), (2, "Private", "Other/Unknown"), (3, "x", "y")],
        "visit_occurrence_id bigint, plan_class string, plan_type string",
    )
    visits = visits_of(spark, (1, 1, 9202, 1, D(2020, 1, 1)), (1, 2, 9202, 1, D(2020, 1, 2)))
    dated = cohorts.payer_with_date(payers, visits)
    assert rows(dated, "visit_occurrence_id", "payer_class", "payer_type") == [
        (1, 0, None),
        (2, 1, 0),
    ]


def test_long_visits_and_persons(spark, rows):
    visits = visits_of(
        spark,
        (1, 1, 9201, 1, D(2020, 1, 1)),
        (2, 2, 9201, 1, D(2020, 1, 1)),
        (3, 3, 9202, 1, D(2020, 1, 1)),
    )
    ends = spark.createDataFrame(
        [(1, D(2020, 1, 4)), (2, D(2020, 1, 3)), (3, D(2020, 2, 1))],
        "visit_occurrence_id bigint, visit_end_date date",
    )
    stays = visits.join(ends, "visit_occurrence_id")
    assert rows(cohorts.long_visits(stays), "person_id", "los") == [(1, 3.0)]
    assert rows(cohorts.persons_with_visit(visits)) == [("a", 1), ("a", 2)]


def test_informative_sex_drops_null(spark, rows):
    people = spark.createDataFrame(
        [("a", 1, 7, 8507, D(2010, 1, 1)), ("a", 2, 7, 44814653, D(2010, 1, 1)),
         ("a", 3, 7, None, D(2010, 1, 1)), ("a", 4, 7, 8532, None), ("a", 5, 7, 8532, D(2011, 1, 1))],
        "site string, person_id bigint, location_id bigint, gender_concept_id bigint, birth_date date",
    )
    seen = spark.createDataFrame([("a", i) for i in range(1, 5)], "site string, person_id bigint")
    assert rows(cohorts.geocode_cohort(people, seen)) == [("a", 1, 7)]


def test_descendants_keep_the_code_itself(spark, rows):
    codes = spark.createDataFrame([(1, "x"), (5, "x")], "concept_id bigint, drug_type string")
    closure = spark.createDataFrame(
        [(1, 1), (1, 2), (1, 3), (9, 5)],
        "ancestor_concept_id bigint, descendant_concept_id bigint",
    )
    found = cohorts.with_descendants(codes, closure)
    assert rows(found, "concept_id") == [(1,), (2,), (3,), (5,)]


def test_ids_are_unique_within_a_site_only(spark, rows):
    visits = spark.createDataFrame(
        [("a", 1, 7, "2020-01-01"), ("b", 1, 7, "2021-01-01")],
        "site string, person_id long, visit_occurrence_id long, visit_start_date string",
    ).withColumn("visit_start_date", F.col("visit_start_date").cast("date"))
    persons = spark.createDataFrame(
        [("a", 1, "2019-06-01", 30.0), ("b", 1, "2020-06-01", 50.0)],
        "site string, person_id long, birth_date string, pn_gestational_age double",
    ).withColumn("birth_date", F.col("birth_date").cast("date"))
    found = cohorts.gestational_age_cohort(visits, persons)
    assert [r[1] for r in rows(found, "site", "pn_gestational_age")] == [30.0, 50.0]
    payers = spark.createDataFrame([("a", 7)], "site string, visit_occurrence_id long")
    assert rows(cohorts.payer_persons(payers, visits)) == [("a", 1, 7)]


def test_specialties_in_one_pass_are_those_of_each(spark, rows):
    """Also with a provider listed twice, a code in two sets and a set that nobody has."""
    general = fixed.GENERAL_SPECIALTY
    visits = spark.createDataFrame(
        [(i, p, c, 9202 + i % 2) for i, (p, c) in enumerate(
            (p, c) for p in (None, 1, 2, 3, 9) for c in (None, 1, 2, 3))],
        "visit_occurrence_id bigint, provider_id bigint, care_site_id bigint, visit_concept_id bigint",
    )
    providers = spark.createDataFrame(
        [(1, 100), (2, general), (3, 999), (9, 100), (9, 300), (None, 100)],
        "provider_id bigint, specialty_concept_id bigint",
    )
    care_sites = spark.createDataFrame(
        [(1, 200), (2, general), (3, 300)], "care_site_id bigint, specialty_concept_id bigint"
    )
    codes = {
        "one": [100, 200, general], "two": [300, 100, 100], "none": [5], "three": [general, 300],
    }
    sets = {n: spark.createDataFrame([(x,) for x in v], "concept_id bigint") for n, v in codes.items()}
    columns = ("visit_occurrence_id", "visit_specialty_concept_id")
    together = cohorts.visits_by_specialty(
        visits, providers, care_sites, sets, visit_concepts={"three": 9202}
    )
    for name, codes_ in sets.items():
        seen = visits.filter("visit_concept_id = 9202") if name == "three" else visits
        alone = cohorts.specialty_visits(seen, providers, care_sites, codes_)
        assert rows(together.filter(F.col("specialty") == name), *columns) == rows(alone, *columns)


def test_settings_in_one_pass_are_those_of_each(spark, rows):
    visits = spark.createDataFrame(
        [(i, (9201, 9202, 9203, None)[i % 4]) for i in range(8)],
        "visit_occurrence_id bigint, visit_concept_id bigint",
    )
    facts = spark.createDataFrame(
        [(i % 9 if i % 5 else None, (1, 2, None)[i % 3], i) for i in range(40)],
        "visit_occurrence_id bigint, kind bigint, n bigint",
    )
    settings = {
        "office": cohorts.Setting((9202,), 1),
        "ward": cohorts.Setting((9201, 9203), 2),
        "any": cohorts.Setting((9202, 9201)),
    }
    together = cohorts.facts_by_setting(facts, visits, settings, "kind")
    for name, s in settings.items():
        field = None if s.type_concept is None else "kind"
        alone = cohorts.facts_at_visits(facts, visits, s.visit_concepts, field, s.type_concept)
        columns = ("visit_occurrence_id", "kind", "n", "visit_concept_id")
        assert rows(together.filter(F.col("setting") == name), *columns) == rows(alone, *columns)
