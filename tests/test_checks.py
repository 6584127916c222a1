"""Hand-made frames for the checks: nulls, windows, gaps and empty inputs."""

import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from sitelens.plans import checks
from sitelens.plans.checks import VisitClass
from sitelens.plans.checks.concordance import level_of
from sitelens.sources.specs import (
    BestMappedSpec,
    CodeSets,
    ConcordanceSpec,
    CycleSpec,
    DatePlausibilitySpec,
    DocumentationSpec,
    ExpectedConceptSpec,
    FactsOverTimeSpec,
    MissingVisitSpec,
    UnmappedSpec,
    VocabularySpec,
)
from sitelens.sources.tables import Tables, frames

D = datetime.date


def tables_of(**named):
    return Tables({"cdm": frames(named), "result": frames(named)})


# --- unmapped ----------------------------------------------------------------------------

UNMAPPED = [
    UnmappedSpec(check_id="x", check_description="X", table="t", concept_field="c",
                 source_value_field="s", date_field="d"),
    UnmappedSpec(check_id="none", check_description="Nothing", table="t", concept_field="c",
                 source_value_field="s", date_field="d", filter_logic="s = 'absent'"),
]


@pytest.fixture
def coded(spark):
    return tables_of(
        t=spark.createDataFrame(
            [("a", 0, "p", D(2020, 1, 1)), ("a", 44814650, "p", D(2020, 5, 1)),
             ("a", None, None, D(2021, 1, 1)), ("a", 7, "q", D(2021, 1, 1)),
             ("b", 7, "q", D(2021, 1, 1))],
            "site string, c bigint, s string, d date",
        )
    )


@pytest.mark.parametrize("null_counts, expected", [(True, 3), (False, 2)])
def test_null_counts_as_unmapped_only_when_listed(coded, rows, null_counts, expected):
    found = checks.unmapped_concepts(coded, UNMAPPED, "v", null_counts=null_counts)
    assert rows(found, "site", "check_name", "total_rows", "unmapped_rows", "unmapped_prop") == [
        ("a", "uc_none", 0, 0, 0.0),
        ("a", "uc_x", 4, expected, expected / 4),
        ("b", "uc_none", 0, 0, 0.0),
        ("b", "uc_x", 1, 0, 0.0),
    ]


def test_unmapped_by_year_and_source_value(coded, rows):
    yearly = checks.unmapped_by_year(coded, UNMAPPED, "v")
    assert rows(yearly, "site", "year_date", "total_rows", "unmapped_rows", "prop_total") == [
        ("a", 2020, 2, 2, 1.0),
        ("a", 2021, 2, 1, 0.5),
        ("b", 2021, 1, 0, 0.0),
    ]
    valued = checks.unmapped_source_values(coded, UNMAPPED, "v")
    assert rows(valued, "site", "source_value", "unmapped_rows") == [("a", "p", 2), ("a", None, 1)]


def test_unmapped_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "site string, c bigint, s string, d date")
    assert checks.unmapped_concepts(tables_of(t=empty), UNMAPPED, "v").count() == 0


# --- vocabulary --------------------------------------------------------------------------


def test_vocabulary_of_unknown_and_null_like_concepts(spark, rows):
    facts = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("a", 3), ("a", 0), ("a", None), ("b", None)],
        "site string, c bigint",
    )
    concept = spark.createDataFrame([(1, "RxNorm"), (2, "NDC")], "concept_id bigint, vocabulary_id string")
    spec = VocabularySpec(check_id="x", check_description="X", table="t", concept_field="c",
                          acceptable_vocabularies="CVX, RxNorm")
    found = checks.vocabulary_conformance(tables_of(t=facts), [spec], concept, "v")
    assert rows(found, "site", "vocabulary_id", "accepted_value", "tot_ct", "total_denom_ct") == [
        ("a", "NDC", False, 1, 4),
        ("a", "RxNorm", True, 2, 4),
        ("a", None, False, 1, 4),
        ("b", None, None, 0, 0),
    ]


def test_best_mapped_defaults(spark, rows):
    facts = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", 2), ("a", 9), ("a", None)], "site string, c bigint"
    )
    concept = spark.createDataFrame([(1, "Pack"), (2, "Ingredient")], "concept_id bigint, kind string")
    listed = spark.createDataFrame(
        [("x", "Pack", 1, "notbest"), ("y", "Ingredient", 0, "best")],
        "check_name string, concept string, best_notbest int, default_to string",
    )
    specs = [
        BestMappedSpec(check_id=name, check_description=name, table="t", concept_field="c",
                       concept_table_field="kind")
        for name in ("x", "y")
    ]
    found = checks.best_mapped_concepts(tables_of(t=facts), specs, listed, "v", concept)
    assert rows(found, "check_name", "concept", "best_notbest", "row_cts", "total_rows") == [
        ("bmc_x", "Ingredient", 0, 1, 4),
        ("bmc_x", "Pack", 1, 2, 4),
        ("bmc_x", None, 0, 1, 4),
        ("bmc_y", "Ingredient", 0, 1, 4),
        ("bmc_y", "Pack", 1, 2, 4),
        ("bmc_y", None, 1, 1, 4),
    ]


# --- visits ------------------------------------------------------------------------------


def test_missing_visits(spark, rows):
    facts = spark.createDataFrame(
        [("a", 1), ("a", 1), ("a", None), ("a", 99), ("b", 1)],
        "site string, visit_occurrence_id bigint",
    )
    visits = spark.createDataFrame([(1,), (1,), (2,)], "visit_occurrence_id bigint")
    spec = MissingVisitSpec(check_id="x", check_description="X", table="t")
    found = checks.missing_visit_ids(tables_of(t=facts), [spec], visits, "v")
    measures = ("total_rows", "null_visit_rows", "unknown_visit_rows", "prop_missing_visits_total")
    assert rows(found, "site", *measures) == [("a", 4, 1, 1, 0.5), ("b", 1, 0, 0, 0.0)]


def test_a_visit_counts_in_every_class(spark, rows):
    visits = spark.createDataFrame(
        [("a", 1, 10, 9201), ("a", 1, 11, 48), ("a", 2, 12, 48), ("a", 3, 13, 9203)],
        "site string, person_id bigint, visit_occurrence_id bigint, visit_concept_id bigint",
    )
    facts = spark.createDataFrame(
        [("a", 11), ("a", 11), ("a", 13), ("a", None)], "site string, visit_occurrence_id bigint"
    )
    classes = [
        VisitClass("inpatient", "visit_concept_id IN (9201, 48)", "-visip"),
        VisitClass("emergency", "visit_concept_id IN (9203, 48)", "-vised"),
    ]
    spec = DocumentationSpec(check_id="x", check_description="X", table="t")
    found = checks.fact_documentation_by_class(tables_of(t=facts), [spec], visits, classes, "v")
    assert rows(found, "check_name", "total_visits", "fact_visits", "total_pts", "fact_pts") == [
        ("cfd_x-vised", 3, 2, 3, 2),
        ("cfd_x-visip", 3, 1, 2, 1),
    ]


def test_expected_concepts_only_count_the_cohort(spark, rows):
    cohort = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("b", 3)], "site string, person_id bigint")
    facts = spark.createDataFrame(
        [("a", 1, 5, "y"), ("a", 1, 5, "y"), ("a", 9, 5, "y"), ("a", 2, 5, "n"), ("b", 3, 6, "y")],
        "site string, person_id bigint, c bigint, flag string",
    )
    spec = ExpectedConceptSpec(check_id="x", check_description="X", cohort_table="cohort",
                               table="t", concept_field="c", conceptset_name="five",
                               filter_logic="flag = 'y'")
    sets = CodeSets(named={"five": spark.createDataFrame([(5,), (5,)], "concept_id bigint")})
    found = checks.expected_concepts(tables_of(t=facts, cohort=cohort), [spec], sets, "v")
    assert rows(found, "site", "total_pts", "pts_with_concept", "prop_with_concept") == [
        ("a", 2, 1, 0.5),
        ("b", 1, 0, 0.0),
    ]


# --- concordance -------------------------------------------------------------------------

PAIR = [
    ConcordanceSpec(cohort_id="one", check_id="p", table="one", date_field="d", time_between_events=14),
    ConcordanceSpec(cohort_id="two", check_id="p", table="two", date_field="d", time_between_events=14),
]
EVENTS = "site string, person_id bigint, d date"


def test_concordance_window(spark, rows):
    start = D(2020, 3, 1)
    day = datetime.timedelta(days=1)
    one = [(p, start) for p in (1, 2, 3, 4, 5)] + [(7, None), (8, start)]
    two = [(1, start), (2, start + 14 * day), (3, start + 15 * day), (4, start - 14 * day),
           (6, start), (7, start), (8, start - 30 * day), (8, start + 40 * day)]
    tables = tables_of(
        one=spark.createDataFrame([("a", *r) for r in one], EVENTS),
        two=spark.createDataFrame([("a", *r) for r in two], EVENTS),
    )
    found = checks.domain_concordance(tables, PAIR, CodeSets(), "v")
    assert rows(found, "cohort", "value", "total_ct", "prop") == [
        ("both_outside_window", 3, 8, 3 / 8),
        ("cohort_1_only", 1, 8, 1 / 8),
        ("cohort_2_only", 1, 8, 1 / 8),
        ("combined", 3, 8, 3 / 8),
    ]


def test_concordance_against_all_pairs(spark):
    """Neighbouring events find exactly what comparing every pair finds."""
    chance = random.Random(7)
    first = D(2020, 1, 1)
    events = {
        side: [
            ("a", chance.randrange(40), first + datetime.timedelta(days=chance.randrange(300)))
            for _ in range(120)
        ]
        for side in ("one", "two")
    }
    dates = {side: {} for side in events}
    for side, listed in events.items():
        for _, person, date in listed:
            dates[side].setdefault(person, []).append(date)
    expected = {"cohort_1_only": 0, "cohort_2_only": 0, "combined": 0, "both_outside_window": 0}
    for person in set(dates["one"]) | set(dates["two"]):
        pairs = itertools.product(dates["one"].get(person, []), dates["two"].get(person, []))
        gaps = [abs((b - a).days) for a, b in pairs]
        if not gaps:
            side = "cohort_1_only" if person in dates["one"] else "cohort_2_only"
        else:
            side = "combined" if min(gaps) <= 14 else "both_outside_window"
        expected[side] += 1
    tables = tables_of(**{s: spark.createDataFrame(e, EVENTS) for s, e in events.items()})
    found = checks.domain_concordance(tables, PAIR, CodeSets(), "v").collect()
    assert {row.cohort: row.value for row in found} == expected


def test_concordance_needs_two_cohorts():
    with pytest.raises(ValueError, match="two cohorts"):
        checks.domain_concordance(tables_of(), PAIR[:1], CodeSets(), "v")


def test_levels():
    assert [level_of(x) for x in ("condsckd-drugshtn", "visgp-wcc", "visdtdial-procs")] == [
        "patient",
        "visit",
        "visit_detail",
    ]


# --- time --------------------------------------------------------------------------------


def test_months_without_facts_are_zero(spark, rows):
    facts = spark.createDataFrame(
        [("a", 1, 10, D(2020, 1, 3)), ("a", 1, 10, D(2020, 1, 9)), ("a", 2, 11, D(2020, 3, 31)),
         ("a", 2, 12, D(2019, 12, 31)), ("a", 2, 13, D(2020, 4, 16))],
        "site string, person_id bigint, visit_occurrence_id bigint, d date",
    )
    spec = FactsOverTimeSpec(check_id="visall", check_description="V", table="t", date_field="d")
    found = checks.facts_over_time(tables_of(t=facts), [spec], "v", D(2020, 1, 1), D(2020, 4, 15))
    assert rows(found, "time_start", "time_end", "row_cts", "row_visits", "row_pts") == [
        (D(2020, 1, 1), D(2020, 1, 31), 2, 1, 1),
        (D(2020, 2, 1), D(2020, 2, 29), 0, 0, 0),
        (D(2020, 3, 1), D(2020, 3, 31), 1, 1, 1),
        (D(2020, 4, 1), D(2020, 4, 30), 0, 0, 0),
    ]
    totals = checks.attach_denominators(found)
    assert rows(totals, "total_row", "total_visit", "total_pt") == [
        (0, 0, 0), (0, 0, 0), (1, 1, 1), (2, 1, 1),
    ]


def test_date_plausibility(spark, rows):
    facts = spark.createDataFrame(
        [("a", 1, 10, D(1999, 1, 1)), ("a", 1, 10, D(2020, 1, 2)), ("a", 1, None, D(2020, 1, 9)),
         ("a", 1, 10, D(2020, 1, 9)), ("a", 2, 77, D(1990, 1, 1)), ("a", 1, 10, None)],
        "site string, person_id bigint, visit_occurrence_id bigint, d date",
    )
    visits = spark.createDataFrame(
        [(10, D(2020, 1, 1), D(2020, 1, 3))],
        "visit_occurrence_id bigint, visit_start_date date, visit_end_date date",
    )
    persons = spark.createDataFrame([("a", 1, D(2000, 1, 1))], "site string, person_id bigint, birth_date date")
    spec = DatePlausibilitySpec(check_id="x", check_description="X", table="t", date_field="d")
    found = checks.date_plausibility(tables_of(t=facts), [spec], visits, persons, "v")
    assert rows(found, "implausible_type", "total_rows", "implausible_row") == [
        ("after_visit", 6, 1),
        ("before_birth", 6, 1),
        ("before_visit", 6, 1),
    ]


# --- data cycle --------------------------------------------------------------------------

CYCLE = [
    CycleSpec(check_id="all", check_description="All", check_domain="T", table_current="t", table_prev="t"),
    CycleSpec(check_id="plain", check_description="No persons", check_domain="P", table_current="p",
              table_prev="p"),
]


def test_cycle_from_tables_and_from_a_stored_result(spark, rows):
    person = "site string, person_id bigint"
    now = tables_of(
        t=spark.createDataFrame([("a", 1), ("a", 1), ("a", None), ("b", 2)], person),
        p=spark.createDataFrame([("a",), ("a",)], "site string"),
    )
    before = tables_of(
        t=spark.createDataFrame([("a", 1), ("c", 4)], person),
        p=spark.createDataFrame([("a",)], "site string"),
    )
    expected = [
        ("a", "dc_all", "person", 1, 1),
        ("a", "dc_all", "rows", 3, 1),
        ("a", "dc_plain", "rows", 2, 1),
        ("b", "dc_all", "person", 1, 0),
        ("b", "dc_all", "rows", 1, 0),
        ("c", "dc_all", "person", 0, 1),
        ("c", "dc_all", "rows", 0, 1),
    ]
    columns = ("site", "check_name", "application", "current_ct", "previous_ct")
    from_tables = checks.data_cycle_changes(now, CYCLE, "v2", before, "v1")
    assert rows(from_tables, *columns) == expected
    empty = tables_of(
        t=spark.createDataFrame([], person), p=spark.createDataFrame([], "site string")
    )
    stored = checks.data_cycle_changes(before, CYCLE, "v1", empty, "v0")
    assert rows(checks.data_cycle_changes(now, CYCLE, "v2", stored, "v1"), *columns) == expected


def test_rows_in_another_order_change_nothing(coded, rows):
    shuffled = tables_of(t=coded.cdm("t").orderBy(F.rand(3)))
    assert rows(checks.unmapped_concepts(coded, UNMAPPED, "v")) == rows(
        checks.unmapped_concepts(shuffled, UNMAPPED, "v")
    )


@pytest.mark.parametrize("plain", [True, False])
def test_tags_of_several_fields_are_found_in_one_pass(spark, plain):
    """Against a loop: several code fields, tags without codes, predicates, dates of their own."""
    from sitelens.plans.checks.common import Tag, tagged_rows

    data = [(i, i % 3 or None, (i * 7) % 5, f"d{i % 2}", f"e{i}") for i in range(30)]
    df = spark.createDataFrame(data, "n long, a long, b int, d string, e string")
    sets = {name: spark.createDataFrame([(x,) for x in values], "concept_id long")
            for name, values in {"x": [1, 2], "y": [0, 3], "empty": []}.items()}
    tags = [
        Tag({"check_name": "one"}, {"day": F.col("d")}, None, "a", sets["x"]),
        Tag({"check_name": "two"}, {"day": F.col("e")}, F.expr("n > 10"), "a", sets["x"]),
        Tag({"check_name": "three"}, {"day": F.col("d")}, F.expr("a = 1 AND n < 25"), "b", sets["y"]),
        Tag({"check_name": "four"}, {"day": F.col("d")}, None, "b", sets["empty"]),
    ]
    codes = {"one": ("a", {1, 2}), "two": ("a", {1, 2}), "three": ("b", {0, 3}), "four": ("b", set())}
    expected = []
    for n, a, b, d, e in data:
        row = {"a": a, "b": b}
        for name, (field, members) in codes.items():
            holds = {"two": n > 10, "three": a == 1 and n < 25}.get(name, True)
            if holds and row[field] in members:
                expected.append((n, name, e if name == "two" else d))
    if plain:
        tags.append(Tag({"check_name": "five"}, {"day": F.col("d")}, F.expr("n % 4 = 0")))
        tags.append(Tag({"check_name": "six"}, {"day": F.col("e")}))
        expected += [(n, "five", d) for n, _, _, d, _ in data if n % 4 == 0]
        expected += [(n, "six", e) for n, _, _, _, e in data]
    found = tagged_rows(df, tags, ["n"])
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    alone = tagged_rows(df, tags[-2:], ["n"]) if plain else tagged_rows(df, tags[:1], ["n"])
    names = {"five", "six"} if plain else {"one"}
    assert sorted(map(tuple, alone.collect())) == sorted(x for x in expected if x[1] in names)
