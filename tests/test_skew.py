"""One visit, person and concept hold a large share of all facts: results stay exact."""

import collections
import datetime
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sitelens import session
from sitelens.operators.groups import first_row, rows_at_minimum, with_group_values
from sitelens.plans import checks, cohorts
from sitelens.plans.checks.concordance import near_pairs
from sitelens.sources.specs import (
    DatePlausibilitySpec,
    FactsOverTimeSpec,
    MissingVisitSpec,
    VocabularySpec,
)
from sitelens.sources.tables import Tables, frames

FIRST = datetime.date(2020, 1, 1)


@pytest.fixture(scope="module")
def facts():
    chance = random.Random(11)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        visit = 1 if hot else chance.choice([None, *range(2, 400)])
        person = 1 if hot else chance.randrange(2, 90)
        concept = 5 if hot else chance.randrange(30)
        day = FIRST + datetime.timedelta(days=chance.randrange(120))
        rows.append(("a" if i % 5 else "b", person, visit, concept, day, i))
    return rows


@pytest.fixture(scope="module")
def frame(spark, facts):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    schema = (
        "site string, person_id bigint, visit_occurrence_id bigint, c bigint, d date, id bigint"
    )
    yield spark.createDataFrame(facts, schema).repartition(6)
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def test_missing_visits(spark, facts, frame, rows):
    visits = spark.range(0, 300).withColumnRenamed("id", "visit_occurrence_id")
    spec = MissingVisitSpec(check_id="x", check_description="X", table="t")
    tables = Tables({"cdm": frames({"t": frame})})
    found = checks.missing_visit_ids(tables, [spec], visits, "v")
    expected = []
    for site in "ab":
        ids = [visit for s, _, visit, *_ in facts if s == site]
        unknown = sum(visit is not None and visit >= 300 for visit in ids)
        expected.append((site, len(ids), ids.count(None), unknown))
    assert rows(found, "site", "total_rows", "null_visit_rows", "unknown_visit_rows") == expected


def test_facts_over_time(facts, frame):
    spec = FactsOverTimeSpec(check_id="x", check_description="X", table="t", date_field="d")
    tables = Tables({"cdm": frames({"t": frame})})
    found = checks.facts_over_time(tables, [spec], "v", FIRST, datetime.date(2020, 4, 30))
    expected = collections.defaultdict(lambda: ([], set(), set()))
    for site, person, visit, _, day, _ in facts:
        listed, visits, people = expected[site, day.replace(day=1)]
        listed.append(day)
        people.add(person)
        if visit is not None:
            visits.add(visit)
    assert {
        (r.site, r.time_start): (r.row_cts, r.row_visits, r.row_pts) for r in found.collect()
    } == {key: tuple(map(len, counted)) for key, counted in expected.items()}


def test_vocabulary(spark, facts, frame):
    concept = spark.createDataFrame(
        [(i, "even" if i % 2 == 0 else "odd") for i in range(25)],
        "concept_id bigint, vocabulary_id string",
    )
    spec = VocabularySpec(check_id="x", check_description="X", table="t", concept_field="c",
                          acceptable_vocabularies="odd")
    tables = Tables({"cdm": frames({"t": frame})})
    found = checks.vocabulary_conformance(tables, [spec], concept, "v")
    expected = collections.Counter(
        (site, None if c >= 25 else ("odd", "even")[c % 2 == 0])
        for site, _, _, c, _, _ in facts
        if c != 0
    )
    assert {(r.site, r.vocabulary_id): r.tot_ct for r in found.collect()} == dict(expected)


def test_grouped_selections(facts, frame, rows):
    firsts = rows_at_minimum(frame, ["person_id"], "d")
    earliest = {}
    for _, person, _, _, day, _ in facts:
        earliest[person] = min(day, earliest.get(person, day))
    expected = sorted(i for _, person, _, _, day, i in facts if day == earliest[person])
    assert sorted(r.id for r in firsts.select("id").collect()) == expected

    flagged = with_group_values(frame, ["person_id", "site"], {"top": F.max("c")})
    top = {}
    for site, person, _, c, _, _ in facts:
        top[person, site] = max(c, top.get((person, site), c))
    found = {r.id: r.top for r in flagged.select("id", "top").collect()}
    assert found == {i: top[person, site] for site, person, _, _, _, i in facts}

    last = first_row(frame, ["person_id"], ["d", "id"], largest=True)
    latest = {}
    for _, person, _, _, day, i in facts:
        latest[person] = max((day, i), latest.get(person, (day, i)))
    assert {r.person_id: (r.d, r.id) for r in last.collect()} == latest


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_hot_key_is_split_among_tasks(spark, frame):
    """Not only are results exact: the partition of the hot key is read by several tasks."""
    flagged = with_group_values(frame, ["person_id", "site"], {"top": F.max("c")})
    flagged.collect()
    assert "skew=true" in final_plan(flagged)
    visits = spark.range(0, 400).selectExpr("id AS visit_occurrence_id", "9202 + id % 2 AS visit_concept_id")
    settings = {"one": cohorts.Setting((9202,), 5), "two": cohorts.Setting((9203,))}
    found = cohorts.facts_by_setting(frame, visits, settings, "c")
    found.collect()
    assert "skew=true" in final_plan(found)


def test_partitions_are_merged_up_to_a_size_that_bounds_the_memory_of_a_task(spark):
    """co_13, ck_dcon_visit, ck_dconm: a task's memory follows the bytes of its partition."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    parallel = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        # 64 partitions of about 1.2 MB; without the cores in view, only the size decides how many merge.
        spark.conf.set(parallel, "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set(name, "64m")
        session.prepare(spark)
        rows = spark.range(0, 4_000_000, 1, 8).select(F.xxhash64("id").alias("a"), F.xxhash64("id", "id").alias("b"))
        firsts = rows.repartition("a").mapInArrow(
            lambda batches: [pa.record_batch({"bytes": [sum(b.nbytes for b in batches)]})], "bytes long"
        )
        assert max(r.bytes for r in firsts.collect()) < 20 << 20
        # A smaller size that a session names is kept.
        spark.conf.set(name, "1m")
        session.prepare(spark)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(parallel)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_events_and_dated_facts_are_shuffled_once_per_key(spark, frame):
    """ck_meta: no shuffle only to remove duplicates before the one that the next step needs."""
    events = frame.selectExpr("'x' AS check_name", "site", "visit_occurrence_id AS __key", "d AS __date",
                              "1 + c % 2 AS cohort")
    assert exchanges(near_pairs(events, {"x": 2})) == 1
    visits = frame.selectExpr("site", "visit_occurrence_id", "d AS visit_start_date", "d AS visit_end_date")
    persons = frame.selectExpr("site", "person_id", "d AS birth_date")
    spec = DatePlausibilitySpec(check_id="x", check_description="X", table="t", date_field="d")
    tables = Tables({"cdm": frames({"t": frame})})
    # Two for each of the two joins, one for the sums per site.
    assert exchanges(checks.date_plausibility(tables, [spec], visits, persons, "v")) == 5


def test_near_pairs_around_the_epoch(spark):
    """Against all pairs: days before 1970, null days, one day in both cohorts, a check without window."""
    chance = random.Random(5)
    rows = []
    for _ in range(400):
        day = datetime.date(1969, 12, 1) + datetime.timedelta(days=chance.randrange(60))
        rows.append((chance.choice(["x", "y"]), "a", chance.randrange(40), chance.choice([day, day, None]),
                     chance.choice([1, 2])))
    events = spark.createDataFrame(rows, "check_name string, site string, __key int, __date date, cohort int")
    expected = {}
    for name, _, key, _, _ in rows:
        own = [(day, cohort) for n, _, k, day, cohort in rows if (n, k) == (name, key)]
        near = name == "x" and any(
            a and b and abs((a - b).days) <= 2 for a, c in own for b, other in own if c != other
        )
        expected[name, key] = (any(c == 1 for _, c in own), any(c == 2 for _, c in own), near)
    found = near_pairs(events, {"x": 2, "y": None}).collect()
    assert {(r.check_name, r["__key"]): (r["__one"], r["__two"], r["__near"]) for r in found} == expected
    assert len(found) == len(expected)


def test_dates_of_a_hot_visit_and_person(spark, facts, frame):
    """Rows are not counted before they meet visits and persons: repeats and null visits keep their number."""
    visits = spark.range(1, 300).selectExpr(
        "id AS visit_occurrence_id", "DATE'2020-01-20' AS visit_start_date", "DATE'2020-02-10' AS visit_end_date"
    )
    persons = spark.createDataFrame(
        [(s, p, datetime.date(2020, 1, 11)) for s in "ab" for p in range(1, 60)],
        "site string, person_id bigint, birth_date date",
    )
    spec = DatePlausibilitySpec(check_id="x", check_description="X", table="t", date_field="d")
    found = checks.date_plausibility(Tables({"cdm": frames({"t": frame})}), [spec], visits, persons, "v")
    expected = {}
    for site in "ab":
        own = [(p, visit, day) for s, p, visit, _, day, _ in facts if s == site]
        seen = [day for _, visit, day in own if visit is not None and visit < 300]
        for kind, n in {
            "before_birth": sum(p < 60 and day < datetime.date(2020, 1, 11) for p, _, day in own),
            "before_visit": sum(day < datetime.date(2020, 1, 20) for day in seen),
            "after_visit": sum(day > datetime.date(2020, 2, 10) for day in seen),
        }.items():
            expected[site, kind] = (len(own), n)
    assert {(r.site, r.implausible_type): (r.total_rows, r.implausible_row) for r in found.collect()} == expected
