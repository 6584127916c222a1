"""Post-processing, outliers, summaries, publication and gates on hand-made results."""

import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from sitelens.operators.groups import with_totals
from sitelens.operators.joins import null_safe_join
from sitelens.operators.reshape import column_spreads, spread
from sitelens.plans import gate, medication, outliers, process, publish, summary

D = datetime.date
NAMED = "check_name string, check_description string, check_type string, database_version string"


def test_null_keys_match_only_in_null_safe_joins(spark, rows):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k bigint, x string")
    right = spark.createDataFrame([(None, "c"), (2, "d")], "k bigint, y string")
    assert rows(left.join(right, "k", "left")) == [(1, "a", None), (None, "b", None)]
    assert rows(null_safe_join(left, right, how="left")) == [(1, "a", None), (None, "b", "c")]
    assert rows(null_safe_join(left, right, how="full")) == [
        (1, "a", None), (2, None, "d"), (None, "b", "c"),
    ]


def test_totals_are_the_sum_of_the_sites(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "x", 4)], "site string, k string, n int")
    assert rows(with_totals(df, ["k"], ["n"])) == [("a", "x", 3), ("b", "x", 4), ("total", "x", 7)]


def test_change_is_null_without_a_previous_count(spark, rows):
    counts = spark.createDataFrame(
        [("a", 5, 10), ("b", 4, 0)],
        "site string, current_ct bigint, previous_ct bigint",
    ).withColumns({n: F.lit(n) for n in ("check_name", "check_type", "database_version",
                                         "previous_version", "domain", "application")})
    meta = spark.createDataFrame([("check_name", "About")], "check_name string, check_description string")
    found = process.process_cycle(counts, meta)
    assert rows(found, "site", "prop_total_change", "check_description") == [
        ("a", -0.5, "About"), ("b", None, "About"), ("total", pytest.approx(-0.1), "About"),
    ]


def conformance(spark):
    return spark.createDataFrame(
        [("a", "x", True, 6, 8), ("a", "y", False, 2, 8), ("b", "x", True, 4, 4)],
        "site string, concept_id string, accepted_value boolean, tot_ct bigint, total_denom_ct bigint",
    ).withColumns({n: F.lit(n) for n in ("check_name", "check_description", "check_type",
                                         "database_version", "table_application",
                                         "measurement_column")})


def test_violations_and_zero_rows(spark, rows):
    result = process.process_conformance(conformance(spark), "concept_id")
    assert rows(result.processed, "site", "viol_ct", "total_denom_ct", "prop_viol", "accepted_value") == [
        ("a", 2, 8, 0.25, False), ("b", 0, 4, 0.0, True), ("total", 2, 12, 2 / 12, False),
    ]
    assert rows(result.violations, "site", "concept_id", "tot_ct", "tot_prop") == [
        ("a", "y", 2, 0.25), ("total", "y", 2, 2 / 12),
    ]
    filled = process.with_zero_rows(result)
    assert rows(filled, "site", "concept_id", "tot_ct", "tot_prop", "check_name_app") == [
        ("a", "y", 2, 0.25, "check_name_rows"),
        ("b", None, 0, 0.0, "check_name_rows"),
        ("total", "y", 2, 2 / 12, "check_name_rows"),
    ]
    judged = gate.vocabulary_gate(result, checks=["check_name"], threshold=0.2)
    assert rows(judged, "site", "value", "pass_fail") == [("a", 0.25, "FAIL"), ("b", 0.0, "PASS")]


def test_month_heuristic(spark, rows):
    counts = [10, 0, 0, 30, 0]
    months = spark.createDataFrame(
        [("a", "fot_x", D(2020, i + 1, 1), D(2020, i + 1, 28), n, 100, 0, 50) for i, n in enumerate(counts)],
        "site string, check_name string, time_start date, time_end date, row_cts bigint,"
        " total_row bigint, total_visit bigint, total_pt bigint",
    )
    found = process.process_timeline(months)
    assert rows(found.heuristic, "time_start", "check") == [
        (D(2020, 1, 1), None),
        (D(2020, 2, 1), -1.0),
        (D(2020, 3, 1), -1.0),
        (D(2020, 4, 1), None),
        (D(2020, 5, 1), None),
    ]
    assert rows(found.summary, "mean_val", "median_val", "sd_val", "min_val", "max_val") == [
        (-1.0, -1.0, 0.0, -1.0, -1.0)
    ]
    assert rows(found.ratios, "ratio_row", "ratio_visit", "ratio_pt")[-1] == (3000.0, None, 6000.0)


def outlier_input(spark):
    values = {"wide": [1, 1.1, 0.9, 1, 1, 9], "pair": [1, 2], "flat": [3] * 6}
    return spark.createDataFrame(
        [(f"s{i}", k, k, float(v)) for k, listed in values.items() for i, v in enumerate(listed)],
        "site string, check_name string, application string, prop_total_change double",
    )


def test_outliers(spark, rows):
    stated = outliers.distribution(outlier_input(spark), ["application"], "prop_total_change")
    found = outliers.flag_outliers(stated, "prop_total_change")
    counted = found.groupBy("application", "anomaly_yn").count()
    assert rows(counted) == [
        ("flat", "not eligible", 6),
        ("pair", "not eligible", 2),
        ("wide", "not outlier", 5),
        ("wide", "outlier", 1),
    ]
    one = found.filter("application = 'wide'").first()
    mean = sum([1, 1.1, 0.9, 1, 1, 9]) / 6
    deviation = math.sqrt(sum((x - mean) ** 2 for x in [1, 1.1, 0.9, 1, 1, 9]) / 5)
    assert one.mean_val == pytest.approx(mean)
    assert one.median_val == 1 and one.mad_val == pytest.approx(0.05)
    assert one.upper_tail == pytest.approx(mean + 1.6448536 * deviation, rel=1e-6)


def test_suppressed_outliers_and_totals(spark, rows):
    totals = spark.createDataFrame(
        [("total", "wide", "wide", 50.0), ("total", "pair", "pair", 50.0)],
        outlier_input(spark).schema,
    )
    stated = outliers.distribution(
        outlier_input(spark).unionByName(totals), ["application"], "prop_total_change", sites_only=True
    )
    found = outliers.suppress_outliers(outliers.flag_outliers(stated, "prop_total_change"))
    wide = rows(found.filter("application = 'wide'"), "site", "plot_prop")
    assert wide[-2:] == [("s5", 1.1), ("total", 1.1)]
    assert rows(found.filter("application = 'pair'"), "site", "plot_prop") == [("s0", 1.0), ("s1", 2.0)]


def test_site_summary_leaves_totals_alone(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", 1.0), ("b", "x", None), ("c", "x", 4.0), ("total", "x", 99.0)],
        "site string, check_name string, v double",
    )
    found = summary.with_site_summary(df, "v", ["check_name"], null_as_zero=True)
    assert rows(found, "site", "v", *summary.STATISTICS) == [
        ("a", 1.0, 0.0, 0.5, 1.0, pytest.approx(5 / 3), 2.5, 4.0),
        ("b", 0.0, 0.0, 0.5, 1.0, pytest.approx(5 / 3), 2.5, 4.0),
        ("c", 4.0, 0.0, 0.5, 1.0, pytest.approx(5 / 3), 2.5, 4.0),
        ("total", 99.0, None, None, None, None, None, None),
    ]


def test_anonymised_tables_share_one_mapping(spark, rows):
    one = spark.createDataFrame([("north", 1), ("south", 2), ("total", 3)], "site string, n int")
    two = spark.createDataFrame([("south", 5), ("unlisted", 6)], "site string, n int")
    plain = spark.createDataFrame([(1,)], "n int")
    found = publish.anonymise({"one": one, "two": two, "plain": plain}, one, "salt")
    assert set(found) == {"one", "two"}
    labels = dict((n, site) for site, n in rows(found["one"], "site", "n"))
    assert {labels[1], labels[2]} == {"site_1", "site_2"} and labels[3] == "total"
    assert rows(found["two"], "n", "site") == [(5, labels[2]), (6, None)]


def test_renaming_keeps_unmapped_names(spark, rows):
    df = spark.createDataFrame([("a", "old"), ("b", "old")], "check_name string, old_check_name string")
    names = spark.createDataFrame([("a", "A")], "check_name string, new_name string")
    other = spark.createDataFrame([(1,)], "n int")
    renamed = publish.rename_checks({"t": df, "other": other}, names)
    assert set(renamed) == {"t"}
    assert rows(renamed["t"], "check_name") == [("A",), ("b",)]
    assert publish.drop_old_names(renamed)["t"].columns == ["check_name", "new_name"]


# --- gates, exactly on the thresholds ----------------------------------------------------


def judged(spark, rows, function, names, column, values, **extra):
    df = spark.createDataFrame(
        [("a", name, "about", float(value) if value is not None else None)
         for name, value in zip(names, values, strict=True)],
        f"site string, check_name string, check_description string, {column} double",
    ).withColumns({k: F.lit(v) for k, v in extra.items()})
    return [tuple(r) for r in function(df).select("check_name", "pass_fail").orderBy("check_name").collect()]


def test_best_gate(spark, rows):
    names = ["bmc_csop", "bmc_demog-eth", "bmc_demog-race", "bmc_other", "bmc_provop"]
    found = judged(spark, rows, gate.best_mapped_gate, names, "best_row_prop",
                   [0.1, 0.7, 0.71, 0.9, 0.8], best_notbest=1)
    assert found == [("bmc_csop", "PASS"), ("bmc_demog-eth", "FAIL"), ("bmc_demog-race", "PASS"),
                     ("bmc_provop", "PASS")]


def test_cycle_gate(spark, rows):
    found = judged(spark, rows, gate.cycle_gate, ["a", "b", "c", "d", "e", "f"], "prop_total_change",
                   [-0.5, -0.51, 1, 1.01, 0, None], application="rows")
    assert [p for _, p in found] == ["PASS", "FAIL", "PASS", "FAIL", "PASS", "PASS"]


def test_share_gates(spark, rows):
    found = judged(spark, rows, gate.unmapped_gate, ["uc_condsall", "uc_drugsall", "uc_procsall", "uc_x"],
                   "unmapped_prop", [0.3, 0.29, 0.49, 0.9])
    assert found == [("uc_condsall", "FAIL"), ("uc_drugsall", "PASS"), ("uc_procsall", "PASS")]
    found = judged(spark, rows, gate.missing_visit_gate, ["m", "mf_visitid_immsall-visitid"],
                   "prop_missing_visits_total", [0.3, 0.9])
    assert found == [("m", "FAIL")]
    found = judged(spark, rows, gate.expected_gate, ["ecp_ht", "ecp_tract-2020", "ecp_wt"],
                   "prop_with_concept", [0.75, 0.71, 0.76])
    assert found == [("ecp_ht", "FAIL"), ("ecp_tract-2020", "PASS"), ("ecp_wt", "PASS")]
    found = judged(spark, rows, gate.date_gate, ["dp_condsall", "dp_labsall", "dp_x"],
                   "prop_implausible", [0.3, 0.1, 0.9])
    assert found == [("dp_condsall", "FAIL"), ("dp_labsall", "PASS")]


def test_enforce(spark):
    columns = "site string, check_name string, check_description string, value double, direction string, threshold double, pass_fail string"
    rows = [("a", "x", "About x", 0.5, "<", 0.3, "FAIL"), ("a", "y", "About y", 0.1, "<", 0.3, "PASS")]
    df = spark.createDataFrame(rows, columns)
    failed = gate.failures([df, df])
    assert failed.count() == 1
    with pytest.raises(gate.GateFailure, match="1 data quality failure.*gate_failures"):
        gate.enforce(failed)
    gate.enforce(failed.filter("value > 1"))


# --- medication --------------------------------------------------------------------------


def test_medication_fields(spark, rows):
    drugs = spark.createDataFrame(
        [("a", 1.0, None, 2.0, 5.0, 0), ("a", 1.0, 1.0, 2.0, None, 7), ("a", 1.0, 1.0, 1.0, 5.0, None),
         ("a", 1.0, 1.0, 1.0, 5.0, 7)],
        "site string, refills double, quantity double, days_supply double,"
        " effective_drug_dose double, dose_unit_concept_id bigint",
    )
    fields = [f for f in medication.FIELDS if f.column in drugs.columns]
    found = medication.field_population(drugs, "v", fields)
    assert rows(found, "check_name", "unmapped_rows") == [
        ("uc_drugs-dayssupply", 0), ("uc_drugs-dose", 1), ("uc_drugs-doseunits", 2),
        ("uc_drugs-quantity", 1), ("uc_drugs-refill", 0),
    ]
    joint = medication.joint_population(drugs, "v")
    assert rows(joint, "check_name", "populated_rows", "unmapped_prop") == [
        ("uc_drugs-dose_unit", 1, 0.75), ("uc_drugs-refquantdays", 3, 0.25),
    ]
    doses = medication.dose_distribution(drugs, keys=["site"])
    assert rows(doses, "dose_unit_concept_id", "min_val", "sd_val") == [
        (0, 5.0, None), (7, 5.0, None), (None, 5.0, None),
    ]


@pytest.mark.parametrize("seed", range(3))
def test_spreads_are_those_of_sorted_values(spark, rows, seed):
    """Against plain order statistics: few and many distinct values, large offsets, signs, one value."""
    r = random.Random(seed)
    kinds = {
        "ties": lambda: r.choice([1.0, 2.0, 2.5]),
        "wide": lambda: r.choice([-1, 1]) * 10 ** r.uniform(-9, 9),
        "close": lambda: 1e6 + r.random(),
        "tiny": lambda: r.uniform(-1e-9, 1e-9),
        None: lambda: float(r.randint(-3, 3)),
    }
    data = [
        (group, draw() if r.random() < 0.9 else None)
        for group, draw in kinds.items()
        for _ in range(r.choice([1, 2, 7, 300]))
    ]
    data.append(("only null", None))
    df = spark.createDataFrame(data, "g string, x double").withColumn("y", F.col("x") * 2)
    expected = []
    for group in kinds:
        values = sorted(x for g, x in data if g == group and x is not None)
        n = len(values)
        if n:
            quartiles = [values[-(-n * k // 4) - 1] for k in (1, 2, 3)]
            expected.append((str(group), values[0], values[-1], *quartiles))
    found = spread(df, ["g"], "x")
    got = [
        (str(r.g), r.min_val, r.max_val, r.q1_val, r.med_val, r.q3_val) for r in found.collect()
    ]
    assert sorted(got) == sorted(expected)
    both = column_spreads(df, ["g"], ["x", "y"], "column").collect()
    doubled = [(str(r.g), r.min_val, r.max_val, r.q1_val, r.med_val, r.q3_val) for r in both if r.column == "y"]
    assert sorted(doubled) == sorted((g, *(2 * x for x in rest)) for g, *rest in expected)


def test_spreads_order_infinite_values_and_no_numbers_last(spark):
    values = [float("-inf"), -1.0, 0.0, 5.0, float("inf"), float("nan"), float("nan"), float("nan")]
    df = spark.createDataFrame([(1, x) for x in values], "g int, x double")
    (row,) = spread(df, ["g"], "x").collect()
    assert (row.min_val, row.q1_val, row.med_val) == (float("-inf"), -1.0, 5.0)
    assert math.isnan(row.q3_val) and math.isnan(row.max_val)
