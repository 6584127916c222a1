"""A whole run over a small clinical data set: every step, from cohorts to the gate."""

import datetime
from dataclasses import replace

import pytest

from sitelens.plans import gate, run
from sitelens.sources.store import Store
from sitelens.sources.tables import Tables, frames

D = datetime.date

# File names and their column headers, as readers of such files expect them.
SPECS = {
    "dc_table": "table_current,table_prev,check_domain,check_id,check_description,filter_logic\n"
    "drug_exposure,drug_exposure,Drugs,drugsall,Drugs,\n"
    "visit_occurrence,visit_occurrence,Visits,visofc,Office visits,visit_concept_id = 9202\n",
    "vc_table": "check_id,check_description,schema,table,acceptable_vocabularies,concept_field,filter_logic\n"
    'drugsall-cid,Drugs,cdm,drug_exposure,"RxNorm, NDC",drug_concept_id,\n',
    "vs_table": "check_id,check_description,schema,table,valueset_name,concept_field,filter_logic\n"
    "sex,Sex,cdm,person,valueset_sex,gender_concept_id,\n",
    "valueset_sex": "concept_id,concept_name\n8507,male\n8532,female\n",
    "uc_table": "check_id,check_description,schema,table,concept_field,source_value_field,date_field,filter_logic\n"
    "drugsall,Drugs,cdm,drug_exposure,drug_concept_id,drug_source_value,drug_exposure_start_date,\n",
    "mf_table": "check_id,check_description,schema,table,filter_logic\n"
    "drugsall-visitid,Drugs,cdm,drug_exposure,\n",
    "bmc_table": "check_id,check_description,schema,table,concept_field,concept_table_field,filter_logic\n"
    "demog-race,Sex,cdm,person,gender_concept_id,concept_name,\n"
    "gestage,Age,result,gest_age_cohort,ga_group,ga_group,\n",
    "bmc_bestnotbest": "check_name,concept,best_notbest,default_to\ndemog-race,Unknown,0,best\n"
    "gestage,20-45 Weeks (Expected Range),1,notbest\n",
    "ecp_table": "check_id,check_description,cohort_definition,cohort_schema,cohort_table,schema,table,concept_field,conceptset_name,filter_logic\n"
    "ht,Pills,Persons,cdm,person,cdm,drug_exposure,drug_concept_id,pills,\n",
    "pills": "concept_id,concept_name\n1,Pill\n",
    "ecp_cat_new": "check_name,check_cat\necp_ht,Drugs\n",
    "cfd_table": "check_id,check_description,schema,table,filter_logic\ndrugsall,Drugs,cdm,drug_exposure,\n",
    "dcon_table": "cohort_id,check_id,cohort_description,schema,table,date_field,concept_field,conceptset_name,filter_logic,time_between_events\n"
    "d,drugs-conds,Pill,cdm,drug_exposure,drug_exposure_start_date,drug_concept_id,pills,,10\n"
    "c,drugs-conds,Diagnosis,cdm,condition_occurrence,condition_start_date,,,,10\n"
    "v,visofc-drugs,Office visit,cdm,visit_occurrence,visit_start_date,,,visit_concept_id = 9202,\n"
    "w,visofc-drugs,Drug,cdm,drug_exposure,drug_exposure_start_date,,,,\n",
    "dp_table": "check_id,check_description,schema,table,date_field,filter_logic\n"
    "drugsall,Drugs,cdm,drug_exposure,drug_exposure_start_date,\n",
    "fot_table": "check_id,check_description,check_domain,schema,table,date_field,filter_logic\n"
    "visall,Visits,Visits,cdm,visit_occurrence,visit_start_date,\n"
    "drugspresc,Drugs,Drugs,cdm,drug_exposure,drug_exposure_start_date,drug_type_concept_id = 38000177\n",
    "cfd_visits": "visit_type,visit_concept_id,visit_source_concept_id\n"
    "inpatient,9201,\noutpatient,9202,\nprimary_care,9202,\ncancelled,,2000001590\n",
    "cfd_mappings": "check_name,description\ncfd_drugsall,Drugs\n",
    "dqa_check_descriptions": "check_name,check_application\ndc_drugsall,Drug rows\n",
    "new_check_names": "check_name,new_name\nuc_drugsall,uc_all_drugs\n",
    "drugmeta_uc_table": "check_id,check_description,schema,table,concept_field,source_value_field,date_field,filter_logic\n"
    "drugs-refill,Refills,cdm,drug_exposure,refills,refills,drug_exposure_start_date,\n"
    "drugs-doseunits,Unit,cdm,drug_exposure,dose_unit_concept_id,,drug_exposure_start_date,\n",
    "general_practice_specialties": "concept_id,concept_name\n500,General\n",
}


def clinical(spark):
    sites = ("a", "b", "c")
    persons = [
        (s, 10 * i + p, D(2018, 1, 1), 8507 if p else 44814653, 30.0)
        for i, s in enumerate(sites)
        for p in range(4)
    ]
    visits = [
        (s, pid, 100 + pid, (9202, 9201)[pid % 2], 1, D(2019, 1 + pid % 12, 1), D(2019, 1 + pid % 12, 5), 1, 1)
        for s, pid, *_ in persons
    ]
    drugs = [
        (s, pid, None if pid % 10 == 3 else vid, (1, 2, 0)[pid % 3], f"src{pid % 2}", start, end,
         38000177, 1.0, 2.0, 3.0, "daily", 4.0, 7)
        for s, pid, vid, _, _, start, end, _, _ in visits
        for _ in range(1 + pid % 3)
    ]
    conditions = [(s, pid, vid, 9, start) for s, pid, vid, _, _, start, *_ in visits if pid % 4 != 1]
    make = spark.createDataFrame
    return Tables(
        {
            "cdm": frames(
                {
                    "person": make(persons, "site string, person_id bigint, birth_date date,"
                                   " gender_concept_id bigint, pn_gestational_age double"),
                    "visit_occurrence": make(visits, "site string, person_id bigint,"
                                             " visit_occurrence_id bigint, visit_concept_id bigint,"
                                             " visit_source_concept_id bigint, visit_start_date date,"
                                             " visit_end_date date, provider_id bigint,"
                                             " care_site_id bigint"),
                    "drug_exposure": make(drugs, "site string, person_id bigint,"
                                          " visit_occurrence_id bigint, drug_concept_id bigint,"
                                          " drug_source_value string, drug_exposure_start_date date,"
                                          " drug_exposure_end_date date, drug_type_concept_id bigint,"
                                          " refills double, quantity double, days_supply double,"
                                          " frequency string, effective_drug_dose double,"
                                          " dose_unit_concept_id bigint"),
                    "condition_occurrence": make(conditions, "site string, person_id bigint,"
                                                 " visit_occurrence_id bigint,"
                                                 " condition_concept_id bigint,"
                                                 " condition_start_date date"),
                    "provider": make([(1, 500)], "provider_id bigint, specialty_concept_id bigint"),
                    "care_site": make([(1, 7)], "care_site_id bigint, specialty_concept_id bigint"),
                }
            ),
            "vocabulary": frames(
                {
                    "concept": make(
                        [(1, "Pill", "RxNorm"), (2, "Drop", "CVX"), (8507, "male", "Gender"),
                         (44814653, "Unknown", "None")],
                        "concept_id bigint, concept_name string, vocabulary_id string",
                    )
                }
            ),
        }
    )


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    for name, text in SPECS.items():
        (folder / f"{name}.csv").write_text(text)
    job = run.Run(spark, clinical(spark), str(folder), Store(spark, str(folder / "results")), "v2",
                  D(2019, 12, 31), str(folder / "text"))
    run.build_cohorts(job, ["gest_age_cohort", "gp_specialties", "ip_admit"])
    run.run_checks(job, list(run.SPEC_FILES), previous=job.tables, previous_version="v1")
    run.run_processing(job)
    run.run_summaries(job)
    run.run_medication_study(job, {"rx_pill": job.code_sets.get("pills")})
    return job


def test_every_result_is_stored(finished):
    expected = [*run.CHECK_OUTPUTS, *[s for s, _, _ in run.SUMMARIES], *[t for _, _, t in run.SUMMARIES],
                "cfd_output_ln", "dqa_check_metadata", "vc_violations_pp", "fot_ratios_pp",
                "uc_drug_metadata", "uc_example_drugs", "qd_example_drugs"]
    assert [name for name in expected if not finished.store.exists(name)] == []
    empty = [name for name in expected if finished.store.read(name).count() == 0]
    assert empty == []


def test_shares_lie_between_zero_and_one(finished):
    for name, column in (("uc_output_pp", "unmapped_prop"), ("vc_output_pp", "prop_viol"),
                         ("ecp_output_pp", "prop_with_concept"), ("dcon_output_pp", "prop"),
                         ("mf_visitid_output_pp", "prop_missing_visits_total"),
                         ("cfd_output_pp", "fact_visits_prop"), ("dp_output_pp", "prop_implausible")):
        outside = finished.store.read(name).filter(f"{column} < 0 OR {column} > 1")
        assert outside.count() == 0, name


def test_totals_equal_the_sum_of_the_sites(finished):
    uc = finished.store.read("uc_output_pp")
    sites = uc.filter("site <> 'total'").groupBy().sum("total_rows").first()[0]
    assert uc.filter("site = 'total'").first().total_rows == sites


def test_running_a_check_again_changes_nothing(finished):
    before = finished.store.read("uc_output").count()
    run.run_checks(finished, ["uc"])
    assert finished.store.read("uc_output").count() == before


def test_unchanged_data_has_no_change(finished):
    changes = finished.store.read("dc_output_pp")
    assert changes.filter("prop_total_change <> 0").count() == 0


def test_primary_care_visits_come_from_the_specialty(finished):
    rows = finished.store.read("cfd_output").filter("visit_type = 'primary_care' AND site = 'a'")
    assert [(r.check_name, r.total_visits) for r in rows.collect()] == [("cfd_drugsall-vispc", 2)]


def test_the_gate_reports_and_stops(finished):
    failed = run.run_gate(finished, stop=False)
    names = {row.check_name for row in failed.collect()}
    assert "vc_drugsall-cid" in names and "ecp_ht" in names
    with pytest.raises(gate.GateFailure):
        run.run_gate(finished)


def test_anonymised_tables_hold_no_site_name(finished):
    names = ["uc_output_pp", "mf_visitid_output_pp"]
    target = Store(finished.spark, f"{finished.specs}/published")
    assert run.run_anonymisation(finished, names, "salt", target) == names
    for name in names:
        sites = {row.site for row in target.read(name).select("site").distinct().collect()}
        assert sites == {"site_1", "site_2", "site_3", "total"}


def test_without_names_all_processed_tables_with_a_site_are_anonymised(finished):
    target = Store(finished.spark, f"{finished.specs}/published_all")
    done = run.run_anonymisation(finished, None, "salt", target)
    stored = [n for n in finished.store.names() if "_pp" in n]
    assert done == [n for n in stored if "site" in finished.store.read(n).columns] and len(done) > 10
    for name in ("dc_output_pp", "fot_heuristic_pp"):
        assert target.read(name).filter("site IN ('a', 'b', 'c')").count() == 0


def test_optional_files_take_effect(finished):
    store = finished.store
    kinds = {r.visit_type for r in store.read("cfd_output").select("visit_type").distinct().collect()}
    assert "inpatient" in kinds and "emergency" not in kinds
    described = store.read("dqa_check_metadata").filter("check_application IS NOT NULL").collect()
    assert [(r.check_name, r.check_application) for r in described] == [("dc_drugsall", "Drug rows")]
    fields = {r.check_name for r in store.read("uc_drug_metadata").collect()}
    assert {"uc_drugs-refill", "uc_drugs-doseunits"} < fields and "uc_drugs-dose" not in fields
    assert store.exists("bmc_concepts") and store.exists("cfd_mappings")


def test_results_are_also_text(finished):
    text = finished.spark.read.option("header", True).csv(f"{finished.files}/uc_output")
    assert text.count() == finished.store.read("uc_output").count()


def test_the_medication_report_is_stored(finished):
    run.run_medication_report(finished, ["v2"])
    rows = finished.store.read("drug_tracking")
    assert {"site", "check_description", "v2"} <= set(rows.columns) and rows.count() > 0
    assert finished.store.read("drug_dose_spreads").count() > 0
    assert finished.store.read("drug_field_spreads").count() > 0


def test_a_second_delivery_is_processed_alone(finished):
    """Rows of an older delivery neither change the results of the newer one nor stop it."""
    store = Store(finished.spark, f"{finished.specs}/two")
    for name in ("dc_output", "uc_output", "uc_by_year", "uc_grpd", "ecp_output", "dc_meta"):
        store.write(finished.store.read(name), name)
    old = finished.store.read("ecp_output")
    newer = replace(finished, store=store, version="v3")
    for name in ("dc_output", "uc_output"):
        rows = finished.store.read(name).selectExpr("* EXCEPT (database_version)", "'v3' AS database_version")
        store.append(rows.select(*finished.store.read(name).columns), name)
    passing = old.selectExpr("* EXCEPT (database_version, pts_with_concept, prop_with_concept)",
                             "'v3' AS database_version", "total_pts AS pts_with_concept",
                             "CAST(1 AS DOUBLE) AS prop_with_concept")
    store.append(passing.select(*old.columns), "ecp_output")
    run.run_processing(newer)
    for name in ("dc_output_pp", "uc_output_pp"):
        assert store.read(name).count() == finished.store.read(name).count()
    assert "ecp_ht" not in {r.check_name for r in run.run_gate(newer, stop=False).collect()}
    assert "ecp_ht" in {r.check_name for r in run.run_gate(replace(newer, version="v2"), stop=False).collect()}


def test_tables_are_renamed_dropped_and_pruned(finished):
    store = Store(finished.spark, f"{finished.specs}/kept")
    rows = finished.store.read("uc_output")
    store.write(rows.withColumn("old_check_name", rows.check_name), "uc_output")
    store.write(finished.store.read("ip_admit"), "ip_admit")
    job = replace(finished, store=store)
    assert run.run_renaming(job) == ["uc_output"]
    renamed = store.read("uc_output")
    assert renamed.columns == rows.columns
    assert {r.check_name for r in renamed.collect()} == {"uc_all_drugs"}
    store.prune("uc_output")
    assert store.read("uc_output").count() == rows.count()
    run.drop_cohorts(job, ["ip_admit", "absent"])
    assert store.names() == ["uc_output"]


def test_one_site_is_judged_alone(finished):
    """A delivery of one site passes or fails by itself."""
    every = run.run_gate(finished, stop=False)
    assert {r.site for r in every.collect()} >= {"a"}
    failed = {r.site for r in every.collect()}
    for site in ("a", "b", "c"):
        own = run.run_gate(finished, stop=False, sites=[site]).collect()
        assert {r.site for r in own} == {site} & failed
        if site in failed:
            with pytest.raises(Exception, match="(?i)fail"):
                run.run_gate(finished, sites=[site])
    assert run.run_gate(finished, sites=["nobody"]).count() == 0
