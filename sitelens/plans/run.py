"""Whole runs: cohorts and checks, post-processing, summaries, anonymisation, gate, medication.

Each step reads stored tables and stores its results under fixed names, so steps can be run on
different days and repeated. Results of checks are appended without duplicates. Cohorts that
several checks read are stored once, which also tells Spark their true size for later joins.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.operators.joins import site_keys
from sitelens.operators.sets import union_all
from sitelens.plans import checks, cohorts, fixed, gate, medication, outliers, process, publish
from sitelens.plans import summary as summaries
from sitelens.plans.checks.concordance import level_of
from sitelens.plans.checks.documentation import VisitClass, visit_classes
from sitelens.sources import specs as sp
from sitelens.sources.store import Store, path_exists
from sitelens.sources.tables import Tables

#: Specification file and kind of each check family; files are optional.
SPEC_FILES = {
    "dc": ("dc_table", sp.CycleSpec),
    "vc": ("vc_table", sp.VocabularySpec),
    "vs": ("vs_table", sp.ValueSetSpec),
    "uc": ("uc_table", sp.UnmappedSpec),
    "mf": ("mf_table", sp.MissingVisitSpec),
    "bmc": ("bmc_table", sp.BestMappedSpec),
    "ecp": ("ecp_table", sp.ExpectedConceptSpec),
    "cfd": ("cfd_table", sp.DocumentationSpec),
    "dcon": ("dcon_table", sp.ConcordanceSpec),
    "dp": ("dp_table", sp.DatePlausibilitySpec),
    "fot": ("fot_table", sp.FactsOverTimeSpec),
}
BEST_LIST_FILE = "bmc_bestnotbest"
CATEGORY_FILE = "ecp_cat_new"

# Names of the optional files.
VISIT_CLASS_FILE = "cfd_visits"
DOCUMENTATION_NAMES_FILE = "cfd_mappings"
DESCRIPTION_FILE = "dqa_check_descriptions"
NEW_NAMES_FILE = "new_check_names"
DRUG_FIELDS_FILE = "drugmeta_uc_table"


@dataclass(frozen=True)
class Run:
    """What a run works on: clinical tables, specification folder, result store, version.

    With a files folder, results of checks are also written there as text.
    """

    spark: SparkSession
    tables: Tables
    specs: str
    store: Store
    version: str
    as_of: datetime.date | None = None
    files: str | None = None

    @property
    def code_sets(self) -> sp.CodeSets:
        return sp.CodeSets(self.spark, self.specs)

    def read(self, family: str) -> list:
        name, kind = SPEC_FILES[family]
        return sp.read_specs(self.spark, self.path(name), kind)

    def current(self, name: str) -> DataFrame:
        """A stored result of this run's version; a result without versions as it is."""
        rows = self.store.read(name)
        if "database_version" not in rows.columns:
            return rows
        return rows.filter(F.col("database_version") == self.version)

    def path(self, name: str) -> str:
        return f"{self.specs.rstrip('/')}/{name}.csv"

    def has(self, name: str) -> bool:
        """Whether the specification folder holds an optional file."""
        return path_exists(self.spark, self.path(name))

    def append(self, rows: DataFrame, name: str) -> None:
        self.store.append(rows, name, csv=self.files)

    def descriptions(self) -> DataFrame | None:
        if not self.has(DESCRIPTION_FILE):
            return None
        return sp.read_descriptions(self.spark, self.path(DESCRIPTION_FILE))

    def with_results(self) -> Tables:
        """Clinical tables together with what the store holds."""
        return self.tables.with_schema("result", self.store.read)


#: The code sets of specialties by the cohort of their visits.
SPECIALTIES = {
    "nephrology_specialties": "nephrology",
    "oncology_specialties": "oncology",
    "gp_specialties": "general_practice_specialties",
}


def build_cohorts(run: Run, names: Sequence[str] | None = None) -> list[str]:
    """Store the derived tables that checks read; all of them, or those named."""
    t, codes = run.tables.cdm, run.code_sets.get
    visits = t("visit_occurrence")

    # Cohorts that differ in a label only are found together and stored once; each is a part of that.
    @cache
    def specialties() -> DataFrame:
        asked = [name for name in SPECIALTIES if names is None or name in names]
        sets = {name: codes(SPECIALTIES[name]) for name in asked}
        found = cohorts.visits_by_specialty(
            visits,
            t("provider"),
            t("care_site"),
            sets,
            visit_concepts={"gp_specialties": fixed.OFFICE_VISIT},
            label="__cohort",
        )
        return run.store.write(found, "specialties_together")

    @cache
    def settings() -> DataFrame:
        found = cohorts.facts_by_setting(
            t("drug_exposure"),
            visits,
            {
                "vodi": cohorts.Setting(office, fixed.INPATIENT_ADMINISTRATION),
                "vipdp": cohorts.Setting(inpatient, fixed.PRESCRIPTION),
            },
            "drug_type_concept_id",
            label="__cohort",
        )
        return run.store.write(found, "settings_together")

    def part(together: Callable[[], DataFrame], name: str) -> Callable[[], DataFrame]:
        return lambda: together().filter(F.col("__cohort") == name).drop("__cohort")

    def valid_persons() -> DataFrame:
        seen = cohorts.persons_seen_with_diagnosis(visits, t("condition_occurrence"))
        return cohorts.geocode_cohort(t("person"), seen)

    office, inpatient = (fixed.OFFICE_VISIT,), fixed.INPATIENT_VISITS
    builders = {
        "payer_with_date": lambda: cohorts.payer_with_date(t("visit_payer"), visits),
        "gest_age_cohort": lambda: cohorts.gestational_age_cohort(visits, t("person")),
        "pth_labs": lambda: cohorts.facts_in_code_set(
            t("measurement"), codes("lab_pth"), "measurement_concept_id", cohorts.LAB_COLUMNS
        ),
        "op_prov_spec": lambda: cohorts.visits_with_specialty(
            visits, t("provider"), "provider_id"
        ),
        "op_cs_spec": lambda: cohorts.visits_with_specialty(
            visits, t("care_site"), "care_site_id"
        ),
        "valid_demo": valid_persons,
        "geocode_cohort": lambda: run.store.read("valid_demo").drop("location_id"),
        "loc_fips": lambda: cohorts.person_geocodes(
            run.store.read("valid_demo"), t("location_fips")
        ),
        "lohis_fips": lambda: cohorts.location_history_counts(
            t("location_history"), t("location_fips"), run.store.read("valid_demo")
        ),
        "pdl_pts": lambda: cohorts.persons_in_all(
            t("procedure_occurrence"), t("drug_exposure"), t("measurement")
        ),
        "ip_admit": lambda: cohorts.persons_with_visit(visits),
        **{name: part(specialties, name) for name in SPECIALTIES},
        "procs_drugs": lambda: cohorts.person_visits(
            t("procedure_occurrence"), t("drug_exposure")
        ),
        "icu_transfer": lambda: cohorts.icu_transfers(t("adt_occurrence")),
        "payer_w_pid": lambda: cohorts.payer_persons(t("visit_payer"), visits),
        "ip_two": lambda: cohorts.long_visits(visits),
        "wc_codes": lambda: cohorts.coded_visits(
            [
                (t("condition_occurrence"), "condition_concept_id"),
                (t("procedure_occurrence"), "procedure_concept_id"),
            ],
            codes("px_wellness_visit"),
            visits,
        ),
        "vodi": part(settings, "vodi"),
        "vipdp": part(settings, "vipdp"),
        "prvo": lambda: cohorts.facts_at_visits(t("procedure_occurrence"), visits, office),
        "c19_imm": lambda: cohorts.facts_in_code_set(
            t("immunization"), codes("c19_immunizations"), "immunization_concept_id"
        ),
        "c19_dx_lab_current": lambda: cohorts.persons_with_code_and_lab(
            t("condition_occurrence"), codes("c19_dx"), t("measurement"), codes("c19_viral_labs")
        ),
    }
    chosen = list(builders if names is None else names)
    for name in chosen:
        run.store.write(builders[name](), name)
    drop_cohorts(run, ["specialties_together", "settings_together"])
    return chosen


def drop_cohorts(run: Run, names: Sequence[str]) -> None:
    """Remove stored cohorts that no later step reads."""
    for name in names:
        run.store.drop(name)


def run_checks(
    run: Run,
    families: Sequence[str],
    previous: Tables | DataFrame | None = None,
    previous_version: str | None = None,
) -> None:
    """Run check families and append their results to the store.

    The data cycle check compares with the previous delivery's tables or stored result.
    """
    tables, store, version = run.with_results(), run.store, run.version
    visits = tables.cdm("visit_occurrence")
    for family in families:
        specs = run.read(family)
        if family == "dc":
            counts = checks.data_cycle_changes(tables, specs, version, previous, previous_version)
            run.append(counts, "dc_output")
            store.write(checks.cycle_metadata(run.spark, specs), "dc_meta")
        elif family == "vc":
            concept = tables.vocabulary("concept")
            run.append(
                checks.vocabulary_conformance(tables, specs, concept, version), "vc_output"
            )
        elif family == "vs":
            run.append(
                checks.value_set_conformance(tables, specs, run.code_sets, version), "vs_output"
            )
        elif family == "uc":
            run.append(checks.unmapped_concepts(tables, specs, version), "uc_output")
            run.append(checks.unmapped_by_year(tables, specs, version), "uc_by_year")
            run.append(checks.unmapped_source_values(tables, specs, version), "uc_grpd")
        elif family == "mf":
            run.append(
                checks.missing_visit_ids(tables, specs, visits, version), "mf_visitid_output"
            )
        elif family == "bmc":
            run.append(_best_mapped(run, tables, specs), "bmc_output")
            best = sp.read_best_list(run.spark, run.path(BEST_LIST_FILE))
            store.write(best, "bmc_concepts")
        elif family == "ecp":
            run.append(
                checks.expected_concepts(tables, specs, run.code_sets, version), "ecp_output"
            )
        elif family == "cfd":
            run.append(_documentation(run, tables, specs, visits), "cfd_output")
            if run.has(DOCUMENTATION_NAMES_FILE):
                names = sp.read_csv(run.spark, run.path(DOCUMENTATION_NAMES_FILE))
                store.write(names, "cfd_mappings")
        elif family == "dcon":
            run.append(_concordance(run, tables, specs), "dcon_output")
            store.write(checks.concordance_metadata(run.spark, specs), "dcon_meta")
        elif family == "dp":
            run.append(
                checks.date_plausibility(tables, specs, visits, tables.cdm("person"), version),
                "dp_output",
            )
        elif family == "fot":
            counts = checks.facts_over_time(tables, specs, version, as_of=run.as_of)
            run.append(checks.attach_denominators(counts), "fot_output")
        else:
            raise ValueError(f"unknown check family {family!r}")


def _best_mapped(run: Run, tables: Tables, specs: Sequence[sp.BestMappedSpec]) -> DataFrame:
    """Checks whose field is its own attribute need no concept table."""
    best = sp.read_best_list(run.spark, run.path(BEST_LIST_FILE))
    own = [s for s in specs if s.concept_field == s.concept_table_field]
    named = [s for s in specs if s.concept_field != s.concept_table_field]
    parts = []
    if named:
        concept = tables.vocabulary("concept")
        parts.append(checks.best_mapped_concepts(tables, named, best, run.version, concept))
    if own:
        parts.append(checks.best_mapped_concepts(tables, own, best, run.version))
    return union_all(parts)


def _visit_classes(run: Run) -> tuple[VisitClass, ...]:
    """The classes of the file, or the usual ones."""
    if not run.has(VISIT_CLASS_FILE):
        return visit_classes()
    concepts: dict[str, tuple[list, list]] = {}
    rows = sp.read_visit_classes(run.spark, run.path(VISIT_CLASS_FILE))
    for row in rows.distinct().orderBy(*rows.columns).toLocalIterator():
        kinds, sources = concepts.setdefault(row.visit_type, ([], []))
        if row.visit_concept_id is not None:
            kinds.append(row.visit_concept_id)
        if row.visit_source_concept_id is not None:
            sources.append(row.visit_source_concept_id)
    return visit_classes(concepts)


def _documentation(
    run: Run, tables: Tables, specs: Sequence[sp.DocumentationSpec], visits: DataFrame
) -> DataFrame:
    """All visit classes at once; general practice visits are marked by their specialty."""
    general = tables.result("gp_specialties")
    keys = site_keys(visits, general, "visit_occurrence_id")
    general = general.groupBy(*keys).agg(
        F.max("visit_specialty_concept_id").alias("visit_specialty_concept_id")
    )
    marked = visits.join(general, keys, "left")
    return checks.fact_documentation_by_class(
        tables, specs, marked, _visit_classes(run), run.version
    )


def _concordance(run: Run, tables: Tables, specs: Sequence[sp.ConcordanceSpec]) -> DataFrame:
    parts = []
    for level in ("patient", "visit", "visit_detail"):
        chosen = [s for s in specs if level_of(s.check_id) == level]
        if chosen:
            parts.append(
                checks.domain_concordance(tables, chosen, run.code_sets, run.version, level)
            )
    return union_all(parts)


def run_processing(run: Run) -> list[str]:
    """Post-process every stored check result, and flag outliers."""
    store, done = run.store, []

    def keep(df: DataFrame, name: str) -> None:
        store.write(df, name)
        done.append(name)

    def outliers_of(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
        return outliers.flag_outliers(outliers.distribution(df, group, value), value)

    if store.exists("dc_output"):
        changes = process.process_cycle(run.current("dc_output"), store.read("dc_meta"))
        value = "prop_total_change"
        stated = outliers.distribution(
            changes, ["check_type", "application"], value, sites_only=True
        )
        flagged = outliers.flag_outliers(stated, value)
        keep(outliers.suppress_outliers(flagged, value), "dc_output_pp")
    for family, value in (("vc", "vocabulary_id"), ("vs", "concept_id")):
        if store.exists(f"{family}_output"):
            result = process.process_conformance(run.current(f"{family}_output"), value)
            keep(result.processed, f"{family}_output_pp")
            keep(process.with_zero_rows(result), f"{family}_violations_pp")
    if store.exists("uc_output"):
        keep(process.process_unmapped(run.current("uc_output")), "uc_output_pp")
        keep(process.process_unmapped(run.current("uc_by_year")), "uc_by_year_pp")
        keep(run.current("uc_grpd"), "uc_grpd_pp")
    if store.exists("mf_visitid_output"):
        missing = process.process_missing_visits(run.current("mf_visitid_output"))
        keep(missing, "mf_visitid_output_pp")
    if store.exists("bmc_output"):
        keep(process.process_best_mapped(run.current("bmc_output")), "bmc_output_pp")
        keep(run.current("bmc_output"), "bmc_output_concepts_pp")
        best = store.read("bmc_output_pp").filter(F.col("best_notbest") == 1)
        group = [*process.NAMED, "check_name_app"]
        keep(outliers_of(best, group, "best_row_prop"), "bmc_anom_pp")
    if store.exists("ecp_output"):
        categories = sp.read_categories(run.spark, run.path(CATEGORY_FILE))
        expected = process.process_expected(run.current("ecp_output"), categories)
        keep(expected, "ecp_output_pp")
        found = outliers_of(store.read("ecp_output_pp"), ["check_name"], "prop_with_concept")
        keep(found, "ecp_anom_pp")
    if store.exists("cfd_output"):
        keep(process.process_documentation(run.current("cfd_output")), "cfd_output_pp")
    if store.exists("dcon_output"):
        keep(process.process_concordance(run.current("dcon_output")), "dcon_output_pp")
    if store.exists("fot_output"):
        timeline = process.process_timeline(run.current("fot_output"))
        keep(timeline.heuristic, "fot_heuristic_pp")
        keep(timeline.summary, "fot_heuristic_summary_pp")
        keep(timeline.ratios, "fot_ratios_pp")
    if store.exists("dp_output"):
        keep(process.process_dates(run.current("dp_output")), "dp_output_pp")
        group = ["check_name", "implausible_type", "check_name_app"]
        keep(outliers_of(store.read("dp_output_pp"), group, "prop_implausible"), "dp_anom_pp")
    results = [run.current(name) for name in CHECK_OUTPUTS if store.exists(name)]
    if results:
        keep(checks.check_metadata(results, run.descriptions()), "dqa_check_metadata")
    return done


CHECK_OUTPUTS = (
    "dc_output",
    "ecp_output",
    "bmc_output",
    "dcon_output",
    "cfd_output",
    "mf_visitid_output",
    "fot_output",
    "uc_output",
    "vc_output",
    "vs_output",
    "dp_output",
)

#: Post-processed table and parameter set of each cross-site summary, and the result's name.
SUMMARIES = (
    ("dc_output_pp", "dc", "dc_output_ln"),
    ("vs_output_pp", "vs", "vs_output_ln"),
    ("vc_output_pp", "vc", "vc_output_ln"),
    ("uc_output_pp", "uc", "uc_output_ln"),
    ("uc_by_year_pp", "uc_by_year", "uc_by_year_ln"),
    ("bmc_output_pp", "bmc", "bmc_output_ln"),
    ("dcon_output_pp", "dcon", "dcon_output_ln"),
    ("mf_visitid_output_pp", "mf", "mf_visitid_ln"),
    ("ecp_output_pp", "ecp", "ecp_output_ln"),
    ("dp_output_pp", "dp", "dp_output_ln"),
)


def run_summaries(run: Run) -> list[str]:
    """Summarise every post-processed result over the sites."""
    done = []
    for source, check, target in SUMMARIES:
        if run.store.exists(source):
            run.store.write(summaries.summarize_check(run.store.read(source), check), target)
            done.append(target)
    if run.store.exists("cfd_output_pp"):
        rows = summaries.summarize_documentation(run.store.read("cfd_output_pp"))
        run.store.write(rows, "cfd_output_ln")
        done.append("cfd_output_ln")
    return done


def run_anonymisation(
    run: Run,
    names: Sequence[str] | None,
    salt: str,
    target: Store | None = None,
    all_sites: str = "dc_output",
) -> list[str]:
    """Replace the site in stored tables by labels shared among them.

    With None for names, every post-processed table that has a site column is taken.
    The results go to the target store. Without one they become the newest version in the run's
    own store, whose earlier versions still name the sites and must not be passed on.
    """
    if names is None:
        names = [name for name in run.store.names() if "_pp" in name]
    tables = {name: run.store.read(name) for name in names}
    anonymous = publish.anonymise(tables, run.store.read(all_sites), salt)
    (target or run.store).write_all(anonymous)
    return list(anonymous)


def run_renaming(run: Run) -> list[str]:
    """Give the checks of all stored tables their new names; drop the column of old names."""
    new_names = sp.read_new_names(run.spark, run.path(NEW_NAMES_FILE))
    stored = {name: run.store.read(name) for name in run.store.names()}
    renamed = publish.rename_checks(stored, new_names)
    renamed = {name: df.select(*stored[name].columns) for name, df in renamed.items()}
    changed = renamed | publish.drop_old_names(stored | renamed)
    run.store.write_all(changed)
    return sorted(changed)


def run_gate(run: Run, stop: bool = True, sites: Sequence[str] | None = None) -> DataFrame:
    """Failures over all stored results; with stop, any failure raises.

    With sites, only those are judged: a delivery of one site passes or fails by itself, whatever the
    others do. The cycle gate takes its descriptions from the description file if there is one, and
    then judges only the checks that the file names; without the file every check is judged under its
    own description.
    """
    store, gates = run.store, []
    if store.exists("bmc_output"):
        processed = process.process_best_mapped(run.current("bmc_output"))
        gates.append(gate.best_mapped_gate(processed))
    if store.exists("dc_output"):
        changes = process.process_cycle(run.current("dc_output"), store.read("dc_meta"))
        gates.append(gate.cycle_gate(changes, run.descriptions()))
    if store.exists("vc_output"):
        result = process.process_conformance(run.current("vc_output"), "vocabulary_id")
        gates.append(gate.vocabulary_gate(result))
    if store.exists("uc_output"):
        gates.append(gate.unmapped_gate(run.current("uc_output")))
    if store.exists("mf_visitid_output"):
        missing = process.process_missing_visits(run.current("mf_visitid_output"))
        gates.append(gate.missing_visit_gate(missing))
    if store.exists("ecp_output"):
        gates.append(gate.expected_gate(run.current("ecp_output")))
    if store.exists("dp_output"):
        gates.append(gate.date_gate(run.current("dp_output")))
    failures = gate.failures(gates)
    if sites is not None:
        failures = failures.filter(F.col("site").isin(list(sites)))
    failed = store.write(failures, "gate_failures")
    if stop:
        gate.enforce(failed)
    return failed


def run_medication_study(
    run: Run, classes: Mapping[str, DataFrame], ancestors: DataFrame | None = None
) -> None:
    """Field population and value distributions of prescriptions, overall and by drug class."""
    fields = medication.FIELDS
    if run.has(DRUG_FIELDS_FILE):
        fields = [
            medication.Field(
                spec.check_id,
                spec.check_description,
                spec.concept_field,
                fixed.NULL_CONCEPTS if spec.concept_field.endswith("_concept_id") else (),
            )
            for spec in sp.read_specs(run.spark, run.path(DRUG_FIELDS_FILE), sp.UnmappedSpec)
        ]
    drugs = medication.prescriptions(run.tables.cdm("drug_exposure"))
    run.append(medication.population(drugs, run.version, fields), "uc_drug_metadata")
    listed = run.store.write(medication.drug_classes(classes, ancestors), "drug_classes")
    by_class = medication.population_by_class(drugs, listed, run.version, fields)
    run.append(by_class, "uc_example_drugs")
    classed = medication.with_length(medication.drugs_by_class(drugs, listed))
    spreads = union_all(
        [medication.dose_distribution(classed), medication.column_distributions(classed)]
    )
    run.store.write(spreads, "qd_example_drugs")


def run_medication_report(run: Run, versions: Sequence[str]) -> None:
    """Store what the report shows: tracking over versions, spreads of doses and other fields."""
    store = run.store
    population = store.read("uc_drug_metadata")
    store.write(medication.tracking(population, versions), "drug_tracking")
    store.write(medication.tracking(population, versions, grouped=True), "drug_tracking_grouped")
    spreads, order = store.read("qd_example_drugs"), ["drug_type", "min_val", "max_val"]
    concept = run.tables.vocabulary("concept")
    store.write(medication.dose_plot_data(spreads, concept, order), "drug_dose_spreads")
    store.write(medication.metadata_plot_data(spreads, order), "drug_field_spreads")
