"""Pass/fail gate over check results.

Each gate returns site, check_name, check_description, value, direction, threshold and
pass_fail.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.functions.columns import not_in, zero_if_null
from sitelens.operators.groups import with_result_values, without_totals
from sitelens.operators.joins import null_safe_join
from sitelens.operators.sets import union_distinct
from sitelens.plans.process import Conformance

COLUMNS = (
    "site",
    "check_name",
    "check_description",
    "value",
    "direction",
    "threshold",
    "pass_fail",
)

# Check names and thresholds of the gates.
BEST_CHECKS = (
    "bmc_demog-race",
    "bmc_demog-eth",
    "bmc_drugsip-rxnorm",
    "bmc_drugspresc-rxnorm",
    "bmc_csop",
    "bmc_provop",
)
SPECIALTY_CHECKS = ("bmc_csop", "bmc_provop")
BEST_THRESHOLD = 0.7
CHANGE_BOUNDS = (-0.5, 1.0)
VOCABULARY_CHECKS = ("vc_condsall-cid", "vc_drugsall-cid", "vc_labsall-cid")
VOCABULARY_THRESHOLD = 0.3
UNMAPPED_CHECKS = ("uc_condsall", "uc_drugsall", "uc_procsall", "uc_labsall")
UNMAPPED_WIDE = ("uc_procsall",)
UNMAPPED_THRESHOLDS = (0.3, 0.5)
MISSING_EXCLUDED = ("mf_visitid_drugspresc-visitid", "mf_visitid_immsall-visitid")
MISSING_THRESHOLD = 0.3
EXPECTED_CHECKS = ("ecp_ht", "ecp_wt", "ecp_tract-2020", "ecp_blgr-2020")
EXPECTED_BODY = ("ecp_ht", "ecp_wt")
EXPECTED_THRESHOLDS = (0.7, 0.75)
DATE_CHECKS = "drugsall|condsall|procsall|labsall"
DATE_THRESHOLD = 0.3


class GateFailure(Exception):
    """Raised when any check fails the gate."""


def _verdict(passed: Column) -> Column:
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))


def _named(
    df: DataFrame, prefix: str, value: str, direction: Column | str, threshold: Column | float
) -> DataFrame:
    return df.withColumns(
        {
            "check_description": F.concat(F.lit(f"{prefix} - "), F.col("check_description")),
            "value": F.col(value).cast("double"),
            "direction": F.lit(direction),
            "threshold": F.lit(threshold).cast("double"),
        }
    ).select(*COLUMNS)


def best_mapped_gate(
    processed: DataFrame,
    checks: Sequence[str] = BEST_CHECKS,
    together: Sequence[str] = SPECIALTY_CHECKS,
    threshold: float = BEST_THRESHOLD,
) -> DataFrame:
    """The best share must exceed the threshold; checks named together pass if one does."""
    rows = (
        without_totals(processed)
        .filter(F.col("check_name").isin(list(checks)) & (F.col("best_notbest") == 1))
        .withColumn(
            "__group",
            F.when(F.col("check_name").isin(list(together)), F.lit("bmc_specop")).otherwise(
                F.col("check_name")
            ),
        )
    )
    passed = {"__any": F.bool_or(F.col("best_row_prop") > threshold)}
    judged = with_result_values(rows, ["site", "__group"], passed).withColumn(
        "pass_fail", _verdict(F.coalesce("__any", F.lit(False)))
    )
    return _named(judged, "BMC", "best_row_prop", ">", threshold)


def cycle_gate(
    processed: DataFrame,
    applications: DataFrame | None = None,
    bounds: tuple[float, float] = CHANGE_BOUNDS,
) -> DataFrame:
    """Row counts must neither fall below nor grow beyond the bounds.

    applications may replace the description by its check_application, per check_name; checks
    it lacks are dropped then.
    """
    low, high = bounds
    rows = without_totals(processed).filter(F.col("application") == "rows")
    if applications is not None:
        rows = rows.drop("check_description").join(
            applications.select("check_name", F.col("check_application").alias("check_description")),
            "check_name",
        )
    change = F.col("prop_total_change")
    fails = ((change < 0) & (change < low)) | ((change > 0) & (change > high))
    judged = rows.withColumn("pass_fail", _verdict(~F.coalesce(fails, F.lit(False))))
    direction = F.when(change < 0, F.lit(">")).when(change >= 0, F.lit("<"))
    threshold = F.when(change < 0, F.lit(low)).when(change >= 0, F.lit(high))
    return _named(judged, "DCC", "prop_total_change", direction, threshold)


def vocabulary_gate(
    result: Conformance,
    checks: Sequence[str] = VOCABULARY_CHECKS,
    threshold: float = VOCABULARY_THRESHOLD,
) -> DataFrame:
    """No rejected value may make up more than the threshold. One row per rejected value."""
    rows = without_totals(result.processed).filter(F.col("check_name").isin(list(checks)))
    shares = result.violations.select("site", "check_name", F.col("tot_prop").alias("viol_prop"))
    joined = null_safe_join(rows, shares, on=["site", "check_name"], how="left").withColumn(
        "viol_prop", zero_if_null("viol_prop")
    )
    fails = ~F.col("accepted_value") & (F.col("viol_prop") > threshold)
    return _named(
        joined.withColumn("pass_fail", _verdict(~fails)), "VC", "viol_prop", "<", threshold
    )


def unmapped_gate(
    result: DataFrame,
    checks: Sequence[str] = UNMAPPED_CHECKS,
    wide: Sequence[str] = UNMAPPED_WIDE,
    thresholds: tuple[float, float] = UNMAPPED_THRESHOLDS,
) -> DataFrame:
    """The unmapped share must stay below the threshold, a wider one for some checks."""
    rows = result.filter(F.col("check_name").isin(list(checks)))
    usual, wider = thresholds
    limit = F.when(F.col("check_name").isin(list(wide)), F.lit(wider)).otherwise(F.lit(usual))
    judged = rows.withColumn("pass_fail", _verdict(F.col("unmapped_prop") < limit))
    return _named(judged, "UC", "unmapped_prop", "<", limit)


def missing_visit_gate(
    processed: DataFrame,
    excluded: Sequence[str] = MISSING_EXCLUDED,
    threshold: float = MISSING_THRESHOLD,
) -> DataFrame:
    """The share without a usable visit must stay below the threshold."""
    rows = without_totals(processed).filter(not_in("check_name", excluded, keep_null=True))
    judged = rows.withColumn(
        "pass_fail", _verdict(F.col("prop_missing_visits_total") < threshold)
    )
    return _named(judged, "MF-VISITID", "prop_missing_visits_total", "<", threshold)


def expected_gate(
    result: DataFrame,
    checks: Sequence[str] = EXPECTED_CHECKS,
    strict: Sequence[str] = EXPECTED_BODY,
    thresholds: tuple[float, float] = EXPECTED_THRESHOLDS,
) -> DataFrame:
    """The share of persons with the concept must exceed the threshold."""
    rows = result.filter(F.col("check_name").isin(list(checks)))
    usual, stricter = thresholds
    limit = F.when(F.col("check_name").isin(list(strict)), F.lit(stricter)).otherwise(
        F.lit(usual)
    )
    judged = rows.withColumn("pass_fail", _verdict(F.col("prop_with_concept") > limit))
    return _named(judged, "ECP", "prop_with_concept", ">", limit)


def date_gate(
    result: DataFrame, pattern: str = DATE_CHECKS, threshold: float = DATE_THRESHOLD
) -> DataFrame:
    """The implausible share must stay below the threshold, for checks named by a pattern."""
    rows = result.filter(F.col("check_name").rlike(pattern))
    judged = rows.withColumn("pass_fail", _verdict(F.col("prop_implausible") < threshold))
    return _named(judged, "DP", "prop_implausible", "<", threshold)


def failures(gates: Sequence[DataFrame]) -> DataFrame:
    """All failures of all gates, each once; none without any gate."""
    if not gates:
        kinds = {"value": "double", "threshold": "double"}
        schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in COLUMNS)
        return SparkSession.active().createDataFrame([], schema)
    return union_distinct(gates).filter(F.col("pass_fail") == "FAIL")


def enforce(failed: DataFrame, table: str = "gate_failures") -> None:
    """Raise if there is any failure. The message gives their number and the table that has them."""
    count = failed.count()
    if count:
        raise GateFailure(f"{count} data quality failure(s), listed in {table}")
