"""Facts without a usable visit id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.functions.columns import proportion, zero_if_null
from sitelens.operators.joins import site_keys
from sitelens.operators.reshape import stack
from sitelens.plans.checks.common import (
    HEADER,
    check_name,
    flagged_counts,
    in_check,
    with_header,
)
from sitelens.sources.specs import MissingVisitSpec
from sitelens.sources.tables import Tables


def missing_visit_ids(
    tables: Tables,
    specs: Sequence[MissingVisitSpec],
    visits: DataFrame,
    version: str,
    check_string: str = "mf_visitid",
) -> DataFrame:
    """Rows, rows with a null visit id and rows whose id no visit has, per site and check.

    Our definition: the missing share is null plus unknown ids over all rows; a site without
    rows for a check gives no row.
    Rows are counted per visit id before the visits are looked up, so the many rows of one
    visit, and all rows without one, reach the join as single counts.
    """
    visit = "visit_occurrence_id"
    specs = list(specs)
    counted = flagged_counts(
        tables, specs, lambda _: {"site": F.col("site"), visit: F.col(visit)}
    )
    keys = site_keys(counted, visits, visit)
    known = visits.select(*keys).distinct().withColumn("__known", F.lit(True))
    absent = F.col(visit).isNull()
    unknown = ~absent & F.col("__known").isNull()
    sums = []
    for i in range(len(specs)):
        for name, test in (("total", F.lit(True)), ("null", absent), ("unknown", unknown)):
            counts = F.sum(F.when(in_check(i) & test, F.col("__n")))
            sums.append(zero_if_null(counts).alias(f"__{name}_{i}"))
    per_site = counted.join(known, keys, "left").groupBy("site").agg(*sums)
    rows = stack(
        per_site,
        ["site"],
        [
            {
                "check_name": F.lit(check_name(check_string, spec.check_id)),
                "total_rows": F.col(f"__total_{i}"),
                "null_visit_rows": F.col(f"__null_{i}"),
                "unknown_visit_rows": F.col(f"__unknown_{i}"),
            }
            for i, spec in enumerate(specs)
        ],
    ).filter(F.col("total_rows") > 0)
    missing = F.col("null_visit_rows") + F.col("unknown_visit_rows")
    descriptions = {check_name(check_string, s.check_id): s.check_description for s in specs}
    headed = with_header(rows, descriptions, check_string, version)
    return headed.withColumns(
        {
            "domain": F.col("check_description"),
            "prop_missing_visits_total": proportion(missing, "total_rows"),
        }
    ).select(
        *HEADER,
        "domain",
        "total_rows",
        "null_visit_rows",
        "unknown_visit_rows",
        "prop_missing_visits_total",
    )
