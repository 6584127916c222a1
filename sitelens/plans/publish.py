"""Site anonymisation and renaming of checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitelens.operators.groups import TOTAL


def site_labels(df: DataFrame, salt: str) -> DataFrame:
    """Label site_<n> for every site of a table: site, site_anon.

    Our definition: sites are ranked by the salted hash of their name, so the numbering shows
    nothing about the names. The window runs over distinct site names only.
    """
    names = df.select("site").filter(F.col("site") != TOTAL).distinct()
    ranked = F.row_number().over(
        Window.orderBy(F.sha2(F.concat(F.lit(salt), F.col("site")), 256), "site")
    )
    return names.select("site", F.concat(F.lit("site_"), ranked).alias("site_anon"))


def anonymise(
    tables: Mapping[str, DataFrame], all_sites: DataFrame, salt: str
) -> dict[str, DataFrame]:
    """Tables with a site column, their site replaced by the label; totals stay totals.

    One mapping serves all tables. A site that the mapping lacks becomes null, never its name.
    """
    labels = site_labels(all_sites, salt)
    result = {}
    for name, df in tables.items():
        if "site" not in df.columns:
            continue
        label = F.when(F.col("site") == TOTAL, F.lit(TOTAL)).otherwise(F.col("site_anon"))
        joined = df.join(labels, "site", "left").withColumn("site", label)
        result[name] = joined.select(*df.columns)
    return result


def rename_checks(
    tables: Mapping[str, DataFrame], new_names: DataFrame
) -> dict[str, DataFrame]:
    """Check names replaced through check_name, new_name; unmapped names stay.

    Tables without check names are left out.
    """
    mapping = new_names.select("check_name", "new_name")
    return {
        name: df.join(mapping, "check_name", "left").withColumn(
            "check_name", F.coalesce("new_name", "check_name")
        )
        for name, df in tables.items()
        if "check_name" in df.columns
    }


def drop_old_names(
    tables: Mapping[str, DataFrame], column: str = "old_check_name"
) -> dict[str, DataFrame]:
    """Tables that carry the legacy column, without it."""
    return {name: df.drop(column) for name, df in tables.items() if column in df.columns}
