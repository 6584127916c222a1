"""Clinical views over the driver's tables, as DataFrames and as SQL.

Orders stand for visits, order lines for facts, parts for concepts, customers for persons,
suppliers for providers and nations for care sites; the site is the customer's region, or the
nation where a check needs many sites. The tables hold no nulls and no unmapped codes, so some
columns are derived from the keys the same way on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sitelens.sources.specs import CodeSets
from sitelens.sources.tables import Tables, frames

VERSION = "v2"
PREVIOUS_VERSION = "v1"
CYCLE_CUT = "2001-01-01"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. Its schema is read from the files once, not at every mention."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _sites(spark: SparkSession, folder: str, site: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    label = F.col("r_name") if site == "region" else F.col("n_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", label.alias("site")
    )


def persons(spark: SparkSession, folder: str, site: str = "region") -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.join(
        _sites(spark, folder, site), F.col("c_nationkey") == F.col("n_nationkey")
    ).selectExpr(
        "site",
        "c_custkey AS person_id",
        "c_nationkey AS location_id",
        "c_mktsegment AS gender_concept_id",
        "date_add(DATE'1990-01-01', CAST(c_custkey % 3650 AS INT)) AS birth_date",
        "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey % 60 AS DOUBLE) END"
        " AS pn_gestational_age",
    )


def visits(spark: SparkSession, folder: str, site: str = "region") -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    located = customer.join(
        _sites(spark, folder, site), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return orders.join(located, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "site",
        "o_custkey AS person_id",
        "o_orderkey AS visit_occurrence_id",
        "o_orderpriority AS visit_concept_id",
        "o_orderstatus AS visit_source_concept_id",
        "CAST(o_orderdate AS DATE) AS visit_start_date",
        "date_add(CAST(o_orderdate AS DATE), CAST(o_orderkey % 6 AS INT)) AS visit_end_date",
        "c_nationkey AS location_id",
        "c_nationkey AS care_site_id",
        "o_totalprice AS total_price",
    )


FACT_COLUMNS = (
    "l_orderkey AS visit_occurrence_id",
    "l_partkey AS concept_id",
    "CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 10 = 3 THEN 0 ELSE l_partkey END"
    " AS mapped_concept_id",
    "CASE WHEN l_orderkey % 11 = 0 THEN NULL WHEN l_orderkey % 13 = 0"
    " THEN -l_orderkey ELSE l_orderkey END AS linked_visit_id",
    "l_returnflag AS fact_type",
    "l_linestatus AS source_value",
    "CAST(l_shipdate AS DATE) AS fact_date",
    "l_quantity AS value",
    "l_extendedprice AS price",
    "l_discount AS discount",
    "l_tax AS tax",
    "l_suppkey AS provider_id",
    "l_linenumber AS line_number",
)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Facts without their visit's site and person, straight from the scan."""
    return table(spark, folder, "lineitem").selectExpr(*FACT_COLUMNS)


def facts(spark: SparkSession, folder: str, site: str = "region") -> DataFrame:
    seen = visits(spark, folder, site).select(
        "site",
        "person_id",
        "visit_occurrence_id",
        "visit_concept_id",
        "visit_start_date",
        "care_site_id",
    )
    return lines(spark, folder).join(seen, "visit_occurrence_id")


def concept(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS concept_id",
        "p_type AS vocabulary_id",
        "p_brand AS concept_name",
        "p_size AS concept_class_id",
    )


def brand(spark: SparkSession, folder: str, *names: str) -> DataFrame:
    """The concepts of some brands, used as a code set."""
    parts = table(spark, folder, "part")
    return parts.filter(F.col("p_brand").isin(list(names))).selectExpr(
        "p_partkey AS concept_id", "p_name AS concept_name"
    )


def providers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS provider_id", "s_nationkey AS specialty_concept_id"
    )


def care_sites(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").selectExpr(
        "n_nationkey AS care_site_id", "n_nationkey AS specialty_concept_id"
    )


def region_nations(spark: SparkSession, folder: str, region: str) -> DataFrame:
    """The nations of a region, used as a specialty code set."""
    nation, regions = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        nation.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .filter(F.col("r_name") == region)
        .selectExpr("n_nationkey AS concept_id")
    )


def clinical_tables(spark: SparkSession, folder: str, site: str = "region") -> Tables:
    """The views under the schema and table names that specifications use."""
    return Tables(
        {
            "cdm": frames(
                {
                    "visit_occurrence": lambda: visits(spark, folder, site),
                    "fact": lambda: facts(spark, folder, site),
                    "person": lambda: persons(spark, folder, site),
                }
            ),
            "vocabulary": frames({"concept": lambda: concept(spark, folder)}),
        }
    )


def code_sets(spark: SparkSession, folder: str) -> CodeSets:
    return CodeSets(
        named={
            "brand_1": brand(spark, folder, "Brand#1"),
            "brand_2": brand(spark, folder, "Brand#2", "Brand#3"),
            "brand_4": brand(spark, folder, "Brand#4"),
        }
    )


def _sites_sql(site: str) -> str:
    label = "r.r_name" if site == "region" else "n.n_name"
    return f"""sites AS (
  SELECT n.n_nationkey, {label} AS site
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


PERSONS_SQL = """persons AS (
  SELECT s.site, c.c_custkey AS person_id, c.c_nationkey AS location_id,
         c.c_mktsegment AS gender_concept_id,
         DATE '1990-01-01' + CAST(c.c_custkey % 3650 AS INTEGER) AS birth_date,
         CASE WHEN c.c_custkey % 9 = 0 THEN NULL ELSE CAST(c.c_custkey % 60 AS DOUBLE) END
           AS pn_gestational_age
  FROM customer c JOIN sites s ON c.c_nationkey = s.n_nationkey
)"""

VISITS_SQL = """visits AS (
  SELECT s.site, o.o_custkey AS person_id, o.o_orderkey AS visit_occurrence_id,
         o.o_orderpriority AS visit_concept_id, o.o_orderstatus AS visit_source_concept_id,
         CAST(o.o_orderdate AS DATE) AS visit_start_date,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 6 AS INTEGER) AS visit_end_date,
         c.c_nationkey AS location_id, c.c_nationkey AS care_site_id,
         o.o_totalprice AS total_price
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN sites s ON c.c_nationkey = s.n_nationkey
)"""

FACTS_SQL = """facts AS (
  SELECT v.site, v.person_id, v.visit_concept_id, v.visit_start_date, v.care_site_id,
         l.l_orderkey AS visit_occurrence_id, l.l_partkey AS concept_id,
         CASE WHEN l.l_partkey % 7 = 0 THEN NULL WHEN l.l_partkey % 10 = 3 THEN 0
              ELSE l.l_partkey END AS mapped_concept_id,
         CASE WHEN l.l_orderkey % 11 = 0 THEN NULL WHEN l.l_orderkey % 13 = 0
              THEN -l.l_orderkey ELSE l.l_orderkey END AS linked_visit_id,
         l.l_returnflag AS fact_type, l.l_linestatus AS source_value,
         CAST(l.l_shipdate AS DATE) AS fact_date, l.l_quantity AS value,
         l.l_extendedprice AS price, l.l_discount AS discount, l.l_tax AS tax,
         l.l_suppkey AS provider_id, l.l_linenumber AS line_number
  FROM lineitem l JOIN visits v ON l.l_orderkey = v.visit_occurrence_id
)"""

CONCEPT_SQL = """concept AS (
  SELECT p_partkey AS concept_id, p_type AS vocabulary_id, p_brand AS concept_name,
         p_size AS concept_class_id
  FROM part
)"""


def views_sql(site: str = "region") -> str:
    """The WITH clause that defines all views; further definitions can follow it."""
    parts = [_sites_sql(site), PERSONS_SQL, VISITS_SQL, FACTS_SQL, CONCEPT_SQL]
    return "WITH " + ",\n".join(parts)


BY_REGION = views_sql("region")
BY_NATION = views_sql("nation")
