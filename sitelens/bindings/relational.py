"""Scans, sinks, projections, filters, joins, aggregations, sets, scalars and reshaping."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sitelens.bindings import views as v
from sitelens.bindings.registry import query
from sitelens.bindings.views import BY_REGION, table
from sitelens.functions import columns as c
from sitelens.operators.groups import (
    first_row,
    rows_at_minimum,
    with_group_values,
    with_result_values,
    with_totals,
)
from sitelens.operators.joins import decode, join_code_set, natural_join, null_safe_join
from sitelens.operators.reshape import column_spreads, spread, wide
from sitelens.operators.sets import union_all, union_distinct
from sitelens.plans.checks.common import matching_rows
from sitelens.plans.summary import summarize_sites
from sitelens.session import shared_folder
from sitelens.sources.specs import read_code_set, read_csv
from sitelens.sources.store import Store
from sitelens.sources.tables import Tables, only_site, parquet_folder

ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(*ORDER_COLUMNS.split(", "))


def _store(spark) -> Store:
    return Store(spark, f"{shared_folder(spark)}/results-{uuid.uuid4().hex}")


# --- scans and sinks ---------------------------------------------------------------------


@query("src_01", f"SELECT {ORDER_COLUMNS}, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def scan_clinical_table(spark, folder):
    tables = Tables({"cdm": parquet_folder(spark, folder, ".parquet")})
    return tables.cdm("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("src_02", f"SELECT {ORDER_COLUMNS} FROM orders")
def scan_result_table(spark, folder):
    store = _store(spark)
    store.write(_orders(spark, folder), "orders_copy")
    return Tables({"result": store.read}).result("orders_copy")


@query(
    "src_03",
    "SELECT p_partkey AS concept_id, p_type AS vocabulary_id, p_brand AS concept_name,"
    " p_size AS concept_class_id FROM part",
)
def scan_vocabulary(spark, folder):
    return v.clinical_tables(spark, folder).vocabulary("concept")


@query(
    "src_05",
    "SELECT l_orderkey, l_linenumber, l_partkey, p_name AS concept_name FROM lineitem"
    " JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#12'",
)
def scan_with_code_set(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    codes = v.brand(spark, folder, "Brand#12")
    return join_code_set(lines, codes, "l_partkey", keep=["concept_name"])


@query(
    "src_06",
    BY_REGION + " SELECT site, person_id, visit_occurrence_id FROM visits WHERE site = 'ASIA'",
)
def scan_one_site(spark, folder):
    rows = v.visits(spark, folder).select("site", "person_id", "visit_occurrence_id")
    return only_site(rows, "ASIA")


@query(
    "snk_01",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'",
)
def write_and_replace(spark, folder):
    store = _store(spark)
    orders = _orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderstatus")
    store.write(orders, "orders_by_status")
    finished = orders.filter(F.col("o_orderstatus") == "F").drop("o_orderstatus")
    return store.write(finished, "orders_by_status")


@query(
    "snk_02",
    "SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
    " UNION SELECT o_custkey, o_orderstatus FROM orders"
    " WHERE o_orderdate >= TIMESTAMP '1997-01-01'",
)
def append_without_duplicates(spark, folder):
    orders = table(spark, folder, "orders")
    day = F.col("o_orderdate").cast("date")
    store = _store(spark)
    early = orders.filter(day < "1999-01-01").select("o_custkey", "o_orderstatus")
    late = orders.filter(day >= "1997-01-01").select("o_custkey", "o_orderstatus")
    store.append(early, "runs", partition_by=["o_orderstatus"])
    return store.append(late, "runs", partition_by=["o_orderstatus"]).select(
        "o_custkey", "o_orderstatus"
    )


@query(
    "snk_05",
    "SELECT 'orders' AS source, o_orderstatus AS label, count(*) AS n FROM orders GROUP BY 2"
    " UNION ALL SELECT 'lines', l_returnflag, count(*) FROM lineitem GROUP BY 2",
)
def write_collection(spark, folder):
    counted = {
        "orders": table(spark, folder, "orders").groupBy(F.col("o_orderstatus").alias("label")),
        "lines": table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("label")),
    }
    store = _store(spark)
    store.write_all({name: g.agg(F.count(F.lit(1)).alias("n")) for name, g in counted.items()})
    return union_all(
        store.read(name).select(F.lit(name).alias("source"), "label", "n") for name in counted
    )


# --- projections -------------------------------------------------------------------------


@query("pj_01", BY_REGION + " SELECT site, visit_occurrence_id FROM visits")
def keep_columns(spark, folder):
    return v.visits(spark, folder).select("site", "visit_occurrence_id")


@query(
    "pj_02", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
)
def drop_column(spark, folder):
    return table(spark, folder, "orders").drop("o_orderpriority", "o_orderdate")


@query(
    "pj_05",
    BY_REGION + " SELECT visit_occurrence_id, line_number, concept_id, provider_id, fact_date,"
    " CAST(fact_date - visit_start_date AS INTEGER) AS los FROM facts",
)
def computed_column(spark, folder):
    return (
        v.facts(spark, folder)
        .withColumn("los", c.days_between("visit_start_date", "fact_date"))
        .select(
            "visit_occurrence_id", "line_number", "concept_id", "provider_id", "fact_date", "los"
        )
    )


# --- filters -----------------------------------------------------------------------------

LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity"


def _lines(spark, folder):
    return table(spark, folder, "lineitem")


def _line(df):
    return df.select(*LINE.split(", "))


@query("fl_01", f"SELECT {LINE} FROM lineitem WHERE l_returnflag = 'R'")
def equality_filter(spark, folder):
    return _line(_lines(spark, folder).filter(F.col("l_returnflag") == "R"))


@query(
    "fl_02",
    f"SELECT {ORDER_COLUMNS} FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def membership_filter(spark, folder):
    return _orders(spark, folder).filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


NULLABLE_PART = "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_partkey % 100 END"


@query(
    "fl_03",
    f"SELECT l_orderkey, l_linenumber, l_suppkey, {NULLABLE_PART} AS code FROM lineitem"
    f" WHERE ({NULLABLE_PART}) NOT IN (1, 2, 3)",
)
def negated_membership(spark, folder):
    rows = _lines(spark, folder).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", f"{NULLABLE_PART} AS code"
    )
    return rows.filter(c.not_in("code", [1, 2, 3]))


@query(
    "fl_04",
    f"SELECT l_orderkey, l_linenumber, l_suppkey, {NULLABLE_PART} AS code FROM lineitem"
    f" WHERE coalesce(({NULLABLE_PART}) NOT IN (1, 2, 3), TRUE)",
)
def negated_membership_keeping_null(spark, folder):
    rows = _lines(spark, folder).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", f"{NULLABLE_PART} AS code"
    )
    return rows.filter(c.not_in("code", [1, 2, 3], keep_null=True))


NULLABLE_STATUS = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END"


@query(
    "fl_05",
    f"SELECT o_orderkey, {NULLABLE_STATUS} AS status FROM orders"
    f" WHERE ({NULLABLE_STATUS}) <> 'P'",
)
def inequality_filter(spark, folder):
    rows = table(spark, folder, "orders").selectExpr(
        "o_orderkey", f"{NULLABLE_STATUS} AS status"
    )
    return rows.filter(F.col("status") != "P")


NULLABLE_MEASURES = (
    "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END AS refills",
    "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_discount END AS quantity",
    "CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_tax END AS days_supply",
)


@query(
    "fl_06",
    f"SELECT * FROM (SELECT l_orderkey, l_linenumber, l_suppkey, {', '.join(NULLABLE_MEASURES)}"
    " FROM lineitem) WHERE refills IS NOT NULL AND quantity IS NOT NULL"
    " AND days_supply IS NOT NULL",
)
def all_present_filter(spark, folder):
    rows = _lines(spark, folder).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", *NULLABLE_MEASURES
    )
    return rows.filter(c.all_present("refills", "quantity", "days_supply"))


@query(
    "fl_07",
    f"SELECT * FROM (SELECT l_orderkey, l_linenumber, l_suppkey, {', '.join(NULLABLE_MEASURES)}"
    " FROM lineitem) WHERE refills IS NOT NULL OR quantity IS NOT NULL",
)
def any_present_filter(spark, folder):
    rows = _lines(spark, folder).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", *NULLABLE_MEASURES
    )
    return rows.filter(c.any_present("refills", "quantity"))


@query(
    "fl_08",
    "SELECT doc_id, regexp_matches(text, 'http|www|@') AS linked FROM documents",
)
def regex_filter(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", F.col("text").rlike("http|www|@").alias("linked"))


@query("fl_09", f"SELECT {LINE} FROM lineitem WHERE l_quantity > 45")
def comparison_filter(spark, folder):
    return _line(_lines(spark, folder).filter(F.col("l_quantity") > 45))


@query(
    "fl_10",
    """
    SELECT 'equal' AS check_name, count(*) AS n FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL
    SELECT 'member', count(*) FROM lineitem
      WHERE l_partkey IN (1, 2, 3, 5, 8, 13) AND l_quantity <> 10
    UNION ALL
    SELECT 'outside', count(*) FROM lineitem WHERE NOT (l_linestatus IN ('O')) AND l_tax IS NOT NULL
    """,
)
def predicates_as_data(spark, folder):
    items = [
        ("equal", F.expr("l_returnflag = 'R'"), {}),
        ("member", F.expr("l_partkey IN (1, 2, 3, 5, 8, 13) AND l_quantity <> 10"), {}),
        ("outside", F.expr("NOT (l_linestatus IN ('O')) AND l_tax IS NOT NULL"), {}),
    ]
    matched = matching_rows(_lines(spark, folder), items, [])
    return matched.groupBy("check_name").agg(F.count(F.lit(1)).alias("n"))


# --- joins -------------------------------------------------------------------------------


@query(
    "jn_01",
    BY_REGION + " SELECT l.visit_occurrence_id, l.line_number, l.fact_type, v.site, v.person_id"
    " FROM (SELECT l_orderkey AS visit_occurrence_id, l_linenumber AS line_number,"
    " l_returnflag AS fact_type FROM lineitem) l JOIN visits v USING (visit_occurrence_id)",
)
def natural_inner_join(spark, folder):
    lines = _lines(spark, folder).selectExpr(
        "l_orderkey AS visit_occurrence_id",
        "l_linenumber AS line_number",
        "l_returnflag AS fact_type",
    )
    seen = v.visits(spark, folder).select("visit_occurrence_id", "site", "person_id")
    return natural_join(lines, seen)


@query(
    "jn_02",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem JOIN part ON l_partkey = p_partkey"
    " WHERE p_brand = 'Brand#7'",
)
def code_set_join(spark, folder):
    lines = _lines(spark, folder).select("l_orderkey", "l_linenumber", "l_partkey")
    return join_code_set(lines, v.brand(spark, folder, "Brand#7"), "l_partkey")


@query(
    "jn_04",
    "SELECT l_orderkey, l_linenumber, key AS l_suppkey, s_nationkey FROM (SELECT *,"
    " CASE WHEN l_suppkey % 9 = 0 THEN -l_suppkey ELSE l_suppkey END AS key FROM lineitem)"
    " LEFT JOIN supplier ON key = s_suppkey",
)
def left_join(spark, folder):
    """Every ninth supplier key of a line is one that no supplier has."""
    suppliers = table(spark, folder, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_nationkey")
    lines = _lines(spark, folder).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE WHEN l_suppkey % 9 = 0 THEN -l_suppkey ELSE l_suppkey END AS l_suppkey",
    )
    return lines.join(suppliers, "l_suppkey", "left")


@query(
    "jn_05",
    "SELECT c_custkey, key AS c_nationkey, n_name FROM (SELECT *,"
    " CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END AS key FROM customer)"
    " LEFT JOIN nation ON key = n_nationkey",
)
def natural_left_join(spark, folder):
    """Every fifth customer has a nation that is not known."""
    nations = table(spark, folder, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey", "CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END AS c_nationkey"
    )
    return natural_join(customers, nations, "left")


@query(
    "jn_06",
    """
    WITH o AS (SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS label,
                      CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus
               FROM orders),
    counts AS (SELECT label, month, o_orderstatus, count(*) AS row_cts FROM o GROUP BY ALL),
    totals AS (SELECT label, month, count(*) AS total_row FROM o GROUP BY ALL)
    SELECT c.label, c.month, c.o_orderstatus, c.row_cts, t.total_row
    FROM counts c LEFT JOIN totals t
      ON c.label IS NOT DISTINCT FROM t.label AND c.month IS NOT DISTINCT FROM t.month
    """,
)
def denominator_join(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority")).alias("label"),
        c.month_start("o_orderdate").alias("month"),
        "o_orderstatus",
    )
    counts = rows.groupBy("label", "month", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_cts")
    )
    totals = counts.groupBy("label", "month").agg(F.sum("row_cts").alias("total_row"))
    return null_safe_join(counts, totals, on=["label", "month"], how="left")


@query(
    "jn_07",
    """
    WITH a AS (SELECT CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_brand END AS label,
                      count(*) AS branded FROM part GROUP BY 1),
    b AS (SELECT CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN p_type
                      WHEN p_brand LIKE 'Brand#1%' THEN 'Brand#1x' ELSE p_brand END AS label,
                 count(*) AS labelled FROM part GROUP BY 1)
    SELECT coalesce(a.label, b.label) AS label, a.branded, b.labelled
    FROM a FULL JOIN b ON a.label IS NOT DISTINCT FROM b.label
    """,
)
def null_safe_full_join(spark, folder):
    """Two counts of all parts whose keys overlap in part, nulls included."""
    parts = table(spark, folder, "part")
    size, brand = F.col("p_size"), F.col("p_brand")
    first = F.when(size % 4 != 0, brand)
    second = (
        F.when(size % 5 == 0, F.lit(None))
        .when(size % 5 == 1, F.col("p_type"))
        .when(brand.like("Brand#1%"), "Brand#1x")
        .otherwise(brand)
    )
    branded = parts.groupBy(first.alias("label")).agg(F.count(F.lit(1)).alias("branded"))
    labelled = parts.groupBy(second.alias("label")).agg(F.count(F.lit(1)).alias("labelled"))
    return null_safe_join(branded, labelled, how="full")


@query(
    "jn_10",
    "SELECT l_orderkey, l_linenumber, key AS l_partkey, p_brand AS concept_name FROM (SELECT *,"
    " CASE WHEN l_partkey % 10 = 3 THEN -l_partkey ELSE l_partkey END AS key FROM lineitem)"
    " LEFT JOIN part ON key = p_partkey",
)
def decode_concepts(spark, folder):
    """Every tenth concept of a line is not in the vocabulary."""
    lines = _lines(spark, folder).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "CASE WHEN l_partkey % 10 = 3 THEN -l_partkey ELSE l_partkey END AS l_partkey",
    )
    return decode(
        lines, v.concept(spark, folder), "l_partkey", {"concept_name": "concept_name"}
    )


# --- aggregations ------------------------------------------------------------------------


@query("ag_01", BY_REGION + " SELECT site, count(*) AS n FROM visits GROUP BY site")
def grouped_count(spark, folder):
    return v.visits(spark, folder).groupBy("site").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ag_02",
    BY_REGION + " SELECT site, min(total_price) AS min_price, max(total_price) AS max_price"
    " FROM visits GROUP BY site",
)
def grouped_extremes(spark, folder):
    return (
        v.visits(spark, folder)
        .groupBy("site")
        .agg(F.min("total_price").alias("min_price"), F.max("total_price").alias("max_price"))
    )


@query(
    "ag_03",
    BY_REGION + " SELECT site, round(avg(value), 6) AS mean_val,"
    " round(stddev_samp(value), 6) AS sd_val FROM facts GROUP BY site",
)
def grouped_moments(spark, folder):
    return (
        v.facts(spark, folder)
        .groupBy("site")
        .agg(
            F.round(F.avg("value"), 6).alias("mean_val"),
            F.round(F.stddev_samp("value"), 6).alias("sd_val"),
        )
    )


@query(
    "ag_04",
    BY_REGION + " SELECT site, quantile_disc(price, 0.25) AS q1_val,"
    " quantile_disc(price, 0.5) AS med_val, quantile_disc(price, 0.75) AS q3_val"
    " FROM facts GROUP BY site",
)
def grouped_quartiles(spark, folder):
    found = spread(v.facts(spark, folder), ["site"], "price")
    return found.select("site", "q1_val", "med_val", "q3_val")


@query(
    "ag_05",
    BY_REGION + " SELECT person_id, CAST(year(fact_date) AS INTEGER) AS year,"
    " count(DISTINCT concept_id) AS concepts FROM facts GROUP BY ALL",
)
def grouped_distinct_count(spark, folder):
    return (
        v.facts(spark, folder)
        .groupBy("person_id", F.year("fact_date").alias("year"))
        .agg(F.countDistinct("concept_id").alias("concepts"))
    )


@query("ag_06", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, folder):
    return table(spark, folder, "orders").select("o_custkey", "o_orderstatus").distinct()


@query("ag_07", BY_REGION + " SELECT DISTINCT site, person_id, visit_concept_id FROM visits")
def distinct_columns(spark, folder):
    return v.visits(spark, folder).select("site", "person_id", "visit_concept_id").distinct()


@query(
    "ag_10",
    BY_REGION + " SELECT site, fact_type, count(*) AS n FROM facts GROUP BY ALL"
    " UNION ALL SELECT 'total', fact_type, count(*) FROM facts GROUP BY ALL",
)
def counts_with_total(spark, folder):
    rows = v.facts(spark, folder).select("site", "fact_type", F.lit(1).alias("n"))
    return with_totals(rows, ["fact_type"], ["n"])


@query(
    "ag_09",
    BY_REGION + """, per AS (
      SELECT site, visit_concept_id, visit_source_concept_id, count(*) AS n
      FROM visits GROUP BY ALL)
    SELECT p.*, s.min_val, s.q1, s.median_val, s.mean_val, s.q3, s.max_val FROM per p JOIN (
      SELECT visit_concept_id, CAST(min(n) AS DOUBLE) AS min_val, quantile_cont(n, 0.25) AS q1,
             quantile_cont(n, 0.5) AS median_val, avg(n) AS mean_val,
             quantile_cont(n, 0.75) AS q3, CAST(max(n) AS DOUBLE) AS max_val
      FROM per GROUP BY 1) s USING (visit_concept_id)""",
)
def exact_summary(spark, folder):
    per = (
        v.visits(spark, folder)
        .groupBy("site", "visit_concept_id", "visit_source_concept_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return summarize_sites(per, "n", ["visit_concept_id"])


# --- grouped selections ------------------------------------------------------------------


@query(
    "wn_01",
    BY_REGION + " SELECT site, person_id, visit_occurrence_id, visit_start_date FROM visits"
    " QUALIFY visit_start_date = min(visit_start_date) OVER (PARTITION BY site, person_id)",
)
def first_visits(spark, folder):
    rows = v.visits(spark, folder).select(
        "site", "person_id", "visit_occurrence_id", "visit_start_date"
    )
    return rows_at_minimum(rows, ["site", "person_id"], "visit_start_date")


@query(
    "wn_02",
    BY_REGION + " SELECT visit_occurrence_id, line_number, concept_id, person_id, fact_type,"
    " bool_or(value > 48) OVER (PARTITION BY person_id, fact_type) AS any_large FROM facts",
)
def group_any(spark, folder):
    rows = v.facts(spark, folder).select(
        "visit_occurrence_id", "line_number", "concept_id", "person_id", "fact_type", "value"
    )
    flagged = with_group_values(
        rows, ["person_id", "fact_type"], {"any_large": F.bool_or(F.col("value") > 48)}
    )
    return flagged.drop("value")


@query(
    "wn_03",
    "SELECT l_orderkey, l_extendedprice, l_linenumber, l_partkey, l_suppkey FROM lineitem"
    " QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,"
    " l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1",
)
def top_line(spark, folder):
    rows = _lines(spark, folder).select(
        "l_orderkey", "l_extendedprice", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return first_row(rows, ["l_orderkey"], ["l_extendedprice"], largest=True)


@query(
    "so_01",
    "SELECT c_nationkey, c_name, c_acctbal FROM customer ORDER BY c_nationkey, c_name",
)
def ordered(spark, folder):
    rows = table(spark, folder, "customer").select("c_nationkey", "c_name", "c_acctbal")
    return rows.orderBy("c_nationkey", "c_name")


# --- set operations ----------------------------------------------------------------------


@query(
    "st_01",
    BY_REGION + " SELECT person_id, visit_occurrence_id FROM facts WHERE fact_type = 'A'"
    " UNION SELECT person_id, visit_occurrence_id FROM facts WHERE fact_type = 'R'",
)
def union_without_duplicates(spark, folder):
    rows = v.facts(spark, folder)
    columns = ["person_id", "visit_occurrence_id"]
    return union_distinct(
        rows.filter(F.col("fact_type") == kind).select(*columns) for kind in ("A", "R")
    )


@query(
    "st_02",
    "SELECT o_orderkey AS id, o_orderstatus AS status, NULL AS segment FROM orders"
    " UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer",
)
def union_of_shapes(spark, folder):
    orders = table(spark, folder, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status")
    people = table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS segment")
    return union_all([orders, people])


@query(
    "st_03",
    "SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'"
    " UNION SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'"
    " UNION SELECT l_orderkey, l_suppkey FROM lineitem WHERE l_linestatus = 'F'",
)
def union_of_many(spark, folder):
    rows = _lines(spark, folder)
    slices = [
        rows.filter(F.col("l_returnflag") == "A"),
        rows.filter(F.col("l_returnflag") == "N"),
        rows.filter(F.col("l_linestatus") == "F"),
    ]
    return union_distinct(s.select("l_orderkey", "l_suppkey") for s in slices)


# --- scalar functions --------------------------------------------------------------------


@query(
    "sc_01",
    "SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium'"
    " ELSE 'large' END AS band FROM part",
)
def conditional_chain(spark, folder):
    size = F.col("p_size")
    band = F.when(size < 10, "small").when(size < 30, "medium").otherwise("large")
    return table(spark, folder, "part").select("p_partkey", band.alias("band"))


@query(
    "sc_02",
    "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 1 END AS flag FROM customer",
)
def two_way_conditional(spark, folder):
    flag = F.when(F.col("c_mktsegment") == "BUILDING", 0).otherwise(1)
    return table(spark, folder, "customer").select("c_custkey", flag.alias("flag"))


@query(
    "sc_03",
    "SELECT l_orderkey, l_linenumber, l_suppkey,"
    " coalesce(CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END, 0) AS refills FROM lineitem",
)
def null_to_zero(spark, folder):
    rows = _lines(spark, folder).selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", NULLABLE_MEASURES[0]
    )
    return rows.withColumn("refills", c.zero_if_null("refills"))


BLANKED = (
    "CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 5 = 1 THEN ' ' ELSE p_name END AS name",
    "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS brand",
)


@query(
    "sc_04",
    "SELECT p_partkey, nullif(nullif(name, ''), ' ') AS name, nullif(nullif(brand, ''), ' ') AS brand"
    f" FROM (SELECT p_partkey, {', '.join(BLANKED)} FROM part)",
)
def blanks_to_null(spark, folder):
    return c.blank_to_null(table(spark, folder, "part").selectExpr("p_partkey", *BLANKED))


@query(
    "sc_05",
    "SELECT n_nationkey, concat_ws('', r_name, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name"
    " END) AS label FROM nation JOIN region ON n_regionkey = r_regionkey",
)
def concatenate(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    name = F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name"))
    return joined.select("n_nationkey", c.pasted("r_name", name).alias("label"))


@query(
    "sc_06",
    "SELECT o_orderkey, replace(o_orderpriority, '-', '_') AS code,"
    " regexp_replace(o_orderpriority, '[0-9]-', '', 'g') AS label FROM orders",
)
def replace_text(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.replace("o_orderpriority", F.lit("-"), F.lit("_")).alias("code"),
        F.regexp_replace("o_orderpriority", "[0-9]-", "").alias("label"),
    )


@query(
    "sc_07",
    "SELECT c_custkey, regexp_replace(c_name, '[A-Za-z]', '', 'g') AS digits FROM customer",
)
def remove_letters(spark, folder):
    rows = table(spark, folder, "customer")
    return rows.select("c_custkey", c.without_letters("c_name").alias("digits"))


@query("sc_08", "SELECT p_partkey, CAST(length(p_name) AS INTEGER) AS n_chars FROM part")
def text_length(spark, folder):
    return table(spark, folder, "part").select("p_partkey", F.char_length("p_name").alias("n_chars"))


@query("sc_09", "SELECT c_custkey, lower(c_mktsegment) AS segment FROM customer")
def lower_case(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", F.lower("c_mktsegment").alias("segment")
    )


@query(
    "sc_10",
    "SELECT page_id, url FROM pages WHERE contains(url, '/fr/') AND NOT regexp_matches(url, 'ref=')",
)
def text_contains(spark, folder):
    url = F.col("url")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return pages.filter(url.contains("/fr/") & ~url.rlike("ref="))


@query(
    "sc_11",
    BY_REGION + " SELECT visit_occurrence_id, line_number, concept_id, provider_id,"
    " CAST(fact_date - visit_start_date AS INTEGER) AS days FROM facts",
)
def day_difference(spark, folder):
    return v.facts(spark, folder).select(
        "visit_occurrence_id",
        "line_number",
        "concept_id",
        "provider_id",
        c.days_between("visit_start_date", "fact_date").alias("days"),
    )


@query(
    "sc_13",
    BY_REGION + " SELECT v.visit_occurrence_id,"
    " CAST(v.visit_start_date - p.birth_date AS DOUBLE) / 365.25 AS age"
    " FROM visits v JOIN persons p USING (site, person_id)",
)
def years_from_days(spark, folder):
    people = v.persons(spark, folder).select("site", "person_id", "birth_date")
    return (
        v.visits(spark, folder)
        .join(people, ["site", "person_id"])
        .select(
            "visit_occurrence_id", c.years_between("birth_date", "visit_start_date").alias("age")
        )
    )


@query(
    "sc_14",
    "SELECT c_custkey, CAST(c_custkey AS DOUBLE) AS as_double,"
    " TRY_CAST(substr(c_name, 10) AS INTEGER) AS as_int,"
    " TRY_CAST(c_name AS DOUBLE) AS dirty FROM customer",
)
def casts(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_custkey").cast("double").alias("as_double"),
        F.substring("c_name", 10, 100).try_cast("int").alias("as_int"),
        F.col("c_name").try_cast("double").alias("dirty"),
    )


@query(
    "sc_17",
    "SELECT p_partkey, list_contains(list_transform(string_split(' STANDARD,PROMO , LARGE', ','),"
    " lambda x: trim(x)), p_type) AS accepted FROM part",
)
def comma_list_membership(spark, folder):
    accepted = c.listed_in("p_type", F.lit(" STANDARD,PROMO , LARGE"))
    return table(spark, folder, "part").select("p_partkey", accepted.alias("accepted"))


# --- reshaping ---------------------------------------------------------------------------


@query(
    "rs_01",
    BY_REGION + """ SELECT site, count(*) FILTER (visit_source_concept_id = 'F') AS "F",
      count(*) FILTER (visit_source_concept_id = 'O') AS "O",
      count(*) FILTER (visit_source_concept_id = 'P') AS "P"
    FROM visits GROUP BY site""",
)
def long_to_wide(spark, folder):
    counts = (
        v.visits(spark, folder)
        .groupBy("site", "visit_source_concept_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return wide(counts, ["site"], "visit_source_concept_id", "n", ["F", "O", "P"])


def spread_sql(column: str) -> str:
    """The statistics of one column, as SQL."""
    return (
        f"CAST(min({column}) AS DOUBLE) AS min_val, CAST(max({column}) AS DOUBLE) AS max_val,"
        f" CAST(quantile_disc({column}, 0.25) AS DOUBLE) AS q1_val,"
        f" CAST(quantile_disc({column}, 0.75) AS DOUBLE) AS q3_val,"
        f" CAST(quantile_disc({column}, 0.5) AS DOUBLE) AS med_val,"
        f" round(avg({column}), 6) AS mean_val, round(stddev_samp({column}), 6) AS sd_val"
    )


def rounded(df):
    """Mean and deviation at six places: engines add floating point numbers in any order."""
    return df.withColumns({n: F.round(n, 6) for n in ("mean_val", "sd_val")})


@query(
    "rs_02",
    BY_REGION
    + " UNION ALL ".join(
        f" SELECT site, '{name}' AS metadata_type, {spread_sql(name)} FROM facts GROUP BY site"
        for name in ("value", "discount", "tax")
    ),
)
def stacked_statistics(spark, folder):
    return rounded(column_spreads(v.facts(spark, folder), ["site"], ["value", "discount", "tax"]))


# --- operators that serve inside others, on their own ------------------------------------


@query("src_04", "SELECT n_nationkey AS concept_id, n_name AS concept_name FROM nation")
def read_code_set_file(spark, folder):
    """A code set written as CSV and read back with declared types."""
    path = f"{shared_folder(spark)}/codes-{uuid.uuid4().hex}"
    rows = table(spark, folder, "nation").selectExpr(
        "n_nationkey AS concept_id", "n_name AS concept_name", "'x' AS note"
    )
    rows.write.option("header", True).csv(path)
    return read_code_set(spark, path).withColumn("concept_id", F.col("concept_id").cast("int"))


@query("snk_03", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def write_file(spark, folder):
    """A result written as a table and as text; the text is read back."""
    store, text = _store(spark), f"{shared_folder(spark)}/text-{uuid.uuid4().hex}"
    counts = table(spark, folder, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    store.write(counts, "status_counts", csv=text)
    return read_csv(spark, f"{text}/status_counts").withColumn("n", F.col("n").cast("bigint"))


@query(
    "snk_04",
    BY_REGION + """, p AS (SELECT DISTINCT site, person_id FROM visits
      WHERE visit_concept_id = '1-URGENT')
    SELECT site, count(*) AS persons, sum(CASE WHEN person_id % 2 = 0 THEN 1 ELSE 0 END)::BIGINT AS even
    FROM p GROUP BY site""",
)
def materialised_intermediate(spark, folder):
    """An intermediate that is used twice is written once."""
    urgent = v.visits(spark, folder).filter(F.col("visit_concept_id") == "1-URGENT")
    people = _store(spark).write(urgent.select("site", "person_id").distinct(), "urgent")
    every = people.groupBy("site").agg(F.count(F.lit(1)).alias("persons"))
    even = people.filter(F.col("person_id") % 2 == 0).groupBy("site").agg(
        F.count(F.lit(1)).alias("even")
    )
    return null_safe_join(every, even, how="left")


@query(
    "pj_03",
    "SELECT o_orderkey AS visit_occurrence_id, o_orderdate::DATE AS time_start,"
    " o_totalprice AS total_row FROM orders",
)
def rename_columns(spark, folder):
    return (
        table(spark, folder, "orders")
        .select(
            F.col("o_orderkey").alias("visit_occurrence_id"),
            F.col("o_orderdate").cast("date").alias("time_start"),
            "o_totalprice",
        )
        .withColumnRenamed("o_totalprice", "total_row")
    )


@query(
    "pj_04",
    BY_REGION + " SELECT site, min(total_price) AS min_val_pts, max(total_price) AS max_val_pts"
    " FROM visits GROUP BY site",
)
def suffix_columns(spark, folder):
    rows = (
        v.visits(spark, folder)
        .groupBy("site")
        .agg(F.min("total_price").alias("min_val"), F.max("total_price").alias("max_val"))
    )
    return rows.withColumnsRenamed({n: f"{n}_pts" for n in ("min_val", "max_val")})


@query(
    "pj_06",
    "SELECT c_custkey, CAST(0.7 AS DOUBLE) AS threshold, '>' AS direction FROM customer",
)
def literal_columns(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", F.lit(0.7).alias("threshold"), F.lit(">").alias("direction")
    )


@query(
    "jn_03",
    "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'"
    " INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'"
    " INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'",
)
def chained_inner_joins(spark, folder):
    orders = table(spark, folder, "orders")
    f, o, p = (
        orders.filter(F.col("o_orderstatus") == status).select("o_custkey").distinct()
        for status in "FOP"
    )
    return natural_join(natural_join(f, o), p)


@query(
    "jn_08",
    BY_REGION + """, a AS (
      SELECT site, CASE visit_concept_id WHEN '1-URGENT' THEN 'none' ELSE visit_concept_id END
        AS kind, count(*) AS visits FROM visits GROUP BY ALL),
    b AS (
      SELECT site, CASE visit_concept_id WHEN '5-LOW' THEN 'other' ELSE visit_concept_id END
        AS kind, max(total_price) AS largest FROM visits GROUP BY ALL)
    SELECT * FROM a FULL JOIN b USING (site, kind)""",
)
def full_join_of_summaries(spark, folder):
    """Two summaries of all visits; each has kinds that the other lacks."""
    rows = v.visits(spark, folder)
    kind = F.col("visit_concept_id")
    counted = rows.groupBy(
        "site", F.when(kind == "1-URGENT", "none").otherwise(kind).alias("kind")
    ).agg(F.count(F.lit(1)).alias("visits"))
    largest = rows.groupBy(
        "site", F.when(kind == "5-LOW", "other").otherwise(kind).alias("kind")
    ).agg(F.max("total_price").alias("largest"))
    return null_safe_join(counted, largest, how="full")


@query(
    "jn_09",
    "SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal, low, high FROM customer JOIN"
    " (SELECT c_nationkey, c_mktsegment, min(c_acctbal) AS low, max(c_acctbal) AS high FROM customer"
    " WHERE c_acctbal > 0 GROUP BY ALL) USING (c_nationkey, c_mktsegment)",
)
def reattach_bounds(spark, folder):
    rows = table(spark, folder, "customer").drop("c_name")
    keys = ["c_nationkey", "c_mktsegment"]
    bounds = (
        rows.filter(F.col("c_acctbal") > 0)
        .groupBy(*keys)
        .agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    )
    return rows.join(bounds, keys)


@query(
    "ag_08",
    BY_REGION + " SELECT site, fact_type, count(*) AS n, sum(count(*)) OVER (PARTITION BY site)::BIGINT"
    " AS total_rows, count(*)::DOUBLE / total_rows AS prop FROM facts GROUP BY site, fact_type",
)
def share_of_total(spark, folder):
    counts = v.facts(spark, folder).groupBy("site", "fact_type").agg(F.count(F.lit(1)).alias("n"))
    return with_result_values(counts, ["site"], {"total_rows": F.sum("n")}).withColumn(
        "prop", c.proportion("n", "total_rows")
    )


@query(
    "wn_04",
    """SELECT o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n,
      lag(count(*)) OVER w AS previous, lead(count(*)) OVER w AS following FROM orders
    GROUP BY 1, 2 WINDOW w AS (PARTITION BY o_orderstatus ORDER BY month)""",
)
def neighbouring_periods(spark, folder):
    counts = (
        table(spark, folder, "orders")
        .groupBy("o_orderstatus", c.month_start("o_orderdate").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    months = Window.partitionBy("o_orderstatus").orderBy("month")
    return counts.withColumns(
        {"previous": F.lag("n").over(months), "following": F.lead("n").over(months)}
    )


@query(
    "wn_05",
    """WITH counts AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL)
    SELECT *, max(n) OVER w AS max_val, n::DOUBLE / max(n) OVER w AS ratio FROM counts
    WINDOW w AS (PARTITION BY o_orderstatus)""",
)
def ratio_to_peers(spark, folder):
    counts = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", "o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    stated = with_group_values(counts, ["o_orderstatus"], {"max_val": F.max("n")})
    return stated.withColumn("ratio", c.proportion("n", "max_val"))


@query(
    "so_02",
    "SELECT n_nationkey, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey"
    " QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY c_acctbal, c_custkey) = 1",
)
def limit_per_group(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "c_nationkey AS n_nationkey", "c_custkey", "c_acctbal"
    )
    return first_row(rows, ["n_nationkey"], ["c_acctbal"])


@query(
    "sc_12",
    "SELECT event_id, CAST(ts AS DATE) - DATE '2024-01-01' AS days FROM events",
)
def days_from_timestamps(spark, folder):
    day = c.days_between(F.lit("2024-01-01").cast("date"), "ts").cast("bigint")
    return table(spark, folder, "events").select("event_id", day.alias("days"))


@query(
    "sc_15",
    "SELECT user_id, 1 - round(count(*) FILTER (event_type = 'click')::DOUBLE / count(*), 2) AS rest"
    " FROM events GROUP BY user_id",
)
def rounded_complement(spark, folder):
    clicks = F.count_if(F.col("event_type") == "click")
    share = F.round(c.proportion(clicks, F.count(F.lit(1))), 2)
    return table(spark, folder, "events").groupBy("user_id").agg((1 - share).alias("rest"))


@query(
    "sc_16",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders"
    " WHERE CAST(o_orderdate AS DATE) <= current_date",
)
def until_today(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    return rows.filter(F.col("day") <= F.current_date())
