"""Specification files, code sets and the result store."""

import pytest
from pyspark.sql import functions as F

from sitelens.sources.specs import (
    CodeSets,
    ConcordanceSpec,
    UnmappedSpec,
    VocabularySpec,
    read_code_set,
    read_specs,
)
from sitelens.sources.store import Store
from sitelens.sources.tables import Tables, add_site, frames


def test_specs_with_byte_order_mark_quotes_and_missing_columns(spark, tmp_path):
    path = tmp_path / "vc.csv"
    path.write_text(
        "﻿check_id,check_description,schema,table,acceptable_vocabularies,concept_field,filter_logic\n"
        'x,"Drugs, all",cdm,drug_exposure,"RxNorm, NDC",drug_concept_id,\n'
        "y,Plain,cdm,drug_exposure,NDC,drug_concept_id,a = 1 AND b IS NOT NULL\n",
        encoding="utf-8",
    )
    first, second = read_specs(spark, str(path), VocabularySpec)
    assert first.check_id == "x" and first.check_description == "Drugs, all"
    assert first.acceptable_vocabularies == "RxNorm, NDC" and first.filter_logic is None
    assert second.filter_logic == "a = 1 AND b IS NOT NULL"


def test_numbers_and_disabled_rows(spark, tmp_path):
    path = tmp_path / "dcon.csv"
    path.write_text(
        "cohort_id,check_id,table,date_field,time_between_events,enabled\n"
        "a,p,t,d,730.5,\nb,p,t,d,,TRUE\nc,q,t,d,1,false\n"
    )
    specs = read_specs(spark, str(path), ConcordanceSpec)
    assert [(s.cohort_id, s.time_between_events) for s in specs] == [("a", 730.5), ("b", None)]


def test_a_missing_column_is_named(spark, tmp_path):
    path = tmp_path / "uc.csv"
    path.write_text("check_id,table\nx,t\n")
    with pytest.raises(ValueError, match="concept_field"):
        read_specs(spark, str(path), UnmappedSpec)


def test_code_set_column_order_and_extra_columns(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("concept_name,domain_id,concept_id\nx,Drug,2000000048\n")
    codes = read_code_set(spark, str(path))
    assert codes.dtypes == [("concept_id", "bigint"), ("concept_name", "string")]
    assert codes.collect()[0].concept_id == 2000000048
    sets = CodeSets(spark, str(tmp_path))
    assert sets.get("codes").count() == 1
    with pytest.raises(KeyError, match="absent"):
        sets.get("absent").count()


def test_store_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "results"))
    assert not store.exists("t")
    first = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "site string, n int")
    store.append(first, "t")
    again = store.append(spark.createDataFrame([(2, "b"), (3, "c")], "n int, site string"), "t")
    assert sorted(map(tuple, again.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert store.append(again, "t").count() == 3
    replaced = store.write(again.filter("n > 2"), "t", csv=str(tmp_path / "text"))
    assert [tuple(r) for r in replaced.collect()] == [("c", 3)]
    text = spark.read.option("header", True).csv(str(tmp_path / "text" / "t"))
    assert [tuple(r) for r in text.collect()] == [("c", "3")]


def test_an_unfinished_version_is_ignored(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write(spark.range(3), "t")
    (tmp_path / "t" / "v000002").mkdir()
    assert store.read("t").count() == 3
    assert store.write(spark.range(5), "t").count() == 5


def test_one_site_and_unknown_tables(spark):
    df = add_site(spark.range(2), "a").unionByName(add_site(spark.range(3), "b"))
    tables = Tables({"cdm": frames({"t": df, "plain": spark.range(4)})}, site="b")
    assert tables.cdm("t").count() == 3 and tables.cdm("plain").count() == 4
    with pytest.raises(KeyError, match="absent"):
        tables.cdm("absent")
    with pytest.raises(KeyError, match="result"):
        tables.result("t")
    more = tables.adding("result", {"extra": spark.range(1).withColumn("site", F.lit("b"))})
    assert more.result("extra").count() == 1 and more.cdm("t").count() == 3


def deliveries(spark, version, rows):
    return spark.createDataFrame([(version, *r) for r in rows], "database_version string, site string, n int")


def bytes_below(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_an_append_writes_only_what_is_new(spark, tmp_path):
    """However many versions are stored, a delivery adds about as many bytes."""
    store = Store(spark, str(tmp_path))
    table = tmp_path / "t"
    added = []
    for k in range(5):
        rows = [(f"site{k}", i) for i in range(2000)]
        before = bytes_below(table) if k else 0
        store.append(deliveries(spark, f"v{k}", rows), "t")
        added.append(bytes_below(table) - before)
    assert max(added) < 1.2 * min(added)
    assert store.read("t").count() == 10_000
    # A delivery that is repeated, in part with new rows, adds the new rows alone.
    before = bytes_below(table)
    store.append(deliveries(spark, "v4", [("site4", i) for i in range(1990, 2010)]), "t")
    assert bytes_below(table) - before < max(added) / 2
    assert store.read("t").count() == 10_010
    segments = sorted(p.name for p in table.iterdir() if p.is_dir())
    store.append(deliveries(spark, "v2", [("site2", i) for i in range(2000)]), "t")
    assert sorted(p.name for p in table.iterdir() if p.is_dir()) == segments
    assert store.read("t").count() == 10_010


def test_append_reads_only_the_deliveries_it_touches(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(3):
        store.append(deliveries(spark, f"v{k}", [("a", k), ("a", k), ("b", None)]), "t")
    (oldest,) = tmp_path.glob("t/__segment=000001")
    for file in oldest.glob("*.parquet"):
        file.write_bytes(b"broken")
    more = deliveries(spark, "v2", [("a", 2), ("c", 9), ("b", None)])
    store.append(more, "t")
    newest = store.read("t").filter("database_version = 'v2'")
    assert max(p.name for p in tmp_path.glob("t/__segment=*")) == "__segment=000005"
    with pytest.raises(Exception, match="(?i)parquet"):
        newest.collect()


def test_append_keeps_nulls_and_partitions_apart(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = deliveries(spark, None, [("a", None), (None, 1)])
    for _ in range(2):
        store.append(rows, "t", partition_by=["site"])
    store.append(deliveries(spark, "v1", [("01", 1)]), "t", partition_by=["site"])
    found = sorted(map(str, (tuple(r) for r in store.read("t").collect())))
    assert found == ["('v1', '01', 1)", "(None, 'a', None)", "(None, None, 1)"]
    # Another partitioning, or a wider type, writes the table anew.
    wide_ = spark.createDataFrame([("v1", "01", 1), ("v1", "02", 1 << 40)], "database_version string, site string, n long")
    assert store.append(wide_, "t").count() == 4
    assert dict(store.read("t").dtypes)["n"] == "bigint"
    with pytest.raises(Exception, match="(?i)column"):
        store.append(rows.withColumnRenamed("n", "m"), "t")


def test_tables_of_many_segments_are_compacted_and_pruned(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for k in range(3):
        store.append(deliveries(spark, f"v{k}", [("a", k)]), "t")
    old = store.read("t")
    assert store.compact("t").count() == 3
    assert sorted(map(tuple, old.collect())) == sorted(map(tuple, store.read("t").collect()))
    store.prune("t")
    assert len(list(tmp_path.glob("t/__segment=*"))) == 1 and store.read("t").count() == 3
    assert store.append(deliveries(spark, "v1", [("a", 1), ("b", 1)]), "t").count() == 4
    empty = deliveries(spark, "v1", []).filter("n > 5")
    assert store.append(empty, "t").count() == 4 and store.append(empty, "u").count() == 0
    assert store.append(deliveries(spark, "v1", [("a", 1)]), "u").count() == 1


def test_of_two_writers_one_fails(spark, tmp_path):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one.append(deliveries(spark, "v0", [("a", 1)]), "t")
    before = two._newest("t")
    one.append(deliveries(spark, "v1", [("a", 1)]), "t")
    with pytest.raises(RuntimeError, match="another writer"):
        two._commit("t", before, before)
    assert two.read("t").count() == 2
