"""Sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.metadata import version_as_of
from ..plans import population
from ..sources import versions
from ..sources.tables import (publish_by_key, read_published, scan_table, scan_table_set, write_csv,
                              write_partitioned)
from .inputs import oracle
from .registry import query


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def scan(x):
    return scan_table(x.spark, f"{x.sf_dir}/customer.parquet", required=["c_custkey", "c_name"]).select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query("scan_pruned", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49")
def pruned(x):
    return scan_table(x.spark, f"{x.sf_dir}/lineitem.parquet",
                      columns=["l_orderkey", "l_linenumber", "l_quantity"]).where("l_quantity >= 49")


@query("scan_table_set", """
SELECT 'nation' AS source, CAST(n_nationkey AS BIGINT) AS key, n_name AS name, CAST(NULL AS VARCHAR) AS segment FROM nation
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL FROM supplier
UNION ALL SELECT 'customer', c_custkey, c_name, c_mktsegment FROM customer""")
def table_set(x):
    return scan_table_set({
        "nation": x.table("nation").select(F.col("n_nationkey").cast("bigint").alias("key"), F.col("n_name").alias("name")),
        "supplier": x.table("supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
        "customer": x.table("customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                               F.col("c_mktsegment").alias("segment")),
    })


@query("write_partitioned", oracle("""
SELECT resp_mode, resp_fwdisp, COUNT(*) AS n, MIN(row_id) AS first_row, CAST(SUM(row_id) AS BIGINT) AS total FROM responses
GROUP BY resp_mode, resp_fwdisp"""))
def partitioned(x):
    path = x.folder()
    write_partitioned(x.view("responses"), path, ["resp_mode"])
    return x.spark.read.parquet(path).groupBy("resp_mode", "resp_fwdisp").agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_row"), F.sum("row_id").alias("total"))


@query("publish_by_key", """
SELECT 'segment' AS codelist, c_mktsegment AS value, COUNT(*) AS n FROM customer GROUP BY c_mktsegment
UNION ALL SELECT 'brand', p_brand, COUNT(*) FROM part GROUP BY p_brand
UNION ALL SELECT 'priority', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority""")
def published(x):
    counted = lambda t, c: x.table(t).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n"))
    lists = scan_table_set({"segment": counted("customer", "c_mktsegment"), "brand": counted("part", "p_brand"),
                            "priority": counted("orders", "o_orderpriority")}, "codelist")
    path = x.folder()
    publish_by_key(lists, path, ["codelist"], ["value"])
    return read_published(x.spark, path)


@query("version_as_of", """
WITH r AS (SELECT DISTINCT CAST(YEAR(l_shipdate) AS INT) AS year FROM lineitem),
v AS (SELECT DISTINCT CAST(YEAR(o_orderdate) AS INT) AS version FROM orders WHERE YEAR(o_orderdate) % 3 = 0)
SELECT year, (SELECT MAX(version) FROM v WHERE version <= year) AS version FROM r""")
def as_of(x):
    requests = x.table("lineitem").select(F.year("l_shipdate").alias("year")).distinct()
    versions = x.table("orders").select(F.year("o_orderdate").alias("version")).where("version % 3 = 0").distinct()
    return version_as_of(requests, versions, "year", "version")


@query("write_csv", """
SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_acctbal > 0""")
def csv(x):
    path = x.folder()
    write_csv(x.table("supplier").where("s_acctbal > 0").select("s_suppkey", "s_name", "s_nationkey"), path)
    return scan_table(x.spark, path, fmt="csv", schema="s_suppkey bigint, s_name string, s_nationkey int")


_YEARS = oracle("""
WITH y AS (SELECT DISTINCT CAST(year AS INT) AS year FROM (VALUES (2021), (2022), (2023), (2024), (2025)) AS t(year)),
va AS (SELECT 2019 AS version, n_nationkey AS value, r_name AS target_value FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20
       UNION ALL SELECT 2024, n_nationkey, CASE WHEN n_nationkey = 3 THEN 'moved' ELSE r_name END FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 22),
p AS (SELECT y.year, CASE CD_SEX WHEN 1 THEN 'male' WHEN 2 THEN 'female' END AS sex,
        CASE WHEN MS_AGE < 25 THEN 'a18_24' WHEN MS_AGE < 35 THEN 'a25_34' WHEN MS_AGE < 45 THEN 'a35_44' WHEN MS_AGE < 55 THEN 'a45_54'
             WHEN MS_AGE < 65 THEN 'a55_64' WHEN MS_AGE < 75 THEN 'a65_74' ELSE 'a75plus' END AS agecat7,
        nt.target_value AS natltygrp, va.target_value AS province
      FROM register JOIN y ON (c_custkey + y.year) % 7 <> 0
      JOIN va ON va.version = CASE WHEN y.year < 2024 THEN 2019 ELSE 2024 END AND va.value = CD_REFNIS
      LEFT JOIN nationalities nt ON nt.value = CD_NATLTY WHERE MS_AGE >= 18),
m AS (SELECT year, 'sex' AS covariate, sex AS category FROM p UNION ALL SELECT year, 'agecat7', agecat7 FROM p
      UNION ALL SELECT year, 'natltygrp', natltygrp FROM p UNION ALL SELECT year, 'province', province FROM p)
SELECT year, covariate, category, COUNT(*) AS n, ROUND(COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY year, covariate) AS DOUBLE), 6) AS p
FROM m WHERE category IS NOT NULL GROUP BY year, covariate, category""")


def _years(x):
    register = x.view("register")
    registers = {y: register.where((F.col("c_custkey") + y) % 7 != 0) for y in range(2021, 2026)}
    areas = x.sql("""SELECT 2019 AS version, n_nationkey AS value, r_name AS target_value FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20
       UNION ALL SELECT 2024, n_nationkey, CASE WHEN n_nationkey = 3 THEN 'moved' ELSE r_name END FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 22""")
    return registers, areas, x.view("nationalities")


@query("margins_all_years", _YEARS)
def every_year(x):
    return population.margins_all_years(*_years(x)).withColumn("p", F.round("p", 6))


@query("margins_added_year", _YEARS)
def added_year(x):
    """Four years stored as cells; the fifth is scanned alone and one of the four delivered again."""
    registers, areas, nationalities = _years(x)
    path = x.folder()
    wrong = {2022: registers[2022].where("c_custkey % 2 = 0")}
    population.store_years({y: df for y, df in {**registers, **wrong}.items() if y != 2025}, areas, nationalities, path)
    population.store_years({y: registers[y] for y in (2022, 2025)}, areas, nationalities, path)
    return population.stored_margins(x.spark, path).withColumn("p", F.round("p", 6))


@query("published_digit_keys", """
SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 3""")
def digit_keys(x):
    """Area codes are digits with leading zeros; a key must come back as it was written."""
    path = x.folder()
    areas = x.table("customer").select(F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("area"), "c_custkey", "c_name")
    publish_by_key(areas, path, ["area"])
    return read_published(x.spark, path, area="00003")


@query("published_pairs_of_keys", """
SELECT CONCAT('0', CAST(c_nationkey AS VARCHAR)) AS area, COUNT(*) AS n FROM customer GROUP BY c_nationkey""")
def pairs_of_keys(x):
    """Published by version and area, one asked for by version: the other, of digits, stays the text that it was."""
    path = x.folder()
    areas = x.table("customer").select(F.lit("2019").alias("version"), F.concat(F.lit("0"), F.col("c_nationkey").cast("string")).alias("area"), "c_custkey")
    publish_by_key(areas, path, ["version", "area"])
    return read_published(x.spark, path, version="2019").groupBy("area").agg(F.count("*").alias("n"))


@query("published_versions", """
SELECT 1 AS version, LPAD(CAST(c_nationkey AS VARCHAR), 5, '0') AS area, c_mktsegment AS segment, COUNT(*) AS n, CAST(SUM(c_custkey) AS BIGINT) AS keys
FROM customer WHERE c_custkey % 2 = 0 GROUP BY ALL
UNION ALL SELECT 2, LPAD(CAST(c_nationkey AS VARCHAR), 5, '0'), c_mktsegment, COUNT(*), CAST(SUM(c_custkey) AS BIGINT) FROM customer GROUP BY ALL""")
def published_versions(x):
    """Two versions published and a third whose writer stops before its commit: the first and the newest complete one."""
    path, people = x.folder(), x.table("customer").select(
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("area"), F.col("c_mktsegment").alias("segment"), "c_custkey")
    versions.publish_version(people.where("c_custkey % 2 = 0"), path, ["area"])
    versions.publish_version(people, path, ["area"])
    versions.write_data(people.where("c_custkey % 3 = 0"), path, ["area"])
    count = lambda df, v: df.groupBy(F.lit(v).alias("version"), "area", "segment").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("keys"))
    return count(versions.read_version(x.spark, path, 1), 1).unionByName(count(versions.read_version(x.spark, path), 2))
