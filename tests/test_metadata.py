"""Registries, DSD lint and validation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import metadata as m
from tallyloom.operators import validation as v
from tallyloom.operators.dsd import DsdError, dsd_lint, publish_dsd
from tallyloom.sources import SchemaError, require_columns, scan_table

DSD = "concept_id string, label_nl string, constraint_type string, constraint_codelist string, constraint_regex string, " \
      "constraint_min double, constraint_max double, constraint_allow_missings boolean"


def _concept(cid, kind="character", codelist=None, regex=None, lo=None, hi=None, missing=True):
    return (cid, cid, kind, codelist, regex, lo, hi, missing)


def test_asof_keeps_ties_and_ignores_later_versions(spark, rows):
    df = spark.createDataFrame([("a", "SV0001", "old"), ("a", "SV0003", "new"), ("a", "SV0003", "newer"), ("a", "SV0009", "later"), ("b", "SV0009", "x")],
                               "concept_id string, from_surv_id string, varlabel string")
    assert rows(m.asof_questions(df, "SV0004")) == [("a", "new"), ("a", "newer")]


def test_exactly_one(spark, rows):
    df = spark.createDataFrame([("A", 1), ("B", 1), ("B", 2)], "surv_id string, n int")
    assert rows(m.exactly_one(df, "surv_id", "A")) == [("A", 1)]
    for wrong in ("B", "C"):
        with pytest.raises(m.MetadataError, match=wrong):
            m.exactly_one(df, "surv_id", wrong)


def test_mailings(spark, rows):
    day = dt.date(2024, 1, 1)
    good = [("P1", c, day + dt.timedelta(i)) for i, c in enumerate(m.CONTACTS)]
    df = spark.createDataFrame([*good, ("P1", "thanks", day), ("P2", "invitation", day), ("P2", "invitation", day)], "fw_period string, contact string, date date")
    assert rows(m.read_mailings(df, "P1"), "fw_period", "reminder_2") == [("P1", dt.date(2024, 1, 3))]
    with pytest.raises(m.MetadataError, match="without exactly one mailing: 3"):
        m.read_mailings(df, "P2")
    with pytest.raises(m.MetadataError, match="no mailing at all"):
        m.read_mailings(df, "P3")


def test_versions(spark, rows):
    versions = spark.createDataFrame([(1995,), (2019,), (2025,)], "version int")
    assert rows(m.version_intervals(versions, "version")) == [(1995, 2018), (2019, 2024), (2025, None)]
    years = spark.createDataFrame([(1990,), (2018,), (2019,), (2030,)], "year int")
    assert rows(m.version_as_of(years, versions, "year", "version")) == [(1990, None), (2018, 1995), (2019, 2019), (2030, 2025)]


def test_required_columns_and_missing_tables(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(SchemaError, match="a, b"):
        require_columns(df, ["id", "a", "b"])
    with pytest.raises(SchemaError, match="no readable table"):
        scan_table(spark, str(tmp_path / "nothing"))
    with pytest.raises(m.MetadataError, match="n_missing|id"):
        m.require_no_nulls(spark.createDataFrame([(None,)], "id int"), ["id"])


def test_load_dsd(spark, rows):
    dsd = spark.createDataFrame([_concept("a"), _concept("b")], DSD)
    wanted = lambda *c: spark.createDataFrame([(x,) for x in c], "concept_id string")
    assert rows(m.load_dsd(dsd, wanted("b")), "concept_id") == [("b",)]
    with pytest.raises(m.MetadataError, match="without a DSD row: 2"):
        m.load_dsd(dsd, wanted("y", "a", "x"))


def test_nested_codelists(spark):
    dsd = spark.createDataFrame([_concept("a", "codelist", "l"), _concept("b")], DSD)
    lists = spark.createDataFrame([("l", 2, 2.0, "no"), ("l", 1, 1.0, "yes")], "codelist string, pos int, valuen double, value string")
    got = {r["concept_id"]: [c["value"] for c in r["constraint_codelist_ds"]] for r in m.dsd_with_codelists(dsd, lists).collect()}
    assert got == {"a": ["yes", "no"], "b": []}


BAD = {
    "type": _concept("c1", "text"), "codelist_on_other_type": _concept("c2", "date", codelist="l"), "codelist_missing": _concept("c3", "codelist"),
    "codelist_unknown": _concept("c4", "codelist", codelist="nope"), "regex_on_other_type": _concept("c5", "integer", regex="x"),
    "regex_invalid": _concept("c6", regex="(["), "min_on_other_type": _concept("c7", "date", lo=1.0), "max_on_other_type": _concept("c8", "character", hi=1.0),
    "min_above_max": _concept("c9", "integer", lo=2.0, hi=1.0),
}


def test_every_lint_rule(spark, rows, tmp_path):
    lists = spark.createDataFrame([("l",)], "codelist string")
    good = [_concept("ok1", "codelist", codelist="l"), _concept("ok2", regex="^a+$"), _concept("ok3", "numeric", lo=1.0, hi=1.0)]
    assert dsd_lint(spark.createDataFrame(good, DSD), lists).count() == 0
    found = rows(dsd_lint(spark.createDataFrame([*good, *BAD.values(), good[0]], DSD), lists), "rule", "concept_id")
    assert found == sorted([(rule, row[0]) for rule, row in BAD.items()] + [("duplicate", "ok1")])
    odd = spark.createDataFrame(good, DSD).withColumns({"constraint_min": F.lit("1"), "constraint_allow_missings": F.lit("yes")})
    assert {r for r, in rows(dsd_lint(odd, lists), "rule")} >= {"min_not_numeric", "allow_missings_not_logical"}
    with pytest.raises(DsdError, match="broken rules of the DSD: 1"):
        publish_dsd(spark.createDataFrame([BAD["regex_invalid"]], DSD), lists, str(tmp_path / "dsd"))
    publish_dsd(spark.createDataFrame(good, DSD), lists, str(tmp_path / "dsd"))
    assert spark.read.parquet(str(tmp_path / "dsd")).count() == 3


LISTS = "codelist string, pos int, valuen double, value string"


def _data(spark):
    dsd = spark.createDataFrame([
        _concept("code", "codelist", codelist="yn", missing=False), _concept("num", "codelist", codelist="yn"), _concept("name", regex="^[a-z]+$"),
        _concept("day", "date"), _concept("at", "datetime"), _concept("n", "integer", lo=0.0, hi=10.0), _concept("x", "numeric")], DSD)
    lists = spark.createDataFrame([("yn", 1, 1.0, "yes"), ("yn", 2, 2.0, "no")], LISTS)
    schema = "name string, code string, num int, day string, at string, n bigint, x int"
    return dsd, lists, schema


def test_valid_data_is_conformed(spark):
    dsd, lists, schema = _data(spark)
    df = spark.createDataFrame([("abc", "yes", 2, "2024-02-29", "2024-01-01T10:00:00", 3, 4), (None, "no", None, None, None, None, None)], schema)
    out = v.validate(df, dsd.withColumn("pos", F.monotonically_increasing_id()), lists)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "string", "string", "date", "timestamp", "int", "double"]
    assert out.columns == ["code", "num", "name", "day", "at", "n", "x"]
    first = out.where("code = 'yes'").first()
    assert first["num"] == "no" and first["day"] == dt.date(2024, 2, 29) and first["x"] == 4.0


def test_all_violations_are_reported_together(spark, rows):
    dsd, lists, schema = _data(spark)
    df = spark.createDataFrame([("ABC", None, 7, "2024-13-01", "noon", 11, 1), ("abc", "maybe", 1, "2024-01-01", "2024-01-01 10:00:00", -1, 1), ("DEF", "maybe", 1, None, None, 3, 1)],
                               schema).withColumn("extra", F.lit(1))
    with pytest.raises(v.ValidationError) as caught:
        v.validate(df, dsd.union(spark.createDataFrame([_concept("gone")], DSD)), lists)
    text = str(caught.value)
    for part in ("extra: column without concept", "gone: concept without column", "code: missing (1 values, 1", "code: codelist (1 values, 2", "num: codelist (1",
                 "name: regex (2 values", "day: date_format", "at: datetime_format", "n: min (1", "n: max (1"):
        assert part in text, part
    whole = {(r["concept_id"], r["rule"], r["value"]) for r in caught.value.offenders.collect()}
    assert {("code", "codelist", "maybe"), ("num", "codelist", "7.0"), ("name", "regex", "ABC"), ("name", "regex", "DEF")} <= whole
    with pytest.raises(v.ValidationError, match="n: class"):
        v.validate(df.drop("extra").withColumn("n", F.lit("text")), dsd, lists)


def test_cell_checks_are_one_scan(spark, plan, tmp_path):
    dsd, lists, schema = _data(spark)
    spark.createDataFrame([("a", "yes", 1, "2024-01-01", None, 1, 1)], schema).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert plan(v.check_cells(df, v.concepts_for(dsd, df.columns))).count("FileScan") == 1


def test_empty_and_all_missing_data(spark):
    dsd, lists, schema = _data(spark)
    empty = spark.createDataFrame([], schema)
    assert v.violations(empty, v.concepts_for(dsd, empty.columns), lists).count() == 0
    nothing = spark.createDataFrame([(None,) * 7], schema)
    assert [(r["concept_id"], r["rule"]) for r in v.violations(nothing, v.concepts_for(dsd, nothing.columns), lists).collect()] == [("code", "missing")]


def test_labels(spark, rows):
    labels = spark.createDataFrame([("v1", "right"), ("v2", "wrong"), ("v3", "wrong"), ("v4", None), ("v5", "unlisted")], "variable string, value string")
    registry = spark.createDataFrame([(f"v{i}", "right") for i in range(1, 5)], "variable string, varlabel string")
    fix = spark.createDataFrame([("v3", "right")], "variable string, value string")
    assert rows(v.label_mismatch(labels, registry, fix), "variable") == [("v2",)]
    with pytest.raises(v.ValidationError, match="more than once: 1"):
        v.label_mismatch(labels, registry, fix.union(fix))


def test_response_checks_ignore_unknown_mode(spark, rows):
    df = spark.createDataFrame([("x", None, None, None), ("x", "online", None, "d"), (None, "paper", None, "d")], "resp_fwdisp string, resp_mode string, resp_qrurl string, resp_date string")
    assert rows(v.response_checks(df)) == [("disposition missing", 1), ("not online but with date", 1), ("online without qr/url", 1)]
    with pytest.raises(v.ValidationError):
        v.require_consistent(df)


def test_five_thousand_offenders_are_all_there(spark):
    dsd = spark.createDataFrame([_concept("name", regex="^a$")], DSD)
    df = spark.range(5000).select(F.concat(F.lit("b"), "id").alias("name"))
    lists = spark.createDataFrame([], "codelist string, value string, valuen double")
    with pytest.raises(v.ValidationError, match="5000 values") as caught:
        v.validate(df, dsd, lists)
    assert caught.value.offenders.where("rule = 'regex'").select("value").distinct().count() == 5000


def test_patterns_are_judged_by_the_engine_that_runs_them(spark, rows):
    lists = spark.createDataFrame([("l",)], "codelist string")
    dsd = spark.createDataFrame([_concept("java", regex=r"^\p{L}+$"), _concept("python", regex=r"^(?P<y>\d+)$")], DSD)
    assert rows(dsd_lint(dsd, lists), "rule", "concept_id") == [("regex_invalid", "python")]


def test_ambiguous_codes_are_errors(spark, rows):
    lists = spark.createDataFrame([("l", "a", 1.0), ("l", "b", 1.0)], "codelist string, value string, valuen double")
    concept = v.Concept("c", "codelist", "l")
    df = spark.createDataFrame([(1,), (2,), (None,)], "c int")
    with pytest.raises(v.ValidationError, match="more than one code value: 1"):
        v.conform(df, [concept], lists)
    assert rows(v.conform(df, [concept], lists.where("value = 'a'"))) == [("a",), (None,), (None,)]
    shown = spark.createDataFrame([("l", "a", "same"), ("l", "b", "same")], "codelist string, value string, display string")
    with pytest.raises(v.ValidationError, match="more than one code: 1"):
        v.relabel_codes(spark.createDataFrame([("same",)], "c string"), {"c": "l"}, shown)
    twice = spark.createDataFrame([_concept("c"), _concept("c")], DSD)
    with pytest.raises(v.ValidationError, match="more than one DSD row"):
        v.concepts_for(twice, ["c"])


def test_two_dates_of_a_contact_are_an_error(spark):
    log = spark.createDataFrame([("P", "invitation", dt.date(2024, 1, 1)), ("P", "invitation", dt.date(2024, 1, 2))], "fw_period string, contact string, date date")
    with pytest.raises(Exception, match="several dates"):
        m.mailings_wide(log).collect()
