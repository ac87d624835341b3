"""Code lists, geography, countries, codebook, sources and older metadata."""

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import codebook as cb
from tallyloom.operators import codelists as cl
from tallyloom.operators import countries, geography, legacy
from tallyloom.sources import publish_by_key, read_published, scan_table, scan_table_set, write_csv, write_partitioned


def test_containment(spark, rows):
    skeleton = spark.createDataFrame([(1.0, "yes", True, True, False), (2.0, "no", True, True, False), (3.0, "dkn", True, False, None)],
                                     "valuen double, value string, yndk boolean, yn boolean, odd boolean")
    assert rows(cl.contained_lists(skeleton)) == [("cl_yndk", "cl_odd"), ("cl_yndk", "cl_yn")]
    assert rows(cl.containment_maps(skeleton)) == [("cl_yndk", "no", "cl_yn", "no"), ("cl_yndk", "yes", "cl_yn", "yes")]
    labels = spark.createDataFrame([("yes", "ja"), ("no", "nee")], "value string, label_nl string")
    lists = cl.assemble_codelists(skeleton, labels)
    wide = cl.codelist_wide(lists, cl.containment_maps(skeleton), "cl_yndk")
    assert wide.columns[-1] == "cl_yn" and rows(wide, "value", "label_nl", "cl_yn") == [("dkn", None, None), ("no", "nee", "no"), ("yes", "ja", "yes")]
    with pytest.raises(cl.CodelistError, match="no value list has: 1"):
        cl.require_known_values(spark.createDataFrame([("s", "x")], "source string, value string"), labels)


def test_hierarchy_with_skipped_level_and_reset(spark, rows):
    df = spark.createDataFrame([(i, lv, n) for i, (lv, n) in enumerate([(0, "top"), (1, "A"), (2, "A1"), (1, "B"), (3, "B..1"), (0, "next"), (2, "N.1")])],
                               "pos int, level int, id string")
    for blocks in (1, 2, 3, 100):
        out = geography.hierarchy_flatten(df, "g", range(4), blocks=blocks)
        assert rows(out, "pos", "glvl0", "glvl1", "glvl2", "glvl3", "parent_id") == [
            (0, "top", None, None, None, None), (1, "top", "A", None, None, "top"), (2, "top", "A", "A1", None, "A"), (3, "top", "B", None, None, "top"),
            (4, "top", "B", None, "B..1", "B"), (5, "next", None, None, None, None), (6, "next", None, "N.1", None, "next")]


def test_crosswalk_gathers_nothing(spark, rows, plan):
    members = spark.createDataFrame([(1, "A", "X"), (2, "A", "X"), (3, "B", "Y"), (4, "C", "Y"), (5, "D", None), (6, "E", "Z"), (7, "E", None)],
                                    "id int, olvl0 string, nlvl0 string")
    out = geography.set_equality_crosswalk(members, [0], "o", "n")
    assert rows(out, "old", "new") == [("A", "X"), ("B", None), ("C", None), ("D", None), ("E", None)]
    assert "collect" not in plan(out)


def test_recodes_split_on_plus(spark, rows):
    df = spark.createDataFrame([("Aa (11001)+Bb (11002)", "Cc (11009)"), ("none", "Dd")], "old string, new string")
    assert rows(geography.merger_recodes(df, "old", "new", "o", "n")) == [("11001", "11009"), ("11002", "11009"), (None, None)]


def test_earlier_version(spark, rows):
    df = spark.createDataFrame([
        ("02000", 1, "01000", "01000", "02000", None, None), ("20001", 2, "02000", "01000", "02000", "20001", None), ("20002", 2, "03000", "01000", "03000", "20002", None),
        ("21000", 3, "04000", "01000", "04000", None, "21000"), ("23000", 3, "20001", "01000", "02000", "20001", "23000")],
        "id string, level int, parent_id string, NIS1995lvl0 string, NIS1995lvl1 string, NIS1995lvl2 string, NIS1995lvl3 string")
    df = df.withColumns({c: F.lit("label") for c in ("label_nl", "label_fr", "label_en")}).withColumn("NIS2019", F.col("id"))
    df = df.withColumn("NIS1995lvl1", F.when(F.col("level") > 2, F.col("NIS1995lvl1")))
    out = geography.derive_earlier_version(df.where("level <> 2").unionByName(df.where("level = 2").withColumn("NIS1995lvl1", F.lit(None).cast("string"))),
                                           geography.BRABANT, "NIS1983", "NIS1995", ["NIS2019"])
    got = rows(out, "id", "parent_id", "label_nl", "NIS1983lvl2", "NIS1995", "NIS2019")
    assert got == [("20000", "01000", "Provincie Brabant", "20000", None, None), ("21000", "20000", "label", "20000", "21000", "21000"),
                   ("23000", "20000", "label", "20000", "23000", "23000")]


def test_country_chain_keeps_both_sides(spark, rows):
    cat1 = spark.createDataFrame([(1.0, "EU", "notBelgium")], "valuen double, value string, cl_belgium string")
    cat2 = spark.createDataFrame([(1.0, "west", "EU"), (2.0, "moon", None)], "valuen double, value string, cl_countrycat1 string")
    iso = spark.createDataFrame([(1.0, "FR", "FRA", "west", "f"), (2.0, "XX", "XXX", None, "x")], "valuen double, value2 string, value3 string, cl_countrycat2 string, label_nl string")
    out = countries.by_code(countries.country_chain(cat1, cat2, iso), "value2", "value3", "cl_countryISO3")
    assert out.columns[-1] == "cl_countryISO3"
    assert rows(out, "value", "cl_countrycat2", "cl_countrycat1", "cl_belgium") == [("FR", "west", "EU", "notBelgium"), ("XX", None, None, None), (None, "moon", None, None)]


def test_multi_codes(spark, rows):
    df = spark.createDataFrame([(1, "FRA;DEU;FRA"), (2, "FRA;???"), (3, None), (800, None)], "valuen int, codes string")
    lookup = spark.createDataFrame([("FRA", "EU"), ("DEU", "EU")], "code string, cl_countrycat1 string")
    out = countries.multi_code_enrich(df, ["valuen"], "codes", lookup, "code", ["cl_countrycat1"])
    out = countries.defaults_above(out, "valuen", 700, {"cl_countrycat1": "notEU27"})
    assert rows(out, "valuen", "codes", "cl_countrycat1") == [(1, "FRA;DEU", "EU"), (2, "FRA;???", None), (3, None, None), (800, None, "notEU27")]


def test_codebook(spark, rows):
    variables = spark.createDataFrame([(1, "V1", "sex"), (2, "V2", "age")], "pos int, variable string, concept_id string")
    dsd = spark.createDataFrame([("sex", "codelist", "s"), ("age", "integer", None)], "concept_id string, constraint_type string, constraint_codelist string")
    questions = spark.createDataFrame([("sex", "Sex", "You are", None), ("age", "Age", "Your", "age")], "concept_id string, varlabel string, question string, question_item string")
    lists = spark.createDataFrame([("s", 1, 1.0, "m"), ("s", 2, 2.5, "f")], "codelist string, pos int, valuen double, value string")
    answers = spark.createDataFrame([("m", "Man"), ("f", "Woman")], "value string, vallabel string")
    out = cb.codebook(variables, dsd, questions, answers, lists).orderBy("pos", "code_pos").select("varname", "varlabel", "question", "valn", "valc")
    assert [tuple(r) for r in out.collect()] == [("V1", "Sex", "You are", "1", "Man"), ("", "", "", "2.50", "Woman"), ("V2", "Age", "Your age", "[integer]", None)]
    with pytest.raises(cb.CodebookError, match="without question: 1"):
        cb.codebook(variables, dsd, questions.where("concept_id = 'sex'"), answers, lists)
    with pytest.raises(cb.CodebookError, match="without answer label: 1"):
        cb.codebook(variables, dsd, questions, answers.where("value = 'm'"), lists)


def test_codebook_ranks_variables_not_codes(spark, rows):
    """What is sorted per concept is as long as the variables; hot, unknown and missing lists keep their rows."""
    variables = spark.createDataFrame([(1, "V1", "a"), (2, "V2", "a"), (3, "V3", "b"), (4, "V4", "c")], "pos int, variable string, concept_id string")
    dsd = spark.createDataFrame([("a", "codelist", "s"), ("b", "codelist", "gone"), ("c", "integer", None)], "concept_id string, constraint_type string, constraint_codelist string")
    questions = spark.createDataFrame([("a", "A", "Q", None), ("b", "B", None, None)], "concept_id string, varlabel string, question string, question_item string")
    lists = spark.createDataFrame([("s", 7, 1.0, "m"), ("s", 8, 2.0, "f"), (None, 1, 3.0, "m")], "codelist string, pos int, valuen double, value string")
    answers = spark.createDataFrame([("m", "Man"), (None, "none")], "value string, vallabel string")
    out = cb.codebook(variables, dsd, questions, answers, lists, check=False)
    assert rows(out, "pos", "varname", "varlabel", "valn", "valc") == [
        (1, "", "", "2", None), (1, "V1", "A", "1", "Man"), (2, "", "", "1", "Man"), (2, "", "", "2", None),
        (3, "V3", "B", "[codelist]", "none"), (4, "V4", None, "[integer]", "none")]
    lines = out._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at, depth = next((i, line.index("Aggregate [concept_id")) for i, line in enumerate(lines) if "Aggregate [concept_id" in line)
    ranked = [lines[at]]
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        ranked.append(line)
    assert not any("struct(pos" in line and "code_pos" in line.split("struct(pos", 1)[1] for line in ranked)


def test_legacy_skeleton(spark, rows):
    scales = spark.createDataFrame([("oldyn", "yn", 1.0, "yes"), ("oldyn", "yn", 2.0, "no"), ("missing", "dkn", 9.0, "dkn")], "old_scale string, scale string, valuen double, value string")
    variables = spark.createDataFrame([("oldyn", "x", None, None), ("oldyn", None, None, None), (None, "x", None, None)], "scale string, weetniet string, filter string, question string")
    wide = legacy.legacy_skeleton(legacy.scale_members(variables, scales), "yn")
    assert rows(wide, "value", "yn", "yn_dkn") == [("dkn", False, True), ("no", True, True), ("yes", True, True)]


def test_partition_overwrite_keeps_other_editions(spark, rows, tmp_path):
    path = str(tmp_path / "cleaned")
    make = lambda *r: spark.createDataFrame(list(r), "id int, surv_id string")
    write_partitioned(make((1, "SV1"), (2, "SV2")), path)
    write_partitioned(make((3, "SV2")), path)
    assert rows(spark.read.parquet(path), "id", "surv_id") == [(1, "SV1"), (3, "SV2")]


def test_published_tables(spark, rows, plan, tmp_path):
    path = str(tmp_path / "lists")
    both = scan_table_set({"a": spark.createDataFrame([("x", "l")], "value string, label string"), "b": spark.createDataFrame([("y",)], "value string")}, "codelist")
    publish_by_key(both, path, ["codelist"], ["value"])
    one = read_published(spark, path, codelist="b")
    assert "PartitionFilters: [isnotnull(codelist" in plan(one) and rows(one, "value") == [("y",)]
    assert read_published(spark, path, drop_empty=True, codelist="b").columns == ["value"]
    write_csv(one, str(tmp_path / "csv"))
    assert rows(scan_table(spark, str(tmp_path / "csv"), required=["value"], fmt="csv"), "value") == [("y",)]


def test_pruned_scan(spark, plan, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("wide"), F.lit(1).alias("other")).write.parquet(str(tmp_path / "t"))
    text = plan(scan_table(spark, str(tmp_path / "t"), columns=["id"]).where("id > 3"))
    assert "ReadSchema: struct<id:bigint>" in text and "GreaterThan(id,3)" in text


def test_chains_over_any_number_of_versions(spark, rows):
    """Brute force over seven versions with mergers, a division, areas that end and a version nobody registered."""
    versions = [1977, 1995, 2003, 2011, 2019, 2025, 2031]
    after = dict(zip(versions, versions[1:]))
    steps = []
    for i, v in enumerate(versions):
        for k in range(12):
            steps.append((v, f"a{k}", f"a{k - 1}" if k % (i + 2) == 1 else f"a{k}" if (k + i) % 9 else None))
    steps += [(1995, "a3", "a7"), (2010, "a1", "a2"), (1977, None, "a1"), (2003, "a5", "a5"), (2003, "a5", "a5")]
    nxt = {}
    for v, a, b in steps:
        if v in versions and a and b:
            nxt.setdefault((v, a), set()).add(b)
    want = set()
    for v in versions:
        for a in {a for w, a in nxt if w == v}:
            now, at = {a}, v
            while at in after and now:
                now = {b for x in now for b in nxt.get((at, x), ())}
                at = after[at]
                want |= {(v, a, at, b) for b in now}
    df = spark.createDataFrame(steps, "version int, id string, next_id string")
    assert rows(geography.version_chains(df, versions), "version", "id", "target", "target_id") == sorted(want, key=repr)
    assert geography.version_chains(df, versions[:1]).count() == geography.version_chains(df.where("id = 'z'"), versions).count() == 0


def test_containment_of_many_lists(spark):
    """Two thousand lists over a few rows, against sets; no pairing of all lists in the plan."""
    rng = random.Random(6)
    names = [f"l{k}" for k in range(2000)]
    table = [[rng.random() < (0.97 if k % 3 else 0.02) for k in range(2000)] for _ in range(24)]
    for row in table:
        row[7] = None if rng.random() < 0.2 else True
        row[9] = False
    schema = ", ".join(["value string", *(f"{n} boolean" for n in names)])
    got = {tuple(r) for r in cl.contained_lists(spark.createDataFrame([(f"v{i}", *row) for i, row in enumerate(table)], schema)).collect()}
    sure = [{i for i, row in enumerate(table) if row[k]} for k in range(2000)]
    need = [{i for i, row in enumerate(table) if row[k] is not False} for k in range(2000)]
    assert got == {(f"cl_l{a}", f"cl_l{b}") for b in range(2000) for a in range(2000) if a != b and need[b] <= sure[a]}
    assert cl.contained_lists(spark.createDataFrame([], "value string, a boolean, b boolean")).count() == 0
