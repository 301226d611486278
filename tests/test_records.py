"""Rejects, drift and quality on small tables."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import drift, quality, rejects
from ledgerloom.plans import training_core

FILES = "file_id int, feed string, delivered_at timestamp, delimiter string, header_line string"
LINES = "line_id bigint, file_id int, line_no int, raw_line string"


def files(spark, *heads, delimiter=","):
    from datetime import datetime

    rows = [(i, "f", datetime(2025, 1, 1 + i), delimiter, h) for i, h in enumerate(heads)]
    return spark.createDataFrame(rows, FILES)


def lines(spark, *records):
    return spark.createDataFrame([(n, f, n, r) for n, (f, r) in enumerate(records)], LINES)


def reasons(spark, header, records, delimiter=","):
    j = rejects.judge_records(lines(spark, *[(0, r) for r in records]), files(spark, header, delimiter=delimiter))
    got = {r["line_id"]: r["reason"] for r in rejects.rejected(j).collect()}
    return [got.get(n) for n in range(len(records))]


def test_reasons(spark):
    cases = [
        ('a,b.com,x@y.z', None),
        ('"a ""q"", b",b.com,', None),
        ('"a\nb",b.com,', None),
        ('"a" b,b.com,', "quoting"),
        ('a,"b.com,', "quoting"),
        ('a,b.com', "column_count"),
        ('', "column_count"),
        (None, "column_count"),
        ('a,b,c,d', "column_count"),
        ('a,no site,', "invalid_value"),
        ('a,,x y@z', "invalid_value"),
        ('a, N/A ,-', None),
        ('a, b.com ,', None),
        (',b"c,', "invalid_value"),
        (',b.com,', None),
    ]
    assert reasons(spark, '﻿"name",web_address,"Contact E-Mail"', [c for c, _ in cases]) == [r for _, r in cases]


@pytest.mark.parametrize("delimiter", [";", "|", "\t", "^", "\\"])
def test_delimiters(spark, delimiter):
    d = delimiter
    assert reasons(spark, f"name{d}website", [f'"a{d}b"{d}c.com', f"a{d}b{d}c"], d) == [None, "column_count"]


def test_long_records(spark):
    quotes = '"' + 'x""' * 200_000 + '"'
    wide = ",".join(["v"] * 50_000)
    assert reasons(spark, "name,about", [f"{quotes},b", wide]) == [None, "column_count"]


def test_unknown_file_and_empty_tables(spark):
    j = rejects.judge_records(lines(spark, (7, "a")), files(spark, "name"))
    assert [r["reason"] for r in rejects.rejected(j).collect()] == ["no_header"]
    none = spark.createDataFrame([], LINES)
    assert rejects.rejected(rejects.judge_records(none, files(spark, "name"))).count() == 0
    assert rejects.loaded(rejects.judge_records(none, files(spark, "name"))).count() == 0


def test_every_row_is_loaded_or_rejected(spark, sf):
    batches = [spark.read.parquet(f"{sf}/{t}.parquet") for t in ("batch_01_standard", "batch_02_messy")]
    j = rejects.judge_batches(batches, spark.read.parquet(f"{sf}/batch_files.parquet"))
    total = sum(b.count() for b in batches)
    assert rejects.rejected(j).count() + rejects.loaded(j).count() == total


def test_no_value_is_lost(spark):
    heads = files(spark, "name,website,founded,headcount,url,x1,x1,e-mail", "is_active,name")
    j = rejects.judge_records(lines(spark, (0, "a,b.com,1990,12,c.com,p,q,m@b.com"), (0, ",,n/a,,c.com,,,"), (1, "yes,b")), heads)
    got = {r["line_id"]: r for r in rejects.loaded(j).collect()}
    extra = {k: [tuple(e) for e in r["extra"]] for k, r in got.items()}
    assert (got[0]["name"], got[0]["website"], got[0]["email"]) == ("a", "b.com", "m@b.com")
    assert extra[0] == [("founded", "1990"), ("headcount", "12"), ("url", "c.com"), ("x1", "p"), ("x1", "q")]
    assert got[1]["website"] is None and extra[1] == [("founded", None), ("headcount", None), ("url", "c.com"), ("x1", None), ("x1", None)]
    assert got[2]["name"] == "b" and extra[2] == [("is_active", "yes")]


def test_loaded_holds_every_value_of_the_valid_records(spark, sf):
    batches = [spark.read.parquet(f"{sf}/{t}.parquet") for t in ("batch_01_standard", "batch_02_messy")]
    j = rejects.judge_batches(batches, spark.read.parquet(f"{sf}/batch_files.parquet"))
    present = lambda c: F.size(F.filter(c, lambda v: v.isNotNull()))
    whole = j.filter("size(errors) = 0").select(F.sum(present(F.transform("fields", rejects.clean_str)))).first()[0]
    kept = F.concat(F.array(*rejects.LOADED_FIELDS), F.transform("extra", lambda e: e["value"]))
    assert rejects.loaded(j).select(F.sum(present(kept))).first()[0] == whole


def change_set(spark, heads, records):
    c = drift.changes(lines(spark, *records).drop("line_no"), files(spark, *heads))
    return {tuple(r) for r in c.select("file_id", "change_kind", "old_field", "new_field").collect()}


def test_changes(spark):
    heads = ["name,website,founded,x1", "name,domain,founded,x1", "domain,name,founded,x1,email", "name,domain,founded,x2,email", "name,domain"]
    records = [
        (0, "a,b.com,1990,p q"), (0, "a,b.com,,p q"),
        (1, "a,b.com,1990-01-02,p q"),
        (2, "b.com,a,1990-01-02,p q,"),
        (3, "a,b.com,,p q,n/a"),
        (4, "a,b.com"), (4, '"broken'),
    ]
    assert change_set(spark, heads, records) == {
        (1, "renamed", "website", "domain"),
        (1, "type_changed", "founded", "founded"),
        (2, "added", "", "email"),
        (3, "renamed", "x1", "x2"),
        (4, "removed", "founded", ""),
        (4, "removed", "x2", ""),
        (4, "removed", "email", ""),
    }


def test_no_files(spark):
    none = spark.createDataFrame([], FILES)
    assert drift.changes(lines(spark, (0, "a")).drop("line_no"), none).count() == 0


@pytest.mark.parametrize(
    "value,tag",
    [("1", "integer"), ("-2", "integer"), ("1.5", "decimal"), ("true", "boolean"), ("FALSE", "boolean"), ("2020-02-30", "text"), ("2020-02-28", "date"), ("x", "text"), ("1,5", "text")],
)
def test_tags(spark, value, tag):
    assert spark.range(1).select(drift.type_tag(F.lit(value))).first()[0] == tag


def test_one_table_has_typed_branches(spark):
    t = drift.one_table(lines(spark, (0, "a,1"), (1, "a,1.5"), (1, ",")).drop("line_no"), files(spark, "name,turnover", "name,revenue", "zip"))
    assert t.columns == ["line_id", "file_id", "name", "turnover", "turnover__integer", "turnover__decimal", "zip"]
    got = {tuple(r) for r in t.drop("line_id").collect()}
    assert got == {(0, "a", "1", 1, 1.0, None), (1, "a", "1.5", None, 1.5, None), (1, None, None, None, None, None)}


QUALITY = "load_no int, ceo string, industry string, phone string, note string"


def test_shifts_and_profile(spark):
    rows = [(0, "Jane Smith", "Retail", "1234567", None)] * 4 + [(1, None, "Retail 1", "12", "x")] * 3 + [(1, "Jo Doe", None, "12", "")]
    df = spark.createDataFrame(rows, QUALITY)
    states = quality.value_states(df, "load_no", ["ceo", "industry", "phone"])
    got = {tuple(r) for r in quality.shifts(states, "load_no").collect()}
    assert got == {(1, "ceo", "missing"), (1, "industry", "missing"), (1, "industry", "pattern"), (1, "phone", "pattern")}
    p = {r["column_name"]: r for r in quality.profile(quality.merge_states(quality.column_states(df, "load_no", df.columns[1:]), ["column_name"])).collect()}
    assert p["ceo"]["missing_share"] == pytest.approx(3 / 8) and p["ceo"]["distinct"] == 2
    assert p["note"]["present"] == 3 and p["phone"]["wrong"] == 4


def test_profile_has_all_columns_by_load_and_in_total(spark, sf):
    df = spark.read.parquet(f"{sf}/enriched_companies.parquet")
    got = {(r["scope"], r["load_no"], r["column_name"]): r for r in training_core.p4_profile(spark, sf).collect()}
    loads = [r[0] for r in df.select("load_no").distinct().collect()]
    assert set(got) == {(s, n, c) for s, n in [("all", None), *(("load", n) for n in loads)] for c in df.columns}
    exact = df.groupBy("load_no").agg(F.countDistinct("row_id").alias("n"), F.min("row_id"), F.max("row_id"), F.min("loaded_at"), F.max("loaded_at"))
    for load, n, least, most, first, last in exact.collect():
        r = got["load", load, "row_id"]
        assert r["rows"] == n and r["distinct"] == pytest.approx(n, rel=0.05)
        assert (r["least_number"], r["most_number"]) == (least, most)
        t = got["load", load, "loaded_at"]
        assert (t["least_time"], t["most_time"]) == (first, last)
    assert got["all", None, "load_no"]["distinct"] == len(loads)


def test_ranges_of_numbers_and_times(spark):
    rows = [(0, "9", "2024-02-01"), (0, "85", "2024-01-31T23:00:00-02:00"), (0, "none", "soon"), (1, "100", None), (1, "x", "2023-05-05 10:00:00")]
    df = spark.createDataFrame(rows, "load_no int, confidence_score string, last_updated string")
    p = quality.profile_by_load(quality.column_states(df, "load_no", df.columns), "load_no")
    got = {(r["load_no"], r["column_name"]): r for r in p.collect()}
    number = lambda n: (got[n, "confidence_score"]["least_number"], got[n, "confidence_score"]["most_number"])
    assert (number(0), number(1), number(None)) == ((9, 85), (100, 100), (9, 100))
    t = got[None, "last_updated"]
    assert [str(t[c]) for c in ("least_time", "most_time")] == ["2023-05-05 10:00:00", "2024-02-01 01:00:00"]
    assert got[None, "confidence_score"]["distinct"] == 4 and got[0, "load_no"]["most_number"] == 0


def test_boundary_of_a_shift(spark):
    rows = [(0, "A B", "x", "1234567", None)] * 20 + [(1, "A B", "x", "1234567", None)] * 17 + [(1, None, "x", "1234567", None)] * 3
    states = quality.value_states(spark.createDataFrame(rows, QUALITY), "load_no", ["ceo"])
    assert [tuple(r) for r in quality.shifts(states, "load_no").collect()] == [(1, "ceo", "missing")]


def test_all_missing_and_empty(spark):
    df = spark.createDataFrame([(0, None, None, None, None), (1, "-", "", "nan", None), (None, "A", "b", "c", "d")], QUALITY)
    states = quality.value_states(df, "load_no", ["ceo", "industry", "phone"])
    assert states.count() == 9
    assert quality.control_limits(states, "load_no").filter("out_of_limits").count() == 0
    empty = spark.createDataFrame([], QUALITY)
    assert quality.shifts(quality.value_states(empty, "load_no", ["ceo"]), "load_no").count() == 0
    assert quality.column_states(empty, "load_no", ["ceo"]).count() == 0


def test_states_merge(spark, sf):
    df = spark.read.parquet(f"{sf}/enriched_companies.parquet")
    parts = quality.merge_states(quality.column_states(df, "load_no", ["ceo", "phone"]), ["column_name"])
    whole = quality.column_states(df.withColumn("all", F.lit(1)), "all", ["ceo", "phone"])
    cols = ["column_name", "rows", "present", "wrong", "least", "most"]
    assert sorted(map(tuple, parts.select(cols).collect())) == sorted(map(tuple, whole.select(cols).collect()))


def test_loads_are_scanned_once(spark, sf, tmp_path):
    df = spark.read.parquet(f"{sf}/enriched_companies.parquet")
    store = quality.StateStore(spark, f"file://{tmp_path}/states", "load_no")
    for (load,) in sorted(df.select("load_no").distinct().collect()):
        one = df.filter(F.col("load_no") == load)
        store.add(quality.value_states(one, "load_no", training_core.WATCHED))
    store.add(quality.value_states(df.filter("load_no = 2"), "load_no", training_core.WATCHED))
    whole = quality.value_states(df, "load_no", training_core.WATCHED)
    assert sorted(map(tuple, store.states().select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    assert store.known().count() == df.select("load_no").distinct().count()
    assert set(quality.shifts(store.states(), "load_no").collect()) == set(training_core.p4_found(spark, sf).collect())


def test_header_words_are_whole_names(spark):
    names = {"mailing_address": None, "logo_url": None, "username": None, "Contact E-Mail": "email", "our-website": "website", "Company Name": "name", "no. of employees": "employees"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r["n"]: r["f"] for r in df.withColumn("f", drift.header_field(F.col("n"))).collect()} == names
    assert reasons(spark, "name,mailing_address", ["a,12 High Street"]) == [None]


def test_content_decides_on_renames(spark):
    heads = ["name,x1,sales", "name,x2,turnover,y", "name,website,headcount,y"]
    records = [(0, "a,b.com,1.5"), (1, "a,c.com,2.5,p"), (2, "a,d.com,12,p")]
    assert change_set(spark, heads, records) == {
        (1, "renamed", "x1", "x2"), (1, "renamed", "sales", "turnover"), (1, "added", "", "y"),
        (2, "renamed", "x2", "website"), (2, "removed", "turnover", ""), (2, "added", "", "headcount"),
    }


def test_alternatives_are_reported(spark):
    heads = ["name,turnover", "name,turnover", "name,revenue", "name,revenue"]
    records = [(0, "a,1"), (0, "b,2"), (0, "c,1.5"), (1, "a,1"), (2, "a,1"), (2, "a,2"), (2, "b,unknown"), (3, "x,")]
    got = drift.alternatives(lines(spark, *records).drop("line_no"), files(spark, *heads))
    assert {tuple(r) for r in got.collect()} == {(1, "turnover", "decimal", "vanished", 1), (2, "revenue", "text", "appeared", 1)}


def test_every_readable_record_is_in_the_one_table(spark, sf):
    t = training_core.p3_table(spark, sf)
    batches = [spark.read.parquet(f"{sf}/{b}.parquet") for b in ("batch_01_standard", "batch_02_messy")]
    j = rejects.judge_batches(batches, spark.read.parquet(f"{sf}/batch_files.parquet"))
    readable = j.filter("NOT arrays_overlap(errors, array('quoting', 'column_count', 'no_header'))")
    assert t.count() == t.select("line_id").distinct().count() == readable.count()
    assert {"name", "website", "email", "linkedin"} <= set(t.columns)
