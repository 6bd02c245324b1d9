import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.lookup import ForeignKey, LookupSpec
from rowferry.operators.merge import MergeConflict
from rowferry.plans import civil
from rowferry.plans import load as load_module
from rowferry.plans.load import LoadFailed, current_target, load_chain, load_table, merge_partitions
from rowferry.plans.progress import (
    clear_progress,
    is_complete,
    latest_progress,
    load_progress,
    mark_complete,
    progress_summary,
    resume_action,
    resume_action_column,
    save_progress,
)
from rowferry.plans.spec import TableLoad, check_plan, priority_groups, tables_with_foreign_keys

TS = "2024-01-01 00:00:00"
SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])


def simple(data, mode="skip-existing", **kwargs):
    return TableLoad("t", lambda s: s.createDataFrame(data, SCHEMA), ("k",), SCHEMA, mode=mode, **kwargs)


def test_load_merges_by_mode_and_reports(spark, root):
    first = load_table(spark, root, simple([(1, "a"), (2, "b")]), TS)
    assert (first.action, first.read, first.inserted, first.target_rows) == ("load", 2, 2, 2)
    again = load_table(spark, root, simple([(1, "a"), (2, "b"), (3, "c")]), TS)
    assert (again.action, again.inserted, again.target_rows) == ("skip", 0, 2)
    up = load_table(spark, root, simple([(2, "B"), (3, "c"), (3, "d")], "upsert"), TS)
    assert (up.action, up.inserted, up.updated, up.superseded, up.target_rows) == ("merge", 1, 1, 1, 3)
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(1, "a"), (2, "B"), (3, "d")]
    ignore = load_table(spark, root, simple([(3, "x"), (4, "y")], "insert-ignore"), TS)
    assert (ignore.inserted, ignore.skipped, ignore.target_rows) == (1, 1, 4)
    assert len(ignore.paths) == 2, "only the new row was written"
    fresh = load_table(spark, root, simple([(9, "z")], "fresh-start"), TS)
    assert (fresh.action, fresh.deleted, fresh.inserted, fresh.target_rows) == ("clear-and-load", 4, 1, 1)
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(9, "z")]
    assert progress_summary(load_progress(spark, root)).first().asDict() == {
        "total_tables": 1, "completed_tables": 1, "total_rows": 1, "read_rows": 8,
    }


def test_staged_source_is_read_once(spark, root):
    calls = []

    def source(s):
        calls.append(1)
        return s.createDataFrame([(1, "a")], SCHEMA)

    load = TableLoad("t", source, ("k",), SCHEMA, stage=True)
    assert load_table(spark, root, load, TS).inserted == 1 and len(calls) == 1


def test_empty_source_completes(spark, root):
    result = load_table(spark, root, simple([]), TS)
    assert (result.read, result.target_rows) == (0, 0)
    assert is_complete(spark, root, "t")
    assert current_target(spark, root, "t", SCHEMA).count() == 0


def test_a_run_that_dies_before_the_commit_changes_nothing(spark, root):
    load_table(spark, root, simple([(1, "a")]), TS)
    # A later run wrote its folder and died: no progress row names it.
    spark.createDataFrame([(5, "lost")], SCHEMA).write.parquet(f"{root}/t/run=2")
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(1, "a")]
    load_table(spark, root, simple([(2, "b")], "upsert"), TS)
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(1, "a"), (2, "b")]


def test_source_columns_must_fit(spark, root):
    load = TableLoad("t", lambda s: s.createDataFrame([(1, "a", 2)], "k long, v string, x int"), ("k",), SCHEMA)
    with pytest.raises(ValueError, match="outside the target schema"):
        load_table(spark, root, load, TS)


def test_progress_records(spark, root):
    assert load_progress(spark, root).count() == 0 and not is_complete(spark, root, "t")
    save_progress(spark, root, table_id="t", run=1, read_rows=5, target_rows=5)
    assert not is_complete(spark, root, "t")
    mark_complete(spark, root, "t")
    assert is_complete(spark, root, "t")
    clear_progress(spark, root, "t")
    last = latest_progress(load_progress(spark, root)).first()
    assert (last["run"], last["is_complete"], last["target_rows"]) == (3, False, 0)
    mark_complete(spark, root, "empty")
    assert is_complete(spark, root, "empty")
    with pytest.raises(ValueError):
        save_progress(spark, root, table_id="t", wrong=1)


def test_resume_actions_agree(spark):
    cases = [
        (m, c, n)
        for m in ("skip-existing", "append-only", "insert", "upsert", "update", "sync", "fresh-start", "delete-insert")
        for c in (True, False)
        for n in (0, 7)
    ]
    df = spark.createDataFrame(cases, "m string, c boolean, n long")
    got = df.select("m", "c", "n", resume_action_column(F.col("m"), F.col("c"), F.col("n")).alias("a")).collect()
    assert [(r["m"], r["c"], r["n"], r["a"]) for r in got] == [(*c, resume_action(*c)) for c in cases]


def test_plan_checks():
    def load(name, priority, **kwargs):
        return TableLoad(name, lambda s: None, ("k",), SCHEMA, priority=priority, **kwargs)

    a = load("a", 1, lookup=LookupSpec("a"))
    fk = (ForeignKey("v", "a", "a_id"),)
    check_plan([load("b", 2, foreign_keys=fk), a])
    assert [p for p, _ in priority_groups([load("b", 10), a])] == [1, 10]
    assert tables_with_foreign_keys([a, load("b", 2, foreign_keys=fk)]) == ["b"]
    for loads, text in [
        ([a, load("a", 2)], "same table_id"),
        ([load("b", 2, depends_on=("gone",))], "no load provides"),
        ([a, load("b", 1, depends_on=("a",))], "does not load before"),
        ([load("a", 1), load("b", 2, foreign_keys=fk)], "declares no lookup"),
    ]:
        with pytest.raises(ValueError, match=text):
            check_plan(loads)
    for kwargs, text in [({"mode": "what"}, "unknown mode"), ({"keys": ()}, "needs keys"), ({"keys": ("z",)}, "target schema")]:
        with pytest.raises(ValueError, match=text):
            TableLoad(**{"table_id": "t", "source": None, "keys": ("k",), "schema": SCHEMA, **kwargs})


def test_a_failing_group_stops_later_groups(spark, root):
    bad = simple([(1, "a"), (1, "b")], "upsert", priority=1, options={"on_duplicate": "error"})
    good = TableLoad("same", lambda s: s.createDataFrame([(1, "a")], SCHEMA), ("k",), SCHEMA, priority=1)
    later = TableLoad("later", lambda s: s.createDataFrame([(1, "a")], SCHEMA), ("k",), SCHEMA, priority=2)
    with pytest.raises(LoadFailed, match="group 1: t: the source repeats"):
        load_chain(spark, root, [bad, good, later], TS)
    assert is_complete(spark, root, "same") and not is_complete(spark, root, "later")
    assert MergeConflict is not LoadFailed


def relations(spark):
    def frame(data, ddl):
        return spark.createDataFrame(data, ddl)

    place = "ID long, CODE string, NAME string, {} POST_CODE string, ACTIVE int"
    born = dt.datetime(2024, 2, 3)
    return {
        "country": frame([(1, "Tanzania", "TZAX", "+255"), (2, "", None, None)], "ID long, NAME string, CODE string, INTL_CODE string"),
        "registration_center_type": frame([(4, "HC", " Health Centre ")], "ID long, CODE string, DESCRIPTION string"),
        "region": frame([(10, "R1", "North", "11", 1, "x"), (11, " R2", "South ", "", 0, None)],
                        "ID long, CODE string, NAME string, POST_CODE string, ACTIVE int, INTL_CODES string"),
        "district": frame([(20, "D1", "Dee", 10, "2", 1), (21, "D2", "Two", None, "2", None)], place.format("REGION_ID long,")),
        "council": frame([(30, "C1", "Cee", 20, "3", 1, "u1"), (31, "C2", "Odd", 99, "3", 1, None)],
                         place.format("DISTRICT_ID long,") + ", MVC_UUID string"),
        "ward": frame([(40, "W1", "Wu", 30, "4", 1)], place.format("COUNCIL_ID long,")),
        "health_facility": frame([(50, "H1", "Hosp", 30, "55 b", 1), (51, "H2", "Shut", 31, None, 2)],
                                 place.format("COUNCIL_ID long,")),
        "registration_center": frame(
            [(60, "RC", "Centre", 10, 20, 30, 40, 50, 1, 0, 1, "Y", 4, "T")],
            "ID long, CODE string, NAME string, REGION_ID long, DISTRICT_ID long, COUNCIL_ID long, WARD_ID long,"
            " HEALTH_FACILITY_ID long, REGISTRATION_FACILITY int, PRINTING_FACILITY int, ACTIVE int, HEAD_OFFICE string,"
            " REGISTRATION_CENTER_TYPE_ID long, REG_TYPE string",
        ),
        "person": frame(
            [(7, 123, "Asha", " ", "Juma", None, "N1", born, 2, 10, 20, 40, 1), (8, 9, "Old", None, None, None, None, born, 1, 1, 1, 1, 1)],
            "ID long, PIN long, FIRST_NAME string, MIDDLE_NAME string, LAST_NAME string, OTHER_NAMES string, NIN string,"
            " DATE_OF_BIRTH timestamp_ntz, SEX_ID long, REGION_OF_BIRTH_ID long, DISTRICT_OF_BIRTH_ID long,"
            " WARD_OF_BIRTH_ID long, COUNTRY_OF_BIRTH_ID long",
        ),
        "sex": frame([(2, "F", "Female", "Ke")], "ID long, CODE string, DESCRIPTION string, DESC_SWAHILI string"),
        "birth_registration": frame(
            [(70, 7, 555, "old", born, born, 3, None, 1, 50, " Hosp ", 1, 2, None, None, 1, 3.2, "S"),
             (71, 8, 556, None, born, dt.datetime(2023, 12, 31), 3, None, 1, 50, "H", 1, 2, None, None, 1, 3.2, "S")],
            "ID long, CHILD_ID long, NOTIFICATION_NUMBER long, OLD_REGISTRATION_NUMBER string, REGISTRATION_DATE timestamp_ntz,"
            " CREATED_DATE timestamp_ntz, MODIFIED_BY long, MODIFIED_DATE timestamp_ntz, PLACE_OF_BIRTH_ID long, HOSPITAL_ID long,"
            " HOSPITAL_NAME string, MOTHER_ID long, FATHER_ID long, CERTIFICATE_PRINT_DATE timestamp_ntz, CERTIFICATE_PRINT_BY string,"
            " TYPE_OF_BIRTH_ID long, WEIGHT_AT_BIRTH double, STATUS_OF_BIRTH string",
        ),
    }


def test_the_nine_table_plan(spark, root):
    loads = civil.civil_plan(relations(spark), TS)
    results = {r.table_id: r for r in load_chain(spark, root, loads, TS)}
    assert [load.table_id for load in loads] == list(results) and len(results) == 9

    def target(name):
        schema = next(load.schema for load in loads if load.table_id == name)
        return current_target(spark, root, name, schema)

    def one(name, code, key="code"):
        return target(name).where(F.col(key) == code).first().asDict()

    at = dt.datetime(2024, 1, 1)
    audit = {"created_at": at, "updated_at": at, "deleted": False}
    assert one("country", "TZA", "country_code") == {
        "country_code": "TZA", "country_name_en": "Tanzania", "country_name_fr": "Tanzania", "nationality_en": None,
        "nationality_fr": None, "translate_code": "+255", "is_active": True, "online_id": 1,
    }
    assert one("region", "R2") == {"code": "R2", "name": "South", "post_code": None, "intl_codes": None, "active": False, "uuid": "11", **audit}
    assert one("registration_center_type", "HC")["description"] == "Health Centre"
    assert one("district", "D1")["region_id"] == 10 and one("district", "D2")["active"] is False
    assert one("council", "C1")["district_id"] == 20 and one("council", "C2")["district_id"] is None
    ward = one("ward", "W1")
    assert (ward["ward_id"], ward["council_id"], ward["district"], ward["council_name"]) == (40, 30, 20, "C1")
    facility = one("health_facility", "H1")
    assert (facility["council_id"], facility["post_code"], facility["active"], facility["is_active"]) == (30, 55, "Y", True)
    assert one("health_facility", "H2")["active"] == "N"
    center = one("registration_center", "RC")
    assert {k: v for k, v in center.items() if k.endswith("_id")} == {
        "mgt_registration_center_id": 60, "region_id": 10, "district_id": 20, "council_id": 30, "ward_id": 40,
        "health_facility_id": 50, "registration_center_type_id": 4,
    }
    assert center["is_head_office"] and center["registration_facility"] and not center["printing_facility"]
    births = target("birth_certificate").collect()
    assert len(births) == 1 and len(births[0]) == 54
    b = births[0].asDict()
    want = {
        "provided_pin_no": "123", "notification_no": "555", "old_pin_no": "old", "first_name": "Asha", "middle_name": "",
        "jamii_no": "N1", "sex_code": "F", "birth_date": dt.datetime(2024, 2, 3), "region_birth_id": 10,
        "region_birth_name": "Unknown Region", "country_birth_name": "Tanzania", "place_of_birth_name": "Hospital",
        "registrar_name": "System Migrated", "facility_id": 50, "facility_name": "Hosp", "last_updated_by_id": 3,
        "certificate_status_id": 1, "printed_count": 0, "last_track_date": at, "migrated_date": at,
        "is_migrated_data": True, "child_full_name": "Asha Juma", "mother_full_name": "", "attachment": None,
        "first_printed_date": None, "last_printed_date": None,
    }
    assert {k: b[k] for k in want} == want

    again = load_chain(spark, root, loads, TS)
    assert {r.action for r in again} == {"skip"}


def test_declared_shapes_agree():
    assert len(civil.CERTIFICATE_FIELDS) == len(set(civil.CERTIFICATE_FIELDS)) == 54
    assert civil.CERTIFICATE_FIELD_MAP["FIRST_NAME"] == "first_name"
    kinds = [f.dataType.simpleString() for f in civil.CERTIFICATE_SCHEMA.fields]
    assert {k: kinds.count(k) for k in set(kinds)} == {"string": 34, "bigint": 11, "timestamp_ntz": 8, "boolean": 1}
    assert {s.table for s in civil.BIRTH_LOOKUPS} == {
        "region", "district", "ward", "country", "health_facility", "place_of_birth",
    }


def test_merge_touches_only_the_partitions_of_the_source(spark, root):
    path, ddl = f"{root}/parts", "k int, v string, day string"
    data = [(k, "old", day) for k in range(3) for day in ("d1", "d2", None)]
    spark.createDataFrame(data, ddl).write.partitionBy("day").parquet(path)

    def files(day):
        got = spark.read.parquet(path).where(F.col("day") == day).select(F.input_file_name().alias("f"))
        return {r["f"] for r in got.collect()}

    untouched = files("d1")
    source = spark.createDataFrame([(0, "new", "d2"), (7, "new", "d2"), (8, "new", "d3"), (0, "new", None)], ddl)
    merge_partitions(spark, path, source, "upsert", ["k", "day"], ["day"])
    want = [r for r in data if r != (0, "old", "d2")] + [(0, "new", "d2"), (7, "new", "d2"), (8, "new", "d3"), (0, "new", None)]
    got = rows(spark.read.parquet(path).select("k", "v", "day"))
    assert got == sorted(want, key=lambda r: [(v is not None, str(v)) for v in r])
    assert files("d1") == untouched
    # Keyed rows are settled: the same merge again changes nothing but the row without a key, which is new each time.
    merge_partitions(spark, path, source.dropna(), "upsert", ["k", "day"], ["day"])
    assert rows(spark.read.parquet(path).select("k", "v", "day")) == got
    with pytest.raises(ValueError, match="must be key columns"):
        merge_partitions(spark, path, source, "upsert", ["k"], ["day"])
    with pytest.raises(ValueError, match="reaches beyond"):
        merge_partitions(spark, path, source, "fresh-start", ["k", "day"], ["day"])


def test_a_partition_merge_cut_short_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "d1"), (2, "b", "d2")], "k long, v string, day string").write.partitionBy("day").parquet(path)
    news = spark.createDataFrame([(1, "A", "d1"), (5, "e", "d1")], "k long, v string, day string")
    more = spark.createDataFrame([(6, "f", "d3")], "k long, v string, day string")

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(load_module, "_replace_partitions", dies)
        with pytest.raises(RuntimeError, match="lost"):
            merge_partitions(spark, path, news, "upsert", ["k", "day"], ["day"])
    assert rows(spark.read.parquet(path).select("k", "v", "day")) == [(1, "a", "d1"), (2, "b", "d2")]
    merge_partitions(spark, path, more, "upsert", ["k", "day"], ["day"])
    want = [(1, "A", "d1"), (2, "b", "d2"), (5, "e", "d1"), (6, "f", "d3")]
    assert rows(spark.read.parquet(path).select("k", "v", "day")) == want
