"""Routing, typed rows, pairing."""

import json

import pytest
from pyspark.sql import functions as F

from airtrack import schemas
from airtrack.functions import text as text_functions
from airtrack.operators import decode, pairing, track
from airtrack.plans import pipelines
from airtrack.sources import fixtures


def element(**changes):
    base = {
        "batch_num": "92025ㆍ202412061458457811", "detect_type": 1, "drone_uuid": "U1", "frequency": 5.8,
        "height": 124.0, "intrusion_start_time": "92025ㆍ20241206145845781", "lasting_time": 32,
        "latitude": 22.5, "longitude": 114.0, "model": "M", "scanID": [{"id": "92025"}], "speed": 7.5, "type": 1,
    }
    base.update(changes)
    return {k: v for k, v in base.items() if v is not None}


def message(*elements, **top):
    return json.dumps(json.dumps({"station_id": "100094", "drone": list(elements), **top}, ensure_ascii=False))


def frame(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "offset bigint, value string").select("value", "offset")


def test_routes_partition_the_input(messages):
    routed = decode.route_jm(messages)
    assert routed.filter("route = 'new'").count() + routed.filter("route = 'old'").count() == messages.count()


@pytest.mark.parametrize(
    "value, route",
    [
        ("not json", "old"),
        ("{}", "old"),
        (json.dumps({"drone": []}), "old"),
        (json.dumps(json.dumps({"drone": []})), "new"),
        (json.dumps(json.dumps({"drone": {}})), "old"),
        (json.dumps("text"), "old"),
        (json.dumps(json.dumps({"station_id": "1"})), "old"),
    ],
)
def test_jm_route(spark, value, route):
    assert decode.route_jm(frame(spark, value)).first()["route"] == route


def test_missing_field_is_quarantined_not_dropped(spark):
    rows = decode.explode_jm(decode.route_jm(frame(spark, message(element(), element(speed=None)))))
    assert sorted(str(r.reason) for r in rows.collect()) == ["None", "missing field"]


def test_every_message_is_in_a_part(spark):
    """Old, usable, unusable elements and empty arrays: nothing is in none of the parts."""
    bad = element(height=None)
    messages = frame(spark, message(element(), element(type=0)), message(), message(bad), "not json", message(element(height="inf")), json.dumps(json.dumps({"drone": [None, 3]})))
    parts = {k: v.collect() for k, v in pipelines.ods_jm_parts(messages).items()}
    assert [len(parts[k]) for k in ("drones", "remotes", "old")] == [2, 1, 1]
    assert sorted(r.reason for r in parts["quarantined"]) == ["missing field", "no elements", "not an object", "not an object"]
    assert [r.height for r in parts["drones"]] == [124.0, 0.0]


@pytest.mark.parametrize("word", ["inf", "-Infinity", "NaN"])
def test_words_are_no_numbers(spark, word):
    row = pairing.pair_messages(frame(spark, message(element(height=word), element(type=0)))).first()
    assert row.reason == "bad number"
    assert spark.createDataFrame([(word,)], "t string").select(text_functions.lenient_double(F.col("t"))).first()[0] == 0.0


def test_lenient_numbers_and_scan_text(spark):
    row = decode.ods_jm(frame(spark, message(element(height="abc", speed="2.5", detect_type=1.9)))).first()
    assert (row.height, row.speed, row.detect_type, row.scanid) == (0.0, 2.5, 1, '[{"id":"92025"}]')


def test_type_split_keeps_unknown_types_with_remotes(spark):
    drones, remotes = pipelines.ods_jm(frame(spark, message(element(), element(type=0), element(type=9))))
    assert (drones.count(), remotes.count()) == (1, 2)


def test_legacy_fallback_keeps_text(spark):
    row = decode.legacy_jm(decode.route_jm(frame(spark, "junk"))).first()
    assert (row.batch_num, row.latitude, row.timestamp) == ("junk", 0.0, 0)


@pytest.mark.parametrize(
    "value, route, stamp",
    [
        ('{"devId":"1","batchno":"b","distance":1,"lasting_time":2,"channel":3,"model":"m","direction":4}', "new", 77),
        ('{"devId":null,"batchno":"b","distance":1,"lasting_time":2,"channel":3,"model":"m","direction":4,"timestamp":5}', "new", 5),
        ('{"batchno":"b"}', "old", None),
        ("[1]", "old", None),
        ("{broken", "old", None),
    ],
)
def test_aoa(spark, value, route, stamp):
    routed = decode.route_aoa(frame(spark, value))
    assert routed.first()["route"] == route
    rows = [r.timestamp for r in decode.typed_aoa(routed, 77).collect()]
    assert rows == ([stamp] if stamp else [])


def test_pairing_takes_last_of_each_type(spark):
    text = message(
        element(type=0, longitude=1.0), element(model="first"), element(type=0, longitude=2.0), element(model="last"),
        element(type=5),
    )
    row = pairing.pair_messages(frame(spark, text)).first()
    assert (row.reason, row.model, row.driverlongitude) == (None, "last", 2.0)
    assert row.signal_id == "U1_92025ㆍ202412061458457811"
    assert row.timestamp == row.event_time == 1733468357


def test_escaped_separator_is_removed(spark):
    inner = json.dumps({"station_id": "1", "drone": [element(), element(type=0)]})  # separator as escape text
    row = pairing.pair_messages(frame(spark, json.dumps(inner))).first()
    assert row.reason is None and row.batch_num == "92025202412061458457811" and row.timestamp == 1733468357


@pytest.mark.parametrize(
    "value, reason",
    [
        ("x", "not a JSON text of an object"),
        (json.dumps(json.dumps({"station_id": "1", "drone": 3})), "no drone array"),
        (json.dumps(json.dumps({"drone": [element(), element(type=0)]}, ensure_ascii=False)), "no station_id"),
        (message(element(type=0)), "no drone element"),
        (message(element()), "no pilot element"),
        (message(element(batch_num="92025ㆍ1"), element(type=0)), "no start time"),
        (message(element(height="abc"), element(type=0)), "bad number"),
        (message(element(speed="abc"), element(type=0)), "bad number"),
        (message(element(speed=None), element(type=0)), None),
    ],
)
def test_pairing_reasons(spark, value, reason):
    assert pairing.pair_messages(frame(spark, value)).first()["reason"] == reason


def test_good_and_quarantined_add_up(messages):
    paired = pairing.pair_messages(messages)
    assert pairing.good_rows(paired).count() + pairing.quarantined(paired).count() == messages.count()


def test_text_is_parsed_once(messages):
    plan = pairing.good_rows(pairing.pair_messages(messages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(station_id") == 1
    plan = decode.ods_jm(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(station_id") == 1


def test_tables_of_all_messages_share_one_parse(messages):
    plan = decode.parse_jm(messages)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(station_id") == 1


def test_a_message_without_text_is_quarantined(spark):
    parts = pipelines.ods_jm_parts(spark.createDataFrame([(None, 1)], "value string, offset bigint"))
    assert parts["drones"].count() == parts["remotes"].count() == parts["old"].count() == 0
    assert parts["quarantined"].count() == 1


def test_both_tables_read_what_was_parsed(messages):
    for rows in pipelines.ods_jm(messages):
        assert "from_json" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_filter_reads_parsed_records(spark, monkeypatch):
    """Range partitioning reads the input of the filter twice; the text must not be parsed twice for that."""
    seen = []
    monkeypatch.setattr(track, "kalman", lambda rows, zone: seen.append(rows) or rows)
    pipelines.dws(spark.createDataFrame([("{}", 1)], "value string, offset bigint"))
    assert "from_json" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_aoa_fixture_has_all_kinds(found):
    routed = decode.route_aoa(fixtures.aoa_messages(found))
    assert routed.groupBy("route").count().count() == 2
    assert decode.ods_aoa(fixtures.aoa_messages(found), 1).filter(F.col("timestamp") == 1).count() > 0


def inner(*elements):
    return json.dumps(json.dumps({"station_id": "1", "drone": list(elements)}, ensure_ascii=False))


def test_a_bad_element_leaves_the_others(spark):
    rows = decode.explode_jm(decode.route_jm(frame(spark, inner(element(), 5, None, element(type=0))))).collect()
    assert [r.reason for r in rows] == [None, "not an object", "not an object", None]
    row = pairing.pair_messages(frame(spark, inner(element(), 5, element(type=0)))).first()
    assert row.reason is None and row.model == element()["model"]


def test_text_in_brackets_is_no_array(spark):
    value = json.dumps(json.dumps({"station_id": "1", "drone": "[x]"}))
    assert decode.route_jm(frame(spark, value)).first()["route"] == "old"
    assert pairing.pair_messages(frame(spark, value)).first()["reason"] == "no drone array"


def test_explicit_null_is_not_missing(spark):
    row = decode.explode_jm(decode.route_jm(frame(spark, inner(element() | {"speed": None, "scanID": None})))).first()
    assert (row.reason, row.speed, row.scanID) == (None, 0.0, "null")
    lacking = {k: v for k, v in element().items() if k != "speed"}
    assert decode.explode_jm(decode.route_jm(frame(spark, inner(lacking)))).first()["reason"] == "missing field"
    old = {name: 1 for name, _ in schemas.JM_OLD_FIELDS} | {"droneUK": None, "batch_num": "b"}
    row = decode.legacy_jm(decode.route_jm(frame(spark, json.dumps(old)))).first()
    assert (row.droneUK, row.batch_num, row.latitude) == ("null", "b", 1.0)


def test_aoa_nulls(spark):
    value = '{"devId":"1","batchno":"b","distance":1,"lasting_time":2,"channel":3,"model":null,"direction":4,"timestamp":null}'
    row = decode.typed_aoa(decode.route_aoa(frame(spark, value)), 77).first()
    assert (row.reason, row.model, row.timestamp) == (None, "null", 0)


def test_json_truth_is_one(spark):
    row = decode.explode_jm(decode.route_jm(frame(spark, inner(element(detect_type=True, speed=False))))).first()
    assert (row.detect_type, row.speed) == (1, 0.0)


def test_fractions_are_cut(spark):
    text = inner(element(type=0.0), element(type=1.0, lasting_time=32.7))
    row = pairing.pair_messages(frame(spark, text)).first()
    whole = pairing.pair_messages(frame(spark, inner(element(type=0), element(lasting_time=32)))).first()
    assert (row.reason, row.timestamp, row.lasting_time) == (None, whole.timestamp, 32)


@pytest.mark.parametrize(
    "changes, reason, stamp",
    [({}, None, 5), ({"timestamp": 5.0}, None, 5), ({"utm_x": "bad"}, "bad number", 5), ({"utm_x": None}, None, 5), ({"timestamp": "x"}, "no usable record", None)],
)
def test_fused_numbers(spark, changes, reason, stamp):
    record = {"timestamp": 5, "utm_x": 1.5, "intrusion_start_time": "92025ㆍ20241206145845781"} | changes
    row = track.parse_fused(frame(spark, json.dumps(record, ensure_ascii=False))).first()
    assert (row.reason, row.timestamp) == (reason, stamp)


def test_every_message_is_accounted_for(messages, found):
    total = messages.count()
    aoa = fixtures.aoa_messages(found)
    sums = {r.job: r.n for r in pipelines.balance(messages, aoa).groupBy("job").agg(F.sum("n").alias("n")).collect()}
    assert sums["dwd messages"] == sums["ods_jm messages"] == total and sums["ods_aoa messages"] == aoa.count()
    fused, bad = pipelines.dwd_parts(messages)
    assert fused.count() + bad.count() == total
    parts = pipelines.ods_jm_parts(messages)
    rows = sum(parts[k].count() for k in ("drones", "remotes", "quarantined"))
    assert rows == sums["ods_jm elements"] and parts["old"].count() == messages.count() * 4 // 20


def test_plain_numbers(spark):
    numbers = [0.0005, 12345678.5, 22.5, 0.0, -0.00012, 1e-05, 1.5e-07, 1e16, 123456789012345.0, -3.0, 1e15, 0.1, 114.05204512345678]
    rows = spark.createDataFrame([(float(x),) for x in numbers], "x double").select("x", text_functions.plain_number(F.col("x")).alias("t")).collect()
    assert [r.t for r in rows] == [repr(r.x) for r in rows]
