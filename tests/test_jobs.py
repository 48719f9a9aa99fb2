"""Tables, topics and streams."""

import json
import time

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from airtrack import schemas
from airtrack.operators import decode, pairing
from airtrack.plans import pipelines, queries
from airtrack.sources import tables, topics
from airtrack.streaming import jobs
from tests.conftest import SCALE

ONCE = {"availableNow": True}


def test_tables_round_trip_and_commit(spark, messages):
    drones, remotes = pipelines.ods_jm(messages)
    for name, rows in (("ods_jm_drone", drones), ("ods_jm_remote", remotes)):
        table = tables.create_table(spark, name)
        tables.insert(rows, table)
        assert spark.table(table).count() == rows.count()
        assert [c for c in spark.table(table).columns] == rows.columns
    table = "ods.ods_jm_drone"
    assert tables.commit_partitions(spark, table, now=time.time()) == []
    marked = tables.commit_partitions(spark, table, now=time.time() + 3601)
    assert ("2024-01-01", "00") in marked
    assert tables.commit_partitions(spark, table, now=time.time() + 3601) == []
    pruned = spark.table(table).filter("dt = '2024-01-01' and hr = '00'")
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString()


def test_inserts_do_not_sort_a_large_hour(spark, messages, tmp_path, monkeypatch):
    """A task writes the rows of its hours as they come; sorted, all of them would be in its memory."""
    plans, insert_into = [], DataFrameWriter.insertInto

    def recorded(writer, table, overwrite=None):
        if not table.endswith("complete_batches"):
            writer._df.createOrReplaceTempView("inserted")
            plans.append(spark.sql(f"EXPLAIN INSERT INTO {table} SELECT * FROM inserted").first()[0])
        return insert_into(writer, table, overwrite)

    monkeypatch.setattr(DataFrameWriter, "insertInto", recorded)
    name, mode = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.sources.partitionOverwriteMode"
    before, overwritten = spark.conf.get(name), spark.conf.get(mode)
    drones, _ = pipelines.ods_jm(messages)
    tables.insert(drones, tables.create_table(spark, "ods_jm_drone", "unsorted", f"{tmp_path}/drone"))
    tables.create_fan_out(spark, ["ods_jm_drone"], f"{tmp_path}/together", "unsorted_together")
    tables.write_batch({"ods_jm_drone": drones}, 0, "unsorted_together")
    spark.conf.set(mode, overwritten)
    assert len(plans) == 2 and not any("Sort [" in plan for plan in plans)
    assert spark.conf.get(name) == before
    assert spark.table("unsorted.ods_jm_drone").exceptAll(drones).isEmpty() and spark.table("unsorted.ods_jm_drone").count() == drones.count()
    assert spark.table("unsorted_together.ods_jm_drone").count() == drones.count()


def test_old_messages_have_a_table(spark, messages):
    table = tables.create_table(spark, "ods_jm_old")
    tables.insert(decode.ods_jm_old(messages), table)
    assert spark.table(table).filter("droneUK is not null").count() == messages.filter("offset % 20 = 1").count()


def test_table_streams_equal_batch(spark, messages, tmp_path):
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    stream = topics.read_topic(spark, "jm", folder=str(tmp_path), maxFilesPerTrigger="1")
    places = {name: f"{tmp_path}/{name}" for name in ("ods_jm_drone", "ods_jm_remote")}
    named = {name: tables.create_table(spark, name, "streamed", place) for name, place in places.items()}
    for query in jobs.ods_jm(stream, places, f"{tmp_path}/cp", ONCE):
        query.awaitTermination()
    for (name, table), rows in zip(named.items(), pipelines.ods_jm(messages)):
        tables.commit_partitions(spark, table, now=time.time() + 7200)
        spark.sql(f"refresh table {table}")
        got = spark.table(table)
        assert got.count() == rows.count() and got.exceptAll(rows).isEmpty()


def test_both_tables_are_filled_by_one_parse(spark, messages, monkeypatch):
    """The streams of ``ods_stream`` read every message once, however many tables there are."""
    started, start = [], topics.start
    for module in (topics, tables):
        monkeypatch.setattr(module, "start", lambda *given: started.append(start(*given)) or started[-1])
    queries.ods_stream(spark, SCALE)
    assert sum(p["numInputRows"] for query in started for p in query.recentProgress) == messages.count()


def test_tables_by_target_equal_batch(spark, messages, tmp_path):
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    stream = topics.read_topic(spark, "jm", folder=str(tmp_path), maxFilesPerTrigger="1")
    jobs.ods_jm_by_target(stream, f"{tmp_path}/ods_jm", f"{tmp_path}/cp", ONCE).awaitTermination()
    for target, rows in zip(("drone", "remote"), pipelines.ods_jm(messages)):
        name = f"ods_jm_{target}"
        got = tables.read_target(spark, name, target, f"{tmp_path}/ods_jm").select(*rows.columns)
        assert got.count() == rows.count() > 0 and got.exceptAll(rows).isEmpty()
        table = tables.create_table(spark, name, "by_target", f"{tmp_path}/ods_jm/target={target}")
        tables.commit_partitions(spark, table, now=time.time() + 7200)
        spark.sql(f"refresh table {table}")
        assert spark.table(table).count() == rows.count() and spark.table(table).exceptAll(rows).isEmpty()


def test_old_messages_stream_into_their_table(spark, messages, tmp_path):
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    places = {name: f"{tmp_path}/{name}" for name in ("ods_jm_drone", "ods_jm_remote", "ods_jm_old")}
    for query in jobs.ods_jm(topics.read_topic(spark, "jm", folder=str(tmp_path)), places, f"{tmp_path}/cp", ONCE):
        query.awaitTermination()
    got = spark.read.schema(tables.TABLES["ods_jm_old"]).parquet(places["ods_jm_old"])
    want = decode.ods_jm_old(messages)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()


def test_current_database(spark):
    tables.use(spark, database="elsewhere")
    try:
        assert spark.catalog.currentDatabase() == "elsewhere"
        tables.create_table(spark, "ods_aoa", "elsewhere")
        assert spark.table("ods_aoa").columns[-2:] == ["dt", "hr"]
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_time_difference_messages_are_typed(spark, tmp_path):
    fields = [part.split()[0].strip("`") for part in schemas.TDOA.split(", ")]
    value = json.dumps({name: 1 for name in fields})
    spark.createDataFrame([(value, 7), ("no json", 8)], "value string, offset bigint").write.json(f"{tmp_path}/tdoa")
    rows = topics.read_tdoa(spark, folder=str(tmp_path), streaming=False)
    assert rows.columns == ["offset", *fields]
    got = {r.offset: r for r in rows.collect()}
    assert all(got[7][name] is not None for name in fields) and all(got[8][name] is None for name in fields)
    stream = topics.read_tdoa(spark, folder=str(tmp_path))
    sink = stream.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    topics.start(sink, "tdoa", f"{tmp_path}/cp", ONCE).awaitTermination()
    assert spark.read.schema(rows.schema).parquet(f"{tmp_path}/out").exceptAll(rows).isEmpty()


def test_duplicates_are_dropped(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "value string, offset bigint")
    frame.write.json(f"{tmp_path}/t")
    stream = topics.read_topic(spark, "t", folder=str(tmp_path)).withColumn("ts", F.timestamp_seconds("offset"))
    kept = topics.without_duplicates(stream, "ts", ["value"], "1 minute").select("value", "offset")
    topics.write_topic(kept, "u", folder=str(tmp_path), checkpoint=f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    assert topics.read_topic(spark, "u", folder=str(tmp_path), streaming=False).count() == 2


def test_fused_stream_equals_batch(spark, found, messages, tmp_path):
    timed = messages.join(found.select("offset", "timestamp"), "offset")
    low, high = found.agg(F.min("timestamp"), F.max("timestamp")).first()
    middle = (low + high) // 2
    for part in (F.col("timestamp") <= middle, F.col("timestamp") > middle):
        timed.filter(part).select("value", "offset").coalesce(1).write.mode("append").json(f"{tmp_path}/jm")
        time.sleep(1.1)
    stream = topics.read_topic(spark, "jm", folder=str(tmp_path), maxFilesPerTrigger="1")
    jobs.dwd(stream, str(tmp_path), f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    streamed = spark.read.schema("value string, offset bigint").json(f"{tmp_path}/dwd_jm_drone")
    batch = pipelines.to_text(pipelines.dwd(messages))
    schema = (
        "fusion_id string, pre_fusion_id string, timestamp bigint, speed double, heading double, curr_batch_first int, "
        "start_latitude double, feature struct<avg_speed:double,time_range:int>, model string, driverlatitude double"
    )

    def values(frame):
        return frame.select("offset", F.from_json("value", schema).alias("j")).select(
            "offset", "j.fusion_id", "j.pre_fusion_id", "j.timestamp", F.round("j.speed", 4), F.round("j.heading", 2),
            "j.curr_batch_first", "j.start_latitude", F.round("j.feature.avg_speed", 4), "j.feature.time_range",
            "j.model", "j.driverlatitude",
        )

    got, want = values(streamed), values(batch).filter(F.col("timestamp") <= high - 6)  # later windows stay open
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()

    topics.write_topic(batch, "fused", folder=str(tmp_path))
    tracks = jobs.dws(topics.read_topic(spark, "fused", folder=str(tmp_path)), ttl_seconds=None)
    sink = tracks.writeStream.format("parquet").option("path", f"{tmp_path}/tracks")
    topics.start(sink, "dws", f"{tmp_path}/cp", ONCE).awaitTermination()

    def positions(frame):
        return frame.select("offset", "fusion_id", "takeofftime", F.round("fused_x", 3), F.round("fused_latitude", 8))

    got, want = positions(spark.read.parquet(f"{tmp_path}/tracks")), positions(pipelines.dws(batch))
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_failed_batch_is_in_no_table(spark, messages, tmp_path, monkeypatch):
    """A micro-batch that fails between two tables shows in neither view, and once in both after it is repeated."""
    database, names = "together", ["ods_jm_drone", "ods_jm_remote", "ods_jm_old"]
    tables.create_fan_out(spark, names, f"{tmp_path}/tables", database)
    for part in ("offset % 2 = 0", "offset % 2 = 1"):
        messages.filter(part).select("value", "offset").coalesce(1).write.mode("append").json(f"{tmp_path}/jm")

    def run():
        stream = topics.read_topic(spark, "jm", folder=str(tmp_path), maxFilesPerTrigger="1")
        return jobs.ods_jm_together(stream, f"{tmp_path}/bad", f"{tmp_path}/cp", database, ONCE)

    def shown():
        out = []
        for name in names:
            spark.sql(f"refresh table {database}.{name}_batches")
            spark.sql(f"refresh table {database}.complete_batches")
            out.append(spark.table(f"{database}.{name}"))
        return out

    real = tables.write_batch

    def failing(parts, number, database):
        if number == 1:  # the first table is written, the second one is not
            parts = parts | {"ods_jm_remote": parts["ods_jm_remote"].withColumn("model", F.raise_error(F.lit("lost")).cast("string"))}
        real(parts, number, database)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "write_batch", failing)
        with pytest.raises(Exception, match="lost"):
            run().awaitTermination()
    first = pipelines.ods_jm_parts(messages.filter("offset % 2 = 0"))
    assert [t.count() for t in shown()] == [first[k].count() for k in ("drones", "remotes", "old")]
    run().awaitTermination()
    whole = pipelines.ods_jm_parts(messages)
    for got, key in zip(shown(), ("drones", "remotes", "old")):
        assert got.count() == whole[key].count() and got.exceptAll(whole[key].select(*got.columns)).isEmpty()
    bad = spark.read.schema("value string").json(f"{tmp_path}/bad")
    assert bad.count() == whole["quarantined"].count()


def test_a_batch_of_one_signal_opens_one_bucket(spark, tmp_path):
    """Memory is dealt by signal and versioned by micro-batch; a repeated micro-batch starts from the same versions."""
    from airtrack.operators import fusion
    from airtrack.streaming import memory
    from tests.test_signals import MEMBERS, replay

    rows = [(t, f"U{i:03d}", "B", f"C{i // 2}", f"9ㆍ{i:04d}", float(i), 1.5, 0.0) for i in range(300) for t in range(2)]
    rows += [(5, "U007", "B", "C0", "9ㆍ0007", 7.0, 1.5, 0.0)]
    root, versions = f"{tmp_path}/memory", {}
    for number, part in enumerate(([r for r in rows if r[0] == t] for t in (0, 1, 5))):
        members = spark.createDataFrame(part, MEMBERS)
        for _ in range(2):  # the second time as after a failure
            versions = memory.manifest(spark, root, number - 1)
            buckets = memory.touched(members)
            known = memory.read(spark, root, versions, buckets)
            identities = fusion.fused(members, known)
            versions = memory.write(root, number, versions, buckets, identities, known)
    assert len(buckets) == 1 and len(known.inputFiles()) <= 2
    assert set(versions.values()) == {1, 2} and sum(v == 2 for v in versions.values()) == 1
    want = replay(rows)[(5, "U007")]
    got = identities.first()
    assert (got.fusion_start_time, got.fusion_longitude) == want[0][:2]
    whole = memory.read(spark, root, versions, sorted(versions))
    assert whole.count() == 300 and whole.select("drone_uuid").distinct().count() == 300
    memory.forget(spark, root, 0)
    memory.forget(spark, root, 1)
    assert memory.read(spark, root, versions, sorted(versions)).count() == 300


def test_state_of_a_stopped_stream_can_be_read(spark, messages, found, tmp_path):
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    stream = topics.read_topic(spark, "jm", folder=str(tmp_path))
    jobs.dwd(stream, str(tmp_path), f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    sent = spark.read.schema("value string, offset bigint").json(f"{tmp_path}/dwd_jm_drone")
    last = sent.select(F.json_tuple("value", "drone_uuid", "batch_num", "timestamp").alias("d", "b", "t"))
    want = last.groupBy("d", "b").agg(F.max(F.col("t").cast("bigint")).alias("t"))
    state = jobs.signal_state(spark, f"{tmp_path}/cp").select("drone_uuid", "batch_num", "timestamp")
    assert state.count() == want.count() > 0 and state.exceptAll(want).isEmpty()
    bad = spark.read.schema("value string, offset bigint").json(f"{tmp_path}/dwd_jm_drone_bad")
    quarantined = pairing.quarantined(pairing.pair_messages(messages))
    assert bad.count() == quarantined.count() > 0
    assert bad.select(F.get_json_object("value", "$.reason")).exceptAll(quarantined.select("reason")).isEmpty()


def test_unusable_messages_are_kept_by_a_stream(spark, messages, tmp_path):
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    parsed = pairing.pair_messages(topics.read_topic(spark, "jm", folder=str(tmp_path)))
    jobs.quarantine(parsed, "jm_bad", str(tmp_path), f"{tmp_path}/cp", ONCE).awaitTermination()
    kept = topics.read_topic(spark, "jm_bad", folder=str(tmp_path), streaming=False)
    want = pairing.quarantined(pairing.pair_messages(messages))
    assert sorted(r.offset for r in kept.collect()) == sorted(r.offset for r in want.collect())


def test_partition_numbers_have_room(spark):
    frame = spark.createDataFrame([(5, 7), (6, 4095)], "offset bigint, partition int")
    assert [r.offset for r in frame.select(topics._arrival()).collect()] == [5 * 4096 + 7, 6 * 4096 + 4095]
    with pytest.raises(Exception, match="too many partitions"):
        spark.createDataFrame([(5, 4096)], "offset bigint, partition int").select(topics._arrival()).collect()


class CountedState:
    """List, map and timer state of one key, kept in memory, that counts the calls to it."""

    def __init__(self):
        self.calls, self.timers, self.rows, self.maps = 0, set(), [], {}

    def getListState(self, name, schema):
        return self

    def getMapState(self, name, key, value):
        state, held = CountedState(), self.maps.setdefault(name, {})
        state.getValue = lambda k: self._called(held.get(tuple(k)))
        state.updateValue = lambda k, v: self._called(held.update({tuple(k): v}))
        state.removeKey = lambda k: self._called(held.pop(tuple(k), None))
        return state

    def _called(self, value=None):
        self.calls += 1
        return value

    def appendValue(self, value):
        self._called(self.rows.append(value))

    def put(self, values):
        self._called(setattr(self, "rows", list(values)))

    def clear(self):
        self.put([])

    def get(self):
        return iter(self._called(list(self.rows)))

    def registerTimer(self, moment):
        self._called(self.timers.add(moment))


def _closed(processor, state, parts):
    """What ``processor`` gives out for micro-batches of ``(watermark, rows)`` of one bucket."""
    from types import SimpleNamespace

    processor.init(state)
    out = []
    for watermark, rows in parts:
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        out += processor.handleInputRows((0,), iter(rows), times)
        for moment in sorted(t for t in state.timers if t < watermark):
            out += processor.handleExpiredTimer((0,), times, SimpleNamespace(getExpiryTimeInMs=lambda: moment))
            state.timers.discard(moment)
    return out


@pytest.mark.parametrize("ttl", [None, 6])
def test_state_calls_grow_with_signals_not_with_rows(ttl):
    from types import SimpleNamespace

    from airtrack.streaming.processors import SignalWindows

    def row(signal, second):
        return SimpleNamespace(
            drone_uuid=f"U{signal}", batch_num="B", timestamp=second, offset=second * 100 + signal, latitude=1.0, longitude=2.0,
            height=3.0 + second, speed=None, utm_x=float(second), utm_y=0.0, payload="{}", reason=None,
        )

    seconds = [*range(100, 140), *range(160, 200)]
    state = CountedState()
    first = [row(s, t) for s in range(20) for t in seconds if t < 130]
    rest = [row(s, t) for s in range(20) for t in seconds if t >= 130]
    out = _closed(SignalWindows(ttl), state, [(-1, first), (124_950, rest), (999_950, [row(0, 150)]), (9_999_950, [])])
    late = [r for r in out if r.reason]
    assert [(r.drone_uuid, r.timestamp, r.reason) for r in late] == [("U0", 150, "late")]
    given = {(r.drone_uuid, r.timestamp): r for r in out if not r.reason}
    assert len(given) == len(out) - 1 == 20 * len(seconds)
    assert given["U3", 100].speed == 0 and given["U3", 131].speed == 1 and given["U3", 130].avg_height == 3 + 132
    anew = given["U7", 160]
    assert (anew.speed, anew.start_height) == ((21 / 21, 103) if ttl is None else (0, 163))
    assert (len(state.maps["last"]) == 0) == (ttl is not None)
    assert state.rows == [] and not state.timers
    assert state.calls < 0.2 * len(given)  # one call per row and second made 15


def test_closed_seconds_are_fused_adaptively(spark, messages, tmp_path, monkeypatch):
    """The fixed number of partitions of a stream with state is not forced on the batch steps of its micro-batches."""
    messages.select("value", "offset").repartition(2, "offset").write.json(f"{tmp_path}/jm")
    stream, seen = topics.read_topic(spark, "jm", folder=str(tmp_path), maxFilesPerTrigger="1"), []

    def fused(rows, *rest):
        seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        return real(rows, *rest)

    real = jobs.fuse_closed_seconds
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "fuse_closed_seconds", fused)
        jobs.dwd(stream, str(tmp_path), f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    assert seen and set(seen) == {"true"}
    assert jobs.signal_state(spark, f"{tmp_path}/cp").count() > 0


def test_memory_of_a_target_is_bounded():
    """A target with all rows of a micro-batch is filtered in order without holding them."""
    import tracemalloc
    from types import SimpleNamespace

    from airtrack.streaming.processors import TargetFilter

    n = 60_000
    order = [(i * 7919) % n for i in range(n)]
    rows = (
        SimpleNamespace(timestamp=i // 3, offset=i, utm_x=float(i), utm_y=2.0, payload=f"{i:01000d}") for i in order
    )
    state = SimpleNamespace(exists=lambda: False, update=lambda value: None)
    one = TargetFilter()
    one.init(SimpleNamespace(getValueState=lambda *args: state))
    tracemalloc.start()
    try:
        for i, row in enumerate(one.handleInputRows(("f",), rows, None)):
            assert (row.timestamp, row.offset, int(row.payload)) == (i // 3, i, i)
        assert i == n - 1 and tracemalloc.get_traced_memory()[1] < 45_000_000
    finally:
        tracemalloc.stop()


def test_topic_folders_are_compressed(spark, messages, tmp_path):
    """What the fused stream sends takes a fraction of its text on disk, and reads like plain files."""
    topics.write_topic(messages, "jm", folder=str(tmp_path))
    stream = topics.read_topic(spark, "jm", folder=str(tmp_path))
    jobs.dwd(stream, str(tmp_path), f"{tmp_path}/cp", trigger=ONCE).awaitTermination()
    for name in ("dwd_jm_drone", "dwd_jm_drone_bad"):
        sent = spark.read.schema("value string, offset bigint").json(f"{tmp_path}/{name}")
        size = sum(file.stat().st_size for file in (tmp_path / name).rglob("part-*"))
        text = sent.agg(F.sum(F.length("value"))).first()[0]
        assert text > 0 and size < 0.4 * text


def test_a_stretch_is_one_micro_batch_in_as_many_files_as_it_needs(spark, tmp_path, monkeypatch):
    """Compressed files are not split, so a stretch is sent in more files as it grows; micro-batches stay the same."""
    rows = spark.range(1000).select(F.col("id").alias("timestamp"), F.col("id").alias("offset"), F.lit("{}").alias("value"))
    monkeypatch.setattr(queries, "TOPIC_FILE_ROWS", 70)
    steps, files = queries._sent(rows, str(tmp_path), "t", rows.limit(1))
    assert files == 8 and len(steps) == 3
    for send in steps:
        send()
    assert len(list((tmp_path / "t").glob("part-*.json.gz"))) in (17, 18)
    stream, seen = topics.read_topic(spark, "t", folder=str(tmp_path), maxFilesPerTrigger=str(files)), []
    sink = stream.writeStream.foreachBatch(lambda batch, number: seen.append(batch.agg(F.min("offset"), F.max("offset"), F.count("offset")).first()[:]))
    topics.start(sink, "t", f"{tmp_path}/cp", ONCE).awaitTermination()
    assert [tuple(s) for s in seen[:2]] == [(0, 499, 500), (500, 999, 500)] and len(seen) == 3


class _Stopped(Exception):
    pass


def _written(spark):
    """Folders of written tables."""
    from pathlib import Path

    from airtrack.lineage import shared_folder

    return {p.parent for p in Path(shared_folder(spark)).rglob("part-*.parquet")}


@pytest.mark.parametrize("name, query", [("dwd", queries.dwd_stream), ("dws", queries.dws_stream)])
def test_messages_are_made_without_leaving_tables(spark, monkeypatch, name, query):
    """The tables that messages are made from are gone before a stream reads them."""
    def stop(*given, **options):
        raise _Stopped

    before = _written(spark)
    monkeypatch.setattr(jobs, name, stop)
    with pytest.raises(_Stopped):
        query(spark, SCALE)
    assert _written(spark) <= before


def test_a_recovering_stream_leaves_no_tables_of_its_messages(spark, monkeypatch):
    """They are needed until the rest is sent, and gone when the job goes on with it."""
    from types import SimpleNamespace

    before, runs = _written(spark), []

    def dwd(*given, **options):
        runs.append(len(_written(spark) - before))
        if len(runs) == 2:
            raise _Stopped
        return SimpleNamespace(awaitTermination=lambda: None)

    monkeypatch.setattr(jobs, "dwd", dwd)
    with pytest.raises(_Stopped):
        queries.recovery_stream(spark, SCALE)
    assert runs[0] > 0 and runs[1] == 0


@pytest.mark.parametrize("ttl", [None, 6])
def test_windows_in_frames_equal_windows_in_rows(ttl):
    """Nulls in a column of whole numbers change neither them nor large numbers beside them."""
    from types import SimpleNamespace

    import pandas as pd

    from airtrack.streaming.processors import SignalWindowFrames, SignalWindows

    large = 2**60 + 1

    def row(signal, second, reason=None):
        return SimpleNamespace(
            drone_uuid=f"U{signal}", batch_num="B", timestamp=second, offset=None if second is None else large + second * 100 + signal,
            latitude=1.0, longitude=2.0, height=3.0, speed=0.0, utm_x=float(second or 0), utm_y=0.0, payload="{}", reason=reason,
        )

    class Framed(SignalWindowFrames):
        def handleInputRows(self, key, rows, timerValues):
            rows = [vars(r) | {n: None if getattr(r, n) is None else str(getattr(r, n)) for n in ("timestamp", "offset")} for r in rows]
            frames = (pd.DataFrame(rows[at:at + 7]) for at in range(0, len(rows), 7))
            for frame in super().handleInputRows(key, frames, timerValues):
                yield from frame.itertuples(index=False)

        def handleExpiredTimer(self, *given):
            for frame in super().handleExpiredTimer(*given):
                yield from frame.itertuples(index=False)

    parts = [
        (-1, [row(s, t) for t in range(100, 130) for s in range(20)] + [row(1, None, "no start time")]),
        (124_950, [row(s, t) for t in range(130, 150) for s in range(20)] + [row(2, 110)]), (999_950, []),
    ]
    got, want = _closed(Framed(ttl), CountedState(), parts), _closed(SignalWindows(ttl), CountedState(), parts)
    assert len(got) == 20 * 50 + 2 and [tuple(r) for r in got] == [tuple(r) for r in want]
    assert all(isinstance(r.offset, int) for r in got if r.reason != "no start time")


def test_a_filtered_target_leaves_in_frames():
    """What a target gives out is not held until its last row is filtered."""
    from types import SimpleNamespace

    import pandas as pd

    from airtrack.streaming import processors

    n, read = 60_000, []

    def frames():
        for at in range(0, n, 5000):
            read.append(at)
            yield pd.DataFrame({
                "timestamp": [str(i) for i in range(at, at + 5000)], "offset": [str(2**60 + i) for i in range(at, at + 5000)],
                "utm_x": float(at), "utm_y": 2.0, "payload": "{}",
            })

    state = SimpleNamespace(exists=lambda: False, update=lambda value: None)
    one = processors.TargetFilterFrames()
    one.init(SimpleNamespace(getValueState=lambda *args: state))
    out = one.handleInputRows(("f",), frames(), None)
    first = next(out)
    assert len(first) == processors.FRAME_ROWS and list(first["offset"][:2]) == [2**60, 2**60 + 1]
    assert len(first) + sum(map(len, out)) == n and len(read) == n // 5000
