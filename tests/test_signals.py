"""Kinematics, ranking under skew, links, clusters, fusion and tracks against brute force."""

import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airtrack.lineage import pin
from airtrack.operators import components, fusion, kinematics, quality, similarity, track
from airtrack.operators.ranking import numbered
from airtrack.operators.similarity import DIMENSIONS


def feature_nodes(spark, rows):
    return spark.createDataFrame(
        rows, "timestamp bigint, signal_id string, lat_range double, lon_range double, time_range int, avg_speed double, avg_height double"
    )


def random_nodes(spark, seed, seconds=3, signals=60, spread=2.0):
    draw = random.Random(seed)
    rows = [
        (t, f"S{i:04d}", draw.random() * 1e-3, draw.random() * 1e-3, draw.randint(0, 2),
         round(draw.random() * spread, 2), round(draw.random() * spread, 2))
        for t in range(seconds) for i in range(signals)
    ]
    return feature_nodes(spark, rows), rows


def brute_pairs(rows, threshold):
    out = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1:]:
            if a[0] == b[0]:
                s = 1 / (1 + float(np.sqrt(sum((x - y) ** 2 for x, y in zip(a[2:], b[2:])))))
                if s > threshold:
                    out[(a[0], *sorted((a[1], b[1])))] = s
    return out


def brute_clusters(rows, threshold):
    label = {(r[0], r[1]): r[1] for r in rows}
    pairs = brute_pairs(rows, threshold)
    changed = True
    while changed:
        changed = False
        for t, a, b in pairs:
            low = min(label[(t, a)], label[(t, b)])
            for k in ((t, a), (t, b)):
                if label[k] != low:
                    label[k], changed = low, True
    return label


@pytest.mark.parametrize("threshold, task_rows", [(0.8, 4000), (0.8, 3), (0.4, 4000)])
def test_similar_pairs(spark, threshold, task_rows):
    frame, rows = random_nodes(spark, 1)
    got = {(r.timestamp, r.left_signal, r.right_signal): r.similarity for r in similarity.similar_pairs(frame, threshold, task_rows).collect()}
    want = brute_pairs(rows, threshold)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.mark.parametrize("task_rows", [4000, 40, 3])
def test_similar_pairs_of_copies(spark, task_rows):
    """Copies of a vector are compared as one, whatever their number; cells are crowded on both sides."""
    draw = random.Random(5)
    vectors = [(draw.random() * 1e-3, 0.0, draw.randint(0, 1), round(draw.random(), 2), round(draw.random(), 2)) for _ in range(12)]
    rows = [(t, f"S{(i * 37) % 120:04d}", *draw.choice(vectors)) for t in range(2) for i in range(120)]
    frame = feature_nodes(spark, rows)
    pairs = similarity.similar_pairs(frame, 0.8, task_rows, digits=4).collect()
    want = brute_pairs(rows, 0.8)
    assert sorted((r.timestamp, r.left_signal, r.right_signal) for r in pairs) == sorted(want)
    assert all(abs(r.similarity - want[(r.timestamp, r.left_signal, r.right_signal)]) <= 0.5e-4 + 1e-12 for r in pairs)
    assert similarity._classes(frame, 10**6).count() == len({(r[0], *r[2:]) for r in rows})
    held = similarity._classes(frame, 5).select(F.size("signals").alias("n"), "signals")
    assert held.agg(F.max("n")).first()[0] <= 12 and held.agg(F.sum("n")).first()[0] == len(rows)


def test_similarity_is_rounded_as_spark_rounds(spark):
    values = spark.range(200_000).select((0.8 + F.rand(3) / 5).alias("v")).unionByName(
        spark.range(8000, 10001).select(F.explode(F.array(*[(F.col("id") / 1e4 + k).alias("v") for k in (0, 5e-5, 5e-5 + 1e-12, 5e-5 - 1e-12, 1e-17)])).alias("v"))
    )
    assert values.filter(similarity.rounded(F.col("v"), 4) != F.round("v", 4)).isEmpty()


@pytest.mark.parametrize("threshold, small, comparisons", [(0.8, 10**6, 10**6), (0.8, 0, 0), (0.4, 10**6, 4)])
def test_clusters(spark, threshold, small, comparisons):
    frame, rows = random_nodes(spark, 2, spread=3.0)
    got = {(r.timestamp, r.signal_id): r.cluster for r in components.clustered(frame, threshold, small, comparisons).collect()}
    assert got == brute_clusters(rows, threshold)


def test_clusters_at_the_reach(spark):
    """Points exactly one reach apart are not linked; copies and chains are."""
    rows = [(0, f"S{i}", 0.0, 0.0, 1, x, 10.0) for i, x in enumerate([0.0, 0.25, 0.49, 0.49, 0.98, 1.2299])]
    got = {r.signal_id: r.cluster for r in components.clustered(feature_nodes(spark, rows)).collect()}
    assert got == {k[1]: v for k, v in brute_clusters(rows, 0.8).items()}


def test_linked_cells_are_not_compared_member_by_member(spark, monkeypatch):
    """Two crowded cells that box distances leave open, but whose outermost members are similar; a third one out of reach of them."""
    rows = [(0, f"S{i:03d}", 0.0, 0.0, 1, 10.0 + i % 100 * 0.001 + (0.23, 0.0, 0.65)[i // 100], 10.0) for i in range(300)]
    seen, compare = [], components._compared_links
    monkeypatch.setattr(components, "_compared_links", lambda vectors, undecided, threshold: seen.append(undecided) or compare(vectors, undecided, threshold))
    got = {(r.timestamp, r.signal_id): r.cluster for r in components.clustered(feature_nodes(spark, rows)).collect()}
    assert got == brute_clusters(rows, 0.8)
    assert (seen[0].agg(F.sum("comparisons")).first()[0] or 0) == 0


def test_long_chain_in_a_large_second(spark):
    rows = [(0, f"S{(i * 37) % 300:04d}", 0.0, 0.0, 1, i * 0.2, 10.0) for i in range(300)]
    got = components.clustered(feature_nodes(spark, rows), small=0).select("cluster").distinct().collect()
    assert [r.cluster for r in got] == ["S0000"]


def test_one_signal_holding_most_rows_is_ranked_in_slices(spark):
    rows = [("a" if i % 3 else "b", (i * 7919) % 5000, i) for i in range(5000)]
    frame = spark.createDataFrame(rows, "k string, t bigint, id bigint")
    plain = numbered(frame, ["k"], ["t", "id"], "n")
    sliced = numbered(frame, ["k"], ["t", "id"], "n", task_rows=100)
    assert plain.exceptAll(sliced).count() == 0 and sliced.count() == 5000


def test_one_row_window(spark):
    rows = spark.createDataFrame(
        [(1, "U", "B", "I", 1733468357, 124.0, 22.5, 114.0, 7.5)],
        "offset bigint, drone_uuid string, batch_num string, intrusion_start_time string, timestamp bigint, "
        "height double, latitude double, longitude double, speed double",
    )
    row = kinematics.kinematics(rows).first()
    assert tuple(row.feature)[1:] == (0.0, 0.0, 0, 7.5, 124.0)
    assert (row.speed, row.heading, row.start_height) == (7.5, 0.0, 124.0)


@pytest.mark.parametrize("mode", [kinematics.CAUSAL, kinematics.LOOKAHEAD])
def test_kinematics_against_windows_replayed_one_by_one(spark, mode):
    """Replays every overlapping window in order, with state kept across windows in lookahead mode."""
    draw = random.Random(5)
    times = sorted(draw.choices(range(1000, 1030), k=25))
    rows = [
        (i, "U", "B", "I", t, 100.0 + draw.random(), 22.5 + i * 1e-5 + draw.random() * 1e-5, 114.0 + draw.random() * 1e-5, 3.0)
        for i, t in enumerate(times)
    ]
    frame = spark.createDataFrame(
        rows, "offset bigint, drone_uuid string, batch_num string, intrusion_start_time string, timestamp bigint, "
        "height double, latitude double, longitude double, speed double",
    )
    got = {r.offset: r for r in kinematics.kinematics(frame, mode).collect()}
    place = {r.offset: (r.utm_x, r.utm_y) for r in got.values()}
    want, state = {}, None
    real = {}
    for i, r in enumerate(rows):
        if i == 0:
            real[i] = 3.0
        elif r[4] == rows[i - 1][4]:
            real[i] = real[i - 1]
        else:
            (x0, y0), (x1, y1) = place[i - 1], place[i]
            real[i] = float(np.hypot(x1 - x0, y1 - y0)) / (r[4] - rows[i - 1][4])
    for start in range(times[0] - 4, times[-1] + 1):
        inside = [r for r in rows if start <= r[4] < start + 5]
        speeds = []
        for r in inside:
            if mode == kinematics.CAUSAL:
                speed = real[r[0]]
            else:
                if state is None:
                    speed = r[8]
                elif r[4] > state[0]:
                    (x0, y0), (x1, y1) = state[1], place[r[0]]
                    speed = float(np.hypot(x1 - x0, y1 - y0)) / (r[4] - state[0])
                else:
                    speed = state[2]
                state = (r[4], place[r[0]], speed)
            speeds.append(speed)
            if r[4] == start:
                want[r[0]] = speed
        for r in inside:
            if r[4] == start:
                assert got[r[0]].feature.avg_speed == pytest.approx(sum(speeds) / len(speeds), rel=1e-9)
                assert got[r[0]].feature.time_range == max(q[4] for q in inside) - start
    assert {k: pytest.approx(v, rel=1e-9) for k, v in want.items()} == {k: got[k].speed for k in want}


def random_members(spark, seed, seconds=25, signals=9):
    draw = random.Random(seed)
    starts = {f"U{i}": f"9ㆍ{draw.randint(0, 4):03d}" for i in range(signals)}
    rows = []
    for t in range(seconds):
        for name in sorted(starts):
            if draw.random() < 0.6:
                rows.append((t, name, "B", f"C{draw.randint(0, 3)}", starts[name], float(name[1:]), 1.5, float(t % 3)))
    schema = "timestamp bigint, drone_uuid string, batch_num string, cluster string, intrusion_start_time string, start_longitude double, start_latitude double, start_height double"
    return spark.createDataFrame(rows, schema), rows


def replay(rows):
    memory, out = {}, {}
    for t in sorted({r[0] for r in rows}):
        news = {}
        for cluster in {r[3] for r in rows if r[0] == t}:
            inside = sorted((r for r in rows if r[0] == t and r[3] == cluster), key=lambda r: r[1:3])
            known = [memory[r[1]] for r in inside if r[1] in memory]
            pre = min(known, key=lambda m: m[0]) if known else None
            first = min(inside, key=lambda r: r[4])
            own = (first[4], *first[5:])
            chosen = own if pre is None or own[0] < pre[0] else pre
            for r in inside:
                news[r[1]] = chosen
                out[(t, r[1])] = (chosen, memory.get(r[1]))
        memory.update(news)
    return out


def identity(values):
    return hashlib.md5("_".join(map(str, values)).encode()).hexdigest()


@pytest.mark.parametrize("seed", [1, 2])
def test_fusion_equals_second_by_second_replay(spark, seed):
    frame, rows = random_members(spark, seed)
    want = replay(rows)
    got = fusion.fused(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        chosen, before = want[(r.timestamp, r.drone_uuid)]
        assert (r.fusion_start_time, r.fusion_longitude, r.fusion_latitude, r.fusion_height) == chosen
        assert r.fusion_id == identity(chosen)
        assert r.pre_fusion_id == (identity(before) if before else None)


MEMBERS = (
    "timestamp bigint, drone_uuid string, batch_num string, cluster string, intrusion_start_time string, start_longitude double, "
    "start_latitude double, start_height double"
)


def relay(signals, start):
    """Signal after signal takes over for a few seconds each; every one meets the one before in one second."""
    rows = []
    for i in range(signals):
        for t in range(3 * i, 3 * i + 4):
            shared = "C%d" % (t // 3 - (t == 3 * i)) if t % 3 == 0 else "C%d" % i
            rows.append((t, f"U{i:04d}", "B", shared, start(i), float(i), 1.5, 0.0))
    return rows


@pytest.mark.parametrize("start", [lambda i: f"9ㆍ{i:04d}", lambda i: f"9ㆍ{(i * 7919) % 1000:04d}"])
def test_relay_of_500_signals_takes_few_passes(spark, start, monkeypatch):
    rows, passes = relay(500, start), []
    frame = pin(spark.createDataFrame(rows, MEMBERS))
    real = fusion.pin_and_test
    monkeypatch.setattr(fusion, "pin_and_test", lambda *a: passes.append(1) or real(*a))
    want = replay(rows)
    got = fusion.fused(frame).collect()
    assert len(got) == len(rows)
    assert all((r.fusion_start_time, r.fusion_longitude, r.fusion_latitude, r.fusion_height) == want[(r.timestamp, r.drone_uuid)][0] for r in got)
    assert len(passes) <= 60


def test_fusion_in_parts_with_memory(spark):
    frame, rows = random_members(spark, 3)
    whole = {(r.timestamp, r.drone_uuid): (r.fusion_id, r.pre_fusion_id) for r in fusion.fused(frame).collect()}
    first = pin(fusion.fused(frame.filter("timestamp < 11")))
    memory = pin(fusion.remembered(first))
    second = fusion.fused(frame.filter("timestamp >= 11"), memory)
    parts = {(r.timestamp, r.drone_uuid): (r.fusion_id, r.pre_fusion_id) for r in first.collect() + second.collect()}
    assert parts == whole


def test_cluster_quality_in_blocks(spark, clusters):
    whole = quality.cluster_quality(clusters)
    blocks = quality.cluster_quality(clusters, block_vectors=2)
    a = {r.timestamp: (r.clusters, r.quality) for r in whole.collect()}
    b = {r.timestamp: (r.clusters, r.quality) for r in blocks.collect()}
    assert a.keys() == b.keys() and all(a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) < 1e-9 for k in a)


def test_memory_of_a_pair_of_blocks():
    draw = np.random.default_rng(5)
    block = pd.DataFrame(draw.random((2000, 5)), columns=list(similarity.DIMENSIONS))
    block = block.assign(timestamp=0, cluster="S", _own=0, _low=0, _high=0, _copies=1)
    tracemalloc.start()
    weight = next(iter(w for w in quality._sum_blocks(iter([block])) if len(w)))["_weight"].iloc[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    points = block[list(similarity.DIMENSIONS)].to_numpy()
    want = sum((1 / (1 + np.sqrt(((points[i] - points[i + 1:]) ** 2).sum(axis=1)))).sum() for i in range(len(points)))
    assert abs(weight - want) < 1e-6 and peak < 25e6


def test_members_are_counted_from_zero(clusters):
    rows = fusion.cluster_members(clusters).groupBy("timestamp").agg(
        F.min("cluster_index").alias("low"), F.max("cluster_index").alias("high"), F.countDistinct("cluster_index").alias("n")
    )
    assert rows.filter("low <> 0 or high <> n - 1").count() == 0


def matrix_filter(points):
    state = cov = last = None
    H, R, Q = np.eye(2, 4), 1e3 * np.eye(2), 1e2 * np.eye(4)
    out = []
    for t, x, y in points:
        if last is None:
            state, cov = np.array([x, y, 0.0, 0.0]), Q
        else:
            dt = t - last if t > last else 1.0
            A = np.eye(4)
            A[0, 2] = A[1, 3] = dt
            state, cov = A @ state, A @ cov @ A.T + Q
            K = cov @ H.T @ np.linalg.inv(H @ cov @ H.T + R)
            state, cov = state + K @ (np.array([x, y]) - H @ state), cov - K @ H @ cov
        last = t
        out.append((state[0], state[1]))
    return out


@pytest.mark.parametrize("slices", [None, 2, 9])
def test_kalman_equals_matrix_filter(spark, slices):
    draw = random.Random(8)
    tracks = {f"F{k}": sorted((draw.randint(0, 60), i, draw.random() * 500, draw.random() * 500) for i in range(n)) for k, n in enumerate((1, 5, 40, 2, 90))}
    rows = [(i, f, t, x, y) for f, points in tracks.items() for t, i, x, y in points]
    frame = spark.createDataFrame(rows, "offset bigint, fusion_id string, timestamp bigint, utm_x double, utm_y double")
    got = {(r.fusion_id, r.offset): (r.fused_x, r.fused_y) for r in track.kalman(frame, slices=slices).collect()}
    assert len(got) == len(rows)
    for f, points in tracks.items():
        for (t, i, x, y), want in zip(points, matrix_filter([(t, x, y) for t, i, x, y in points])):
            assert got[(f, i)] == pytest.approx(want, abs=1e-8)


def test_one_target_of_300000_rows(spark):
    """Slices, Arrow batches and other targets cut it; the result is that of one row after another."""
    n = 300_000
    frame = spark.range(n + 20).selectExpr(
        "id as offset", f"case when id < {n} then 'M' when id < {n} + 10 then 'A' else 'Z' end as fusion_id",
        "id div 3 + id % 2 as timestamp", "4e6 + 500 * sin(id / 700) + id % 11 as utm_x", "5e5 + id / 9 + id % 7 as utm_y", "id % 5 as other",
    )
    found = track.kalman(frame, slices=8)
    assert found.columns == [*frame.columns, "fused_x", "fused_y", "fused_longitude", "fused_latitude"]
    got = found.select("offset", "fused_x", "fused_y").toPandas().set_index("offset").sort_index()
    rows = frame.toPandas().sort_values(["fusion_id", "timestamp", "offset"])
    state = key = None
    for r in rows.itertuples():
        here = (r.timestamp, r.utm_x, r.utm_y)
        state = track.next_state(state, *here) if r.fusion_id == key else track.first_state(*here)
        key = r.fusion_id
        if r.offset % 97 == 0 or r.offset >= n:
            assert got.loc[r.offset].tolist() == pytest.approx([state[1], state[3]], abs=1e-6)


def test_kalman_of_nothing(spark):
    schema = "offset bigint, fusion_id string, timestamp bigint, utm_x double, utm_y double"
    assert track.kalman(spark.createDataFrame([], schema)).count() == 0
    assert track.kalman(spark.createDataFrame([(1, None, 5, 1.0, 2.0), (2, None, 6, 1.0, 2.0)], schema)).count() == 2


def test_track_defaults(spark):
    frame = spark.createDataFrame(
        [('{"timestamp":5,"intrusion_start_time":"92025ㆍ20241226174202401","scanID":[{"id":"92025"},{},{"id":"7"}]}', 1), ("[]", 2), ("{", 3), ('{"timestamp":5}', 4)],
        "value string, offset bigint",
    )
    parsed = track.parse_fused(frame)
    assert parsed.filter("reason is not null").count() == 3
    row = track.project_tracks(parsed.filter("reason is null")).first()
    assert (row.fusion_id, row.utm_x, row.driverid, row.status, row.companyid) == ("", 0.0, "92025/7", 1, 29570)
    assert row.takeofftime == "2024-12-26 17:42:02"
    assert len(row.asDict()) == 22  # 21 fields and the offset


def test_push_payload_rounds_to_ten_decimals(spark):
    frame = spark.createDataFrame([(1, 0.123456789012345, "x")], "offset bigint, a double, b string")
    assert track.push_payload(frame).first()["payload"] == '{"a":0.123456789,"b":"x"}'


def test_features_only_need_pruned_columns(found):
    plan = kinematics.node_features(found)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and all("event_type" not in s.split("ReadSchema")[1] for s in scans)
    assert set(DIMENSIONS) <= set(kinematics.node_features(found).columns)
