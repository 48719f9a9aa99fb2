"""Target tracks: projection of fused records, constant-velocity Kalman filter, push payload."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from airtrack import schemas
from airtrack.functions import clock, text
from airtrack.functions.geo import with_lonlat
from airtrack.lineage import pin
from airtrack.settings import COMPANY_ID, TRACK_STATUS, UTM_ZONE

# Fixed values of the filter model.
OBSERVATION_VARIANCE = 1e3
PROCESS_VARIANCE = 1e2


def parse_fused(messages: DataFrame) -> DataFrame:
    """Fused records from their JSON text; ``reason`` is set for text that holds no usable record.

    Numbers are read as text and cast: a number that is not one gives the record a reason instead of a default.
    """
    carried = [c for c in messages.columns if c != "value"]
    fields = T.StructType.fromDDL(schemas.DWD).fields
    numbers = {f.name: f.dataType for f in fields if isinstance(f.dataType, T.NumericType)}
    as_text = T.StructType([T.StructField(f.name, T.StringType() if f.name in numbers else f.dataType) for f in fields])
    parsed = messages.select(*carried, F.from_json(text.strip_control(F.col("value")), as_text).alias("_j"))
    values, spoiled = [], F.lit(False)
    for f in fields:
        field = F.col("_j")[f.name]
        if f.name not in numbers:
            values.append(field.alias(f.name))
            continue
        number = text.finite(field) if isinstance(f.dataType, T.DoubleType) else field.try_cast(f.dataType)
        if isinstance(f.dataType, T.IntegralType):
            number = F.coalesce(number, field.try_cast("double").try_cast(f.dataType))
        values.append(number.alias(f.name))
        spoiled = spoiled | (field.isNotNull() & number.isNull())
    read = text.computed_once(parsed.select(*carried, F.col("_j").isNull().alias("_none"), *values, spoiled.alias("_spoiled")))
    bad = F.col("_none") | F.col("timestamp").isNull() | clock.takeoff_text(F.col("intrusion_start_time")).isNull()
    reason = F.when(bad, F.lit("no usable record")).when(F.col("_spoiled"), F.lit("bad number")).alias("reason")
    return text.computed_once(read.select(*carried, *[f.name for f in fields], reason))


def project_tracks(records: DataFrame, company: int = COMPANY_ID) -> DataFrame:
    """The 21 track columns (plus ``offset`` when present); missing values get the format's defaults."""

    def of(name: str, default, alias: str | None = None):
        return F.coalesce(F.col(name), F.lit(default)).alias(alias or name)

    ids = F.filter(F.transform("scanID", lambda scan: scan["id"]), lambda i: i.isNotNull())
    return records.select(
        *[c for c in ("offset",) if c in records.columns],
        of("fusion_id", ""),
        F.coalesce(F.col("timestamp"), F.lit(0).cast("bigint")).alias("timestamp"),
        of("utm_x", 0.0),
        of("utm_y", 0.0),
        of("latitude", 0.0),
        of("longitude", 0.0),
        of("speed", 0.0),
        of("height", 0.0),
        of("heading", 0.0),
        of("model", ""),
        of("drone_uuid", ""),
        F.lit(TRACK_STATUS).alias("status"),
        of("batch_num", "", "batchno"),
        clock.takeoff_text(F.col("intrusion_start_time")).alias("takeofftime"),
        of("start_longitude", 0.0, "takeofflongitude"),
        of("start_latitude", 0.0, "takeofflatitude"),
        of("driverlongitude", 0.0),
        of("driverlatitude", 0.0),
        F.lit(company).alias("companyid"),
        of("station_id", ""),
        F.coalesce(F.array_join(ids, "/"), F.lit("")).alias("driverid"),
    )


def first_state(timestamp: int, x: float, y: float) -> tuple:
    """State of a target after its first row: last time, position and velocity per axis, shared covariance."""
    return timestamp, x, 0.0, y, 0.0, PROCESS_VARIANCE, 0.0, PROCESS_VARIANCE


def next_state(state: tuple, timestamp: int, x: float, y: float) -> tuple:
    """One predict-and-update step; the two axes share their covariance because the model treats them alike."""
    last, px, vx, py, vy, a, b, c = state
    dt = float(timestamp - last)
    if dt <= 0:
        dt = 1.0
    a, b, c = a + 2 * dt * b + dt * dt * c + PROCESS_VARIANCE, b + dt * c, c + PROCESS_VARIANCE
    k1, k2 = a / (a + OBSERVATION_VARIANCE), b / (a + OBSERVATION_VARIANCE)
    px, py = px + dt * vx, py + dt * vy
    rx, ry = x - px, y - py
    return (
        timestamp, px + k1 * rx, vx + k2 * rx, py + k1 * ry, vy + k2 * ry,
        a - k1 * a, b - k1 * b, c - k2 * b,
    )


def kalman(
    tracks: DataFrame,
    order: tuple[str, ...] = ("timestamp", "offset"),
    zone: int = UTM_ZONE,
    slices: int | None = None,
) -> DataFrame:
    """Add the filtered position (``fused_x/y`` and ``fused_longitude/latitude``) per ``fusion_id``.

    The steps of the filter compose associatively (Saerkkae and Garcia-Fernandez 2021), so the filter is a prefix scan.  Rows are
    dealt in slices of even size by target and time, however many rows one target has, and every slice is scanned on its own.  What
    is then open is the state in which the first target of a slice comes in: a chain over one summary per slice, and one closed
    formula per row.  ``slices`` sets their number, else Spark does.
    """
    by = ["fusion_id", *order]
    dealt = tracks.repartitionByRange(*by) if slices is None else tracks.repartitionByRange(slices, *by)
    ranged = dealt.sortWithinPartitions(*by).withColumn("_slice", F.spark_partition_id())
    schema = T.StructType([
        *ranged.schema.fields, T.StructField("_row", T.LongType()), T.StructField("_open", T.BooleanType()),
        T.StructField("fused_x", T.DoubleType()), T.StructField("fused_y", T.DoubleType()),
        T.StructField("_element", T.ArrayType(T.DoubleType())),
    ])
    scanned = pin(ranged.mapInArrow(_scan_slice(to_arrow_schema(schema)), schema))
    last = F.struct("fusion_id", "timestamp", "_element")
    ends = scanned.groupBy("_slice").agg(
        F.min_by(F.struct("fusion_id", "timestamp", "utm_x", "utm_y"), "_row").alias("first"),
        F.max_by(last, F.when(F.col("_open"), F.col("_row"))).alias("open"),
        F.max_by(last, "_row").alias("last"),
    )
    flat = ends.select("_slice", "first.*", *(F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in ("open", "last") for c in ("fusion_id", "timestamp", "_element")))
    chained = flat.repartition(1).sortWithinPartitions("_slice").mapInPandas(
        _chain, "_slice int, " + ", ".join(f"{name} double" for name in _STATE)
    )
    joined = scanned.join(F.broadcast(chained), "_slice")
    x, y = _entered()
    filtered = joined.select(
        *tracks.columns, F.when(F.col("_open"), x).otherwise(F.col("fused_x")).alias("fused_x"),
        F.when(F.col("_open"), y).otherwise(F.col("fused_y")).alias("fused_y"),
    )
    return with_lonlat(filtered, "fused_x", "fused_y", "fused_longitude", "fused_latitude", zone)


#: State of the first target of a slice after the slice's first row.
_STATE = ("_px", "_vx", "_py", "_vy", "_a", "_b", "_c")
_UNIT = np.eye(2)[:, :, None]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of 2 x 2 matrices that lie along the last axis."""
    return a[:, 0, None] * b[None, 0] + a[:, 1, None] * b[None, 1]


def _turned(a: np.ndarray) -> np.ndarray:
    return a.swapaxes(0, 1)


def _compose(first: tuple, second: tuple) -> tuple:
    """Elements (A, b, C, eta, J) of runs of steps that follow each other."""
    a1, b1, c1, e1, j1 = first
    a2, b2, c2, e2, j2 = second
    k = _UNIT + _times(c1, j2)
    inverse = np.array([[k[1, 1], -k[0, 1]], [-k[1, 0], k[0, 0]]]) / (k[0, 0] * k[1, 1] - k[0, 1] * k[1, 0])
    forward, onward = _times(a2, inverse), _times(inverse, a1)
    return (
        _times(forward, a1),
        _times(forward, b1 + _times(c1, e2)) + b2,
        _times(_times(forward, c1), _turned(a2)) + c2,
        _times(_turned(onward), e2 - _times(j2, b1)) + e1,
        _times(_times(_turned(onward), j2), a1) + j1,
    )


def _prefixes(elements: tuple) -> tuple:
    """Every run of steps from the first one on; pairs are composed first, so the work is twice the number of rows."""
    n = elements[0].shape[2]
    if n == 1:
        return elements
    even = n // 2 * 2
    pairs = _prefixes(_compose(tuple(m[..., 0:even:2] for m in elements), tuple(m[..., 1:even:2] for m in elements)))
    out = tuple(np.empty((2, 2, n)) for _ in elements)
    odd = _compose(tuple(m[..., : (n - 1) // 2] for m in pairs), tuple(m[..., 2::2] for m in elements))
    for whole, one, two, three in zip(out, elements, pairs, odd):
        whole[..., 0], whole[..., 1::2], whole[..., 2::2] = one[..., 0], two, three
    return out


def _elements(dt: np.ndarray, x: np.ndarray, y: np.ndarray, starts: np.ndarray) -> tuple:
    """One element per row; a row that starts a target forgets what was before."""
    n, spread = len(dt), PROCESS_VARIANCE + OBSERVATION_VARIANCE
    gain = PROCESS_VARIANCE / spread
    dt = np.where(dt <= 0, 1.0, dt)
    zero, one, z = np.zeros(n), np.ones(n), np.stack([x, y])
    go = ~starts
    return (
        np.array([[one * (1 - gain), (1 - gain) * dt], [zero, one]]) * go,
        np.array([np.where(starts, z, gain * z), np.zeros((2, n))]),
        np.array([[np.where(starts, 1.0, 1 - gain), zero], [zero, one]]) * PROCESS_VARIANCE,
        np.array([z, dt * z]) / spread * go,
        np.array([[one, dt], [dt, dt * dt]]) / spread * go,
    )


def _scan_slice(layout: pa.Schema):
    """Scan the sorted rows of a slice batch by batch; rows of its first target keep their element, because it may have begun earlier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, key, time, rows, is_open, held = None, None, None, 0, True, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if held is not None:
                yield _made(held, layout, False)
            ids = batch.column("fusion_id")
            codes = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            starts = np.diff(codes, prepend=codes[:1]) != 0
            starts[0] = rows > 0 and ids[0].as_py() != key
            times = batch.column("timestamp").to_numpy(zero_copy_only=False)
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("utm_x", "utm_y"))
            elements = _elements(np.diff(times, prepend=times[:1] if time is None else time).astype(float), x, y, starts)
            if not rows:  # whatever comes in is in the state after the first row
                for matrix, value in zip(elements, (_UNIT, 0, 0, 0, 0)):
                    matrix[..., :1] = value
            found = _prefixes(elements)
            found = found if total is None else _compose(total, found)
            total = tuple(m[..., -1:] for m in found)
            opened = np.logical_and(is_open, np.cumsum(starts) == 0)
            held = (batch, rows, opened, found)
            rows, is_open, key, time = rows + n, bool(opened[-1]), ids[n - 1].as_py(), times[-1:]
        if held is not None:
            yield _made(held, layout, True)

    return run


def _made(held: tuple, layout: pa.Schema, final: bool) -> pa.RecordBatch:
    batch, rows, opened, found = held
    n = batch.num_rows
    kept = opened.copy()
    kept[-1] |= final
    flat = np.concatenate([m.reshape(4, n) for m in found])[:, kept]
    ends = np.concatenate([[0], np.cumsum(kept) * len(flat)]).astype(np.int32)
    elements = pa.ListArray.from_arrays(
        pa.array(ends, mask=np.append(~kept, False)), pa.array(flat.T.ravel())
    )
    return pa.record_batch([
        *batch.columns, pa.array(np.arange(rows, rows + n)), pa.array(opened), pa.array(found[1][0, 0]), pa.array(found[1][0, 1]), elements
    ], schema=layout)


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """State after the first row of each slice.  One summary per slice arrives, in order, and one state is kept."""
    key = time = state = None
    for batch in batches:
        out = []
        for row in batch.itertuples(index=False):
            here = (row.timestamp, row.utm_x, row.utm_y)
            same = state is not None and row.fusion_id == key
            state = next_state((time, *state), *here)[1:] if same else first_state(*here)[1:]
            out.append((row._0, *state))
            px, vx, py, vy, a, b, c = state
            start = (np.zeros((2, 2, 1)), np.array([[px, py], [vx, vy]])[..., None], np.array([[a, b], [b, c]])[..., None]) + (np.zeros((2, 2, 1)),) * 2
            run = _compose(start, tuple(np.asarray(row.open__element, float).reshape(5, 2, 2, 1)))
            key, time = row.open_fusion_id, row.open_timestamp
            if row.last_fusion_id != key:
                run = tuple(np.asarray(row.last__element, float).reshape(5, 2, 2, 1))
                key, time = row.last_fusion_id, row.last_timestamp
            mean, spread = run[1][..., 0], run[2][..., 0]
            state = (mean[0, 0], mean[1, 0], mean[0, 1], mean[1, 1], spread[0, 0], spread[0, 1], spread[1, 1])
        yield pd.DataFrame(out, columns=["_slice", *_STATE])


def _entered() -> tuple:
    """Filtered position of a row of a slice's first target: its element applied to the state that comes in."""
    a00, a01, _, _, b00, b01, _, _, _, _, _, _, e00, e01, e10, e11, j00, j01, j10, j11 = (F.col("_element")[i] for i in range(20))
    ca, cb, cc = (F.col(c) for c in ("_a", "_b", "_c"))
    k00, k01 = 1 + ca * j00 + cb * j10, ca * j01 + cb * j11
    k10, k11 = cb * j00 + cc * j10, 1 + cb * j01 + cc * j11

    def axis(place: str, velocity: str, e0, e1, b):
        w0, w1 = F.col(place) + ca * e0 + cb * e1, F.col(velocity) + cb * e0 + cc * e1
        v0, v1 = k11 * w0 - k01 * w1, k00 * w1 - k10 * w0
        return (a00 * v0 + a01 * v1) / (k00 * k11 - k01 * k10) + b

    return axis("_px", "_vx", e00, e10, b00), axis("_py", "_vy", e01, e11, b01)


def push_payload(tracks: DataFrame) -> DataFrame:
    """One JSON text per track row with every floating number rounded to ten decimals."""
    columns = [
        F.round(field.name, 10).alias(field.name) if isinstance(field.dataType, T.DoubleType) else F.col(field.name)
        for field in tracks.schema.fields
        if field.name != "offset"
    ]
    return tracks.select(
        *[c for c in ("offset",) if c in tracks.columns], F.to_json(F.struct(*columns)).alias("payload")
    )
