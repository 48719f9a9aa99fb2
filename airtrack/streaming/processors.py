"""Stateful processors: the keyed parts of the batch operators for Structured Streaming."""

from __future__ import annotations

import heapq
import itertools
import math
import pickle
import tempfile
from collections import namedtuple
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from airtrack.operators.track import first_state, next_state
from airtrack.settings import SLIDE_SECONDS, WINDOW_SECONDS

BUCKETS = 4096  # groups that the signals of a stream are dealt into
_SIGNAL = "drone_uuid string, batch_num string"
_ROW = (
    f"{_SIGNAL}, second bigint, offset bigint, latitude double, longitude double, height double, speed double, x double, y double, "
    "payload string"
)
_CHUNK = 4096  # rows that one value of its state holds

WINDOW_OUTPUT = (
    "drone_uuid string, batch_num string, timestamp bigint, offset bigint, payload string, "
    "utm_x double, utm_y double, speed double, heading double, start_latitude double, start_longitude double, "
    "start_height double, curr_batch_first int, lat_range double, lon_range double, time_range int, "
    "avg_speed double, avg_height double, reason string"
)


FILTER_OUTPUT = "fusion_id string, timestamp bigint, offset bigint, payload string, fused_x double, fused_y double"


def _named(ddl: str) -> Row:
    """Row factory with the column names of a flat DDL."""
    return Row(*[column.split()[0] for column in ddl.split(", ")])


LATE = "late"
_WINDOW, _FILTER = _named(WINDOW_OUTPUT), _named(FILTER_OUTPUT)
_UNKNOWN = (None,) * (len(WINDOW_OUTPUT.split(", ")) - 6)  # between the payload and the reason


FRAME_ROWS = 4096  # rows of a frame that goes back to Spark


def _given(frames: Iterable[pd.DataFrame], whole: tuple[str, ...]) -> Iterator[tuple]:
    """Rows of frames by column name; the ``whole`` numbers come as text, because a frame with a null in them would hold floats."""
    for frame in frames:
        row = namedtuple("row", frame.columns)
        columns = (frame[name].tolist() for name in frame.columns)
        yield from map(row, *(
            [v if v is None else int(v) for v in column] if name in whole else column for name, column in zip(frame.columns, columns)
        ))


def _frames(rows: Iterable[tuple], ddl: str) -> Iterator[pd.DataFrame]:
    """Rows in frames of at most :data:`FRAME_ROWS`, with the columns of a flat DDL and nothing converted."""
    rows, names = iter(rows), [column.split()[0] for column in ddl.split(", ")]
    while held := list(itertools.islice(rows, FRAME_ROWS)):
        yield pd.DataFrame(held, columns=names, dtype=object)


class SignalWindows(StatefulProcessor):
    """Five-second windows of the signals of one bucket, each giving out the rows of its first second when it closes.

    State: the rows of seconds whose window is open, and per signal the last position given out with the start position.  What a
    micro-batch adds is appended as columns, and one timer reads it back and closes all windows that are due.  A call to the state
    costs as much as many rows, and its number grows with buckets, micro-batches and signals, not with rows.
    The watermark lags by the window length, so the window that starts at a second closes when the watermark
    passes that second, and a row counts as late only when the watermark has passed it.  Positions are forgotten
    ``ttl_seconds`` of event time after the last row (``None`` keeps them).  With ``lookahead`` a row carries the step of the last
    second before the newest one of its window, as ``kinematics.node_features`` does.  A row with a ``reason`` cannot be used; it
    is given out at once as it is, and so is a row that comes after its window, with the reason ``late``.
    """

    _row = staticmethod(_WINDOW)

    def __init__(self, ttl_seconds: int | None = None, lookahead: bool = False):
        self._ttl = ttl_seconds
        self._lookahead = lookahead

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getListState("open", _as_arrays(_ROW))
        self._last = handle.getMapState(
            "last", _SIGNAL, "timestamp bigint, x double, y double, start_latitude double, start_longitude double, start_height double"
        )
        self._ended = handle.getMapState("ended", "second bigint", _as_arrays(_SIGNAL))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        closed, fresh, earliest = timerValues.getCurrentWatermarkInMs(), [], None
        for row in rows:
            if row.reason is not None or row.timestamp * 1000 <= closed:
                yield self._row(
                    row.drone_uuid, row.batch_num, row.timestamp, row.offset, row.payload, *_UNKNOWN, row.reason or LATE
                )
                continue
            fresh.append((
                row.drone_uuid, row.batch_num, row.timestamp, row.offset, row.latitude, row.longitude, row.height, row.speed,
                row.utm_x, row.utm_y, row.payload,
            ))
            earliest = row.timestamp if earliest is None else min(earliest, row.timestamp)
            if len(fresh) == _CHUNK:
                self._open.appendValue(_as_columns(fresh))
                fresh = []
        if fresh:
            self._open.appendValue(_as_columns(fresh))
        if earliest is not None:
            self._handle.registerTimer(earliest * 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        fired, forget = divmod(expiredTimerInfo.getExpiryTimeInMs(), 1000)
        if forget:
            self._forget(fired - self._ttl)
            return
        watermark = timerValues.getCurrentWatermarkInMs()

        def due(second: int) -> bool:
            return second <= fired or second * 1000 < watermark

        signals: dict[tuple, list[tuple]] = {}
        for held in self._open.get():
            for row in zip(*held):
                signals.setdefault(row[:2], []).append(row[2:])
        if not any(due(row[0]) for rows in signals.values() for row in rows):  # an earlier timer of this micro-batch has closed them
            return
        still, ended = [], {}
        for signal, rows in signals.items():
            window: dict[int, list[tuple]] = {}
            for row in sorted(rows, key=lambda r: r[:2]):
                window.setdefault(row[0], []).append(row)
            closing = [second for second in window if due(second)]
            still += [(*signal, *row) for t, rows_of in window.items() if not due(t) for row in rows_of]
            if closing:
                ended.setdefault(closing[-1], []).append(signal)
                yield from self._close(signal, window, closing)
        if still:
            self._open.put([_as_columns(still[at:at + _CHUNK]) for at in range(0, len(still), _CHUNK)])
            self._handle.registerTimer(min(row[2] for row in still) * 1000)
        else:
            self._open.clear()
        if self._ttl is not None:
            for second, names in ended.items():
                before = self._ended.getValue((second,))
                self._ended.updateValue((second,), _as_columns(names + (list(zip(*before)) if before else [])))
                self._handle.registerTimer((second + self._ttl) * 1000 + 1)

    def _forget(self, second: int) -> None:
        """Forget the signals that have given out nothing since ``second``."""
        names = self._ended.getValue((second,))
        for signal in zip(*names) if names else ():
            last = self._last.getValue(signal)
            if last is not None and last[0] == second:
                self._last.removeKey(signal)
        if names:
            self._ended.removeKey((second,))

    def _close(self, signal: tuple, window: dict[int, list[tuple]], closing: list[int]) -> Iterator[Row]:
        """Rows of the ``closing`` seconds of a signal, which are the first ones of its open ``window``."""
        last, steps, reached, sums = self._last.getValue(signal), {}, {}, {}
        for t, rows in window.items():
            first, final = rows[0], rows[-1]
            if last is None or (self._ttl is not None and t - last[0] > self._ttl):  # its timer comes later in the same micro-batch
                start, steps[t] = first[2:5], (first[5] or 0.0, 0.0)
            else:
                dx, dy, start = first[6] - last[1], first[7] - last[2], last[3:]
                steps[t] = (math.sqrt(dx * dx + dy * dy) / (t - last[0]), math.degrees(math.atan2(dy, dx)) % 360)
            last = reached[t] = (t, *final[6:8], *start)
            latitudes, longitudes = [r[2] for r in rows], [r[3] for r in rows]
            sums[t] = (len(rows), min(latitudes), max(latitudes), min(longitudes), max(longitudes), sum(r[4] for r in rows))
        self._last.updateValue(signal, reached[closing[-1]])
        for second in closing:
            seen = [t for t in range(second, second + WINDOW_SECONDS) if t in window]
            step = steps[second]
            if self._lookahead:
                step = steps[max(t for t in seen if t < second + WINDOW_SECONDS - SLIDE_SECONDS)]
            counts, low_lat, high_lat, low_lon, high_lon, heights = zip(*(sums[t] for t in seen))
            rows = sum(counts)
            features = (
                max(high_lat) - min(low_lat),
                max(high_lon) - min(low_lon),
                seen[-1] - second,
                (step[0] * counts[0] + sum(steps[t][0] * n for t, n in zip(seen[1:], counts[1:]))) / rows,
                sum(heights) / rows,
            )
            for rank, row in enumerate(window[second], start=1):
                yield self._row(*signal, second, row[1], row[8], *row[6:8], *step, *reached[second][3:], rank, *features, None)

    def close(self) -> None:
        pass


class SignalWindowFrames(SignalWindows):
    """The same for ``transformWithStateInPandas``: rows come and go in frames.

    Row by row, Spark converts every cell on its own and keeps all that a call gives out, that is all windows that a partition
    closes, in memory before it sends them on; frames are converted by column and sent one after the other.  ``timestamp`` and
    ``offset`` come as text.
    """

    _row = staticmethod(lambda *values: values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return _frames(super().handleInputRows(key, _given(rows, ("timestamp", "offset")), timerValues), WINDOW_OUTPUT)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return _frames(super().handleExpiredTimer(key, timerValues, expiredTimerInfo), WINDOW_OUTPUT)


def _as_arrays(ddl: str) -> str:
    return ", ".join(f"{name} array<{kind}>" for name, kind in (column.split() for column in ddl.split(", ")))


def _as_columns(rows: list[tuple]) -> tuple[list, ...]:
    return tuple(map(list, zip(*rows)))


SORTED_ROWS = 20_000  # rows of a target that are sorted in memory


def _in_order(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows by their first two fields; of more than :data:`SORTED_ROWS`, sorted runs wait in temporary files."""
    def by(row: tuple) -> tuple:
        return row[:2]

    def waiting(held: list[tuple]) -> Iterator[tuple]:
        with tempfile.TemporaryFile() as file:
            for at in range(0, len(held), 64):
                pickle.dump(held[at:at + 64], file)
            held.clear()
            file.seek(0)
            yield None  # everything is in the file
            while True:
                try:
                    yield from pickle.load(file)
                except EOFError:
                    return

    runs, held = [], []
    for row in rows:
        held.append(row)
        if len(held) == SORTED_ROWS:
            runs.append(waiting(sorted(held, key=by)))
            next(runs[-1])
            held = []
    return heapq.merge(*runs, sorted(held, key=by), key=by)


class TargetFilter(StatefulProcessor):
    """Kalman state of one fused target; rows of a micro-batch are filtered in time and arrival order.

    A target may hold much of a micro-batch, so its rows are sorted outside of memory beyond a size.
    """

    _row = staticmethod(_FILTER)

    def __init__(self, ttl_ms: int | None = None):
        self._ttl = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState(
            "track",
            "last bigint, px double, vx double, py double, vy double, a double, b double, c double",
            self._ttl,
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        state = tuple(self._state.get()) if self._state.exists() else None
        fields = ((row.timestamp, row.offset, row.utm_x, row.utm_y, row.payload) for row in rows)
        for timestamp, offset, x, y, payload in _in_order(fields):
            state = first_state(timestamp, x, y) if state is None else next_state(state, timestamp, x, y)
            yield self._row(*key, timestamp, offset, payload, state[1], state[3])
        self._state.update(state)

    def close(self) -> None:
        pass


class TargetFilterFrames(TargetFilter):
    """The same for ``transformWithStateInPandas``; see :class:`SignalWindowFrames`."""

    _row = staticmethod(lambda *values: values)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        return _frames(super().handleInputRows(key, _given(rows, ("timestamp", "offset")), timerValues), FILTER_OUTPUT)
