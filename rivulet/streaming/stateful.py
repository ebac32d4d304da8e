"""Keyed stateful processors for Structured Streaming.

Both run under ``transformWithStateInPandas`` in ``EventTime`` mode: Spark
shuffles rows by key, keeps per-key state in the (RocksDB) state store with
the query's checkpoint, and calls the processor once per key per
micro-batch with that key's new rows.

The click cap counts in arrival order (sorted by (event time, seq) inside a
micro-batch) per UTC day, and keeps each open day's count: rows of two days may
interleave. The login rule takes rows in event-time order: they wait in state
until the watermark passes them, so any input whose disorder stays within the
watermark delay gives the batch operator's result.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from rivulet.functions.reports import BLACKLIST_MESSAGE, LOGIN_WARNING_MESSAGE, seconds_text

DAY_MS = 86_400_000

CLICK = ("user_id", "ad_id", "province", "city", "ts", "event_time", "seq")
CLICK_COLUMNS = (*CLICK, "nulls")
CLICK_NUMBERS = ("user_id", "ad_id", "ts", "seq")  # bits 0 to 3 of ``nulls``
NO_SEQ = 1 << CLICK_NUMBERS.index("seq")

CAP_OUTPUT = ("user_id long, ad_id long, province string, city string, ts long, event_time timestamp, seq long, "
              "kind string, msg string")
CAP_MARKED = CAP_OUTPUT.replace("kind", "nulls int, kind")
LOGIN_OUTPUT = ("user_id long, first_fail_time long, last_fail_time long, first_seq long, fail_count long, msg string, "
                "event_time timestamp")


def _us(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


class ClickCapProcessor(StatefulProcessor):
    """Per (user, ad): the first ``max_count + 1`` clicks of a UTC day pass; click max+2 warns once.

    A key of the stream is a shard of the (user, ad) pairs, so a micro-batch costs a call and some state
    requests per shard and day, not per pair. State: day -> clicks counted (up to the cap) and a warned flag of
    each pair of the shard, packed as ``PAIRS``. An event-time timer at the end of a day removes its entry (the
    reference's processing-time reset, made repeatable). Of a pair and day no more than ``max_count + 2`` rows of
    a micro-batch are held. Output rows are tagged ``kind`` = 'pass' | 'warn'.

    Rows are ``CLICK_COLUMNS`` with 0 for a missing number and a bit for it in ``nulls``: pandas would turn a column
    with a null into doubles. Pairs with a null user or ad are in shards of their own, so values alone tell pairs apart.
    """

    PAIRS = np.dtype([("user_id", "<i8"), ("ad_id", "<i8"), ("count", "<i8"), ("warned", "?")])
    HELD = 200_000  # rows to collect before those over the cap are let go

    def __init__(self, max_count: int = 100):
        self.max_count = max_count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.days = handle.getMapState("days", "day long", "pairs binary")

    def _first(self, pdf: pd.DataFrame) -> pd.DataFrame:
        """In order, the rows that can pass or warn: ``n`` counts those of a pair and day from 0."""
        pdf = pdf.assign(day=_us(pdf["event_time"]) // (DAY_MS * 1000), no_seq=pdf["nulls"] & NO_SEQ)
        pdf = pdf.sort_values(["event_time", "no_seq", "seq"], kind="mergesort", ignore_index=True)
        pdf["n"] = pdf.groupby(["day", "user_id", "ad_id"], sort=False).cumcount()
        return pdf[pdf["n"] < self.max_count + 2]

    def _pairs(self, day: int) -> pd.DataFrame | None:
        if not self.days.containsKey((day,)):
            return None
        return pd.DataFrame(np.frombuffer(self.days.getValue((day,))[0], self.PAIRS)).assign(day=day)

    def _keep(self, day: int, pairs: pd.DataFrame) -> None:
        packed = np.empty(len(pairs), self.PAIRS)
        for c in self.PAIRS.names:
            packed[c] = pairs[c].to_numpy()
        self.days.updateValue((day,), (packed.tobytes(),))

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        parts, held, first = [], 0, 0
        for pdf in rows:
            if len(pdf):
                parts.append(pdf)
                held += len(pdf)
            if held > 2 * first + self.HELD:
                parts = [self._first(pd.concat(parts, ignore_index=True))]
                held = first = len(parts[0])
        if not parts:
            return
        pdf = self._first(pd.concat(parts, ignore_index=True))
        pair = ["day", "user_id", "ad_id"]
        known = []
        for d in pdf["day"].unique().tolist():
            pairs = self._pairs(d)
            if pairs is None:
                self.handle.registerTimer((d + 1) * DAY_MS)
            else:
                known.append(pairs)
        here = pdf.groupby(pair, sort=False).agg(count=("n", "size")).reset_index().assign(warned=False)
        before = pd.concat([*known, here.assign(count=0)], ignore_index=True).drop_duplicates(pair)  # the known one first
        at = pdf[pair].merge(before, "left", pair)  # keeps the order of the rows
        room = np.maximum(self.max_count + 1 - at["count"].to_numpy(np.int64), 0)
        n = pdf["n"].to_numpy()
        keep, warn = n < room, (n == room) & ~at["warned"].to_numpy(bool)
        now = pd.concat([before, here, pdf[warn][pair].assign(count=0, warned=True)], ignore_index=True)
        now = now.groupby(pair, sort=False).agg(count=("count", "sum"), warned=("warned", "max")).reset_index()
        now["count"] = now["count"].clip(upper=self.max_count + 1)
        for d, pairs in now.groupby("day"):
            self._keep(int(d), pairs)
        if keep.any() or warn.any():
            yield _tagged(pdf[keep], pdf[warn], self.max_count, CLICK_COLUMNS)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Rows of ``operators.patterns.click_cap_state``: what a table of earlier clicks left."""
        for day, pairs in initialState.groupby("day"):
            before = self._pairs(int(day))
            if before is None:
                self.handle.registerTimer((int(day) + 1) * DAY_MS)
            else:
                pairs = pd.concat([before, pairs], ignore_index=True)
            self._keep(int(day), pairs.drop_duplicates(["user_id", "ad_id"], keep="last"))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = (expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 1,)  # each day has its own timer
        if self.days.containsKey(day):
            self.days.removeKey(day)
        return iter([])

    def close(self) -> None:
        pass


class ClickCapResetProcessor(StatefulProcessor):
    """The click cap with the reference's own reset: counts run until the next reset of the processing clock.

    The first click of a (user, ad) fixes its reset, the next multiple of ``reset_ms`` on the clock of the machine (UTC
    midnight for a day). State is the count, the warned flag and that reset; a processing-time timer clears it, and its
    time to live removes it where no timer fires any more. Rows of a micro-batch are handled before its timers, so a
    reset that has passed is also noticed here. The result depends on when rows arrive: ``ClickCapProcessor`` is the
    form whose result repeats.
    """

    def __init__(self, max_count: int = 100, reset_ms: int = DAY_MS):
        self.max_count, self.reset_ms = max_count, reset_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cap = handle.getValueState("cap", "count long, warned boolean, reset long", 2 * self.reset_ms)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        state = tuple(self.cap.get()) if self.cap.exists() else None
        if state is None or state[2] <= now:
            state = (0, False, (now // self.reset_ms + 1) * self.reset_ms)
            self.handle.registerTimer(state[2])
        count, warned, reset = state
        for pdf in rows:
            if pdf.empty:
                continue
            pdf = pdf.sort_values(["event_time", "seq"], kind="mergesort")
            room = max(self.max_count + 1 - count, 0)
            yield _tagged(pdf.iloc[:room], pdf.iloc[room:room + 1] if not warned else pdf.iloc[:0], self.max_count)
            warned = warned or len(pdf) > room
            count = min(count + len(pdf), self.max_count + 1)
        self.cap.update((count, warned, reset))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.cap.exists() and self.cap.get()[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.cap.clear()
        return iter([])

    def close(self) -> None:
        pass


def _tagged(passed: pd.DataFrame, warned: pd.DataFrame, max_count: int, columns=CLICK) -> pd.DataFrame:
    out = pd.concat([passed.assign(kind="pass", msg=None), warned.assign(kind="warn", msg=BLACKLIST_MESSAGE % max_count)], ignore_index=True)
    return out[[*columns, "kind", "msg"]]


class LoginFailProcessor(StatefulProcessor):
    """Per user: an episode opens at a fail t0, holds fails <= t0+W, warns at close if >= N; a non-fail cancels.

    A key of the stream is a shard of the users, so a micro-batch costs a call and some state requests per shard, not per
    user. Rows without a user (shard -1) take no part, as in ``operators.patterns.login_fail_episodes``. State: the rows the watermark has not passed yet, in chunks of at
    most ``CHUNK`` rows in time order, the chunks' numbers and first times, and the shard's open episodes
    (user, t0, first seq, count, last fail). A timer at the earliest waiting row (or at the end of the first open episode)
    folds every row at or before the watermark in (event time, seq) order; it reads and rewrites only the chunks that are due.
    """

    ROWS = np.dtype([("user", "<i8"), ("us", "<i8"), ("seq", "<i8"), ("fail", "?")])
    CHUNKS = np.dtype([("number", "<i8"), ("us", "<i8")])
    OPEN = np.dtype([("user", "<i8"), ("t0", "<i8"), ("s0", "<i8"), ("n", "<i8"), ("tl", "<i8")])
    CHUNK = 8192
    HELD = 262_144  # rows to collect before they are put into state

    def __init__(self, max_fails: int = 2, within_ms: int = 2000, fail_value: str = "fail"):
        self.max_fails = max_fails
        self.w_us = within_ms * 1000
        self.fail_value = fail_value
        self.seconds = seconds_text(timedelta(milliseconds=within_ms))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "number long", "rows binary")
        self.chunks = handle.getValueState("chunks", "chunks binary")
        self.episodes = handle.getValueState("episodes", "open binary")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues: TimerValues) -> None:
        """Rows of ``operators.patterns.login_open_episodes``: the episodes that a table of earlier rows left open."""
        new = np.empty(len(initialState), self.OPEN)
        for name, column in zip(self.OPEN.names, ("user_id", "t0", "s0", "n", "tl")):
            new[name] = initialState[column].to_numpy()
        episodes = np.concatenate([self._packed(self.episodes, self.OPEN), new])
        self._pack(self.episodes, episodes)
        self._set_timer(self._packed(self.chunks, self.CHUNKS), episodes)

    @staticmethod
    def _packed(state, dtype: np.dtype) -> np.ndarray:
        return np.frombuffer(state.get()[0], dtype) if state.exists() else np.empty(0, dtype)

    @staticmethod
    def _pack(state, values: np.ndarray) -> None:
        if len(values):
            state.update((values.tobytes(),))
        elif state.exists():
            state.clear()

    def _hold(self, chunks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """``chunks`` with those that ``rows`` make."""
        rows = rows[np.argsort(rows["us"], kind="stable")]
        number = int(chunks["number"].max()) + 1 if len(chunks) else 0
        new = []
        for at in range(0, len(rows), self.CHUNK):
            self.waiting.updateValue((number,), (rows[at:at + self.CHUNK].tobytes(),))
            new.append((number, int(rows["us"][at])))
            number += 1
        return np.concatenate([chunks, np.array(new, self.CHUNKS)])

    def _set_timer(self, chunks: np.ndarray, episodes: np.ndarray) -> None:
        """One timer at the first millisecond after which a waiting row or an open episode is due."""
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [int(chunks["us"].min())] if len(chunks) else []
        if len(episodes):
            due.append(int(episodes["t0"].min()) + self.w_us)
        if due:
            self.handle.registerTimer(min(due) // 1000 + 1)

    def _rows(self, pdf: pd.DataFrame) -> np.ndarray:
        if pdf["seq"].hasnans:
            raise ValueError("a login row without seq has no place in the order")
        rows = np.empty(len(pdf), self.ROWS)
        rows["user"], rows["us"], rows["seq"] = pdf["user_id"].to_numpy(), _us(pdf["event_time"]), pdf["seq"].to_numpy()
        rows["fail"] = (pdf["event_type"] == self.fail_value).to_numpy(bool)
        return rows

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            return iter([])
        chunks, parts, held = self._packed(self.chunks, self.CHUNKS), [], 0
        for pdf in rows:
            if len(pdf):
                parts.append(self._rows(pdf))
                held += len(pdf)
            if held > self.HELD:
                chunks, parts, held = self._hold(chunks, np.concatenate(parts)), [], 0
        if parts:
            chunks = self._hold(chunks, np.concatenate(parts))
        self._pack(self.chunks, chunks)
        self._set_timer(chunks, self._packed(self.episodes, self.OPEN))
        return iter([])

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        chunks = self._packed(self.chunks, self.CHUNKS)
        due, chunks = chunks["number"][chunks["us"] < mark].tolist(), chunks[chunks["us"] >= mark]
        rows = [np.frombuffer(self.waiting.getValue((n,))[0], self.ROWS) for n in due]
        rows = np.concatenate(rows) if rows else np.empty(0, self.ROWS)
        ready, rest = rows[rows["us"] < mark], rows[rows["us"] >= mark]
        ready = ready[np.lexsort([ready[c] for c in ("fail", "seq", "us", "user")])]
        held = self._packed(self.episodes, self.OPEN)
        episodes, closed = {ep[0]: ep[1:] for ep in held.tolist()}, []
        for user, us, seq, fail in ready.tolist():
            ep = episodes.pop(user, None)
            if ep is not None and us > ep[0] + self.w_us:  # the episode's window has passed: close it
                closed.append((user, *ep))
                ep = None
            if fail:  # any non-fail inside the window cancels the episode
                episodes[user] = (us, seq, 1, us) if ep is None else (ep[0], ep[1], ep[2] + 1, us)
        for user, ep in list(episodes.items()):
            if ep[0] + self.w_us < mark:
                closed.append((user, *episodes.pop(user)))
        for n in due:
            self.waiting.removeKey((n,))
        if len(rest):
            chunks = self._hold(chunks, rest)
        self._pack(self.chunks, chunks)
        still = np.array([(user, *ep) for user, ep in episodes.items()], self.OPEN)
        self._pack(self.episodes, still)
        self._set_timer(chunks, still)
        out = [ep for ep in closed if ep[3] >= self.max_fails]
        if out:
            yield self._warnings(out, mark + 1000)

    def _warnings(self, episodes: list[tuple], at_us: int) -> pd.DataFrame:
        """``at_us``: the rows' event time, just after the watermark that closed the episodes."""
        return pd.DataFrame({
            "user_id": [ep[0] for ep in episodes],
            "first_fail_time": [ep[1] // 1_000_000 for ep in episodes], "last_fail_time": [ep[4] // 1_000_000 for ep in episodes],
            "first_seq": [ep[2] for ep in episodes], "fail_count": [ep[3] for ep in episodes],
            "msg": [LOGIN_WARNING_MESSAGE % (self.seconds, ep[3]) for ep in episodes],
            "event_time": pd.Timestamp(at_us, unit="us")})

    def close(self) -> None:
        pass
