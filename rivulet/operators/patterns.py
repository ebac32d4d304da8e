"""Keyed pattern operators on batch data.

Streaming forms of T1/T2 and T4 live in ``rivulet.streaming.stateful``; they
implement the same rules with keyed state and timers.

Order inside a key is always (event time, seq): deterministic, unlike the
reference's arrival order.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions.reports import blacklist_message, login_warning_message
from rivulet.functions.timefmt import duration_ms
from rivulet.operators.windows import _col, _key_cols, _null_safe_on
from rivulet.session import materialize

DAY_MS = 86_400_000
HOUR_MS = 3_600_000


@dataclass
class CapResult:
    passed: DataFrame  # rows under the cap, unchanged
    warnings: DataFrame  # one row per key and day that went over it


def click_cap(df: DataFrame, key_cols=("user_id", "ad_id"), time_col: str = "event_time", seq_col: str = "seq",
              max_count: int = 100) -> CapResult:
    """T1 + T2: per key and UTC day, the first ``max_count + 1`` clicks pass.

    The reference tests ``count > max`` before adding, so click max+1 still
    passes and click max+2 raises the once-a-day warning; later clicks are
    dropped silently. It resets at processing-time midnight; here the day is
    the event's UTC date, so results repeat.

    Both outputs are ``row_number`` filters, which Catalyst runs as
    ``WindowGroupLimit`` before the shuffle: a key with a third of all clicks
    ships at most max+2 rows per map task, never the whole key.
    """
    keys = _key_cols(key_cols)
    day = F.floor(F.unix_seconds(_col(time_col)) / F.lit(86_400))  # the UTC day, whatever the session's zone
    w = Window.partitionBy(*keys, day).orderBy(_col(time_col), F.col(seq_col))
    passed = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= max_count + 1).drop("_rn")
    warned = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == max_count + 2)
    warnings = warned.select(*keys, F.unix_seconds(_col(time_col)).alias("ts"), blacklist_message(max_count).alias("msg"))
    return CapResult(passed, warnings)


def _is_fail(type_col: str, fail_value: str) -> Column:
    return F.coalesce(F.col(type_col) == F.lit(fail_value), F.lit(False))


def login_fail_bursts(df: DataFrame, user_col: str = "user_id", time_col: str = "event_time", seq_col: str = "seq",
                      type_col: str = "event_type", fail_value: str = "fail", within="2 seconds",
                      min_fails: int = 2, block=None) -> DataFrame:
    """Each fail that starts >= ``min_fails`` fails within ``within`` (closed), no success between.

    Equivalent SQL: ``seg = sum(non_fail) OVER (user ORDER BY t, seq)``, then
    ``count(fail) OVER (user, seg ORDER BY t RANGE BETWEEN CURRENT ROW AND W FOLLOWING)``.

    A user's rows are not one partition: time is cut into blocks (default
    max(W, 1 hour)) and each block also receives the rows of the first W after
    its end (a halo), which is all a frame starting in the block can reach.
    Partitions are (user, block), so a user holding a third of all rows is
    spread over its blocks.
    Rows without a user or a time take no part. Output: user, first_fail_time,
    last_fail_time (epoch s), first_seq, fail_count.
    """
    w_us = duration_ms(within) * 1000
    b_us = (duration_ms(block) if block is not None else max(duration_ms(within), HOUR_MS)) * 1000
    us = F.unix_micros(_col(time_col))
    base = df.select(F.col(user_col).alias("_u"), us.alias("_us"), F.col(seq_col).alias("_seq"),
                     _is_fail(type_col, fail_value).alias("_fail")).where("_u IS NOT NULL AND _us IS NOT NULL")
    home = F.floor(F.col("_us") / F.lit(b_us))
    first_halo = F.ceil((F.col("_us") - F.lit(w_us)) / F.lit(b_us)) - 1
    # home block plus every block whose halo [end, end + W] holds the row
    copies = base.select("*", home.alias("_home"), F.explode(F.sequence(F.least(first_halo, home), home)).alias("_blk"))
    wseg = Window.partitionBy("_u", "_blk").orderBy("_us", "_seq")
    segd = copies.withColumn("_seg", F.sum(F.when(F.col("_fail"), 0).otherwise(1)).over(
        wseg.rowsBetween(Window.unboundedPreceding, 0)))
    frame = Window.partitionBy("_u", "_blk", "_seg").orderBy("_us").rangeBetween(0, w_us)
    counted = segd.select(
        "*",
        F.count(F.when(F.col("_fail"), 1)).over(frame).alias("_n"),
        F.max(F.when(F.col("_fail"), F.col("_us"))).over(frame).alias("_last_us"),
    )
    out = counted.where(F.col("_fail") & (F.col("_blk") == F.col("_home")) & (F.col("_n") >= min_fails))
    return out.select(
        F.col("_u").alias(user_col),
        F.floor(F.col("_us") / 1_000_000).alias("first_fail_time"),
        F.floor(F.col("_last_us") / 1_000_000).alias("last_fail_time"),
        F.col("_seq").alias("first_seq"),
        F.col("_n").alias("fail_count"),
    )


_EPISODE_SCHEMA = T.StructType([
    T.StructField("_u", T.LongType()),
    T.StructField("first_us", T.LongType()),
    T.StructField("last_us", T.LongType()),
    T.StructField("first_seq", T.LongType()),
    T.StructField("fail_count", T.LongType()),
])


_RUN = ["_u", "_run_us", "_run_seq"]
_RUN_BLOCK = _RUN + ["_rblk"]

_EXITS_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in
                              _RUN_BLOCK + ["cand_us", "cand_seq", "exit_us", "exit_seq"]])


def _complete_groups(batches, keys: list[str]):
    """Sorted Arrow batches -> frames of complete groups; only an unfinished group is carried over."""
    carry: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        last = pdf.iloc[-1]
        tail = np.ones(len(pdf), dtype=bool)
        for k in keys:
            tail &= (pdf[k] == last[k]).to_numpy()
        head = pdf[~tail]
        if len(head):
            yield pd.concat(carry + [head]) if carry else head
            carry = []
        carry.append(pdf[tail])
    if carry:
        yield pd.concat(carry)


def _groups(pdf: pd.DataFrame, keys: list[str]):
    """Group index per row and group start/end offsets of a frame sorted by ``keys``."""
    n = len(pdf)
    brk = np.zeros(n, dtype=bool)
    brk[0] = True
    for k in keys:
        v = pdf[k].to_numpy()
        brk[1:] |= v[1:] != v[:-1]
    gid = np.cumsum(brk) - 1
    starts = np.flatnonzero(brk)
    return gid, starts, np.append(starts[1:], n)


def _successors(us: np.ndarray, gid: np.ndarray, starts: np.ndarray, w_us: int, span: int) -> np.ndarray:
    """Per row, the first row of its own group later than t + W (group end if none), for all groups at once.

    Times are rebased per group and groups laid ``span`` apart (span > a
    group's time range + W), so one ``searchsorted`` never crosses a group.
    """
    key = (us - us[starts][gid]) + gid * span
    return np.searchsorted(key, key + w_us, side="right")


def _nullable(values: np.ndarray, valid: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(values.astype("int64"), ~valid)


def _block_exits(batches, w_us: int, b_us: int):
    """Pass 1, per (run, block): from every possible entry fail, where the greedy chain leaves the block.

    Rows are the block's fails plus a halo of the next block's first 2W,
    sorted by time (home rows first). The entry of block 0 is the run's first
    fail; that of block b > 0 lies in its first 2W. All candidate chains of
    all groups in a batch are walked together.
    """
    span = b_us + 3 * w_us + 1
    for pdf in _complete_groups(batches, _RUN_BLOCK):
        gid, gs, ge = _groups(pdf, _RUN_BLOCK)
        us, seq = pdf["_us"].to_numpy(), pdf["_seq"].to_numpy()
        halo = pdf["_halo"].to_numpy(dtype=bool)
        run_us, blk = pdf["_run_us"].to_numpy(), pdf["_rblk"].to_numpy()
        home_end = gs + np.add.reduceat((~halo).astype(np.int64), gs)
        succ = _successors(us, gid, gs, w_us, span)
        idx = np.arange(len(pdf))
        cand = ~halo & np.where(blk == 0, idx == gs[gid], us <= run_us + blk * b_us + 2 * w_us)
        cands = np.flatnonzero(cand)
        pos, he = cands.copy(), home_end[gid[cands]]
        active = pos < he
        while active.any():
            pos[active] = succ[pos[active]]
            active = pos < he
        has_exit = pos < ge[gid[cands]]
        safe = np.where(has_exit, pos, 0)
        out = pdf.iloc[cands][_RUN_BLOCK].reset_index(drop=True)
        out["cand_us"], out["cand_seq"] = us[cands], seq[cands]
        out["exit_us"] = _nullable(us[safe], has_exit)
        out["exit_seq"] = _nullable(seq[safe], has_exit)
        yield out


def _block_entries(exits: DataFrame) -> DataFrame:
    """(run, block, entry) of every block that its run's chain enters, by pointer doubling.

    A candidate of block b points to its exit, a candidate of block b + 1. The chain starts at block 0's one candidate.
    Round i adds what the blocks reached so far point to over 2^i blocks and squares the pointers, so the number of rounds
    is the logarithm of the longest run's blocks, and every round is a join of (run, block, candidate) rows: no task
    follows a run.
    """
    exits = materialize(exits, "run-exits")
    last = exits.agg(F.max("_rblk")).first()[0] or 0
    reached = exits.where("_rblk = 0").select(*_RUN_BLOCK, F.col("cand_us").alias("entry_us"), F.col("cand_seq").alias("entry_seq"))
    pointers = exits.where("exit_us is not null").select(
        *_RUN_BLOCK, F.col("cand_us").alias("entry_us"), F.col("cand_seq").alias("entry_seq"),
        (F.col("_rblk") + 1).alias("to_blk"), F.col("exit_us").alias("to_us"), F.col("exit_seq").alias("to_seq"))
    place, target = ["_rblk", "entry_us", "entry_seq"], ["to_blk", "to_us", "to_seq"]
    step = 1
    while step <= last:
        r, p = reached.alias("r"), pointers.alias("p")
        hop = r.join(p, _null_safe_on("r", "p", _RUN, place)).select(
            *[F.col(f"r.{c}").alias(c) for c in _RUN], *[F.col(f"p.{t}").alias(c) for c, t in zip(place, target)])
        reached = materialize(reached.unionByName(hop), "run-entries")
        step *= 2
        if step <= last:
            a, b = pointers.alias("a"), pointers.alias("b")
            on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _RUN] + [F.col(f"a.{t}") == F.col(f"b.{c}") for c, t in zip(place, target)]
            pointers = materialize(a.join(b, on).select(
                *[F.col(f"a.{c}").alias(c) for c in [*_RUN, *place]], *[F.col(f"b.{t}").alias(t) for t in target]), "run-pointers")
    return reached


def _block_episodes(batches, w_us: int, min_fails: int, b_us: int):
    """Pass 2, per (run, block): walk the chain from the block's entry and emit its episodes.

    An episode counts the fails in [t0, t0+W] (the halo holds those past the
    block end). The run's last episode is cancelled by the run's trailing
    non-fail at or before t0+W. All groups of a batch are walked together.
    """
    span = b_us + 3 * w_us + 1
    for pdf in _complete_groups(batches, _RUN_BLOCK):
        gid, gs, ge = _groups(pdf, _RUN_BLOCK)
        us, seq = pdf["_us"].to_numpy(), pdf["_seq"].to_numpy()
        halo = pdf["_halo"].to_numpy(dtype=bool)
        home_end = gs + np.add.reduceat((~halo).astype(np.int64), gs)
        succ = _successors(us, gid, gs, w_us, span)
        is_entry = (us == pdf["entry_us"].to_numpy()) & (seq == pdf["entry_seq"].to_numpy())
        pos = np.flatnonzero(is_entry)  # one per group, in group order
        grp = gid[pos]
        starts = []
        active = pos < home_end[grp]
        while active.any():
            starts.append(pos[active])
            pos[active] = succ[pos[active]]
            active = pos < home_end[grp]
        s_idx = np.concatenate(starts) if starts else np.array([], dtype=np.int64)
        q = succ[s_idx]
        n = q - s_idx
        reset = pdf["_reset_us"].to_numpy(dtype="float64")[s_idx]  # NaN: the run has no trailing non-fail
        cancelled = (q == ge[gid[s_idx]]) & ~np.isnan(reset) & (reset <= us[s_idx] + w_us)
        keep = (n >= min_fails) & ~cancelled
        s_idx, q, n = s_idx[keep], q[keep], n[keep]
        yield pd.DataFrame({"_u": pdf["_u"].to_numpy()[s_idx], "first_us": us[s_idx], "last_us": us[q - 1],
                            "first_seq": seq[s_idx], "fail_count": n}).astype("int64")


def _fold_runs_by_blocks(runs: DataFrame, w_us: int, min_fails: int, b_us: int) -> DataFrame:
    """Greedy episodes of every run, with no run gathered into one task.

    Consecutive episode starts are more than W apart and a run has no gap
    over W, so the first start inside a block of length B > 2W lies in the
    block's first 2W. Pass 1 finds, per (run, block), the exit of the chain
    from each such candidate; pointer doubling over those exits
    (``_block_entries``) fixes each block's entry; pass 2 re-walks every block
    from its entry. Rows are split by (run, block) throughout.
    """
    runs = materialize(runs, "runs")  # both passes read them
    fails = runs.where("_fail").select(*_RUN, "_us", "_seq")
    resets = runs.where(~F.col("_fail")).groupBy(*_RUN).agg(F.min("_us").alias("_reset_us"))
    off = F.col("_us") - F.col("_run_us")
    home = F.floor(off / F.lit(b_us))
    in_head = (home >= 1) & (off - home * b_us <= 2 * w_us)  # also the previous block's halo
    copies = fails.select("*", home.alias("_home"), F.explode(F.sequence(
        home - F.when(in_head, 1).otherwise(0), home)).alias("_rblk"))
    copies = copies.select(*_RUN, "_rblk", "_us", "_seq", (F.col("_rblk") != F.col("_home")).alias("_halo"))

    def by_block(df):
        return df.repartition(*_RUN_BLOCK).sortWithinPartitions(*_RUN_BLOCK, "_us", "_seq")

    exits = by_block(copies).mapInPandas(lambda it: _block_exits(it, w_us, b_us), schema=_EXITS_SCHEMA)
    entries = _block_entries(exits)
    # null-safe joins infer no isnotnull filters, so this branch keeps the same plan as pass 1's and
    # shares its scan and shuffles
    c, e = copies.alias("c"), entries.alias("e")
    walked = c.join(e, _null_safe_on("c", "e", _RUN_BLOCK, [])).select("c.*", "e.entry_us", "e.entry_seq")
    w, r = walked.alias("w"), resets.alias("r")
    walked = w.join(r, _null_safe_on("w", "r", _RUN, []), "left").select("w.*", "r._reset_us")
    return by_block(walked).mapInPandas(lambda it: _block_episodes(it, w_us, min_fails, b_us), schema=_EPISODE_SCHEMA)


def _episodes(df: DataFrame, user_col: str, time_col: str, seq_col: str, type_col: str, fail_value: str, within, min_fails: int,
              block, run_block) -> DataFrame:
    """Uncancelled episodes of at least ``min_fails`` fails: _u, first_us, last_us, first_seq, fail_count."""
    w_us = duration_ms(within) * 1000
    b_us = duration_ms(block) * 1000
    base = df.select(F.col(user_col).alias("_u"), F.unix_micros(_col(time_col)).alias("_us"),
                     F.col(seq_col).alias("_seq"), _is_fail(type_col, fail_value).alias("_fail")
                     ).where("_u IS NOT NULL AND _us IS NOT NULL")
    # hashed by (user, block) once: the window below needs exactly this, and every branch that
    # reads `base` then shares the exchange (one scan, ReusedExchange) instead of re-reading the input
    base = base.withColumn("_blk", F.floor(F.col("_us") / F.lit(b_us))).repartition("_u", "_blk")
    row = F.struct("_us", "_seq", "_fail")

    # last row of each (user, block), and the last row of the previous non-empty block
    blocks = base.groupBy("_u", "_blk").agg(F.max(row).alias("_last"))
    wb = Window.partitionBy("_u").orderBy("_blk")
    blocks = blocks.select("_u", "_blk", F.lag("_last").over(wb).alias("_carry"))

    wi = Window.partitionBy("_u", "_blk").orderBy("_us", "_seq")
    a, b = base.alias("a"), blocks.alias("b")
    joined = a.join(b, _null_safe_on("a", "b", ["_u"], ["_blk"])).select("a.*", "b._carry")
    prev = F.coalesce(F.lag(row).over(wi), F.col("_carry"))
    flagged = joined.withColumn("_prev", prev)
    starts = flagged.withColumn(
        "_start",
        F.col("_fail") & (F.col("_prev").isNull() | ~F.col("_prev._fail") | (F.col("_us") - F.col("_prev._us") > w_us)),
    )
    # a run holds its fails plus the first non-fail right after one of them
    members = starts.where(F.col("_fail") | F.coalesce(F.col("_prev._fail"), F.lit(False)))

    # run id = (us, seq) of the latest run start at or before the row, forward-filled across blocks
    start_key = F.when(F.col("_start"), F.struct("_us", "_seq"))
    in_block = members.withColumn("_run", F.last(start_key, ignorenulls=True).over(
        wi.rowsBetween(Window.unboundedPreceding, 0)))
    block_last_start = (members.where("_start").groupBy("_u", "_blk").agg(F.max(F.struct("_us", "_seq")).alias("_ls")))
    m, ls = members.select("_u", "_blk").distinct().alias("m"), block_last_start.alias("ls")
    fill = (m.join(ls, _null_safe_on("m", "ls", ["_u"], ["_blk"]), "left")
            .select("m._u", "m._blk", "ls._ls")
            .select("_u", "_blk", F.last("_ls", ignorenulls=True).over(
                wb.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry_run")))
    c, d = in_block.alias("c"), fill.alias("d")
    runs = c.join(d, _null_safe_on("c", "d", ["_u"], ["_blk"])).select(
        "c._u", "c._us", "c._seq", "c._fail", F.coalesce(F.col("c._run"), F.col("d._carry_run")).alias("_run"))
    runs = runs.select("_u", "_us", "_seq", "_fail", F.col("_run._us").alias("_run_us"),
                       F.col("_run._seq").alias("_run_seq"))

    rb_us = (duration_ms(run_block) * 1000) if run_block is not None else max(4 * w_us, 3_600_000_000)
    if rb_us <= 2 * w_us:
        raise ValueError("run_block must be longer than twice `within`")
    return _fold_runs_by_blocks(runs, w_us, min_fails, rb_us)


def login_fail_episodes(df: DataFrame, user_col: str = "user_id", time_col: str = "event_time", seq_col: str = "seq",
                        type_col: str = "event_type", fail_value: str = "fail", within="2 seconds",
                        min_fails: int = 2, block="1 hour", run_block=None) -> DataFrame:
    """T4: the reference's timer rule in event time, deterministic.

    An episode opens at a fail t0 when none is open, holds the fails with
    t <= t0+W, and at close warns if it holds >= ``min_fails``; any non-fail
    at t <= t0+W cancels it.

    The state is empty after any non-fail and before any fail more than W
    after the previous row, so the input splits into independent *runs* (a
    fail after such a break, the fails that follow within W of each other, and
    the one non-fail that may end them). Finding runs needs each row's
    predecessor: inside (user, hour-block) partitions by ``lag``, and for a
    block's first row from a per-(user, block) summary of last rows - a table
    of one row per block, so no partition ever holds a whole user.

    Each run is then folded by ``_fold_runs_by_blocks``: a run (a burst of
    fails with no W-long pause, possibly huge) is cut into blocks of
    ``run_block`` (default max(4W, 1 hour)), whose entries are found by
    doubling. The Python passes are ``mapInPandas`` over hash-partitioned, sorted data, so the
    Python cost is per batch of rows, not per group.
    Rows without a user or a time take no part.
    Output: user, first_fail_time, last_fail_time (epoch s), first_seq, fail_count, msg.
    """
    episodes = _episodes(df, user_col, time_col, seq_col, type_col, fail_value, within, min_fails, block, run_block)
    return episodes.select(
        F.col("_u").alias(user_col),
        F.floor(F.col("first_us") / 1_000_000).alias("first_fail_time"),
        F.floor(F.col("last_us") / 1_000_000).alias("last_fail_time"),
        "first_seq", "fail_count",
        login_warning_message("fail_count", within).alias("msg"),
    )


def login_open_episodes(df: DataFrame, cut, user_col: str = "user_id", time_col: str = "event_time", seq_col: str = "seq",
                        type_col: str = "event_type", fail_value: str = "fail", within="2 seconds") -> DataFrame:
    """The episodes of a table of all rows before ``cut`` (a TIMESTAMP column expression) that later rows can still change:
    user, t0, s0, n, tl (microseconds), the state a stream that goes on from ``cut`` starts with."""
    w_us = duration_ms(within) * 1000
    found = _episodes(df, user_col, time_col, seq_col, type_col, fail_value, within, 1, "1 hour", None)
    return found.where(F.col("first_us") + w_us >= F.unix_micros(cut)).select(
        F.col("_u").alias(user_col), F.col("first_us").alias("t0"), F.col("first_seq").alias("s0"), F.col("fail_count").alias("n"), F.col("last_us").alias("tl"))


def click_cap_state(clicks: DataFrame, max_count: int = 100, keys=("user_id", "ad_id"), time_col: str = "event_time") -> DataFrame:
    """What the click cap remembers after a table of clicks: keys, day, count, warned."""
    us = F.unix_micros(_col(time_col))
    day = ((us - F.pmod(us, F.lit(86_400_000_000))) / 86_400_000_000).cast("long")
    return clicks.groupBy(*keys, day.alias("day")).agg(F.count("*").alias("_n")).select(
        *keys, "day", F.least(F.col("_n"), F.lit(max_count + 1)).alias("count"), (F.col("_n") > max_count + 1).alias("warned"))
