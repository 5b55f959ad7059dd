"""Greedy packing of sorted rows, on arrays.

Where a package that opens at row *i* ends depends on the rows from *i* on and on
nothing before, so ``next_starts`` finds it for all rows at once by binary search in
running totals. The packages are then one walk along these links.

A sequence cut into slices is packed slice by slice: ``summarise`` tells for every row
of a slice at which the first package may open what is left open at its end, ``merge``
puts neighbouring summaries together, ``resolve`` hands each slice the package that is
open when it begins, and ``label`` packs a slice from there. A summary covers no more
rows than one package can hold, however large the slice.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np

from logfreight.model import PackOptions

REASONS = ("size", "overflow", "count", "linger", "flush")
SIZE, OVERFLOW, COUNT, LINGER, FLUSH = range(5)
UNKNOWN = -1


@dataclass
class Rows:
    """Rows of one slice in order: arrival, accounting bytes, bytes as an opener, logs."""

    arrival: np.ndarray
    size: np.ndarray
    opening: np.ndarray
    n_logs: np.ndarray
    new_key: np.ndarray

    def __len__(self) -> int:
        return len(self.arrival)


@dataclass
class Open:
    """What is open at a border: parallel arrays, one entry per possible past.

    ``opened`` counts the packages begun so far under ``key``; where ``is_open`` is
    false the last of them is closed and the next row of the key opens another.
    """

    key: tuple
    last_ms: int
    is_open: np.ndarray
    size: np.ndarray
    logs: np.ndarray
    create_ms: np.ndarray
    opened: np.ndarray

    def take(self, which) -> Open:
        cut = (getattr(self, f)[which] for f in ("is_open", "size", "logs", "create_ms", "opened"))
        return Open(self.key, self.last_ms, *cut)


@dataclass
class Slice:
    """Summary of a slice: its head rows and what each way into it leaves open.

    ``head_*`` cover the first run of equal keys up to where any package open before it
    must have closed (arrival, running bytes, running logs). ``exits`` has an entry per
    row of the head at which a package may open, or a single one if the slice has more
    than one run and its end does not depend on its beginning.
    """

    first_key: tuple
    one_run: bool
    run_rows: int
    run_bytes: int
    run_logs: int
    head_ms: np.ndarray
    head_bytes: np.ndarray
    head_logs: np.ndarray
    exits: Open


def nothing_open() -> Open:
    zero = np.zeros(1, dtype=np.int64)
    return Open((), 0, np.zeros(1, dtype=bool), zero, zero, zero, zero)


def next_starts(rows: Rows, limits: PackOptions):
    """Per row: the row at which the package after one opened here starts, why, and when.

    The link is ``len(rows)`` with reason ``UNKNOWN`` where the end is not in the slice.
    """
    n = len(rows)
    row = np.arange(n)
    # Gaps are clipped to the linger time and a new key counts as such a gap: the clock
    # stays monotone over the whole slice and keeps every comparison with the linger time.
    gap = np.minimum(np.diff(rows.arrival, prepend=rows.arrival[:1]), limits.linger_ms)
    gap[rows.new_key] = limits.linger_ms
    clock = np.cumsum(gap)
    filled = np.cumsum(rows.size)
    held = np.cumsum(rows.n_logs)
    held_before = held - rows.n_logs

    by_time = np.searchsorted(clock, clock + limits.linger_ms, "left")
    by_size = np.searchsorted(filled, filled - rows.opening + limits.max_bytes, "right")
    by_count = np.searchsorted(held, held_before + limits.max_logs, "left") + 1
    by_size = np.maximum(by_size, row + 1)
    by_count = np.maximum(by_count, row + 1)
    stop = np.minimum(np.minimum(np.minimum(by_time, by_size), by_count), n)

    at = np.minimum(stop, n - 1)
    bytes_at_stop = rows.opening + filled[at] - filled
    reason = np.where(by_count == stop, COUNT, OVERFLOW)
    fits = (by_size == stop) & (by_count > stop) & (bytes_at_stop < limits.cap_bytes)
    reason = np.where(fits, SIZE, reason)
    reason = np.where(by_time == stop, np.where(rows.new_key[at], FLUSH, LINGER), reason)
    reason = np.where(stop == n, UNKNOWN, reason)
    close_ms = np.select(
        [reason == LINGER, reason == FLUSH],
        [rows.arrival + limits.linger_ms, rows.arrival[np.maximum(stop - 1, 0)]],
        rows.arrival[at],
    )
    return stop + (reason == SIZE), reason, close_ms


def first_close(head_ms, head_bytes, head_logs, before: Open, limits: PackOptions):
    """Row of the head at which a package open before it closes, and why.

    The row is ``len(head)`` with reason ``UNKNOWN`` where it stays open.
    """
    by_time = np.searchsorted(head_ms, before.create_ms + limits.linger_ms, "left")
    by_size = np.searchsorted(head_bytes, limits.max_bytes - before.size, "right")
    by_count = np.searchsorted(head_logs, limits.max_logs - before.logs, "left") + 1
    by_count = np.where(before.logs >= limits.max_logs, 0, by_count)
    n = len(head_ms)
    stop = np.minimum(np.minimum(np.minimum(by_time, by_size), by_count), n)
    at = np.minimum(stop, n - 1)
    reason = np.where(by_count == stop, COUNT, OVERFLOW)
    fits = (by_size == stop) & (by_count > stop)
    fits &= before.size + head_bytes[at] < limits.cap_bytes
    reason = np.where(fits, SIZE, reason)
    reason = np.where(by_time == stop, LINGER, reason)
    reason = np.where(stop == n, UNKNOWN, reason)
    return stop, reason


def summarise(rows: Rows, first_key: tuple, last_key: tuple, limits: PackOptions) -> Slice:
    n = len(rows)
    starts = np.flatnonzero(rows.new_key[1:]) + 1
    one_run = len(starts) == 0
    run_rows = n if one_run else int(starts[0])
    filled = np.cumsum(rows.size[:run_rows])
    held = np.cumsum(rows.n_logs[:run_rows])
    certain = min(
        int(np.searchsorted(rows.arrival[:run_rows], rows.arrival[0] + limits.linger_ms, "left")),
        int(np.searchsorted(filled, limits.max_bytes, "right")),
        int(np.searchsorted(held, limits.max_logs - 1, "left")) + 1,
    )
    head = min(certain + 1, run_rows)

    links, reason, _ = next_starts(rows, limits)
    if one_run:
        ways_in = np.arange(min(head + 1, run_rows))
        opener, hops = _last_openers(links, ways_in)
    else:
        opener, hops = _last_openers(links, starts[-1:])
    total_bytes, total_logs = np.cumsum(rows.size), np.cumsum(rows.n_logs)
    exits = Open(
        last_key,
        int(rows.arrival[-1]),
        reason[opener] == UNKNOWN,
        rows.opening[opener] + total_bytes[-1] - total_bytes[opener],
        total_logs[-1] - total_logs[opener] + rows.n_logs[opener],
        rows.arrival[opener],
        hops + 1,
    )
    return Slice(
        first_key,
        one_run,
        run_rows,
        int(filled[-1]),
        int(held[-1]),
        rows.arrival[:head],
        filled[:head],
        held[:head],
        exits,
    )


def _last_openers(links: np.ndarray, ways_in: np.ndarray):
    """Last package start reached from each way in, and the number of links to it.

    Pointers are doubled until all have arrived, which is a few passes over the slice.
    """
    n = len(links)
    reach = np.where(links < n, links, np.arange(n))
    hops = (links < n).astype(np.int64)
    while True:
        further = reach[reach]
        if np.array_equal(further, reach):
            return reach[ways_in], hops[ways_in]
        hops = hops + hops[reach]
        reach = further


def cross(part: Slice, before: Open, limits: PackOptions):
    """What is open after ``part``; and row, reason of the close of what was open before.

    The row is -1 where nothing was open under the first key of the part.
    """
    n = len(before.is_open)
    entry = np.zeros(n, dtype=np.int64)
    stop = np.full(n, -1)
    reason = np.full(n, UNKNOWN)
    known = before.key == part.first_key
    if known:
        found, why = first_close(part.head_ms, part.head_bytes, part.head_logs, before, limits)
        stop = np.where(before.is_open, found, -1)
        reason = np.where(before.is_open, why, UNKNOWN)
        entry = np.where(before.is_open, found + (why == SIZE), 0)
    if not part.one_run:
        after = part.exits.take(np.zeros(n, dtype=np.int64))
        reason = np.where((stop >= 0) & (reason == UNKNOWN), FLUSH, reason)
        return after, stop, reason

    after = part.exits.take(np.minimum(entry, len(part.exits.opened) - 1))
    if known:
        after.opened = after.opened + before.opened
        ended = entry >= part.run_rows
        carried = ended & (reason == UNKNOWN)
        after.is_open = np.where(ended, carried, after.is_open)
        after.size = np.where(ended, before.size + part.run_bytes, after.size)
        after.logs = np.where(ended, before.logs + part.run_logs, after.logs)
        after.create_ms = np.where(ended, before.create_ms, after.create_ms)
        after.opened = np.where(ended, before.opened, after.opened)
    return after, stop, reason


def merge(parts: list[Slice], limits: PackOptions) -> Slice:
    """One summary for neighbouring slices."""
    first = parts[0]
    run = [first]
    while run[-1].one_run and len(run) < len(parts):
        following = parts[len(run)]
        if following.first_key != first.first_key:
            break
        run.append(following)
    one_run = len(run) == len(parts) and run[-1].one_run

    heads, rows_before, bytes_before, logs_before = [], 0, 0, 0
    for part in run:
        heads.append((part, rows_before, bytes_before, logs_before))
        rows_before += part.run_rows
        bytes_before += part.run_bytes
        logs_before += part.run_logs
        if len(part.head_ms) < part.run_rows:
            break
    if one_run:
        exits = []
        for place, (part, *_) in enumerate(heads):
            state = part.exits
            for following in parts[place + 1 :]:
                state, _, _ = cross(following, state, limits)
            exits.append(state)
        fields = ("is_open", "size", "logs", "create_ms", "opened")
        merged = (np.concatenate([getattr(e, f) for e in exits]) for f in fields)
        state = Open(exits[0].key, exits[0].last_ms, *merged)
    else:
        state = nothing_open()
        for part in parts:
            state, _, _ = cross(part, state, limits)
    return Slice(
        first.first_key,
        one_run,
        sum(p.run_rows for p in run),
        sum(p.run_bytes for p in run),
        sum(p.run_logs for p in run),
        np.concatenate([p.head_ms for p, *_ in heads]),
        np.concatenate([p.head_bytes + b for p, _, b, _ in heads]),
        np.concatenate([p.head_logs + held for p, _, _, held in heads]),
        state,
    )


@dataclass(frozen=True)
class Border:
    """What a slice has to know of its neighbours.

    The package open when it begins, and how the package open at its end will close.
    """

    key: tuple = ()
    last_ms: int = 0
    is_open: bool = False
    size: int = 0
    logs: int = 0
    create_ms: int = 0
    opened: int = 0
    tail_reason: int = FLUSH
    tail_ms: int | None = None

    def state(self) -> Open:
        values = (self.is_open, self.size, self.logs, self.create_ms, self.opened)
        return Open(self.key, self.last_ms, *(np.array([v]) for v in values))

    def dumps(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def loads(text: str) -> Border:
        fields = json.loads(text)
        return Border(**{**fields, "key": tuple(fields["key"])})


def resolve(parts: list[Slice], outer: Border, limits: PackOptions) -> list[Border]:
    """The borders of neighbouring slices from the border around them all."""
    state = outer.state()
    borders: list[Border] = []
    waiting: list[int] = []
    for place, part in enumerate(parts):
        borders.append(
            Border(
                state.key,
                int(state.last_ms),
                bool(state.is_open[0]),
                int(state.size[0]),
                int(state.logs[0]),
                int(state.create_ms[0]),
                int(state.opened[0]),
            )
        )
        after, stop, reason = cross(part, state, limits)
        if waiting:
            why, when = int(reason[0]), None
            if state.key != part.first_key:
                why, when = FLUSH, state.last_ms
            elif why == FLUSH:
                # Not closed in the last run of its key: that run's last arrival.
                when = int(part.head_ms[-1])
            elif why == LINGER:
                when = int(state.create_ms[0]) + limits.linger_ms
            elif why != UNKNOWN:
                when = int(part.head_ms[stop[0]])
            if why != UNKNOWN:
                for w in waiting:
                    borders[w] = replace(borders[w], tail_reason=why, tail_ms=when)
                waiting = []
        state = after
        if state.is_open[0]:
            waiting.append(place)
    for w in waiting:
        when = state.last_ms if outer.tail_ms is None else outer.tail_ms
        borders[w] = replace(borders[w], tail_reason=outer.tail_reason, tail_ms=int(when))
    return borders


def label(rows: Rows, first_key: tuple, border: Border, limits: PackOptions):
    """Per row: number of its package under its key, and when and why that one closes."""
    n = len(rows)
    links, reason, close_ms = next_starts(rows, limits)
    known = border.key == first_key
    begin = 0
    lead = None
    if known and border.is_open:
        run_rows = np.flatnonzero(rows.new_key[1:])
        run_rows = int(run_rows[0]) + 1 if len(run_rows) else n
        filled = np.cumsum(rows.size[:run_rows])
        held = np.cumsum(rows.n_logs[:run_rows])
        stop, why = first_close(rows.arrival[:run_rows], filled, held, border.state(), limits)
        stop, why = int(stop[0]), int(why[0])
        begin = stop + (why == SIZE)
        if why == UNKNOWN and run_rows < n:
            lead = (FLUSH, int(rows.arrival[run_rows - 1]))
        elif why == UNKNOWN:
            lead = (border.tail_reason, border.tail_ms or 0)
        elif why == LINGER:
            lead = (why, border.create_ms + limits.linger_ms)
        else:
            lead = (why, int(rows.arrival[stop]))

    starts = []
    at = begin
    hop = links.tolist()
    while at < n:
        starts.append(at)
        at = hop[at]
    starts = np.array(starts, dtype=np.int64)

    package = np.searchsorted(starts, np.arange(n), "right")  # 0 is the carried package
    opens_key = rows.new_key[starts]
    if len(starts) and starts[0] == 0:
        opens_key[0] = not known
    order = np.arange(1, len(starts) + 1)
    base = np.maximum.accumulate(np.where(opens_key, order - 1, 0))
    number = order - base
    if known:
        number[~np.logical_or.accumulate(opens_key)] += border.opened

    why = reason[starts]
    when = close_ms[starts]
    if len(starts) and why[-1] == UNKNOWN:
        why[-1] = border.tail_reason
        when[-1] = border.tail_ms if border.tail_ms is not None else rows.arrival[-1]
    create = rows.arrival[starts]

    def with_lead(first, values):
        return np.concatenate([np.array([first], dtype=np.int64), values])[package]

    lead_reason, lead_ms = lead or (UNKNOWN, 0)
    return (
        with_lead(border.opened, number),
        with_lead(border.create_ms, create),
        with_lead(lead_ms, when),
        with_lead(lead_reason, why),
    )

