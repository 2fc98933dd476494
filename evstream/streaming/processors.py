"""Keyed state and timers: processors for ``groupBy(key).transformWithState``.

Two families. :class:`ArrivalProcessor` handles rows as they come, sorted within a micro-batch.
:class:`EventOrderProcessor` holds rows back until the watermark has passed them and handles
them in event-time order, so its results equal those of the operators on tables. Rows reach a
processor with their event time in ``_us`` (microseconds), added by :mod:`.jobs`.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Row, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from evstream.streaming import packs

DAY_US = 86_400_000_000
RUN_ROWS = 4096


def _ms_up(us: int) -> int:
    return -(-us // 1000)


class Processor(StatefulProcessor):
    """A processor that knows the names of its output columns, set before it is started."""

    columns: tuple[str, ...] = ()

    def row(self, *values) -> Row:
        return Row(*self.columns)(*values)

    def close(self) -> None:
        pass


class ArrivalProcessor(Processor):
    """Rows in order of arrival; within a micro-batch in the order of the ``order`` fields.

    The rows one key has in a micro-batch are sorted in memory: bound the batch with the trigger
    options of the source (``maxBytesPerTrigger``, ``maxOffsetsPerTrigger``).
    """

    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open(handle)

    def open(self, handle: StatefulProcessorHandle) -> None:
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self.on_rows(key, sorted(rows, key=lambda r: tuple(r[c] for c in self.order)))

    def on_rows(self, key, rows: list[Row]) -> Iterator[Row]:
        raise NotImplementedError


class KeyedReduce(ArrivalProcessor):
    """The running pairwise reduce: puts out the new value after every row.

    ``pick`` takes the value tuple of a row, ``combine`` joins the held value and a new one.
    """

    def __init__(self, order, fields: T.StructType, pick: Callable, combine: Callable, emit: Callable):
        super().__init__(order)
        self.fields, self.pick, self.combine, self.emit = fields, pick, combine, emit

    def open(self, handle):
        self.held = handle.getValueState("held", self.fields)

    def on_rows(self, key, rows):
        held = tuple(self.held.get()) if self.held.exists() else None
        for row in rows:
            value = self.pick(row)
            held = value if held is None else self.combine(held, value)
            yield self.row(*self.emit(key, row, held))
        self.held.update(held)


class SliceCarry(Processor):
    """What the slices of a key start from: partial folds of the slices in (``slice``, ``value``), and
    out, for each slice of the micro-batch in order, the fold of all that came before. Holds a value for
    each slice of one micro-batch; the state is one value."""

    def __init__(self, value: str, fold: Callable):
        self.value, self.fold = value, fold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "v bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        parts: dict[int, int | None] = {}
        for row in rows:
            parts[row["_slice"]] = _folded(self.fold, parts.get(row["_slice"]), row[self.value])
        held = self.held.get()[0] if self.held.exists() else None
        for number in sorted(parts, key=lambda n: (n is not None, n)):
            yield self.row(*key, number, held)
            held = _folded(self.fold, held, parts[number])
        if held is not None:
            self.held.update((held,))


def _folded(fold: Callable, a, b):
    return b if a is None else a if b is None else fold(a, b)


class SliceFold(ArrivalProcessor):
    """The running fold within a slice, from the row that says what it starts from (``_carried``). Keeps
    nothing: rows of a later micro-batch bring what they start from with them."""

    def __init__(self, order, value: str, fold: Callable):
        super().__init__(order)
        self.value, self.fold = value, fold

    def open(self, handle):
        pass

    def handleInputRows(self, key, rows, timerValues):
        held, own = None, []
        for row in rows:
            if row["_carried"]:
                held = row[self.value]
            else:
                own.append((tuple((row[c] is not None, row[c]) for c in self.order), row[self.value]))
        for place, value in sorted(own, key=lambda x: x[0]):
            held = _folded(self.fold, held, value)
            yield self.row(*key, *[v for _, v in place], held)


class EarlyTotal(ArrivalProcessor):
    """The total so far, put out after every micro-batch that adds to it, with its number. State
    is kept for ``forget`` milliseconds after its last change, or for good."""

    def __init__(self, value: str, forget: int | None):
        super().__init__([value])
        self.value, self.forget = value, forget

    def open(self, handle):
        self.held = handle.getValueState("held", "firing bigint, total bigint", self.forget)

    def handleInputRows(self, key, rows, timerValues):
        firing, total = self.held.get() if self.held.exists() else (0, None)
        for row in rows:
            if row[self.value] is not None:
                total = (total or 0) + row[self.value]
        self.held.update((firing + 1, total))
        yield self.row(*key, firing + 1, total)


class CountWindow(ArrivalProcessor):
    """Every ``every``-th row puts out the sum of the last ``size`` rows or fewer. With ``size``
    equal to ``every`` this is the tumbling count window."""

    def __init__(self, order, value: str, size: int, every: int):
        super().__init__(order)
        self.value, self.size, self.every = value, size, every

    def open(self, handle):
        self.seen = handle.getValueState("seen", "n bigint")
        self.last = handle.getListState("last", "v bigint")

    def on_rows(self, key, rows):
        n = self.seen.get()[0] if self.seen.exists() else 0
        last = [v[0] for v in self.last.get()]
        for row in rows:
            n += 1
            last = (last + [row[self.value]])[-self.size :]
            if n % self.every == 0:
                yield self.row(*key, n // self.every, sum(v for v in last if v is not None))
        self.seen.update((n,))
        self.last.put([(v,) for v in last])


class Changelog(Processor):
    """The updates of a running sum: retract the old total, insert the new one. Key: the sum's key and a
    slice of its order. The slice's rows come as packs of the ``order`` columns and ``_v``, with a row
    without a pack whose ``_v`` says what the slice starts from. Updates go out as a pack. Keeps nothing:
    rows of a later micro-batch bring what they start from with them."""

    def __init__(self, order: Sequence[str], having: Callable[[int], bool] | None = None):
        self.order, self.having = list(order), having

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        start, own = None, []
        for row in rows:
            if row[packs.ROWS] is None:
                start = row["_v"]
            else:
                own.append(packs.unpack(row[packs.ROWS]))
        t = pa.concat_tables(own) if own else None
        t = None if t is None else t.filter(pc.is_valid(t["_v"]))
        if t is None or not t.num_rows:
            return
        if self.order:
            places = [(c, "ascending") for c in self.order]
            t = t.take(pc.sort_indices(t, sort_keys=places, null_placement="at_start"))
        new = pc.cumulative_sum_checked(t["_v"], start=pa.scalar(start or 0, pa.int64())).combine_chunks()
        old = pa.concat_arrays([pa.array([start], pa.int64()), new[:-1]])
        kept = pa.concat_arrays([self._kept(old), self._kept(new)])
        changed = pc.fill_null(pc.not_equal(old, new), True)
        kept = pc.and_(kept, pa.concat_arrays([changed, changed]))
        # An old total stands before the new one.
        both = np.arange(2 * len(new)).reshape(2, -1).T.ravel()
        both = both[kept.to_numpy(zero_copy_only=False)[both]]
        if len(both):
            ids = t.select(self.order).take(pa.array(both % len(new)))
            totals = pa.concat_arrays([old, new]).take(pa.array(both))
            yield self.row(*key, packs.pack(ids.append_column("inserted", pa.array(both >= len(new))).append_column("_total", totals)))

    def _kept(self, totals: pa.Array) -> pa.Array:
        if self.having is None:
            return pc.is_valid(totals)
        return pa.array([v is not None and bool(self.having(v)) for v in totals.to_pylist()], pa.bool_())


class EventOrderProcessor(Processor):
    """Rows of a key in event-time order, each handled once the watermark has passed it.

    Subclasses declare ``state`` (what they remember between rows), and give ``on_row`` and,
    if they wait for something not to happen, ``on_time`` and ``deadline``.
    """

    state: str = "n bigint"
    initial: tuple = (None,)

    def __init__(self, fields: T.StructType, order: Sequence[str]):
        # The order's first field is the event time in microseconds.
        self.fields, self.order = fields, list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows wait in sorted runs of bounded length, found by the order fields of their first
        # row, so that neither a batch nor the waiting rows of a key are ever held at once.
        first = T.StructType([self.fields[c] for c in self.order])
        rows = T.StructType([T.StructField("rows", T.ArrayType(self.fields))])
        self.runs = handle.getMapState("runs", first, rows)
        self.memory = handle.getValueState("memory", self.state)
        self.timer = handle.getValueState("timer", "us bigint")
        self.names = self.fields.fieldNames()
        self.at = [self.names.index(c) for c in self.order]

    def _place(self, row: tuple) -> tuple:
        return tuple(row[i] for i in self.at)

    def _store(self, run: list[tuple]) -> int:
        first = self._place(run[0])
        if self.runs.containsKey(first):
            # The same row came twice; keep both runs.
            held = [tuple(r) for r in self.runs.getValue(first)[0]]
            run = sorted(held + run, key=self._place)
        self.runs.updateValue(first, (run,))
        return first[0]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        tuples = (tuple(r[n] for n in self.names) for r in rows)
        earliest = None
        while run := sorted(islice(tuples, RUN_ROWS), key=self._place):
            first = self._store(run)
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            held = self.timer.get()[0] if self.timer.exists() else None
            if held is None or earliest < held:
                self._wake(held, earliest)
        return iter(())

    def _wake(self, held: int | None, us: int | None) -> None:
        """Let the key's one timer stand at ``us``: the first waiting row or the first time-out still
        open. What it stood at before, ``held``, is deleted, so that nothing fires for an item that was
        resolved meanwhile."""
        if held is not None and (us is None or _ms_up(held) != _ms_up(us)):
            self.handle.deleteTimer(_ms_up(held))
        if us is None:
            self.timer.clear()
        elif us != held:
            self.handle.registerTimer(_ms_up(us))
            self.timer.update((us,))

    def _due(self, passed: int, left: list[int]) -> Iterator[tuple]:
        """The waiting rows up to ``passed`` in order, merged from the runs and taken out of the
        state; the first times of what stays go to ``left``."""
        firsts = sorted(tuple(k) for k in self.runs.keys())
        opened: list = []
        n = 0
        while True:
            while n < len(firsts) and firsts[n][0] <= passed and (not opened or firsts[n] <= opened[0][0]):
                run = [tuple(r) for r in self.runs.getValue(firsts[n])[0]]
                self.runs.removeKey(firsts[n])
                heapq.heappush(opened, (firsts[n], n, 0, run))
                n += 1
            if not opened:
                break
            place, number, i, run = heapq.heappop(opened)
            if place[0] > passed:
                left.append(self._store(run[i:]))
                continue
            yield run[i]
            if i + 1 < len(run):
                heapq.heappush(opened, (self._place(run[i + 1]), number, i + 1, run))
        left.extend(f[0] for f in firsts[n:])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        memory = self.load(tuple(self.memory.get()) if self.memory.exists() else self.initial)
        out: list[Row] = []
        left: list[int] = []
        us = self.at[0]
        for values in self._due(passed, left):
            memory = self.on_time(key, memory, values[us] - 1, out)
            memory = self.on_row(key, memory, dict(zip(self.names, values)), out)
            yield from out
            out.clear()
        memory = self.on_time(key, memory, passed, out)
        yield from out
        self.memory.update(self.save(memory))
        limit = self.deadline(memory)
        if limit is not None:
            left.append(limit)
        held = self.timer.get()[0] if self.timer.exists() else None
        if held is not None and held <= passed:
            self.timer.clear()  # it is this one that fires
            held = None
        self._wake(held, min(left, default=None))

    def load(self, held: tuple):
        """What ``on_row`` and ``on_time`` work on, from what the state holds."""
        return held

    def save(self, memory) -> tuple:
        return memory

    def on_row(self, key, memory: tuple, row: dict, out: list[Row]) -> tuple:
        raise NotImplementedError

    def on_time(self, key, memory: tuple, us: int, out: list[Row]) -> tuple:
        """No row at or before ``us`` will follow."""
        return memory

    def deadline(self, memory: tuple) -> int | None:
        return None


class JumpAlert(EventOrderProcessor):
    """Rows whose value differs from the previous one by more than the threshold."""

    state, initial = "v double", (None,)

    def __init__(self, fields, order, value: str, threshold: float):
        super().__init__(fields, order)
        self.value, self.threshold = value, threshold

    def on_row(self, key, memory, row, out):
        (before,) = memory
        now = row[self.value]
        if before is not None and now is not None and abs(now - before) > self.threshold:
            out.append(self.row(*key, *[row[c] for c in self.order], now, before))
        return (now,)


class RiseAlert(EventOrderProcessor):
    """One alert per run whose first rise sees no fall for ``lasting`` microseconds."""

    state, initial = "v double, start bigint, told boolean", (None, None, False)

    def __init__(self, fields, order, value: str, lasting: int):
        super().__init__(fields, order)
        self.value, self.lasting = value, lasting

    def on_row(self, key, memory, row, out):
        before, start, told = memory
        now = row[self.value]
        if None in (before, now):  # no rise and no fall
            return (now, start, told)
        if now < before:
            start, told = None, False
        elif now > before and start is None:
            start = row[self.order[0]]
        return (now, start, told)

    def on_time(self, key, memory, us, out):
        before, start, told = memory
        if start is not None and not told and us + 1 >= start + self.lasting:
            out.append(self.row(*key, start, start + self.lasting))
            told = True
        return (before, start, told)

    def deadline(self, memory):
        _, start, told = memory
        return None if start is None or told else start + self.lasting


class DailyCap(EventOrderProcessor):
    """The first ``cap`` rows of a day pass, the next one warns, the rest is left out."""

    state, initial = "day bigint, n bigint", (None, 0)

    def __init__(self, fields, order, cap: int):
        super().__init__(fields, order)
        self.cap = cap

    def on_row(self, key, memory, row, out):
        day, n = memory
        today = row[self.order[0]] // DAY_US
        n = n + 1 if today == day else 1
        if n <= self.cap + 1:
            tag = "pass" if n <= self.cap else "warn"
            out.append(self.row(*key, *[row[c] for c in self.order], tag))
        return (today, min(n, self.cap + 1))


class FirstSeen(EventOrderProcessor):
    """Marks the rows whose bit of a page was not set before: key (window's end, page, ...).

    The page is held as words of 64 bits, those in use alone, and forgotten when the window's end has
    passed. Rows keep their order columns; ``fresh`` is 1 or 0.
    """

    state, initial = "until bigint", (None,)

    def __init__(self, fields, order, bit: str, end: str):
        super().__init__(fields, order)
        self.bit, self.end = bit, end

    def init(self, handle):
        super().init(handle)
        self.page = handle.getMapState("page", "word bigint", "bits bigint")

    def load(self, held):
        return [held[0], {}]

    def save(self, memory):
        for word, (old, bits) in memory[1].items():
            if bits != old:
                self.page.updateValue((word,), (bits - (1 << 64) if bits >> 63 else bits,))
        return (memory[0],)

    def on_row(self, key, memory, row, out):
        bit, fresh = row[self.bit], 0
        if bit is not None:
            word, mask = bit >> 6, 1 << (bit & 63)
            if word not in memory[1]:
                bits = self.page.getValue((word,))[0] & (1 << 64) - 1 if self.page.containsKey((word,)) else 0
                memory[1][word] = (bits, bits)
            old, bits = memory[1][word]
            if not bits & mask:
                memory[1][word], fresh = (old, bits | mask), 1
        memory[0] = row[self.end]
        out.append(self.row(*key, *[row[c] for c in self.order], fresh))
        return memory

    def on_time(self, key, memory, us, out):
        if memory[0] is not None and us + 1 >= memory[0]:
            self.page.clear()
            memory[0], memory[1] = None, {}
        return memory

    def deadline(self, memory):
        return memory[0]


class SliceCount(EventOrderProcessor):
    """Counts ``fresh`` within a slice of a window: key (window's end, slice), slices numbered in order
    of time. Every row comes out with the count so far in its slice; once the slice is over, a row
    for each later slice carries its total there, with the time at which that slice starts.
    Rows out: window's end, slice, ``carry`` (a total and no row), the order columns, n."""

    state, initial = "n bigint, open boolean", (0, False)

    def __init__(self, fields, order, fresh: str, window: int, slices: int):
        super().__init__(fields, order)
        self.fresh, self.slice, self.window, self.slices = fresh, window // slices, window, slices

    def on_row(self, key, memory, row, out):
        n = memory[0] + row[self.fresh]
        out.append(self.row(*key, False, *[row[c] for c in self.order], n))
        return (n, True)

    def _over(self, key) -> int:
        end, k = key
        return end - self.window + (k + 1) * self.slice if k + 1 < self.slices else end

    def on_time(self, key, memory, us, out):
        n, open_ = memory
        if not open_ or us + 1 < self._over(key):
            return memory
        end, k = key
        blank = [None] * (len(self.order) - 1)
        if n:
            for later in range(k + 1, self.slices):
                out.append(self.row(end, later, True, end - self.window + later * self.slice, *blank, n))
        return (0, False)

    def deadline(self, memory):
        return None if not memory[1] else self._due_at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._due_at = self._over(key)
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)


class Carry(EventOrderProcessor):
    """Adds the totals of earlier slices to the counts within a slice: key (window's end, slice).
    Totals bear the start of the slice, so they come before its rows, whose watermark has passed
    all earlier slices."""

    state, initial = "n bigint", (0,)

    def __init__(self, fields, order, carry: str, n: str, window: int):
        super().__init__(fields, order)
        self.carry, self.n, self.window = carry, n, window

    def _place(self, row):
        # Carried totals have no other order columns than the time.
        place = super()._place(row)
        return tuple(-(1 << 62) if v is None else v for v in place)

    def on_row(self, key, memory, row, out):
        if row[self.carry]:
            return (memory[0] + row[self.n],)
        out.append(self.row(*key, *[row[c] for c in self.order], memory[0] + row[self.n]))
        return memory


class LateTag(Processor):
    """Tags rows by the watermark in force when their micro-batch starts: ``names`` for a window
    that is still open, one kept for ``lateness`` longer, and one that takes no rows any more."""

    def __init__(self, columns: Sequence[str], end: str, lateness: int, names: Sequence[str]):
        self.carried, self.end, self.lateness, self.names = list(columns), end, lateness, list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        for row in rows:
            end = row[self.end]
            tag = 0 if mark <= 0 or end > mark else 1 if end + self.lateness > mark else 2
            yield self.row(*key, *[row[c] for c in self.carried], self.names[tag])


class RefiringWindow(Processor):
    """Totals of the keys of a window: put out when the watermark passes the window's end and again
    after every micro-batch that brings rows for them within ``lateness`` more.

    The state's key is a share of a window's ``keys`` and, last, the window's end in microseconds.
    Firings of a key are numbered from 1; rows that come later still are left out, and the state goes
    with a timer. A key whose first rows come late fires with them. Rows are packs of partial sums
    ``value``, and so are rows out: keys, firing, ``value``, whether late rows brought it about. The state is
    a pack of the share's totals, with the firings so far.
    """

    def __init__(self, keys: Sequence[str], value: str, lateness: int):
        self.keys, self.value, self.lateness = list(keys), value, lateness

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "rows binary")

    def _told(self, key, totals: pa.Table, late: bool) -> Iterator[Row]:
        if totals.num_rows:
            marks = pa.array([late] * totals.num_rows, pa.bool_())
            out = totals.select([*self.keys, "_firing", self.value]).append_column("_late", marks)
            yield self.row(*key, packs.pack(out))

    def _due(self, held: pa.Table) -> tuple[pa.Table, pa.Table]:
        """Totals not told yet, and all with these counted as told."""
        waiting = pc.equal(held["_firing"], 0)
        at = held.column_names.index("_firing")
        told = held.set_column(at, "_firing", pc.if_else(waiting, 1, held["_firing"]))
        return told.filter(waiting), told

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark, end = timerValues.getCurrentWatermarkInMs() * 1000, key[-1]
        if mark > 0 and end + self.lateness <= mark:
            return
        over, kept = mark > 0 and end <= mark, self.held.exists()
        come = pa.concat_tables([packs.unpack(r[packs.ROWS]) for r in rows])
        come = packs.sums(come, self.keys, self.value)
        zeros = pa.array(np.zeros(come.num_rows, np.int64))
        come = come.append_column("_firing", zeros).append_column("_come", pc.add(zeros, 1))
        if kept:
            held = packs.unpack(self.held.get()[0])
            if over:
                # Due in this very micro-batch: what came in time is told first.
                due, held = self._due(held)
                yield from self._told(key, due, False)
            held = held.append_column("_come", pa.array(np.zeros(held.num_rows, np.int64)))
            come = packs.sums(pa.concat_tables([held, come.select(held.column_names)]), self.keys, self.value, "_firing", "_come")
        else:
            self.handle.registerTimer(_ms_up(end + self.lateness))
            if not over:
                self.handle.registerTimer(_ms_up(end))
        if over:
            at = come.column_names.index("_firing")
            come = come.set_column(at, "_firing", pc.add(come["_firing"], come["_come"]))
            yield from self._told(key, come.filter(pc.equal(come["_come"], 1)), True)
        self.held.update((packs.pack(come.drop_columns(["_come"])),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.held.exists():
            return
        due, held = self._due(packs.unpack(self.held.get()[0]))
        yield from self._told(key, due, False)
        if expiredTimerInfo.getExpiryTimeInMs() >= _ms_up(key[-1] + self.lateness):
            self.held.clear()
        elif due.num_rows:
            self.held.update((packs.pack(held),))


class BestOfWindow(Processor):
    """The ``n`` greatest counts of a window, ties to the smaller item: a heap of ``n`` rows as state.

    The key's first field is the window's end in microseconds. A new count of an item takes the place
    of the old one. Counts never fall, so whatever was pushed out and is not told anew stays below
    what is held, and ``n`` rows are enough. With ``again`` None the best are put out once, when
    the watermark passes the end; else after every micro-batch that brought counts, numbered, until
    the end is ``again`` microseconds past. Counts that come in time and counts that late rows
    corrected (``late``) are ranked one after the other if one micro-batch brings both.
    Rows out: key, firing, rank, item, count, whether it was late.
    """

    def __init__(self, n: int, item: str, count: str, fields: T.StructType, again: int | None = None, late: str | None = None):
        self.n, self.item, self.count, self.fields, self.again, self.late = n, item, count, fields, again, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.fields)
        self.firing = handle.getValueState("firing", "n bigint")

    def _put(self, heap: list[tuple], item, count) -> None:
        """The least of the items in ``heap`` stands first and gives way."""
        for i, (c, x) in enumerate(heap):
            if x.value == item:
                heap[i] = (max(c, count), x)
                heapq.heapify(heap)
                return
        entry = (count, _Later(item))
        if len(heap) < self.n:
            heapq.heappush(heap, entry)
        elif heap[0] < entry:
            heapq.heapreplace(heap, entry)

    def _merged(self, rows) -> tuple[list[tuple], list[tuple], set[bool]]:
        """The best after the counts in time, those after the late ones too, and which of both came."""
        heaps: tuple[list, list] = ([], [])
        for r in self.best.get():
            self._put(heaps[0], r[0], r[1])
        came = set()
        for r in rows:
            if r[self.item] is not None and r[self.count] is not None:
                late = bool(self.late and r[self.late])
                came.add(late)
                self._put(heaps[late], r[self.item], r[self.count])
        ranked = [(x.value, c) for c, x in sorted(heaps[0], reverse=True)]
        for c, x in heaps[1]:
            self._put(heaps[0], x.value, c)
        return ranked, [(x.value, c) for c, x in sorted(heaps[0], reverse=True)], came

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        in_time, best, came = self._merged(rows)
        self.best.put(best)
        self.handle.registerTimer(_ms_up(key[0] + (self.again or 0)))
        if self.again is None:
            return
        firing = self.firing.get()[0] if self.firing.exists() else 0
        for late, ranked in ((False, in_time), (True, best)):
            if late in came:
                firing += 1
                yield from (self.row(*key, firing, i, *entry, late) for i, entry in enumerate(ranked, 1))
        self.firing.update((firing,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.again is None:
            yield from (self.row(*key, 1, i, r[0], r[1], False) for i, r in enumerate(self.best.get(), 1))
        self.best.clear()
        self.firing.clear()


class _Later:
    """Orders items the other way round."""

    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return self.value == other.value


class RepeatedFailure(EventOrderProcessor):
    """A failure less than ``within`` microseconds after the previous row, itself a failure."""

    state, initial = "last bigint", (None,)

    def __init__(self, fields, order, failed: str, within: int):
        super().__init__(fields, order)
        self.failed, self.within = failed, within

    def on_row(self, key, memory, row, out):
        (last,) = memory
        if not row[self.failed]:
            return (None,)
        now = row[self.order[0]]
        if last is not None and now - last < self.within:
            out.append(self.row(*key, last, now))
        return (now,)


class FailureBurst(EventOrderProcessor):
    """``least`` or more failures within ``within`` microseconds of the first, with no success
    between: reported once, when that time is over, with first and last failure and number."""

    state, initial = "first bigint, last bigint, n bigint", (None, None, 0)

    def __init__(self, fields, order, failed: str, within: int, least: int):
        super().__init__(fields, order)
        self.failed, self.within, self.least = failed, within, least

    def on_row(self, key, memory, row, out):
        first, last, n = memory
        if not row[self.failed]:
            return (None, None, 0)
        now = row[self.order[0]]
        return (now if first is None else first, now, n + 1)

    def on_time(self, key, memory, us, out):
        first, last, n = memory
        if first is None or us < first + self.within:
            return memory
        if n >= self.least:
            out.append(self.row(*key, first, last, n))
        return (None, None, 0)

    def deadline(self, memory):
        return None if memory[0] is None else memory[0] + self.within


class OrderPayment(EventOrderProcessor):
    """One status per create: ``paid`` or ``late`` at the first pay after it, ``timeout`` once
    ``limit`` microseconds have passed without one; a pay before any create is ``no create``.

    A create that timed out is kept for its pay, which then changes the status to ``late``;
    consumers hold the last status of a create. With ``forget`` it is kept that many microseconds
    after its time-out at most, which bounds the state of orders that are never paid.
    """

    state = "seen boolean, open array<array<bigint>>, told array<array<bigint>>"
    initial = (False, [], [])

    def __init__(self, fields, order, created: str, paid: str, limit: int, forget: int | None = None):
        super().__init__(fields, order)
        self.created, self.paid, self.limit, self.forget = created, paid, limit, forget

    def load(self, held):
        # Creates as (time, *ids), oldest first.
        return [held[0], deque(tuple(c) for c in held[1]), deque(tuple(c) for c in held[2])]

    def save(self, memory):
        return (memory[0], [list(c) for c in memory[1]], [list(c) for c in memory[2]])

    def _put(self, key, create, pay, tag, out):
        out.append(self.row(*key, create[0], pay, tag, *create[1:]))

    def on_row(self, key, memory, row, out):
        _, waiting, told = memory
        place = tuple(row[c] for c in self.order)
        if row[self.created]:
            memory[0] = True
            waiting.append(place)
        elif row[self.paid]:
            now = place[0]
            if not memory[0]:
                self._put(key, (None, *place[1:]), now, "no create", out)
            for create in chain(told, waiting):
                self._put(key, create, now, "paid" if now < create[0] + self.limit else "late", out)
            told.clear()
            waiting.clear()
        return memory

    def on_time(self, key, memory, us, out):
        _, waiting, told = memory
        while waiting and us + 1 >= waiting[0][0] + self.limit:
            create = waiting.popleft()
            self._put(key, create, None, "timeout", out)
            told.append(create)
        while self.forget is not None and told and us >= told[0][0] + self.limit + self.forget:
            told.popleft()
        return memory

    def deadline(self, memory):
        return memory[1][0][0] + self.limit if memory[1] else None


class OrderCheck(EventOrderProcessor):
    """The fixed check ``limit`` microseconds after a create with no pay before it."""

    state, initial = "paid bigint, open array<bigint>", (None, [])

    def __init__(self, fields, order, created: str, paid: str, limit: int):
        super().__init__(fields, order)
        self.created, self.paid, self.limit = created, paid, limit

    def load(self, held):
        return [held[0], deque(held[1])]

    def save(self, memory):
        return (memory[0], list(memory[1]))

    def on_row(self, key, memory, row, out):
        if memory[0] is None:
            if row[self.created]:
                memory[1].append(row[self.order[0]])
            elif row[self.paid]:
                memory[0] = row[self.order[0]]
        return memory

    def on_time(self, key, memory, us, out):
        paid, waiting = memory
        while waiting and us >= waiting[0] + self.limit:
            create = waiting.popleft()
            in_time = paid is not None and paid <= create + self.limit
            out.append(self.row(*key, create, "paid" if in_time else "timeout"))
        return memory

    def deadline(self, memory):
        return memory[1][0] + self.limit if memory[1] else None


class Kept(dict):
    """Map state of a processor that no stream runs."""

    def getValue(self, key):
        return self[key]

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key, None)

    def iterator(self):
        return iter(list(self.items()))


class Stretch:
    """Starts ``lo`` to ``hi`` of a key, numbered in order, that were taken on by the same later events:
    their times and ids. ``dead`` if a strict step was missed."""

    __slots__ = ("lo", "hi", "dead", "at", "ids")

    def __init__(self, lo, hi, dead=False, at=(), ids=()):
        self.lo, self.hi, self.dead, self.at, self.ids = lo, hi, dead, list(at), list(ids)

    def held(self) -> tuple:
        return (self.hi, self.dead, self.at, self.ids)


class SequenceMatcher(EventOrderProcessor):
    """An ordered sequence of steps within a time limit; see ``patterns.match_sequence``.

    The input has one boolean field per step. Each row fitting the first step opens a partial
    match; it takes the first later row that fits its next step (for a strict step, the very next row
    or none) and ends as ``match`` or, when the time is over, as ``timeout`` with the steps reached.

    All starts that wait for the same step are taken on by the same row, so the events that follow
    are shared: a start is one entry of a map by number, and consecutive starts with the same later
    events form a :class:`Stretch`, another map's entry. A row writes its own start and the stretches it
    takes on, each of which it can do once a step; starts are expired from the front.
    """

    state, initial = "front bigint, next bigint", (0, 0)

    def __init__(self, fields, order, flags: Sequence[str], strict: Sequence[bool], within: int):
        super().__init__(fields, order)
        self.flags, self.strict, self.within = list(flags), list(strict), within
        self.starts, self.stretches = Kept(), Kept()

    def init(self, handle):
        super().init(handle)
        self.starts = handle.getMapState("starts", "n bigint", "us bigint, id bigint")
        self.stretches = handle.getMapState(
            "stretches", "lo bigint", "hi bigint, dead boolean, at array<bigint>, ids array<bigint>")

    class _Memory:
        """Of a key, while its rows are handled: stretches in order, those that wait for each step, the
        numbers of the first start left and of the next, and the stretches to write."""

        def __init__(self, front, next_, stretches, steps):
            self.front, self.next, self.stretches, self.changed = front, next_, stretches, set()
            self.first = None  # time and id of the first start left
            self.groups: list[list[Stretch]] = [[] for _ in range(steps)]
            for s in stretches.values():
                if not s.dead:
                    self.groups[len(s.ids) + 1].append(s)

    def load(self, held):
        found = sorted((k[0], tuple(v)) for k, v in self.stretches.iterator())
        return self._Memory(held[0], held[1], {lo: Stretch(lo, *v) for lo, v in found}, len(self.flags))

    def save(self, memory):
        for lo in memory.changed:
            if lo in memory.stretches:
                self.stretches.updateValue((lo,), memory.stretches[lo].held())
            else:
                self.stretches.removeKey((lo,))
        memory.changed.clear()
        return (memory.front, memory.next)

    def _put(self, key, start, stretch, out):
        last = (stretch.ids[-1], stretch.at[-1]) if stretch.ids else (start[1], start[0])
        reached = len(stretch.ids) + 1
        tag = "match" if reached == len(self.flags) else "timeout"
        out.append(self.row(*key, start[1], start[0], *last, reached, tag))

    def _first(self, memory):
        """Number, time and id of the first start left, or None."""
        if not memory.stretches:
            return None
        n = max(next(iter(memory.stretches.values())).lo, memory.front)
        if memory.first is None or memory.first[0] != n:
            memory.first = (n, *tuple(self.starts.getValue((n,))))
        return memory.first

    def on_row(self, key, memory, row, out):
        groups, us, row_id = memory.groups, row[self.order[0]], row[self.order[1]]
        last = len(self.flags) - 1
        # From the last step down: a match moves one step at most on one row.
        for step in range(last, 0, -1):
            group = groups[step]
            if not group:
                continue
            if row[self.flags[step]]:
                for s in group:
                    s.at.append(us)
                    s.ids.append(row_id)
                    memory.changed.add(s.lo)
                    if step == last:
                        for n in range(max(s.lo, memory.front), s.hi + 1):
                            self._put(key, tuple(self.starts.getValue((n,))), s, out)
                            self.starts.removeKey((n,))
                        del memory.stretches[s.lo]
                if step < last:
                    groups[step + 1].extend(group)
                groups[step] = []
            elif self.strict[step]:
                for s in group:
                    s.dead = True
                    memory.changed.add(s.lo)
                groups[step] = []
        if row[self.flags[0]]:
            n = memory.next
            memory.next += 1
            if not last:
                self._put(key, (us, row_id), Stretch(n, n), out)
                return memory
            self.starts.updateValue((n,), (us, row_id))
            open_ = groups[1][-1] if groups[1] else None
            if open_ is not None and open_.hi == n - 1:
                open_.hi = n
            else:
                open_ = memory.stretches[n] = Stretch(n, n)
                groups[1].append(open_)
            memory.changed.add(open_.lo)
        return memory

    def on_time(self, key, memory, us, out):
        while (first := self._first(memory)) is not None and us + 1 >= first[1] + self.within:
            n, stretch = first[0], next(iter(memory.stretches.values()))
            self._put(key, first[1:], stretch, out)
            self.starts.removeKey((n,))
            memory.front = n + 1
            if n == stretch.hi:
                del memory.stretches[stretch.lo]
                memory.changed.add(stretch.lo)
                if not stretch.dead:
                    memory.groups[len(stretch.ids) + 1].remove(stretch)
        return memory

    def deadline(self, memory):
        first = self._first(memory)
        return None if first is None else first[1] + self.within


class MarkedWindow(Processor):
    """Tumbling minimum per key and window under a watermark that only marker rows move.

    ``F.window`` would be governed by its own column, so the windows are kept here and put out
    by timers, which follow the watermark the caller declared on the marker column. The state's key ends
    with the window's start in microseconds. NaN is above all numbers.
    """

    def __init__(self, value: str, size: int):
        self.value, self.size = value, size

    def init(self, handle):
        self.handle = handle
        self.least = handle.getValueState("least", "v double")

    def handleInputRows(self, key, rows, timerValues):
        mark, end = timerValues.getCurrentWatermarkInMs() * 1000, key[-1] + self.size
        if end <= mark:
            return iter(())
        held = self.least.get() if self.least.exists() else ()
        values = (v for v in chain(held, (row[self.value] for row in rows)) if v is not None)
        self.least.update((min(values, key=lambda v: (v != v, v), default=None),))
        self.handle.registerTimer(_ms_up(end))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.least.exists():
            value = self.least.get()[0]
            self.least.clear()
            yield self.row(*key, value)
