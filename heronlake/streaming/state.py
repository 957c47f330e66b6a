"""Keyed state across micro-batches, in Spark's state store."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from heronlake.operators.ordering import positions
from heronlake.session import settle
from heronlake.streaming.runner import batch_ids, batch_writer, drop_batches, run_available
from heronlake.streaming.windows import seconds

ENOUGH = "enough rows are stored"


@dataclass(frozen=True)
class Fold:
    """What a user keeps per key.

    state: the fields of a state, as in "n long, last string"; start() gives the first state (a tuple), add(state, rows) moves
    it on by a frame of rows. merge(a, b) joins the states of two sets of rows; with it the rows of a key are folded where they
    are read and only states meet at the key's state, so a key of any share of the rows is no burden. A fold without
    merge gets all rows of a key in a batch at once, in the order asked for.
    """

    state: str
    start: Callable[[], tuple]
    add: Callable[[tuple, pd.DataFrame], tuple]
    merge: Callable[[tuple, tuple], tuple] | None = None

    @property
    def fields(self) -> list[str]:
        return [f.split()[0] for f in self.state.split(", ")]


#: Counts rows.
COUNT = Fold("n long", lambda: (0,), lambda state, rows: (state[0] + len(rows),), lambda a, b: (a[0] + b[0],))


def _plain(values) -> tuple:
    """Python values in place of numpy's; a missing one is None."""
    values = [v.item() if hasattr(v, "item") else v for v in values]
    return tuple(None if v is None or v is pd.NaT or v != v else v for v in values)


def _frame(columns: dict[str, Sequence]) -> pd.DataFrame:
    """A frame of plain objects, which Spark turns into the declared types (missing values are None)."""
    return pd.DataFrame({name: pd.Series(_plain(values), dtype=object) for name, values in columns.items()})


class Keyed(StatefulProcessor):
    """One state per key, moved on by the rows of a batch (`folded`: by the states of its parts). Gives a row per key of a batch:
    the state after it, or with `before` the one that was there when it came."""

    def __init__(self, fold: Fold, order: Sequence[str], folded: bool, before: bool) -> None:
        self.fold, self.order, self.folded, self.before = fold, list(order), folded, before

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("fold", self.fold.state)

    def _moved(self, state: tuple, rows: Iterator[pd.DataFrame]) -> tuple:
        if self.folded:
            for chunk in rows:
                for values in zip(*[chunk[c] for c in self.fold.fields]):
                    state = self.fold.merge(state, _plain(values))
        elif self.order:
            state = self.fold.add(state, pd.concat(list(rows)).sort_values(self.order, kind="stable"))
        else:
            for chunk in rows:
                state = self.fold.add(state, chunk)
        return _plain(state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = tuple(self.state.get()) if self.state.exists() else _plain(self.fold.start())
        new = self._moved(old, rows)
        self.state.update(new)
        shown = old if self.before else new
        yield _frame({"key": [key[0]], **{c: [v] for c, v in zip(self.fold.fields, shown)}})

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for values in zip(*[initialState[c] for c in self.fold.fields]):
            self.state.update(_plain(values))

    def close(self) -> None:
        pass


def fold_by_key(df: DataFrame, key: str, fold: Fold, columns: Sequence[str] = (), order: Sequence[str] = (),
                initial: DataFrame | None = None, before: bool = False) -> DataFrame:
    """A user's fold as Spark's keyed state: rows (key, fields of the state) in update mode, one per key of a batch.

    columns: what `add` gets to see; order: the order in which a fold without merge sees the rows of a batch; initial:
    states to begin with (key, fields); before=True gives the states from before the batch.
    """
    kind = df.schema[key].dataType.simpleString()
    shape = f"key {kind}, {fold.state}"
    rows = df.select(F.col(key).alias("key"), *columns)
    if fold.merge:
        def parts(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for chunk in chunks:
                states = [(k, *_plain(fold.add(fold.start(), some))) for k, some in chunk.groupby("key", dropna=False, sort=False)]
                yield _frame(dict(zip(["key", *fold.fields], zip(*states))))

        rows = rows.mapInPandas(parts, shape)
    start = None
    if initial is not None:
        start = initial.select(F.col(key).cast(kind).alias("key"), *[F.col(c) for c in fold.fields]).groupBy("key")
    out = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=Keyed(fold, order, bool(fold.merge), before), outputStructType=shape, outputMode="Update",
        timeMode="None", initialState=start)
    return out.withColumnRenamed("key", key)


def count_per_record(df: DataFrame, key: str, order: Sequence[str], bucket: Column, path: str,
                     checkpoint: str, initial: DataFrame | None = None) -> None:
    """For every input row the running count of its key, starting from `initial` (key, n); rows go to path, a folder per batch.

    The count of a key before the batch comes from Spark's keyed state, which sees one partial count per key and chunk of rows;
    the rows go past it. Inside the batch they are numbered in pieces (see `positions`), not by one task per key. A replayed
    batch starts from the same state and gives the same output; a batch reads the state of its own keys only.
    """
    held = fold_by_key(df, key, COUNT, initial=initial, before=True)
    row = F.struct(*df.columns)
    shape = df.select(row.alias("row")).schema["row"].dataType
    both = df.select(row.alias("row"), F.lit(None).cast(df.schema[key].dataType).alias("of"), F.lit(None).cast("long").alias("held"))
    both = both.unionByName(held.select(F.lit(None).cast(shape).alias("row"), F.col(key).alias("of"), F.col("n").alias("held")))

    def write(batch: DataFrame, batch_id: int) -> None:
        stored = settle(batch, "per-record")  # read twice, and the state must be moved once
        counts = stored.filter("held is not null").select("of", "held")
        rows = positions(stored.filter("row is not null").select("row.*"), [key], order, bucket)
        numbered = rows.join(counts, F.col(key).eqNullSafe(F.col("of")), "left")
        batch_writer(path)(numbered.select(*df.columns, (F.col("held") + F.col("pos") + 1).alias("n")), batch_id)

    run_available(both, "update", checkpoint, write)


class Ring(StatefulProcessor):
    """Counts of a key's last panes. When a pane closes, its count is added to the window's and that of the pane which falls out
    is taken off. A timer stands at the end of the next pane, rows or no rows, so a window without rows gives a zero."""

    def __init__(self, length: int, slide: int, keep: int | None) -> None:
        self.length, self.slide, self.keep = length, slide, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the end of the next pane to close; panes that are closed, oldest first; panes still open; zeros given in a row
        self.state = handle.getValueState("ring", "next long, closed array<long>, ends array<long>, counts array<long>, idle long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        border = timerValues.getCurrentWatermarkInMs()
        known = self.state.get() if self.state.exists() else None
        following, closed, ends, counts, idle = known if known else (None, [], [], [], 0)
        panes = dict(zip(ends, counts))
        for chunk in rows:
            for end, n in zip(chunk["pane_end"].tolist(), chunk["n"].tolist()):
                if end > border:  # else its windows are out already
                    panes[end] = panes.get(end, 0) + n
        if not panes:
            return
        first = min(panes)
        if following is None or first < following and not closed:
            following = first
            self.handle.registerTimer(first)
        self.state.update((following, list(closed), list(panes), list(panes.values()), idle))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        border = timerValues.getCurrentWatermarkInMs()
        at, closed, ends, counts, idle = self.state.get()
        closed, panes = list(closed), dict(zip(ends, counts))
        if at > border:  # an earlier timer has done the work
            return
        total, size, out = sum(closed), self.length // self.slide, []
        while at <= border:
            new = panes.pop(at, 0)
            closed.append(new)
            total += new
            if len(closed) > size:
                total -= closed.pop(0)
            idle = idle + 1 if total == 0 else 0
            if self.keep is not None and idle > self.keep:  # enough zeros: the key goes, until it has rows again
                closed, idle = [], 0
                if not panes:
                    break
                at = min(panes)
                continue
            out.append((at, total))
            at += self.slide
            if len(out) == 10_000:
                yield self._rows(key[0], out)
                out = []
        if out:
            yield self._rows(key[0], out)
        if not closed and not panes:
            self.state.clear()
            return
        self.state.update((at, closed, list(panes), list(panes.values()), idle))
        self.handle.registerTimer(at)

    def _rows(self, key, out: list[tuple[int, int]]) -> pd.DataFrame:
        end = pd.to_datetime([t for t, _ in out], unit="ms")
        return pd.DataFrame({"key": pd.Series([key] * len(out), dtype=object), "start": end - pd.Timedelta(milliseconds=self.length),
                             "end": end, "n": [n for _, n in out]})

    def close(self) -> None:
        pass


def sliding_counts(df: DataFrame, key: str, length: str, slide: str, ts: str = "ts", keep: str | None = None) -> DataFrame:
    """(start, end, key, n) of every sliding window of each key once it is over, zeros included, from the first window with
    a row on; in append mode. df carries a watermark on ts.

    Rows become counts per key and pane where they are read. A key's state is a ring of length/slide panes and the panes
    that are open; with `keep` a key is let go after zeros for so long, and begins anew with its next row.
    """
    size, step = seconds(length) * 1000, seconds(slide) * 1000
    if size % step:
        raise ValueError("the window length is a multiple of the slide")
    kind = df.schema[key].dataType.simpleString()
    pane_end = (F.floor(F.unix_millis(ts) / step) + 1) * step

    def counted(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            sizes = chunk.groupby(["key", "pane_end"], dropna=False, sort=False).size()
            yield _frame({"key": sizes.index.get_level_values(0), "pane_end": sizes.index.get_level_values(1), "n": sizes})

    rows = df.select(F.col(key).alias("key"), pane_end.cast("long").alias("pane_end"))
    out = rows.mapInPandas(counted, f"key {kind}, pane_end long, n long").groupBy("key").transformWithStateInPandas(
        statefulProcessor=Ring(size, step, None if keep is None else seconds(keep) * 1000 // step),
        outputStructType=f"key {kind}, start timestamp, end timestamp, n long", outputMode="Append", timeMode="EventTime")
    return out.select("start", "end", F.col("key").alias(key), "n")


class Best(StatefulProcessor):
    """The rows of a finished window with the largest counts (ties: least name), given out when the window's end has passed."""

    def __init__(self, k: int) -> None:
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("best", "names array<string>, counts array<long>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = list(zip(*self.state.get())) if self.state.exists() else []
        for chunk in rows:
            found = best_of(found + list(zip(_plain(chunk["name"]), chunk["n"].tolist())), self.k)
        self.state.update(([name for name, _ in found], [n for _, n in found]))
        self.handle.registerTimer(int(key[1].timestamp() * 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        names, counts = self.state.get()
        self.state.clear()
        yield pd.DataFrame({"start": key[0], "end": key[1], "name": pd.Series(list(names), dtype=object), "n": list(counts),
                            "place": range(1, len(names) + 1)})

    def close(self) -> None:
        pass


def best_of(rows: list[tuple], k: int) -> list[tuple]:
    return sorted(rows, key=lambda r: (-r[1], r[0] is not None, r[0]))[:k]


def top_finished(counts: DataFrame, name: str, k: int) -> DataFrame:
    """(start, end, name, n, place): the k largest counts of every finished window, a second stateful step behind counts per
    window (start, end, name, n) in append mode. Each chunk of a window is cut to k rows before the shuffle."""
    def cut(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            kept = [(start, end, *row) for (start, end), some in chunk.groupby(["start", "end"], sort=False)
                    for row in best_of(list(zip(_plain(some["name"]), some["n"].tolist())), k)]
            frame = pd.DataFrame(kept, columns=["start", "end", "name", "n"])
            yield frame.assign(name=pd.Series([row[2] for row in kept], dtype=object))

    rows = counts.select("start", "end", F.col(name).alias("name"), "n")
    out = rows.mapInPandas(cut, "start timestamp, end timestamp, name string, n long").groupBy("start", "end").transformWithStateInPandas(
        statefulProcessor=Best(k), outputStructType="start timestamp, end timestamp, name string, n long, place int",
        outputMode="Append", timeMode="EventTime")
    return out.withColumnRenamed("name", name)


def keep_recent(df: DataFrame, ts: str, length: str, path: str, checkpoint: str) -> None:
    """Stores the rows of a stream and lets batches go once all their rows are older than `length` before the newest row
    stored so far: the folder holds about one window of rows, however long the stream runs."""
    spark = df.sparkSession
    store, span = batch_writer(path), seconds(length)
    newest: dict[int, float] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        store(batch, batch_id)
        for i in batch_ids(spark, path):  # after a restart the batches of earlier runs are measured once
            if i == batch_id or i not in newest:
                last = spark.read.parquet(f"{path}/batch_id={i}").agg(F.max(ts).cast("double")).first()[0]
                newest[i] = last if last is not None else float("-inf")
        border = max(newest.values()) - span
        old = [i for i, last in newest.items() if last <= border and i != batch_id]
        drop_batches(spark, path, old)
        for i in old:
            del newest[i]

    run_available(df, "append", checkpoint, write)


class _Enough(Exception):
    """Ends a query before the batch at hand is stored or committed."""


def collect_until(df: DataFrame, target: int, path: str, checkpoint: str, poll_seconds: float | None = None) -> int:
    """Stores whole batches until at least `target` rows are there; gives the number stored.

    The query ends at the boundary of the batch that reaches the target: later input is neither stored nor committed, so a
    further call on the same checkpoint with a higher target goes on with it. The stored batches are counted once when
    the call begins; then every batch adds its own count. Without poll_seconds it also ends when the input does.
    """
    spark = df.sparkSession
    store = batch_writer(path)
    try:
        sizes = {r["batch_id"]: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    except AnalysisException:  # nothing written yet
        sizes = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        if sum(n for i, n in sizes.items() if i < batch_id) >= target:
            raise _Enough(ENOUGH)
        store(batch, batch_id)
        sizes[batch_id] = spark.read.parquet(f"{path}/batch_id={batch_id}").count()

    while True:
        try:
            run_available(df, "append", checkpoint, write)
        except StreamingQueryException as error:
            if ENOUGH not in str(error):
                raise
        total = sum(sizes.values())
        if total >= target or poll_seconds is None:
            return total
        time.sleep(poll_seconds)
