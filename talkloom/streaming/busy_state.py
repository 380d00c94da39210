"""Busy flags on a stream whose requests come out of order, by state kept per key in event time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talkloom import session

DELAY = "10 minutes"

_ROW, _OUTLINE = 0, 1
_FIELDS = ["endpoint", "user", "start", "finish", "tie", "kind"]
_STATE = "pending binary, running binary, until long"
_NEVER = np.iinfo(np.int64).min


def busy_state(
    requests: DataFrame,
    endpoint: str,
    user: str,
    start: str,
    finish: str,
    tie: str,
    delay: str = DELAY,
    cells: int | Column = 1,
) -> DataFrame:
    """Stream of endpoint, user, start, finish, tie and `busy`, as `busy_at_arrival` flags them, for rows in any order within `delay`.

    `start` and `finish` are whole microseconds since 1970, `tie` is a whole number, never null. A request is flagged once the watermark has passed its
    start; until then it waits in the state of its cell, together with the latest finish of what came before, and of each user
    whose request still runs. State that can no longer matter is dropped, by event-time timeout where nothing more arrives.

    `cells` (a number, or an expression over the row that is the same for all rows of an endpoint) cuts the users of a hot endpoint
    into that many keys. A cell gets its own requests whole; of the others it gets outlines, start and finish only, of those that
    outlast all earlier ones read with them. What an earlier request outlasts cannot change any flag. While they wait, outlines that
    run into one another are one: whoever comes in between is busy either way. Spark hands the state of a key to Python with every
    Arrow batch of its rows, so `cells` must grow with an endpoint's requests: some 100,000 for each cell.

    A row without a start is flagged false at once and not counted, one without a finish does not run. Rows behind the
    watermark are left out, and counted by the query's progress as dropped by watermark. Other columns are not kept.
    """
    given = requests.schema
    number = cells if isinstance(cells, Column) else F.lit(cells)
    cell = F.when(number > 1, F.pmod(F.xxhash64(user), number)).otherwise(F.lit(0))
    named = requests.select(
        F.col(endpoint).alias("endpoint"), F.col(user).alias("user"), F.col(start).cast("long").alias("start"),
        F.col(finish).cast("long").alias("finish"), F.col(tie).cast("long").alias("tie"),
        F.lit(_ROW).alias("kind"), number.cast("long").alias("cells"), cell.cast("long").alias("cell"),
    )
    dealt = session.shipped(named).mapInPandas(_with_outlines, named.schema)
    dealt = dealt.withColumn("at", F.timestamp_micros("start")).withWatermark("at", delay)
    fields = [
        T.StructField("endpoint", given[endpoint].dataType), T.StructField("user", given[user].dataType), T.StructField("start", T.LongType()),
        T.StructField("finish", T.LongType()), T.StructField("tie", T.LongType()), T.StructField("busy", T.BooleanType()),
    ]
    flagged = dealt.groupBy("endpoint", "cell").applyInPandasWithState(
        _flag, T.StructType(fields), _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    names = dict(zip([f.name for f in fields], [endpoint, user, start, finish, tie, "busy"], strict=True))
    return flagged.select(*[F.col(old).alias(new) for old, new in names.items()])


def _with_outlines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows, and for the other cells of their endpoint the outlines of those that outlast what comes before them in the batch."""
    for rows in batches:
        yield rows
        split = rows[(rows["cells"] > 1) & rows["start"].notna() & rows["finish"].notna()].sort_values(["start", "tie"])
        if len(split):
            latest = split.groupby("endpoint", dropna=False)["finish"].cummax()
            before = latest.groupby(split["endpoint"], dropna=False).shift()
            lasting = split[before.isna() | (split["finish"] > before)].assign(user=None, kind=_OUTLINE)
            copies = lasting.loc[lasting.index.repeat(lasting["cells"].astype("int64"))]
            to = copies.groupby(level=0).cumcount()
            copies = copies.assign(own=copies["cell"], cell=to)
            yield copies[copies["cell"] != copies["own"]][rows.columns]


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes | None, columns: list[str]) -> pd.DataFrame:
    if not raw:
        return pd.DataFrame({c: pd.Series(dtype=object) for c in columns})
    return pa.ipc.open_stream(raw).read_all().to_pandas()


def _spells(rows: pd.DataFrame) -> pd.DataFrame:
    """The waiting rows, with outlines that run into one another as one, from the first start to the latest finish.

    The watermark has let all of them through, so none can still be left out. An outline that starts where the others end begins a new one.
    """
    outline = (rows["kind"] == _OUTLINE).to_numpy(bool)
    if outline.sum() < 2:
        return rows
    waiting = rows[outline].astype({"start": "int64", "finish": "int64"}).sort_values(["start", "tie"])
    latest = waiting["finish"].cummax().to_numpy()
    first = np.append(True, waiting["start"].to_numpy()[1:] >= latest[:-1])
    last = np.append(np.flatnonzero(first)[1:], len(waiting)) - 1
    return pd.concat([rows[~outline], waiting[first].assign(finish=latest[last])])


def settle(rows: pd.DataFrame, running: pd.Series, until: int) -> tuple[np.ndarray, pd.Series, int]:
    """Flags of rows in order of start and tie, given the latest finish of each user before them and of all; both as they are after them."""
    start, finish = rows["start"].to_numpy(np.int64), rows["finish"].fillna(_NEVER).to_numpy(np.int64)
    latest = np.maximum.accumulate(np.concatenate([[until], finish]))
    whole = (rows["kind"] == _ROW).to_numpy(bool)
    mine = pd.Series(finish[whole], index=rows["user"].to_numpy()[whole])
    both = pd.concat([running, mine]).astype("int64")
    until_mine = both.groupby(level=0, dropna=False).cummax()
    before = until_mine.groupby(level=0, dropna=False).shift().fillna(_NEVER).to_numpy()[len(running) :]
    own = np.full(len(rows), _NEVER)
    own[whole] = before.astype(np.int64)
    busy = (latest[:-1] > start) & (own <= start)
    return busy, both.groupby(level=0, dropna=False).max(), int(latest[-1])


def _flag(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    pending, running, until = state.get if state.exists else (None, None, _NEVER)
    users = _unpacked(running, ["user", "until"])
    running = pd.Series(users["until"].to_numpy(np.int64), index=users["user"].to_numpy())
    rows = pd.concat([f for f in [_unpacked(pending, _FIELDS), *(f[_FIELDS] for f in frames)] if len(f)] or [pd.DataFrame(columns=_FIELDS)])
    columns = ["endpoint", "user", "start", "finish", "tie"]
    unplaced = rows["start"].isna()
    if unplaced.any():
        yield rows[unplaced][columns].assign(busy=False)
        rows = rows[~unplaced]
    passed = state.getCurrentWatermarkMs() * 1000
    ready = (rows["start"] <= passed).to_numpy(bool)
    done, rows = rows[ready].sort_values(["start", "tie"]), rows[~ready]
    if len(done):
        busy, running, until = settle(done, running, until)
        own = (done["kind"] == _ROW).to_numpy(bool)
        yield done[own][columns].assign(busy=busy[own])
    running = running[running > passed]
    waits = [int(rows["start"].min())] if len(rows) else []
    waits += [until] if until > passed else []
    if waits:
        users = pd.DataFrame({"user": running.index, "until": running.to_numpy(np.int64)})
        state.update((_packed(_spells(rows)), _packed(users), until))
        state.setTimeoutTimestamp(max(min(waits) // 1000, state.getCurrentWatermarkMs()) + 1)
    elif state.exists:
        state.remove()
