"""Look-back de-duplication of a stream, with the last hashes of each key as state."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import nlargest
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "ts array<bigint>, dedup_key array<string>"
EARLIEST = -(2**63)


def upsert_stream(stream: DataFrame, n: int) -> DataFrame:
    """Rows of a stream whose dedup hash is not among the last `n` that earlier batches let through for their key.

    The stream has row_key, ts (a number) and dedup_key, and any other columns. As in
    `operators.cells.upsert_with_lookback`, rows of one batch don't hide each other and rows
    without a hash always pass; the stored rows are those that passed. The state holds `n` pairs of a key, whatever its history, so a
    batch reads no history; a key's rows come in pieces and are never held together. After a restart
    the state of the checkpoint goes on.
    """

    def passing(key: tuple[Any, ...], pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ts, hashes = state.get if state.exists else ([], [])
        stored = list(zip(ts, [h or "" for h in hashes]))
        known = {h for _, h in stored if h}
        for rows in pieces:
            # plain lists: a key has few rows in a piece, and a call of pandas costs more than they do
            hashes = ["" if pd.isna(h) else h for h in rows["dedup_key"].tolist()]
            stamps = [EARLIEST if pd.isna(t) else int(t) for t in rows["ts"].tolist()]
            passes = [h not in known for h in hashes]
            stored = nlargest(n, [*stored, *((t, h) for t, h, p in zip(stamps, hashes, passes) if p)])
            yield rows if all(passes) else rows[passes]
        state.update(([t for t, _ in stored], [h for _, h in stored]))

    grouped = stream.groupBy("row_key")
    return grouped.applyInPandasWithState(passing, stream.schema, STATE, "append", GroupStateTimeout.NoTimeout)
