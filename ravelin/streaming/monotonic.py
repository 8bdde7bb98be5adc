"""Rising times as a stateful stream: one small state per document. ``streaming.pages`` has the other corrections."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from ravelin.operators.folds import repaired
from ravelin.shipping import ship

OUTPUT = "document bigint, page_num bigint, block_idx bigint, s bigint, fixed bigint"


def monotonic_stream(blocks: DataFrame) -> DataFrame:
    """Strictly increasing seconds of the comm blocks of each document, across micro-batches.

    ``blocks`` is a stream of (document, page_num, block_idx, s); a batch's rows of a document are
    taken in page and block order, and the last time is kept as state. No row is late: one that comes in a later
    batch than blocks behind it is taken as it comes, after them, and so raised above them. Only the order is
    worked out over all of a batch's rows of a document; they are written by Arrow batch.
    """
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    ship(blocks.sparkSession)

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        held = list(frames)
        order = sorted((page, idx, k, i) for k, f in enumerate(held) for i, (page, idx) in enumerate(zip(f["page_num"], f["block_idx"], strict=True)))
        fixed = [[0] * len(f) for f in held]
        for _, _, k, i in order:
            now = int(held[k]["s"].iat[i])
            fixed[k][i] = last = now if last is None else repaired(now, last)
        state.update((last,))
        for f, values in zip(held, fixed, strict=True):
            yield f.assign(fixed=values)[["document", "page_num", "block_idx", "s", "fixed"]]

    return blocks.groupBy("document").applyInPandasWithState(step, OUTPUT, "last bigint", "append", GroupStateTimeout.NoTimeout)
