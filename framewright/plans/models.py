"""Model calls as iterator UDFs: built once a task, fed in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


class Model(Protocol):
    """Maps a batch of frames (flat value arrays) to one result a frame."""

    def __call__(self, frames: list, /) -> list: ...


def model_column(build: Callable[[], Model], result: str, *inputs: Column, batch: int = 32) -> Column:
    """A column of model results. ``build`` runs once a task, so no state is set before the task has it."""

    @F.pandas_udf(result)
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = build()
        for part in parts:
            rows = list(zip(*([part] if isinstance(part, pd.Series) else part), strict=True))
            out: list = []
            for a in range(0, len(rows), batch):
                out += model([r[0] if len(r) == 1 else r for r in rows[a : a + batch]])
            yield pd.Series(out)

    return run(*inputs)
