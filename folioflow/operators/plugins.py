"""How model calls plug in.

A plug-in is ``fn(batches) -> batches`` over pandas frames: it gets the input columns it asked
for and yields, per batch and in row order, a frame with its output columns. It runs once per
task, so a client made before its loop is made once.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Plugin = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def apply_plugin(
    df: DataFrame, fn: Plugin, inputs: list[str], outputs: str, batch_rows: int | None = None, error: str | None = None
) -> DataFrame:
    """``df`` with the plug-in's output columns (a DDL string) added.

    With ``error``, a column of that name takes what the plug-in yields as ``error``; and where
    the plug-in itself raises, the rows that it was given and has not answered get the failure
    there, and it is started anew for the rest.
    """
    added = T.StructType.fromDDL(outputs)
    told = list(added.names)
    if error:
        added = added.add(error, "string")
    schema = T.StructType([*[f for f in df.schema.fields if f.name not in added.names], *added.fields])
    kept = [f.name for f in schema.fields if f.name not in added.names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: deque[pd.DataFrame] = deque()

        def feed() -> Iterator[pd.DataFrame]:
            for batch in batches:
                step = batch_rows or max(len(batch), 1)
                for start in range(0, len(batch), step):
                    piece = batch.iloc[start : start + step].reset_index(drop=True)
                    waiting.append(piece)
                    yield piece[inputs]

        def joined(piece: pd.DataFrame, result: pd.DataFrame) -> pd.DataFrame:
            if len(result) != len(piece):
                raise ValueError(f"the plug-in gave {len(result)} rows for a batch of {len(piece)}")
            result = result.reset_index(drop=True)
            columns = result[told]
            if error:
                columns = columns.assign(**{error: result["error"] if "error" in result.columns else None})
            return pd.concat([piece[kept], columns], axis=1)

        given, going = feed(), True
        while going:
            results = iter(fn(given))
            try:
                for result in results:
                    yield joined(waiting.popleft(), result)
                going = False
            except Exception as failure:  # noqa: BLE001 - with an error column, every failure becomes a row status
                if not error or not waiting:
                    raise
                why = f"{type(failure).__name__}: {failure}"
                while waiting:
                    piece = waiting.popleft()
                    lost = pd.DataFrame({name: pd.Series([None] * len(piece), dtype=object) for name in told})
                    yield joined(piece, lost.assign(error=why))
        if waiting:
            raise ValueError(f"the plug-in left {len(waiting)} batches without a result")

    return df.mapInPandas(run, schema)


def per_page(call: Callable[..., object], output: str) -> Plugin:
    """A plug-in from a function of one page; what it raises ends in the ``error`` column.

    A failing page does not take the rest of its file along.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values, errors = [], []
            for row in batch.itertuples(index=False):
                try:
                    values.append(call(*row))
                    errors.append(None)
                except Exception as failure:  # noqa: BLE001 - every failure becomes a row status
                    values.append(None)
                    errors.append(f"{type(failure).__name__}: {failure}")
            yield pd.DataFrame({output: pd.Series(values, dtype=object), "error": pd.Series(errors, dtype=object)})

    return run
