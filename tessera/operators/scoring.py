"""The caller's predictor over a table of rows, each scored exactly once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import coverage_problems, require_empty
from .lineage import written


def score_rows(rows: DataFrame, predict: Callable[[Any, pd.DataFrame], pd.DataFrame], schema: str, model: Any = None, batch_size: int = 64, id_col: str = "roi_id") -> DataFrame:
    """The caller's predictor over all rows, each exactly once: predict(model, batch) gets batch_size rows (the last batch of a partition fewer).

    The model is broadcast once. A batch must give as many rows as it has; all outputs together must have each id of the rows once, else
    this raises, also for rows whose id is null, empty or repeated. The outputs are written before they are checked, so the
    predictor runs once.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        count = 0

        def scored(last: bool) -> Iterator[pd.DataFrame]:
            whole = pd.concat(held, ignore_index=True) if held else pd.DataFrame()
            stop = len(whole) if last else len(whole) - len(whole) % batch_size
            for at in range(0, stop, batch_size):
                batch = whole.iloc[at : min(at + batch_size, stop)].reset_index(drop=True)
                out = predict(shared.value, batch)
                if len(out) != len(batch):
                    raise ValueError(f"the predictor gave {len(out)} rows for a batch of {len(batch)}")
                yield out
            held[:] = [whole.iloc[stop:]] if stop < len(whole) else []

        for frame in frames:
            held.append(frame)
            count += len(frame)
            if count >= batch_size:
                yield from scored(False)
                count = sum(map(len, held))
        yield from scored(True)

    require_empty(rows.groupBy(id_col).agg(F.count("*").alias("n")).where((F.coalesce(F.col(id_col).cast("string"), F.lit("")) == "") | (F.col("n") > 1)), "rows to score need unique ids")
    out = written(rows.mapInPandas(run, schema), "scored")
    require_empty(coverage_problems(rows, out, id_col), "the predictor must return each id once")
    return out
