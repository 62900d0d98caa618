"""Order-dependent work inside a key: a left-to-right fold that never holds a whole group."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def ordered_fold(df: DataFrame, keys: list[str], order: list[str], values: list[str], step: Callable, out: str) -> DataFrame:
    """keys, order and the fold's verdict ('name type') for each row.

    step(state, *values) -> (state, verdict), with state None at each key's first row. Rows are dealt by key and
    sorted in their partition; only the state is carried from one batch to the next.
    """
    columns = [*keys, *order]
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns) + f", {out}"
    name = out.split()[0]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, state = None, None
        for batch in batches:
            verdicts = []
            for key, row in zip(batch[keys].itertuples(index=False, name=None), batch[values].itertuples(index=False, name=None), strict=True):
                if key != last:
                    last, state = key, None
                state, verdict = step(state, *row)
                verdicts.append(verdict)
            yield batch[columns].assign(**{name: verdicts})

    dealt = df.select(*dict.fromkeys([*columns, *values])).repartition(*keys).sortWithinPartitions(*columns)
    return dealt.mapInPandas(run, schema)


def chain_map(df: DataFrame, keys: list[str], order: list[str], values: list[str], solve: Callable, out: str) -> DataFrame:
    """keys, order and a verdict for each row, from solve(rows of one chain) -> verdicts.

    keys name a chain that barriers keep short; one chain is held at a time.
    """
    columns = [*keys, *order]
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns) + f", {out}"
    names = [*columns, out.split()[0]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, ids, rows = None, [], []

        def done() -> list[tuple]:
            return [(*i, v) for i, v in zip(ids, solve(rows), strict=True)] if rows else []

        for batch in batches:
            ready = []
            for key, at, row in zip(
                batch[keys].itertuples(index=False, name=None), batch[columns].itertuples(index=False, name=None),
                batch[values].itertuples(index=False, name=None), strict=True,
            ):
                if key != last:
                    ready += done()
                    last, ids, rows = key, [], []
                ids.append(at)
                rows.append(row)
            yield pd.DataFrame(ready, columns=names)
        yield pd.DataFrame(done(), columns=names)

    dealt = df.select(*dict.fromkeys([*columns, *values])).repartition(*keys).sortWithinPartitions(*columns)
    return dealt.mapInPandas(run, schema)
