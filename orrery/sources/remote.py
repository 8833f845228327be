"""Rows of a remote service, asked for a batch of scopes at a time by the tasks themselves.

Scopes are a DataFrame and stay one: they are dealt out in batches, each batch is one call, made and repeated within its task. The number of
tasks bounds how many calls run at once, and a task pauses between its calls. The rows are stored, so that the service is asked once
whatever is done with them; a task that runs again asks again, which a service that only reads doesn't mind.

A transport is a function from a list of scopes to rows, which must not depend on how scopes are batched. `file_transport` is one that
reads a folder of Parquet files, for tests and for services that are mirrored. Null scopes are not asked for, repeated ones once; no scopes, no
call. Temporary failures are tried again after a fixed delay; the last one fails the task, and so, after Spark's own retries, the job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators.graph import stored
from orrery.sources.read import retried

Transport = Callable[[list], Iterable[tuple]]


def fetched(scopes: DataFrame, transport: Transport, schema: str, batch: int = 50, tasks: int = 8, retries: int = 3, delay: float = 2.0, pause: float = 1.0) -> DataFrame:
    """The rows (of `schema`) that the service has for a one-column table of scopes."""
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        called = False
        for part in parts:
            for at in range(0, len(part), batch):
                if called:
                    time.sleep(pause)
                called, asked = True, part.iloc[at : at + batch, 0].tolist()
                rows = retried(lambda asked=asked: list(transport(asked)), retries, delay)
                yield pd.DataFrame(rows, columns=columns)

    name = scopes.columns[0]
    # a fixed order makes the batches of a task that runs again the same
    dealt = scopes.where(F.col(name).isNotNull()).distinct().repartition(tasks, name).sortWithinPartitions(name)
    return stored(dealt.mapInPandas(run, schema))


def file_transport(folder: str, scope: str, columns: list[str]) -> Transport:
    """Answers from Parquet files in a folder that all executors see: the rows whose `scope` column is one of those asked for."""

    def ask(scopes: list) -> list[tuple]:
        import pyarrow.dataset as ds

        rows = ds.dataset(folder.removeprefix("file://"), format="parquet", exclude_invalid_files=True).to_table(columns=columns, filter=ds.field(scope).isin(scopes))
        return list(zip(*(rows[c].to_pylist() for c in columns)))

    return ask
