"""Work that may fail: batches tried again row by row, failures named, stamps only for what succeeded."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Work = Callable[[pd.DataFrame], pd.Series]


def attempted(rows: DataFrame, work: Work) -> DataFrame:
    """With result and error: `work` gives a text for each row of an Arrow batch.

    A batch that raises is halved and tried again, down to single rows, so that a bad row names itself
    and costs no other row its result. Where the first half passes, the second is to blame and is
    halved untried. A task that is lost is run again whole; what it gave before is not counted.
    """

    def tried(batch: pd.DataFrame, blamed: bool = False) -> tuple[list, list, bool]:
        """Results, errors, and whether all rows passed."""
        if not blamed or len(batch) == 1:
            try:
                return list(work(batch)), [None] * len(batch), True
            except Exception as e:
                if len(batch) == 1:
                    return [None], [f"{type(e).__name__}: {e}"[:120]], False
        half = len(batch) // 2
        one, faults, passed = tried(batch.iloc[:half])
        two, more, _ = tried(batch.iloc[half:], passed)
        return one + two, faults + more, False

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done, errors, _ = tried(batch) if len(batch) else ([], [], True)
            yield batch.assign(result=done, error=errors)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInPandas(run, f"{fields}, result string, error string")


def said(done: DataFrame) -> DataFrame:
    """path, said of each clip (path, hash, voice, error): its stamp if it was made, else its error; the work runs once."""
    return done.select("path", F.coalesce("error", F.concat_ws(" ", "hash", "voice")).alias("said"))


def stamped(done: DataFrame) -> DataFrame:
    """path, stamp (hash and voice) of the clips (path, hash, voice, error) that were made."""
    return done.where("error is null").select("path", F.concat_ws(" ", "hash", "voice").alias("stamp"))
