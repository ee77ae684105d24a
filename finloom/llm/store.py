"""Tables that cut a job in two: written to the session's shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finloom.scratch import fresh_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The rows as they are now; what reads them later does not repeat the work, also after losing executors."""
    folder = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name the frame does not have yet, also not in other case."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish
