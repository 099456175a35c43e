"""Hooks for user code: a splitter as a table function, a mapper with set-up per task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf


def register_splitter(spark: SparkSession, name: str, split: Callable[[str], list[str]]) -> None:
    """Register `split` as a table function: one row per piece, usable with LATERAL in SQL."""

    class Splitter:
        def eval(self, text: str):
            if text is not None:
                for piece in split(text):
                    yield (piece,)

    spark.udtf.register(name, udtf(Splitter, returnType="word string", useArrow=True))


def map_with_setup(
    df: DataFrame,
    setup: Callable[[], object],
    each: Callable[[object, pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Map batches of rows with user code that needs something made once per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = setup()
        for batch in batches:
            yield each(tool, batch)

    return df.mapInPandas(run, schema)
