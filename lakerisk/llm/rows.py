"""Column helpers the operators share: folds, labels, and scoring that keeps a table's columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm import text


def remainder(divisor: int) -> Column:
    """crc32 of doc_id as text, modulo `divisor`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(divisor))


def labelled(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label) with one row per document: the majority of its marks, 1 on a tie."""
    known = labels.filter(F.col(name).isNotNull() & F.col("doc_id").isNotNull())
    return known.groupBy("doc_id").agg((F.avg(name) >= 0.5).cast("int").alias("label"))


def with_columns(
    docs: DataFrame, added: dict[str, T.DataType], compute: Callable[[pa.RecordBatch], list[np.ndarray]], column: str = "text"
) -> DataFrame:
    """`docs` with the columns `compute` gives for each group of rows; same-named ones are replaced."""
    kept = [f for f in docs.schema.fields if f.name not in added]
    schema = T.StructType(kept + [T.StructField(n, t) for n, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text.groups(whole, column):
                values = [pa.array(v) for v in compute(batch)]
                yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + values, names=schema.names)

    return docs.mapInArrow(run, schema)
