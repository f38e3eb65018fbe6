"""What the operators share: table reads, text words, folds and small table checks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.session import fresh_dir

#: Bytes of an Arrow batch that goes to a Python worker; rows of texts differ in size, so a bound
#: on rows alone bounds neither the worker's memory nor the buffers on Spark's side.
BATCH_BYTES = 4 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Characters that part words: space and \t \n \v \f \r (what ``bytes.split`` splits on).
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches to BATCH_BYTES, unless the session has a bound of its own.
    A batch is planned when its query runs, so the bound stays."""
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))


def fold(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id falls in fold 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of)), F.lit(0))


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [t or "" for t in batch.column(name).to_pylist()]


def arrow_map(df: DataFrame, make, schema: str) -> DataFrame:
    """``mapInArrow`` where ``make()`` builds, once per task, the function of a batch.

    ``make`` returns a function RecordBatch -> dict of columns (in the schema's order)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            if b.num_rows:
                cols = step(b)
                if cols is not None:
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(f.type) if isinstance(c, (pa.Array, pa.ChunkedArray))
                         else pa.array(c, f.type) for c, f in zip(cols, out, strict=True)],
                        schema=out)

    return df.mapInArrow(run, schema)


def arrow_rows(df: DataFrame, make) -> DataFrame:
    """``mapInArrow`` that keeps the schema: ``make()`` builds, once per task, a function
    RecordBatch -> RecordBatch (some of its rows, or other values in them)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            if b.num_rows:
                yield step(b)

    return df.mapInArrow(run, df.schema)


def int_lists(lists: list) -> pa.ListArray:
    """Many lists of small non-negative ints as one Arrow list column."""
    from itertools import chain

    import numpy as np

    ends = np.zeros(len(lists) + 1, np.int32)
    np.cumsum(np.fromiter(map(len, lists), np.int32, len(lists)), out=ends[1:])
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def written(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.  Unlike a checkpoint it
    carries no constraints over from the plan behind it, which in a loop would grow with
    every turn; use ``cut`` where row numbers are taken from the result."""
    path = fresh_dir(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
