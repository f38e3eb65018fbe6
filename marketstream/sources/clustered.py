"""The trades table kept clustered by (symbol, ts) over all its batches.

Rows are laid out along a space-filling curve over the symbol's bucket and the time, so a file
holds few symbols and a short time both at once.  A version of the table is one manifest: its
files, each with its rows and the ranges of bucket and time in it.  A reader takes one version
and opens only files whose ranges meet its question.  Appends and compaction write new files
first and then the next manifest, under a number that must be free; who comes second looks at
the new version and tries again, so nothing is lost and a reader never sees half a change.

Compaction rewrites the files of fewer than ``least_rows`` rows along the curve; the files of
older versions stay for the readers that still use them (``unused`` lists them).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream import files

BITS = 8                # of each coordinate on the curve
FILE_ROWS = 1 << 20


@dataclass(frozen=True)
class File:
    """A data file: rows, and its ranges of the symbol's bucket and of ts."""

    name: str
    rows: int
    low: int
    high: int
    first: int
    last: int


def bucket(symbol: Column) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(1 << BITS)).cast("int")


def curve(x: Column, y: Column) -> Column:
    """The place of (x, y) on the Z curve: their bits in turn, the highest first."""
    place = F.lit(0).cast("long")
    for k in range(BITS):
        for c, at in ((y, 2 * k), (x, 2 * k + 1)):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), k).bitwiseAND(F.lit(1)), at))
    return place


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in files.names(spark, f"{path}/_versions") if n.isdigit()]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[File]]:
    """(version, its files); version 0, without files, before the first append."""
    found = _versions(spark, path)
    v = version if version is not None else max(found, default=0)
    if not v:
        return 0, []
    return v, [File(**f) for f in json.loads(files.read_text(spark, f"{path}/_versions/{v:010d}"))]


def _swap(spark: SparkSession, path: str, gone: set[str], new: list[File]) -> int:
    """The next version: without ``gone``, with ``new``."""
    while True:
        v, now = manifest(spark, path)
        if not gone <= {f.name for f in now}:
            raise RuntimeError("files to be replaced are no longer in the table")
        listed = json.dumps([asdict(f) for f in now if f.name not in gone] + [asdict(f) for f in new])
        if files.write_new(spark, f"{path}/_versions/{v + 1:010d}", listed):
            return v + 1


def _written(rows: DataFrame, path: str, file_rows: int) -> list[File]:
    """``rows`` as new files along the curve, in no version yet."""
    spark = rows.sparkSession
    folder = f"data-{uuid.uuid4().hex[:12]}"
    span = rows.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    if span["a"] is None:
        return []
    width = (span["b"] - span["a"]) // (1 << BITS) + 1
    at = curve(bucket(F.col("symbol")), F.floor((F.col("ts") - span["a"]) / width))
    (rows.withColumn("_z", at).repartitionByRange("_z", "symbol", "ts")
     .sortWithinPartitions("_z", "symbol", "ts").drop("_z")
     .write.option("maxRecordsPerFile", file_rows).parquet(f"{path}/{folder}"))
    b = bucket(F.col("symbol"))
    stats = (spark.read.schema(rows.schema).parquet(f"{path}/{folder}")
             .groupBy(F.col("_metadata.file_name").alias("f"))
             .agg(F.count(F.lit(1)).alias("n"), F.min(b).alias("lo"), F.max(b).alias("hi"),
                  F.min("ts").alias("a"), F.max("ts").alias("b")))
    # one row per file
    return [File(f"{folder}/{r['f']}", r["n"], r["lo"], r["hi"], r["a"], r["b"])
            for r in stats.orderBy("f").collect()]


def append(rows: DataFrame, path: str, file_rows: int = FILE_ROWS) -> int:
    """Add rows (with symbol and ts, both not null); the new version."""
    new = _written(rows, path, file_rows)
    return _swap(rows.sparkSession, path, set(), new)


def compact(spark: SparkSession, path: str, file_rows: int = FILE_ROWS,
            least_rows: int | None = None) -> int:
    """Lay the files of fewer than ``least_rows`` rows (half a file) out along the curve
    again; the new version, or the present one if there are not two of them."""
    v, now = manifest(spark, path)
    small = [f for f in now if f.rows < (least_rows or file_rows // 2)]
    if len(small) < 2:
        return v
    rows = spark.read.parquet(*[f"{path}/{f.name}" for f in small])
    return _swap(spark, path, {f.name for f in small}, _written(rows, path, file_rows))


def chosen(spark: SparkSession, path: str, symbol: str | None = None, first: int | None = None,
           last: int | None = None, version: int | None = None) -> list[File]:
    """The files that may hold rows of ``symbol`` with ``first`` <= ts < ``last``."""
    _, now = manifest(spark, path, version)
    if symbol is not None:
        b = spark.range(1).select(bucket(F.lit(symbol)).alias("b")).first()["b"]
        now = [f for f in now if f.low <= b <= f.high]
    return [f for f in now if (first is None or f.last >= first) and (last is None or f.first < last)]


def read(spark: SparkSession, path: str, schema, symbol: str | None = None, first: int | None = None,
         last: int | None = None, version: int | None = None) -> DataFrame:
    """The rows of one version, of a symbol and a time if given."""
    picked = [f"{path}/{f.name}" for f in chosen(spark, path, symbol, first, last, version)]
    rows = spark.read.schema(schema).parquet(*picked) if picked else spark.createDataFrame([], schema)
    for given, cond in ((symbol, F.col("symbol") == symbol), (first, F.col("ts") >= first),
                        (last, F.col("ts") < last)):
        if given is not None:
            rows = rows.where(cond)
    return rows


def unused(spark: SparkSession, path: str) -> list[str]:
    """Data folders that no file of the present version lies in."""
    used = {f.name.split("/")[0] for f in manifest(spark, path)[1]}
    return [n for n in files.names(spark, path) if n.startswith("data-") and n not in used]
