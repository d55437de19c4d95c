"""What the operators share: stored tables, learning splits and batches of texts that carry their rows along."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from triagelake.sources.session import fresh_path, remove

#: A word is a run of anything but ASCII white space; fixed by the contract of the queries.
WORD = r"[^\x20\x09-\x0D]+"

_STORED: list[str] = []
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of all executors, once per application, so that it need not be installed there."""
    if spark.sparkContext.applicationId not in _SHIPPED:
        _SHIPPED.add(spark.sparkContext.applicationId)
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="triagelake-")) / "triagelake.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
    return spark


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back, so that what follows starts from files that all executors see."""
    spark = rows.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    rows.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(rows.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Delete the tables written so far; call it when no result that reads them is needed any more."""
    remove(spark, *_STORED)
    _STORED.clear()


def remainder(divisor: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``: the learning split that the contract fixes."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % divisor


def with_columns(rows: DataFrame, fields: list[StructField], score: Callable[[], Callable[[list], list[pa.Array]]],
                 text: str = "text") -> DataFrame:
    """Rows with further columns computed from their texts in Arrow batches; all given columns pass through untouched.

    ``score()`` is called once in each task and returns a function from a list of texts (UTF-8 bytes, b"" for null) to the new
    columns.  The new names must not be among those of ``rows``.
    """
    clash = {f.name for f in fields} & set(rows.columns)
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = score()
        for batch in batches:
            values = [v or b"" for v in batch.column(text).cast(pa.binary()).to_pylist()]
            new = function(values)
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *(f.name for f in fields)])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *fields]))


def bounded_sample(rows: DataFrame, most: int, salt: int, key: str = "doc_id") -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of their key, so that reruns agree; all rows if there are no more than that."""
    n = rows.count()
    if n <= most:
        return rows
    return rows.where(F.xxhash64(F.lit(salt), F.col(key)).bitwiseAND(F.lit((1 << 30) - 1)) < int((1 << 30) * most / n))
