"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

import asiento
from asiento.sources.shared import write_shared

__all__ = ["fold_ascii", "fold_of", "read_table", "row_key", "ship", "streamed", "write_shared"]

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every Python worker of the application this package, wherever it was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(asiento.__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="asiento-")) / "asiento.zip"  # Spark sends it on
    with ZipFile(archive, "w") as files:
        for file in root.rglob("*.py"):
            files.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(text: Column) -> Column:
    """Next to ``doc_id``: tells rows of one ``doc_id`` with different texts apart.

    Rows that agree in both are copies, and every operator decides alike about copies. The
    key is a function of the row, so a task that runs again gives the same one.
    """
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fold_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is.

    ``lower`` does just that to ASCII, at the speed of a byte loop; ``translate`` is only
    needed where other letters must be left alone.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; NULL ids count as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % F.lit(folds)).cast("int")


def streamed(df: DataFrame, name: str, parts: int = 8) -> Iterator[Row]:
    """The rows of a bounded table, on the driver, a part at a time.

    ``toLocalIterator`` runs one job for each partition, one after another. So the rows are computed first, all
    partitions at once, and what is fetched is a few parts of the files.
    """
    return write_shared(df, name).coalesce(parts).toLocalIterator()
