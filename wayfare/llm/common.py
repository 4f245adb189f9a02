"""Helpers that the operators share: batch bounds, words, row ids and table access."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.session import materialise

# Rows and bytes that Spark hands to a Python worker at once. Long texts fill the bytes first.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20
# The six bytes that separate words.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

ROW = "_wf_row"


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session, so that a worker never holds many long texts.

    Also makes sure that workers can import this package.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, unless they find it where the driver does."""
    root = Path(__file__).resolve().parents[2]
    found = {Path.cwd(), *map(Path, os.environ.get("PYTHONPATH", "").split(os.pathsep))}
    app = spark.sparkContext.applicationId
    if root in found or app in _shipped:
        return
    # The folder lasts as long as the driver, since executors fetch the file when they start.
    folder = tempfile.TemporaryDirectory(prefix="wayfare-package-")
    archive = Path(folder.name) / "wayfare.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted((root / "wayfare").rglob("*.py")):
            out.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(archive))
    _shipped[app] = folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_rows(df: DataFrame) -> DataFrame:
    """Write `df` as one struct per row, `_doc`, with a unique id `_wf_row`, and read it back.

    Ids are fixed by the write, so later stages may join on them whatever is recomputed. In the
    struct, the columns of `df` can not clash with any that an operator adds.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    return materialise(
        df.select(F.struct(*columns).alias("_doc"), F.monotonically_increasing_id().alias(ROW))
    )


def fields_of(df: DataFrame, replaced: dict[str, Column] | None = None) -> list[Column]:
    """The columns inside `_doc`, some of them replaced."""
    new = replaced or {}
    return [
        new[c].alias(c) if c in new else F.col(f"_doc.{quoted(c)}").alias(c)
        for c in df.schema["_doc"].dataType.names
    ]


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def words_of(text: str) -> list[bytes]:
    """Words between ASCII blanks; `bytes.split` cuts at exactly the six bytes of BLANKS."""
    return text.encode("utf-8", "surrogatepass").split()


def texts_in(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def file_place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a place in the shared folder, for code inside tasks."""
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
