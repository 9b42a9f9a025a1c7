"""Helpers shared by the corpus operators: the shared folder, stored tables, slices of text batches."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word: the space and the control characters from tab to carriage return.
#: These are also the characters at which ``bytes.split()`` splits.
SPACE = r"\x20\x09-\x0D"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a session on a local master may leave it unset; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="keyscout-llm-"))
    return context.getCheckpointDir().rstrip("/")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, which need not have it installed; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="keyscout-package-")) / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, str(file.relative_to(root.parent)))
        context.addPyFile(str(path))
        _SHIPPED.add(context.applicationId)
    return spark


def new_path(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read again, for several readers."""
    path = new_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_list(text: Column) -> Column:
    """The words of a text (none for null), without Python."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def slices(sizes: Iterable[int], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of these sizes that hold about ``limit`` bytes together, or one longer text."""
    start = held = end = 0
    for end, size in enumerate(sizes, 1):
        if held and held + size > limit:
            yield start, end - 1
            start, held = end - 1, 0
        held += int(size) + 64
    if start < end:
        yield start, end


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """The words of texts as codes, how many each text has, and the word of each code. A null text has none."""
    texts = pc.fill_null(texts, "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    words = split.flatten()
    full = pc.binary_length(words).to_numpy() > 0
    upto = np.concatenate([[0], np.cumsum(full)])[split.offsets.to_numpy() - split.offsets[0].as_py()]
    coded = words.filter(pa.array(full)).dictionary_encode()
    return coded.indices.to_numpy(), np.diff(upto), coded.dictionary.cast(pa.binary()).to_pylist()


def text_length(column: str) -> Column:
    """Code points of a text as a long, null for null."""
    return F.length(column).cast("long")
