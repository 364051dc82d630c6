"""Helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the contracts: blank and the control characters 09 to 0D. bytes.split() cuts at the same six.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of UTF-8 text with A-Z lower-cased and all else kept.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where lambdas inside ``use`` refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, null as empty, without a Python string in between."""
    for value in column:
        raw = value.as_buffer()
        yield b"" if raw is None else raw.to_pybytes()


def slices(column: pa.Array, most: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """A text column in runs of rows of about so many bytes, with the number of the first row."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > most:
            yield start, column.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < len(column):
        yield start, column.slice(start)


def tokenizer_file(name: str) -> str:
    """Where the installed public vocabularies lie, or the folder that LLM_TOKENIZERS names."""
    if folder := os.environ.get("LLM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)

