"""Helpers that several operators share: settings, scratch tables and flat text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.session import scratch

# Words of the contracts. WHITE splits on ASCII white space; PLAIN also on ASCII punctuation.
WHITE_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Bytes of text that one step of a Python task works on; one longer text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in bytes, so that long texts do not add up in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def settle(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: it is computed once, and executors may be lost."""
    path = scratch(df.sparkSession, label)
    df.write.mode("overwrite").option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only, as the contracts ask; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of the frame has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def hash_share(value: Column) -> Column:
    """A number from 0 up to 1 that a hash of the value fixes: keeping rows below a share draws the same sample on every run."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("double") / float(1 << 32)


def row_digest(*columns: Column) -> Column:
    """A 128-bit key of a row's values that tells null from empty, so that equal rows, and only those, share it."""
    parts = [F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.md5(F.concat_ws("|", *parts))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, and where each row begins and ends in it (null: empty)."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(at) == 0 or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


def steps(offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together have about ``limit`` bytes at most."""
    rows, begin = len(offsets) - 1, 0
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), rows)
        yield begin, end
        begin = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (an invertible finaliser of shifts and odd multiplications)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))
