"""Helpers that several operators of this folder share."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes that are no part of a word in the word rule of licences and benchmarks: all ASCII but digits and letters.
_WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def alnum_words(raw: bytes) -> list[bytes]:
    """Words of letters, digits and all that is not ASCII, with A-Z lower-cased, from UTF-8."""
    return raw.translate(_WORD_BYTES).split()


def blank_words(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z lower-cased, from UTF-8."""
    return raw.lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Slots:
    """A bit set of fixed size that tells rows which cannot matter from those which may.

    Its size does not depend on the data, so it may be sent to every task. A set bit only says
    "perhaps": what passes is still joined exactly, so the set changes cost and never results.
    """

    BITS = 1 << 23

    def __init__(self, keys: DataFrame, column: str):
        """``column`` of ``keys`` holds longs. At most ``BITS / 64`` numbers reach the driver."""
        slot = slot_of(F.col(column))
        words = (
            keys.select(slot.alias("slot"))
            .groupBy(F.expr("slot div 64").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("bits"))
            .toPandas()
        )
        packed = np.zeros(self.BITS // 64, dtype=np.int64)
        packed[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
        self.sent = keys.sparkSession.sparkContext.broadcast(packed.view(np.uint64))


def slot_of(key: Column) -> Column:
    """The slot of a long, the same here and in ``slots_of``."""
    return F.shiftrightunsigned(key.bitwiseXOR(F.shiftrightunsigned(key, 29)), 11).bitwiseAND(F.lit(Slots.BITS - 1))


def slots_of(keys: np.ndarray) -> np.ndarray:
    return ((keys ^ (keys >> np.uint64(29))) >> np.uint64(11)) & np.uint64(Slots.BITS - 1)


def holds(packed: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Which of the slots are set."""
    return (packed[(slots >> np.uint64(6)).astype(np.int64)] >> (slots & np.uint64(63))) & np.uint64(1) == 1


_SENT: set[str] = set()


def ready_for_python(spark: SparkSession, size: int = 4 << 20) -> None:
    """What every operator with Python in its tasks needs of the session.

    No batch of rows that goes to Python holds more than ``size`` bytes, unless one row does: a batch is
    held several times over while it is converted, and the default is too much for long texts. And the
    tasks' Python finds this package, which the driver sends along once.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SENT.add(context.applicationId)
