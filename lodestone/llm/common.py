"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import lodestone

# Python functions travel with their code: executors need no copy of this library.
cloudpickle.register_pickle_by_value(lodestone)

# White space of the word rule, and the ASCII capitals that are lower-cased.
WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def whole_text(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only, so that the result has the same code points elsewhere."""
    return F.translate(text, UPPER, LOWER)


def words_by(text: Column, separator: str) -> Column:
    """Array of the non-empty pieces between separators."""
    return F.array_remove(F.split(text, separator, -1), "")


def running(sizes: Column, block: int = 128) -> Column:
    """For every entry of an array of numbers the sum of those before it.

    Appending copies an array, so that sums are appended within blocks, and once per block.
    """
    last = F.greatest(F.size(sizes) - 1, F.lit(0))
    empty = F.array().cast("array<int>")

    def sums(values: Column, start: Column) -> Column:
        first = F.struct(start.cast("int").alias("at"), empty.alias("out"))
        return F.aggregate(values, first, lambda a, x: F.struct((a["at"] + x).cast("int").alias("at"), F.array_append(a["out"], a["at"]).cast("array<int>").alias("out")))["out"]

    blocks = F.transform(F.sequence(F.lit(0), last, F.lit(block)), lambda i: F.slice(sizes, i + 1, block))
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: (a + x).cast("int")))
    return F.flatten(F.zip_with(blocks, sums(totals, F.lit(0)), sums))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is set only in a local session that names none (as in tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            spark.sparkContext.setCheckpointDir(named)
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    made = f"file://{tempfile.mkdtemp(prefix='lodestone-checkpoint-')}"
    spark.sparkContext.setCheckpointDir(made)
    return made


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Arrow batches of about ``size`` bytes, so that a Python worker's memory follows neither the number of
    rows nor their length; a size that the session names already is left alone."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, str(size))


def pieces(column: pa.Array, most: int = 1 << 20):
    """Slices of about a megabyte of a string column, so that memory follows the slice and not the batch."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(column).to_pylist()):
        size += n
        if size >= most:
            yield column.slice(at, i + 1 - at)
            at, size = i + 1, 0
    if at < len(column):
        yield column.slice(at)


def trim() -> None:
    """Returns freed memory to the system at the end of a task: a Python worker outlives it, and other tasks need the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trimmed = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trimmed:
        trimmed(0)


def checkpointed(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder and cuts the lineage, so that lost executors cost no recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def few_parts(stored: DataFrame, n: int, each: int = 20_000) -> DataFrame:
    """Stored narrow rows, n in number, read in as many partitions as they need, at least one a core.

    Every partition costs a shuffle that reads it some small files, however few its rows are.
    """
    return stored.coalesce(max(stored.sparkSession.sparkContext.defaultParallelism, -(-n // each)))


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """``compacted`` and the number of rows: the driver keeps a record of every query, so that none is asked twice."""
    stored = checkpointed(df)
    n = stored.count()
    return few_parts(stored, n), n


def compacted(df: DataFrame) -> DataFrame:
    """``checkpointed`` for narrow rows of unknown number, in few partitions."""
    return counted(df)[0]


def bounded_broadcast(df: DataFrame, most: int = 500_000, n: int | None = None) -> DataFrame:
    """Marks a stored table of narrow rows, n if that is known, for broadcast if it has at most so many; beyond that it is joined by a shuffle."""
    return F.broadcast(df) if (df.count() if n is None else n) <= most else df


def release(spark: SparkSession) -> None:
    """Lets go of shuffle files and checkpoints that nothing refers to any more: Spark drops them when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- bit votes

BYTES, PAIR = 0x0101010101010101, 0x000000FF000000FF  # eight counters of 8 bits; two of 32


def votes(terms: DataFrame, keys: list[str], hashes: list[str], position: str, weight: str | None = None, most: int = 1) -> DataFrame:
    """keys, total and the packed votes v{hash}_{bit} of every text.

    terms has one row per term: keys, its position in the text, 64-bit hashes (null: no term) and a
    weight from 1 to ``most``.  Blocks of a few dozen consecutive terms are counted first, in eight
    8-bit counters per long, so that a term costs eight additions per hash; the blocks of a text are
    then added in 32-bit counters.  Both steps aggregate on the map side.
    """
    w = F.lit(1).cast("long") if weight is None else F.col(weight).cast("long")
    zero = F.lit(0).cast("long")

    def lanes(h: str, k: int) -> Column:
        x = F.shiftrightunsigned(F.coalesce(F.col(h), zero), k).bitwiseAND(F.lit(BYTES))
        return F.sum(x if weight is None else x * w).alias(f"c_{h}_{k}")

    # 127 is the largest count that leaves the top counter's sign alone
    block = (F.col(position) / F.lit(127 // most)).cast("int")
    total = F.sum(F.when(F.col(hashes[0]).isNotNull(), w).otherwise(zero)).alias("n")
    blocks = terms.groupBy(*keys, block.alias("block")).agg(total, *[lanes(h, k) for h in hashes for k in range(8)])
    sums = [F.sum(F.shiftrightunsigned(f"c_{h}_{k % 8}", k // 8 * 8).bitwiseAND(F.lit(PAIR))).alias(f"v{j}_{k}") for j, h in enumerate(hashes) for k in range(32)]
    return blocks.groupBy(*keys).agg(F.sum("n").alias("total"), *sums)


def voted_bits(j: int, total: Column) -> Column:
    """The 64-bit fingerprint whose bits are set where more than half of the weight voted for them."""
    low = F.lit(0xFFFFFFFF)
    bits = []
    for k in range(32):
        s = F.col(f"v{j}_{k}")
        bits.append(F.when(s.bitwiseAND(low) * 2 > total, F.lit(1 << k)).otherwise(F.lit(0).cast("long")))
        top = -(1 << 63) if k == 31 else 1 << (k + 32)
        bits.append(F.when(F.shiftrightunsigned(s, 32) * 2 > total, F.lit(top)).otherwise(F.lit(0).cast("long")))
    # a balanced tree keeps the expression shallow
    while len(bits) > 1:
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2], strict=True)]
    return bits[0]


def hex16(value: Column) -> Column:
    """16 lowercase hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
