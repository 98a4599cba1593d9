"""Training-order materialisation: token ids in fixed-stride binary shards, in a keyed global order.

The documents' ids, each ended by a separator, form one stream in the order of the input table's
partitions; it is cut into sequences of ``length`` ids.  A keyed Feistel permutation with cycle-walking
maps sequence numbers one to one to slots: no sort by a random key and no table of it.  Slots are dealt
by range, ``per_shard`` to a shard, straight to the partition that writes the shard, so the one shuffle
moves each id once.  Record j of shard k holds slot k * per_shard + j at byte j * stride: a reader that
stopped at a slot goes on from there with one seek (``read_slots``).

Recovery: a shard is written under a temporary name and renamed when whole; a repeated task writes the
same bytes, and a shard that is there with its length and digest is not written again.  The manifest is
written last, by renaming: a folder without one is not complete.  What the shards hold is stored as a table
beside them, which is the result.

The stream's order is that of a scan's partitions, which both passes must see alike; the second checks
the first one's counts and fails otherwise.  So the input must be a stored table.

Nulls and ties: a null or empty text gives just a separator; repeated rows are written repeatedly; null
doc_ids are written and left out of the lists of ids; an empty table gives no shards and an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import ensure_checkpoint_dir, whole_text

SEPARATOR, PADDING = 0xFF, 0xFE  # bytes that UTF-8 never has
MANIFEST = "manifest.json"
LEVEL = 3  # of zstd, for what is shuffled


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit finaliser as round function."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def permuted(numbers: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """Slots of sequence numbers below n: a bijection of 0..n-1 that the key fixes.

    The Feistel network works on the least even number of bits that holds n; results of n or more are
    put in again until they are below (at most four times as many values, so few walks).
    """
    half = max(1, ((max(2, n) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [int.from_bytes(hashlib.blake2b(f"{key}:{r}".encode(), digest_size=8).digest(), "little") for r in range(rounds)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right, k) & mask)
        return left << shift | right

    out = once(np.asarray(numbers, np.uint64))
    while (walk := out >= n).any():
        out[walk] = once(out[walk])
    return out.astype(np.int64)


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def shard_name(k: int) -> str:
    return f"shard-{k:08d}.bin"


def materialised(docs: DataFrame, folder: str, length: int = 2048, per_shard: int | None = None, key: int = 20240229, ids: str | None = None, dtype: str = "<u4", separator: int | None = None, padding: int | None = None) -> DataFrame:
    """Writes the shards and the manifest; slot, shard, byte_offset, sequence, n_tokens, doc_ids, sha256.

    Without ``ids`` the ids of a text are its UTF-8 bytes, one byte each.  With the name of an
    array<int> column they are its values in ``dtype``, with the given separator and padding; an id that
    does not fit or equals the padding is an error.  A binary column holds a text's ids in ``dtype`` already.
    per_shard: sequences of a shard; unless given, 4,096, and more beyond 20,000 shards, up to 128 MB.
    The folder gets a manifest of the layout; shards of another layout are removed from it.
    """
    spark = docs.sparkSession
    if ids is None:
        dtype, separator, padding = "u1", SEPARATOR, PADDING
        payload, count = whole_text().cast("binary"), F.octet_length(whole_text()).cast("long") + 1
    else:
        if separator is None or padding is None:
            raise ValueError("ids need a separator and a padding id")
        payload, count = F.coalesce(F.col(ids).cast("array<int>"), F.array().cast("array<int>")), F.coalesce(F.size(ids), F.lit(0)).cast("long") + 1
    width = np.dtype(dtype).itemsize
    packed = ids is not None and docs.schema[ids].dataType.typeName() == "binary"
    if packed:
        payload, count = F.coalesce(ids, F.lit(b"")), F.floor(F.coalesce(F.octet_length(ids), F.lit(0)) / width) + 1
    # one number per partition of the table reaches the driver
    counts = {r.p: r.n for r in docs.select(F.spark_partition_id().alias("p"), count.alias("n")).groupBy("p").agg(F.sum("n").alias("n")).collect()}
    starts, total = {}, 0
    for p in sorted(counts):
        starts[p], total = total, total + counts[p]
    n = -(-total // length)
    size = length * width
    if per_shard is None:
        per_shard = max(1, min(max(4096, -(-n // 20_000)), (128 << 20) // size))
    shards = max(1, -(-n // per_shard))
    fit = np.iinfo(dtype)
    if ids is not None and not (fit.min <= separator <= fit.max and fit.min <= padding <= fit.max and separator != padding):
        raise ValueError(f"separator {separator} and padding {padding} have to differ and to fit {dtype}")
    end = np.array([separator], dtype).tobytes()
    layout = {"sequences": n, "ids": total, "length": length, "per_shard": per_shard, "shards": -(-n // per_shard), "dtype": dtype, "separator": separator, "padding": padding, "key": key}
    _make_room(folder, layout)

    def stored(raw: bytes) -> bytes:
        """Ids that come as bytes, after a look at them."""
        if ids is not None and (len(raw) % width or (np.frombuffer(raw, dtype) == padding).any()):
            raise ValueError(f"{len(raw)} bytes are no ids in {dtype} without the padding {padding}")
        return raw

    def encoded(values: np.ndarray) -> bytes:
        if len(values) and (values.min() < fit.min or values.max() > fit.max or (values == padding).any()):
            raise ValueError(f"ids from {values.min()} to {values.max()} do not fit {dtype} beside the padding {padding}")
        return values.astype(dtype).tobytes()

    def cut(batches):
        """Pieces of sequences in stream order, compressed for the shuffle: at most one a sequence and batch."""
        p, codec = TaskContext.get().partitionId(), pa.Codec("zstd", compression_level=LEVEL)
        at = first = starts.get(p, 0)
        for batch in batches:
            doc_ids, parts, lengths = batch.column("doc_id").to_pylist(), [], []
            for x in batch.column("ids"):
                raw = stored(x.as_buffer().to_pybytes()) if ids is None or packed else encoded(x.values.to_numpy(zero_copy_only=False))
                parts.append(raw + end)
                lengths.append(len(raw) // width + 1)
            if not parts:
                continue
            data, ends = b"".join(parts), at + np.cumsum(lengths)
            seqs = np.arange(at // length, (ends[-1] - 1) // length + 1)
            lo, hi = np.maximum(seqs * length, at), np.minimum((seqs + 1) * length, ends[-1])
            # documents with an id in [lo, hi)
            a, b = np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi - 1, "right")
            rows = {
                "slot": pa.array(permuted(seqs, n, key)), "sequence": pa.array(seqs, pa.int64()), "at": pa.array(lo - seqs * length, pa.int64()),
                "n": pa.array(hi - lo, pa.int32()), "ids": pa.array([codec.compress(data[(x - at) * width : (y - at) * width], asbytes=True) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary()),
                "doc_ids": pa.array([[d for d in doc_ids[x : y + 1] if d is not None] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.list_(pa.int64())),
            }
            at = int(ends[-1])
            yield pa.RecordBatch.from_arrays(list(rows.values()), list(rows))
        if at - first != counts.get(p, 0):
            raise RuntimeError(f"partition {p} has {at - first} ids now and had {counts.get(p, 0)}: the input is no stored table")

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), payload.alias("ids")).mapInArrow(cut, "slot long, sequence long, at long, n int, ids binary, doc_ids array<long>")
    pieces = pieces.withColumn("shard", (F.col("slot") / per_shard).cast("int"))
    dealt = pieces.repartitionById(shards, F.col("shard")).sortWithinPartitions("slot", "at")
    pad = np.array([padding], dtype).tobytes()

    def write(batches):
        """Joins the pieces of each slot, writes the shard, and reads the digests back from it."""
        store, base = _filesystem(folder)
        shard, records, info, codec = None, [], [], pa.Codec("zstd")
        for batch in batches:
            for r in batch.to_pylist():
                shard, ids_of = r["shard"], codec.decompress(r["ids"], r["n"] * width, asbytes=True)
                if info and info[-1][0] == r["slot"]:
                    records[-1] += ids_of
                    info[-1][2] += r["doc_ids"]  # a document is in one batch, so these are others
                else:
                    records.append(bytearray(ids_of))
                    info.append([r["slot"], r["sequence"], list(r["doc_ids"])])
        if shard is None:
            return
        used = [len(x) // width for x in records]
        data = b"".join(bytes(x) + pad * (length - u) for x, u in zip(records, used, strict=True))
        name = f"{base}/{shard_name(shard)}"
        got = _read(store, name)
        if got != data:
            spare = f"{name}.{TaskContext.get().taskAttemptId()}.tmp"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(spare) as f:
                f.write(data)
            store.move(spare, name)
            got = _read(store, name)
        for i in range(0, len(info), 1024):
            part = info[i : i + 1024]
            digests = [hashlib.sha256(memoryview(got)[(i + j) * size : (i + j + 1) * size]).hexdigest() for j in range(len(part))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in part]), pa.array([shard] * len(part), pa.int32()), pa.array([(i + j) * size for j in range(len(part))], pa.int64()), pa.array([x[1] for x in part]), pa.array(used[i : i + 1024], pa.int32()), pa.array([x[2] for x in part], pa.list_(pa.int64())), pa.array(digests)], ["slot", "shard", "byte_offset", "sequence", "n_tokens", "doc_ids", "sha256"])

    schema = "slot long, shard int, byte_offset long, sequence long, n_tokens int, doc_ids array<long>, sha256 string"
    index = f"{folder.rstrip('/')}-index"
    dealt.mapInArrow(write, schema).write.mode("overwrite").parquet(index)
    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/{MANIFEST}.tmp") as f:
        f.write(_manifest_bytes(layout))
    store.move(f"{base}/{MANIFEST}.tmp", f"{base}/{MANIFEST}")
    return spark.read.schema(schema).parquet(index)


def _manifest_bytes(layout: dict) -> bytes:
    return json.dumps(layout, sort_keys=True).encode()


def _make_room(folder: str, layout: dict) -> None:
    """Takes away the manifest until the shards are whole, and the shards of another layout."""
    from pyarrow import fs

    store, base = _filesystem(folder)
    store.create_dir(base, recursive=True)
    known = _read(store, f"{base}/{MANIFEST}")
    if known is not None:
        store.delete_file(f"{base}/{MANIFEST}")
    if known != _manifest_bytes(layout):
        for x in store.get_file_info(fs.FileSelector(base)):
            if x.base_name.startswith("shard-"):
                store.delete_file(x.path)


def width_for(vocabulary: int) -> tuple[str, int]:
    """The narrowest dtype that holds the ids of a vocabulary and a padding id beside them, and that padding."""
    return ("<u2", 0xFFFF) if vocabulary <= 0xFFFF else ("<u4", 0xFFFFFFFF)


def manifest(folder: str) -> dict:
    store, base = _filesystem(folder)
    return json.loads(_read(store, f"{base}/{MANIFEST}"))


def _read(store, name: str) -> bytes | None:
    try:
        with store.open_input_stream(name) as f:
            return f.read()
    except FileNotFoundError:
        return None


def read_slots(folder: str, start: int, count: int):
    """The ids of slots start, start + 1, ... one array each: a seek and sequential reads, by the folder's manifest."""
    store, base = _filesystem(folder)
    m = manifest(folder)
    size, per_shard, slot, end = m["length"] * np.dtype(m["dtype"]).itemsize, m["per_shard"], start, min(start + count, m["sequences"])
    while slot < end:
        with store.open_input_file(f"{base}/{shard_name(slot // per_shard)}") as f:
            f.seek(slot % per_shard * size)
            for _ in range(min(end, (slot // per_shard + 1) * per_shard) - slot):
                yield np.frombuffer(f.read(size), m["dtype"])
                slot += 1


def shard_folder(spark: SparkSession, name: str) -> str:
    """A folder for shards beside the checkpoints, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
