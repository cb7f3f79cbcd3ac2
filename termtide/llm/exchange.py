"""Moving packed arrays between blocks of rows and buckets of hash values.

Corpus-wide questions about very many small items (is this window, word or
shingle known elsewhere, and how often?) are asked in three steps. Rows are
grouped into *blocks* by a hash of their id. A block reduces its items to
distinct hash values and sends one packed array to each *bucket* of the hash
space. A bucket sees every block's answer for its values and replies to each
block with one packed array. An item that occurs in a third of all rows thus
costs one entry per block, and neither side ever holds more than its share.

The numbers of blocks and buckets follow the size of the input, so a group is
as large for a terabyte as for a megabyte.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import freed_shuffles, stage

BLOCK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20


def staged(df: DataFrame, label: str) -> DataFrame:
    """A written copy in the shared folder; the shuffle files of the job that wrote it are freed."""
    with freed_shuffles(df.sparkSession):
        return stage(df, label)


def block_count(df: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks of about ``block_bytes`` each; at least as many as the session has shuffle partitions."""
    total = df.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / block_bytes), 1)


def block_of(blocks: int, *columns: Column | str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def flat_text(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes and the offsets between them; null counts as empty."""
    parts = [c for c in column.chunks if len(c)]
    if not parts:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    values = pa.concat_arrays(parts).cast(pa.large_binary())
    if values.null_count:
        values = pc.fill_null(values, b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], np.uint8) if values.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def numbers(column: pa.ChunkedArray, missing: int = 0) -> np.ndarray:
    """A whole-number column as int64; null becomes ``missing``."""
    return pc.fill_null(column, missing).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64) if len(column) else np.zeros(0, np.int64)


def split_sorted(owner: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order by owner, and where each owner's run begins (length ``buckets`` + 1)."""
    order = np.argsort(owner, kind="stable")
    return order, np.searchsorted(owner[order], np.arange(buckets + 1))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(arrays: Sequence[np.ndarray]) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def address(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each hash, and the half of it that is told apart within the bucket."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def ask_shared(block: int, hashes: np.ndarray, row: np.ndarray, buckets: int) -> pa.Table:
    """One block's question to the buckets: its distinct hashes and how many of its rows have each (65,535 at most)."""
    bucket, low = address(hashes, buckets)
    order = np.lexsort((row, low, bucket))
    bucket, low, row = bucket[order], low[order], row[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (bucket[1:] != bucket[:-1]) | (low[1:] != low[:-1])
    distinct = fresh.copy()
    distinct[1:] |= row[1:] != row[:-1]
    heads = np.flatnonzero(fresh)
    counts = np.add.reduceat(distinct, heads, dtype=np.int64) if len(heads) else np.zeros(0, np.int64)
    return by_bucket(block, bucket[heads], buckets, ["lows", "counts"], [low[heads], np.minimum(counts, 65535).astype(np.uint16)])


def by_bucket(block: int, owner: np.ndarray, buckets: int, names: Sequence[str], columns: Sequence[np.ndarray]) -> pa.Table:
    """Rows (block, bucket, one packed slice of each column) for the buckets that have any."""
    order, edges = split_sorted(owner, buckets)
    used = np.flatnonzero(np.diff(edges))
    slices = [order[edges[b] : edges[b + 1]] for b in used]
    arrays = [pa.array(packed([column[s] for s in slices]), pa.binary()) for column in columns]
    return pa.table([pa.array(np.full(len(used), block, np.int32)), pa.array(used.astype(np.int32)), *arrays], names=["block", "bucket", *names])


def tell_shared(rows: pa.Table, often: int) -> pa.Table:
    """One bucket's answer to each block: which of its hashes more than one row has, and which more than ``often``."""
    bucket = rows.column("bucket")[0].as_py()
    blocks = rows.column("block").to_pylist()
    lows = [np.frombuffer(x, np.uint32) for x in rows.column("lows").to_pylist()]
    counts = [np.frombuffer(x, np.uint16) for x in rows.column("counts").to_pylist()]
    values, which = np.unique(np.concatenate(lows), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts).astype(np.float64), len(values))
    edges = np.cumsum([0, *map(len, lows)])
    out = []
    for block, own, a, b in zip(blocks, lows, edges, edges[1:]):
        known = total[which[a:b]]
        shared = known > 1
        if shared.any():
            out.append((block, bucket, own[shared].tobytes(), (known[shared] > often).astype(np.uint8).tobytes()))
    return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "bucket", "lows", "often"])


def known_shared(told: pa.Table, hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A block's hashes by the answers: 0 in one row only, 1 shared, 2 shared by very many."""
    keys, flags = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for bucket, lows, often in zip(told.column("bucket").to_pylist(), told.column("lows").to_pylist(), told.column("often").to_pylist()):
        keys.append(np.frombuffer(lows, np.uint32).astype(np.uint64) | np.uint64(bucket << 32))
        flags.append(np.frombuffer(often, np.uint8))
    known, flag = np.concatenate(keys), np.concatenate(flags)
    if not len(known):
        return np.zeros(len(hashes), np.int8)
    order = np.argsort(known)
    known, flag = known[order], flag[order]
    bucket, low = address(hashes, buckets)
    own = (bucket.astype(np.uint64) << np.uint64(32)) | low
    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return np.where(known[place] == own, 1 + flag[place], 0).astype(np.int8)


def slices(batches: Iterable[pa.RecordBatch], text: int, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut, without a copy, so that a slice has ``size`` bytes in its column ``text``, or is one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.cast(pc.binary_length(batch.column(text)), pa.int64()), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths + 1)
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
