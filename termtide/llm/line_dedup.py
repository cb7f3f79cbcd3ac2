"""Repeated lines over a whole table: sorted hashes, one pass, keep bitmaps.

A text's lines are what stands between newlines. A line's key is the line without
the bytes 0x20 and 0x09-0x0D at both ends, lower-cased in A-Z. A key of at least
``min_chars`` code points that at least ``min_docs`` documents have loses its lines
everywhere but in the document with the largest id.

1. Texts become entries (128-bit hash of the key, id, text hash, place); texts stay
   where they are.
2. Entries are range-partitioned by hash, then id and place, so that a key that a
   third of all rows share spreads over many ranges, and sorted within, largest id
   first. A stream over a range sees each key's keeper first and counts ids as they
   come; it holds back what the first ``min_docs`` - 1 ids have, no more.
3. Only the first and the last key of a range may go on in the next one. Their
   entries wait, with one summary row for each, until the summaries (two for each
   range) are put together.
4. Dropped places are sorted by document and streamed into one compressed bitmap
   for each, bit i set if line i stays; lines past its end stay.

Definitions: a null or empty text is one empty line. Rows with equal ids are one
document. A null id is one document, smaller than any number (and than -2**63, which
stands for it). Ids are whole numbers; others fail in the cast. Rows with equal id
and text share a bitmap. If all lines go the text is empty. An empty table gives an
empty result. Input columns named like a result column are replaced, all others are
carried along.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import slices, staged

MIN_CHARS = 40
MIN_DOCS = 5
RANGE_ROWS = 1_000_000
SPACE = b" \t\n\x0b\x0c\r"
NO_ID = -(1 << 63)
# bytes that go on with a character and do not begin one
CONTINUATION = bytes(range(0x80, 0xC0))

_ENTRIES = "hi long, lo long, id long, row long, place int, copy long"
_FOUND = "edge int, hi long, lo long, id long, row long, place int, docs long, last long"
_BITMAPS = "id long, row long, keep binary, dropped long"
NEW_COLUMNS = T.StructType().add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string").add("kept", "string")


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def long_keys(text: bytes, min_chars: int):
    """Place and key of each line whose key has at least ``min_chars`` code points."""
    for place, line in enumerate(text.split(b"\n")):
        if len(line) >= min_chars:
            key = line_key(line)
            if len(key) >= min_chars and (key.isascii() or len(key.translate(None, CONTINUATION)) >= min_chars):
                yield place, key


def _entries(min_chars: int):
    def entries(batches):
        copy = 0
        for batch in slices(batches, 2):
            digests, rows, places = [], [], []
            for row, text in enumerate(batch.column(2).to_pylist()):
                for place, key in long_keys(text or b"", min_chars):
                    digests.append(hashlib.blake2b(key, digest_size=16).digest())
                    rows.append(row)
                    places.append(place)
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            owner = np.array(rows, np.int64)
            # equal rows' entries are told apart, so that a range need not hold all of them
            copies = np.arange(copy, copy + len(owner))
            copy += len(owner)
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            columns = [halves[:, 0].copy(), halves[:, 1].copy(), ids[owner], texts[owner], np.array(places, np.int32), copies]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["hi", "lo", "id", "row", "place", "copy"])

    return entries


class _OpenKey:
    """The key that a range's stream stands in."""

    def __init__(self, hi: int, lo: int, keeper: int, edge: bool):
        self.hi, self.lo, self.keeper, self.edge = hi, lo, keeper, edge
        self.docs, self.last, self.held = 0, 0, []


def _found(edge: int, hi: np.ndarray, lo: np.ndarray, ids: np.ndarray, rows: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    columns = [np.full(n, edge, np.int32), hi, lo, ids, rows, places, np.zeros(n, np.int64), np.zeros(n, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["edge", "hi", "lo", "id", "row", "place", "docs", "last"])


def _summary(key: _OpenKey) -> pa.RecordBatch:
    values = [2, key.hi, key.lo, key.keeper, 0, 0, key.docs, key.last]
    types = [pa.int32(), *[pa.int64()] * 4, pa.int32(), *[pa.int64()] * 2]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=["edge", "hi", "lo", "id", "row", "place", "docs", "last"])


def _first_occurrences(min_docs: int):
    """A stream over one sorted range: entries to drop (edge 0), entries that wait (1), what is known of their keys (2)."""

    def stream(batches):
        key: _OpenKey | None = None
        begun = False
        for batch in batches:
            if not batch.num_rows:
                continue
            hi, lo, ids, rows, places = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            fresh = np.ones(len(ids), bool)
            fresh[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            if key is not None:
                fresh[0] = (int(hi[0]), int(lo[0])) != (key.hi, key.lo)
            heads = np.flatnonzero(fresh)
            group = np.cumsum(fresh)  # 0 is the key that the batch before ended in
            groups = len(heads) + 1
            newdoc = np.ones(len(ids), bool)
            newdoc[1:] = fresh[1:] | (ids[1:] != ids[:-1])
            if key is not None and not fresh[0]:
                newdoc[0] = int(ids[0]) != key.last
            docs = np.bincount(group, newdoc, groups).astype(np.int64)
            keeper = np.empty(groups, np.int64)
            keeper[1:] = ids[heads]
            keeper[0] = key.keeper if key is not None else 0
            if key is not None:
                docs[0] += key.docs
            edge = np.zeros(groups, bool)
            edge[0] = key is not None and key.edge
            if not begun:
                edge[1] = True
                begun = True
            often = docs >= min_docs
            closing = groups - 1
            # equal entries of equal rows are one
            again = np.zeros(len(ids), bool)
            again[1:] = ~newdoc[1:] & (rows[1:] == rows[:-1]) & (places[1:] == places[:-1])
            extra = (ids != keeper[group]) & ~again
            gone = extra & (often & ~edge)[group]
            if key is not None and not key.edge and often[0]:
                yield from key.held
                key.held = []
            if gone.any():
                yield _found(0, hi[gone], lo[gone], ids[gone], rows[gone], places[gone])
            waits = edge[group] & ~again
            if waits.any():
                yield _found(1, hi[waits], lo[waits], ids[waits], rows[waits], places[waits])
            if groups > 1:
                if key is not None and key.edge:
                    key.docs, key.last = int(docs[0]), int(ids[heads[0] - 1]) if heads[0] else key.last
                    yield _summary(key)
                if edge[1] and closing > 1:
                    first = _OpenKey(int(hi[heads[0]]), int(lo[heads[0]]), int(keeper[1]), True)
                    first.docs, first.last = int(docs[1]), int(ids[heads[1] - 1])
                    yield _summary(first)
                key = _OpenKey(int(hi[-1]), int(lo[-1]), int(keeper[closing]), bool(edge[closing]))
            key.docs, key.last = int(docs[closing]), int(ids[-1])
            if not key.edge and not often[closing]:
                own = extra & (group == closing)
                if own.any():
                    key.held.append(_found(0, hi[own], lo[own], ids[own], rows[own], places[own]))
        if key is not None:
            # the last key may go on in the next range
            for held in key.held:
                yield held.set_column(0, "edge", pa.array(np.ones(held.num_rows, np.int32)))
            yield _summary(key)

    return stream


def _verdicts(summaries: list, min_docs: int) -> list[tuple[int, int, int]]:
    """Keys of range ends that enough documents have, with the largest id, from each range's count."""
    out, at = [], 0
    summaries = sorted(summaries, key=lambda r: (r["hi"], r["lo"], -r["id"], -r["last"]))
    while at < len(summaries):
        upto = at
        docs = 0
        while upto < len(summaries) and (summaries[upto]["hi"], summaries[upto]["lo"]) == (summaries[at]["hi"], summaries[at]["lo"]):
            docs += summaries[upto]["docs"] - (upto > at and summaries[upto - 1]["last"] == summaries[upto]["id"])
            upto += 1
        if docs >= min_docs:
            out.append((summaries[at]["hi"], summaries[at]["lo"], summaries[at]["id"]))
        at = upto
    return out


def keep_bits(places: np.ndarray) -> bytes:
    """Compressed bits, bit i set if line i stays, up to the byte of the last dropped line."""
    bits = np.ones((int(places[-1]) // 8 + 1) * 8, bool)
    bits[places] = False
    return zlib.compress(np.packbits(bits, bitorder="little").tobytes())


def dropped_places(bitmap: bytes | None, lines: int) -> np.ndarray:
    """Places of the lines that a bitmap drops."""
    if bitmap is None:
        return np.zeros(0, np.int64)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    return np.flatnonzero(bits[:lines] == 0)


def _bitmaps(batches):
    """A stream over dropped places in order of document and place: one bitmap for each document."""
    owner, held = None, []

    def row(owner, held):
        places = np.unique(np.concatenate(held))
        return owner[0], owner[1], keep_bits(places), len(places)

    for batch in batches:
        ids, rows, places = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        edges = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (rows[1:] != rows[:-1])])) if len(ids) else []
        out = []
        for a, b in zip(edges, [*edges[1:], len(ids)]):
            now = (int(ids[a]), int(rows[a]))
            if owner is not None and now != owner:
                out.append(row(owner, held))
                held = []
            owner = now
            held.append(places[a:b].astype(np.int64))
        yield _bitmap_batch(out)
    if owner is not None:
        yield _bitmap_batch([row(owner, held)])


def _bitmap_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["id", "row", "keep", "dropped"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row (id, row, keep, dropped) for each document that loses lines; ``row`` is the hash of its text."""
    spark = docs.sparkSession
    texts = docs.select(*_address(id_col, text_col), F.col(text_col).cast("binary").alias("text"))
    entries = staged(texts.mapInArrow(_entries(min_chars), _ENTRIES), "line-entries")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(least, math.ceil(entries.count() / range_rows))
    order = ["hi", "lo", F.col("id").desc(), "row", "place"]
    ordered = entries.repartitionByRange(ranges, *order, "copy").sortWithinPartitions(*order)
    found = staged(ordered.mapInArrow(_first_occurrences(min_docs), _FOUND), "line-drops")
    # two rows at most for each range
    verdicts = spark.createDataFrame(_verdicts(found.where("edge = 2").select("hi", "lo", "id", "docs", "last").collect(), min_docs), "hi long, lo long, keeper long")
    waiting = found.where("edge = 1").join(F.broadcast(verdicts), ["hi", "lo"]).where("id != keeper")
    drops = found.where("edge = 0").select("id", "row", "place").union(waiting.select("id", "row", "place"))
    per_document = drops.repartition(ranges, "id", "row").sortWithinPartitions("id", "row", "place")
    return staged(per_document.mapInArrow(_bitmaps, _BITMAPS), "line-bitmaps")


def _address(id_col: str, text_col: str) -> list:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce(F.xxhash64(F.col(text_col).cast("string")), F.lit(0)).alias("row")]


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows with n_lines, n_dropped, kept_sha256 and kept, the text of the lines that stay."""
    taken = {f.name for f in NEW_COLUMNS.fields}
    carried = [c for c in docs.columns if c.lower() not in taken]
    size = len(carried)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], *[c.alias(f"__{n}") for c, n in zip(_address(id_col, text_col), ("id", "row"))], F.col(text_col).cast("binary").alias("__text"))
    small = bitmaps.select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("keep").alias("__keep"))
    joined = rows.join(small, ["__id", "__row"], "left").select(*[f"c{i}" for i in range(size)], "__text", "__keep")

    def apply(batches):
        for batch in slices(batches, size):
            out = []
            for text, bitmap in zip(batch.column(size).to_pylist(), batch.column(size + 1).to_pylist()):
                text = text or b""
                if bitmap is None:
                    out.append((text.count(b"\n") + 1, 0, hashlib.sha256(text).hexdigest(), text))
                    continue
                lines = text.split(b"\n")
                gone = dropped_places(bitmap, len(lines))
                for place in gone.tolist():
                    lines[place] = None
                kept = b"\n".join(line for line in lines if line is not None)
                out.append((len(lines), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            types = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            new = [pa.array([r[i] for r in out], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], *new], names=names)

    names = [*[f"c{i}" for i in range(size)], *[f.name for f in NEW_COLUMNS.fields]]
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + NEW_COLUMNS.fields[:3] + [T.StructField("kept", T.BinaryType())])
    done = joined.mapInArrow(apply, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], "n_lines", "n_dropped", "kept_sha256", F.col("kept").cast("string").alias("kept"))
