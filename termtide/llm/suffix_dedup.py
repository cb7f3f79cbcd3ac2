"""Exact removal of repeated passages by a partitioned suffix array.

A byte goes if some string of ``length`` bytes that covers it also starts in a
row with a smaller id. All strings of that length are compared, over the whole
table, without moving all of them:

1. Each string of ``length`` bytes (window) has a minimizer, the smallest hash
   among its 16-byte grams. Equal windows have equal minimizers, and consecutive
   windows mostly share theirs, so a text of n bytes has about n / 18 of them.
   Blocks of rows send their distinct minimizers to buckets and learn which occur
   in more than one row.
2. Runs of windows with a shared minimizer go to the minimizer's bucket, equal
   runs of a block once with their smallest id. The bucket orders the suffixes of
   its runs by deep-shallow sorting; equal neighbours are one window, known with
   its smallest id everywhere. Runs that are equal as a whole need no ordering.
   A minimizer that very many rows have is split: its windows travel one by one
   to the bucket of their own hash.
3. Buckets reply to blocks, and blocks mark and cut their rows.

Definitions: a null text counts as empty; a null id counts as smaller than any
number; rows with equal ids never remove each other's bytes; repeated rows are
judged each on its own; an empty table gives an empty result. Input columns named
like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import address, ask_shared, block_count, block_of, by_bucket, flat_text, known_shared, mix64, numbers, packed, split_sorted, staged, tell_shared
from .suffix_sort import byte_words, deep_shallow, ranges

GRAM = 16
CHUNK = 1 << 16
LONGEST_RUN = 192
HOT_ROWS = 20_000

_ASK = "block int, bucket int, lows binary, counts binary"
_TELL = "block int, bucket int, lows binary, often binary"
_PIECES = "block int, bucket int, sizes binary, lows binary, first binary, contents binary"
_RUNS = "block int, bucket int, piece binary, begin binary, upto binary, first binary"
NEW_COLUMNS = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string").add("kept", "binary").add("spans", T.ArrayType(T.LongType()))


def minimizers(data: np.ndarray, length: int) -> np.ndarray:
    """The smallest 16-byte-gram hash of every window of ``length`` bytes, by place."""
    windows = max(0, len(data) - length + 1)
    out = np.empty(windows, np.uint64)
    words = byte_words(data)
    wide = length - GRAM + 1
    for at in range(0, windows, CHUNK):
        upto = min(at + CHUNK, windows) + wide - 1
        low, high = words[at:upto].astype(np.uint64), words[at + 8 : upto + 8].astype(np.uint64)
        least = mix64(low * np.uint64(0x9E3779B97F4A7C15) + (high ^ (high >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F))
        width = 1
        while width * 2 <= wide:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < wide:
            least = np.minimum(least[: len(least) - (wide - width)], least[wide - width :])
        out[at : at + len(least)] = least
    return out


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one text with one minimizer: begin, windows, minimizer, text."""
    least = minimizers(data, length)
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    step = np.zeros(len(least) + 1, np.int8)
    full = counts > 0
    step[offsets[:-1][full]] += 1
    step[offsets[:-1][full] + counts[full]] -= 1
    valid = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    begins = np.flatnonzero(change & valid)
    ends = np.ones(len(least), bool)
    ends[:-1] = change[1:] | ~valid[1:]
    sizes = np.flatnonzero(ends & valid) + 1 - begins
    parts = (sizes + LONGEST_RUN - 1) // LONGEST_RUN
    within = ranges(np.zeros(len(parts), np.int64), parts)
    begins = np.repeat(begins, parts) + within * LONGEST_RUN
    sizes = np.minimum(np.repeat(sizes, parts) - within * LONGEST_RUN, LONGEST_RUN)
    return begins, sizes, least[begins], np.searchsorted(offsets, begins, side="right") - 1


class _Block:
    """One block's texts and their runs."""

    def __init__(self, rows: pa.Table, text: str, id_: str, length: int, buckets: int):
        self.data, self.offsets = flat_text(rows.column(text))
        self.ids = numbers(rows.column(id_), np.iinfo(np.int64).min)
        self.begins, self.sizes, self.least, self.row = window_runs(self.data, self.offsets, length)
        self.bucket, self.low = address(self.least, buckets)
        self.length, self.buckets = length, buckets

    def pieces(self, told: pa.Table) -> None:
        """Distinct strings of shared windows in order, with bucket, low half of the hash and smallest id."""
        classes = known_shared(told, self.least, self.buckets)
        shared, split = classes > 0, classes > 1
        plain = shared & ~split
        # a split run gives one piece for each of its windows
        at = np.flatnonzero(split)
        begins = np.concatenate([self.begins[plain], ranges(self.begins[at], self.sizes[at])])
        sizes = np.concatenate([self.sizes[plain], np.ones(int(self.sizes[at].sum()), np.int64)])
        rows = np.concatenate([self.row[plain], np.repeat(self.row[at], self.sizes[at])])
        bucket, low = np.concatenate([self.bucket[plain], np.zeros(len(rows) - plain.sum(), np.int64)]), np.concatenate([self.low[plain], np.zeros(len(rows) - plain.sum(), np.uint32)])
        if len(at):
            one = len(rows) - int(self.sizes[at].sum())
            words = byte_words(self.data)
            own = np.full(len(rows) - one, 7, np.uint64)
            for step in [*range(0, self.length - 8, 8), self.length - 8]:
                own = mix64(own * np.uint64(0x9E3779B97F4A7C15) + words[begins[one:] + step].astype(np.uint64))
            bucket[one:], low[one:] = address(own, self.buckets)
        raw, more = self.data.tobytes(), self.length - 1
        number: dict[bytes, int] = {}
        piece = np.fromiter((number.setdefault(raw[b : b + s + more], len(number)) for b, s in zip(begins.tolist(), sizes.tolist())), np.int64, len(begins))
        # numbered by content, so that any later pass over the same rows agrees
        contents = sorted(number)
        rank = np.empty(len(contents), np.int64)
        rank[np.fromiter(map(number.__getitem__, contents), np.int64, len(contents))] = np.arange(len(contents))
        self.piece, self.piece_begin, self.piece_size, self.piece_row, self.contents = rank[piece], begins, sizes, rows, contents
        some = np.zeros(len(contents), np.int64)
        some[self.piece] = np.arange(len(begins))
        self.content_bucket, self.content_low, self.content_size = bucket[some], low[some], sizes[some]
        self.first = np.full(len(contents), np.iinfo(np.int64).max)
        np.minimum.at(self.first, self.piece, self.ids[rows])

    def send(self, block: int) -> pa.Table:
        order, edges = split_sorted(self.content_bucket, self.buckets)
        texts = [b"".join([self.contents[i] for i in order[edges[b] : edges[b + 1]].tolist()]) for b in range(self.buckets) if edges[b] < edges[b + 1]]
        table = by_bucket(block, self.content_bucket, self.buckets, ["sizes", "lows", "first"], [self.content_size.astype(np.uint16), self.content_low, self.first])
        return table.append_column("contents", pa.array(texts, pa.binary()))

    def cut(self, replies: pa.Table) -> list[pa.Array]:
        order, edges = split_sorted(self.content_bucket, self.buckets)
        piece, begin, upto, first = [], [], [], []
        for bucket, p, b, u, f in zip(*(replies.column(c).to_pylist() for c in ("bucket", "piece", "begin", "upto", "first"))):
            piece.append(order[edges[bucket] + np.frombuffer(p, np.uint32)])
            begin.append(np.frombuffer(b, np.uint16))
            upto.append(np.frombuffer(u, np.uint16))
            first.append(np.frombuffer(f, np.int64))
        step = np.zeros(len(self.data) + 1, np.int32)
        own = self.first[self.piece] < self.ids[self.piece_row]
        np.add.at(step, self.piece_begin[own], 1)
        np.add.at(step, self.piece_begin[own] + self.piece_size[own] - 1 + self.length, -1)
        if piece:
            piece, begin, upto, first = map(np.concatenate, (piece, begin, upto, first))
            by = np.argsort(piece, kind="stable")
            piece, begin, upto, first = piece[by], begin[by].astype(np.int64), upto[by].astype(np.int64), first[by]
            edge = np.searchsorted(piece, np.arange(len(self.contents) + 1))
            counts = np.diff(edge)[self.piece]
            run, seat = ranges(edge[self.piece], counts), np.repeat(np.arange(len(self.piece)), counts)
            hit = first[run] < self.ids[self.piece_row[seat]]
            run, seat = run[hit], seat[hit]
            np.add.at(step, self.piece_begin[seat] + begin[run], 1)
            np.add.at(step, self.piece_begin[seat] + upto[run] - 1 + self.length, -1)
        gone = np.cumsum(step[:-1]) > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        edge = np.zeros(len(gone) + 1, bool)
        edge[:-1] = gone
        edge[1:-1] &= ~gone[:-1]
        # a text's first byte begins a run of its own
        inside = self.offsets[:-1][self.offsets[:-1] < len(gone)]
        edge[inside] = gone[inside]
        begins = np.flatnonzero(edge[:-1])
        last = np.ones(len(gone), bool)
        last[:-1] = ~gone[1:] | edge[1:-1]
        ends = np.flatnonzero(gone & last) + 1
        firsts = np.searchsorted(begins, self.offsets)
        counts = np.diff(firsts)
        owner = np.repeat(np.arange(len(self.ids)), counts)
        spans = np.empty(2 * len(begins), np.int64)
        spans[0::2], spans[1::2] = begins - self.offsets[owner], ends - self.offsets[owner]
        keep = self.data[~gone].tobytes()
        removed = np.diff(before[self.offsets])
        at = self.offsets - before[self.offsets]
        kept = [keep[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        return [
            pa.array(np.diff(self.offsets)), pa.array(removed), pa.array(counts.astype(np.int64)),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary()),
            pa.ListArray.from_arrays(pa.array((2 * firsts).astype(np.int32)), pa.array(spans)),
        ]


def first_owners(contents: list[bytes], lows: np.ndarray, first: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of each content with the smallest id that has the window: content, begin, upto, id."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents)) - (length - 1)
    values, group = np.unique(lows, return_inverse=True)
    alone = np.bincount(group, minlength=len(values))[group] == 1
    several = np.flatnonzero(~alone)
    data = np.frombuffer(b"".join([contents[i] for i in several.tolist()]), np.uint8)
    bytes_ = sizes[several] + length - 1
    starts = ranges(np.cumsum(bytes_) - bytes_, sizes[several])
    owner = np.repeat(several, sizes[several])
    order, new = deep_shallow(data, starts, length)
    least = np.empty(len(starts), np.int64)
    if len(starts):
        heads = np.flatnonzero(new)
        least[order] = np.repeat(np.minimum.reduceat(first[owner][order], heads), np.diff(np.append(heads, len(order))))
    change = np.ones(len(starts), bool)
    change[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(change)
    end = np.append(head[1:], len(starts))
    base = np.zeros(len(contents), np.int64)
    base[several] = np.cumsum(sizes[several]) - sizes[several]
    one = np.flatnonzero(alone)
    content = np.concatenate([one, owner[head]])
    begin = np.concatenate([np.zeros(len(one), np.int64), head - base[owner[head]]])
    upto = np.concatenate([sizes[one], end - base[owner[head]]])
    least = np.concatenate([first[one], least[head]])
    by = np.lexsort((begin, content))
    return content[by], begin[by], upto[by], least[by]


def _compare_pieces(length: int):
    def compare(rows: pa.Table) -> pa.Table:
        """One bucket: the smallest id of every window, told to the blocks that do not have it themselves."""
        bucket = rows.column("bucket")[0].as_py()
        number: dict[bytes, int] = {}
        lows_of: list[int] = []
        sent = []
        for block, sizes, lows, first, contents in zip(*(rows.column(c).to_pylist() for c in ("block", "sizes", "lows", "first", "contents"))):
            ends = np.cumsum(np.frombuffer(sizes, np.uint16).astype(np.int64) + length - 1).tolist()
            which = np.empty(len(ends), np.int64)
            at = 0
            for i, (end, low) in enumerate(zip(ends, np.frombuffer(lows, np.uint32).tolist())):
                content = contents[at:end]
                found = number.get(content)
                if found is None:
                    found = number[content] = len(lows_of)
                    lows_of.append(low)
                which[i] = found
                at = end
            sent.append((block, which, np.frombuffer(first, np.int64)))
        least = np.full(len(lows_of), np.iinfo(np.int64).max)
        for _, which, first in sent:
            np.minimum.at(least, which, first)
        content, begin, upto, owner = first_owners(list(number), np.array(lows_of, np.uint32), least, length)
        edges = np.searchsorted(content, np.arange(len(lows_of) + 1))
        out = []
        for block, which, first in sent:
            counts = np.diff(edges)[which]
            run, piece = ranges(edges[which], counts), np.repeat(np.arange(len(which)), counts)
            news = owner[run] < first[piece]
            run, piece = run[news], piece[news]
            if len(run):
                out.append((block, bucket, *packed([piece.astype(np.uint32), begin[run].astype(np.uint16), upto[run].astype(np.uint16), owner[run]])))
        types = (pa.int32(), pa.int32(), *[pa.binary()] * 4)
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["block", "bucket", "piece", "begin", "upto", "first"])

    return compare


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows with n_bytes, n_removed, n_spans, kept_sha256, kept (remaining bytes) and spans (begin, end, begin, ..).

    A minimizer that more than ``hot_rows`` rows have is split over buckets. See the
    module's text for the rule, the method and the cases that it defines.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} at least")
    taken = {f.name for f in NEW_COLUMNS.fields}
    carried = [c for c in docs.columns if c.lower() not in taken]
    blocks = block_count(docs, text_col)
    rows = docs.select(block_of(blocks, F.col(id_col), F.col(text_col)).alias("__block"), F.col(id_col).cast("long").alias("__id"), F.col(text_col).cast("string").alias("__text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])
    bare = rows.select("__block", "__id", "__text")

    def ask(part: pa.Table) -> pa.Table:
        one = _Block(part, "__text", "__id", length, blocks)
        return ask_shared(part.column("__block")[0].as_py(), one.least, one.row, blocks)

    def tell(part: pa.Table) -> pa.Table:
        return tell_shared(part, hot_rows)

    def send(part: pa.Table, told: pa.Table) -> pa.Table:
        one = _Block(part, "__text", "__id", length, blocks)
        one.pieces(told)
        return one.send(part.column("__block")[0].as_py()) if len(part) else one.send(0)

    def cut(part: pa.Table, replies: pa.Table) -> pa.Table:
        one = _Block(part, "__text", "__id", length, blocks)
        kind = np.array(replies.column("kind").to_pylist(), dtype=bool) if len(replies) else np.zeros(0, bool)
        told, runs = replies.filter(pa.array(~kind)), replies.filter(pa.array(kind))
        one.pieces(told.rename_columns(["block", "bucket", "lows", "often", "c", "d", "kind"]))
        new = one.cut(runs.rename_columns(["block", "bucket", "piece", "begin", "upto", "first", "kind"]))
        return pa.table([*[part.column(f"c{i}") for i in range(len(carried))], *new], names=[*[f"c{i}" for i in range(len(carried))], *[f.name for f in NEW_COLUMNS.fields]])

    told = staged(bare.groupBy("__block").applyInArrow(ask, _ASK).groupBy("bucket").applyInArrow(tell, _TELL), "repeats-told")
    pieces = bare.groupBy("__block").cogroup(told.groupBy("block")).applyInArrow(send, _PIECES)
    runs = staged(pieces.groupBy("bucket").applyInArrow(_compare_pieces(length), _RUNS), "repeats-runs")
    nothing = F.lit(None).cast("binary")
    replies = told.select("block", "bucket", F.col("lows").alias("a"), F.col("often").alias("b"), nothing.alias("c"), nothing.alias("d"), F.lit(False).alias("kind")).unionByName(
        runs.select("block", "bucket", F.col("piece").alias("a"), F.col("begin").alias("b"), F.col("upto").alias("c"), F.col("first").alias("d"), F.lit(True).alias("kind"))
    )
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + NEW_COLUMNS.fields)
    done = rows.groupBy("__block").cogroup(replies.groupBy("block")).applyInArrow(cut, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *[f.name for f in NEW_COLUMNS.fields])
