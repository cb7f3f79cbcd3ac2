"""Language-model scores from a log-frequency Bloom filter.

Counting. Blocks of rows send each bucket of the hash space their distinct words and the
n-grams of their training rows with counts; buckets add them up. Words are counted exactly
and every block is told the counts of its own words, so the base score needs no
approximation and no word table is sent to all workers.

The model. A count of 2 ** q up to 2 ** (q + 1) - 1 is held as level q: the filter has bits
for (n-gram, 0), .. (n-gram, q), so that an n-gram seen once is held, too. Each bucket fills
the filter's segment for its own addresses, as large as its n-grams need, and writes its
bits; the counts are forgotten. So there is no ceiling, and what is held is the same at
every size.

Reading. Blocks of all rows ask the segments for their distinct n-grams by hash. Where they
are asked there are bits and no counts: levels are probed from 0 up until one is missing,
so a count is never read too low, and too high with a chance that halves with every probe.
The answer is one byte for each n-gram; no task and not the driver holds more than a segment.

Probability. Orders are interpolated: the share of the lower order is fitted per
order and power of two of the context's count, by leaving one out over all
training tokens (deleted interpolation). Order one is the base estimate
(c + 1) / (N + V + 1).

Definitions: a word is a run of bytes other than 0x20 and 0x09-0x0D, lower-cased
in A-Z; each text ends with one end token, which counts as a word. A null text
counts as empty: it has its end token alone. A null training mark counts as no.
Without training rows every probability of order one is 1 / 1. Repeated rows are
scored, and counted, each on its own. An empty table gives an empty result. Input
columns named like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .exchange import address, block_count, block_of, flat_text, mix64, split_sorted, staged
from .words import BASE, word_hashes, word_spans

ORDER = 3
PROBES = 6
END, START = np.uint64(0x5E5E5E5E0001), np.uint64(0x5E5E5E5E0002)
SHARES = np.array([0.01, 0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95, 0.99, 0.999])
FIRST_GUESS = 0.5
BINS = 40

_COUNTS = "block int, bucket int, kind int, values binary, counts binary"
_TOLD = "block int, bucket int, counts binary, words long, total long, level int, seen long, occurrences long, bits binary"
_ASKS = "block int, bucket int, lows binary"
_LEVELS = "block int, bucket int, levels binary"
NEW_COLUMNS = T.StructType().add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, each text's followed by the end token, and where texts begin."""
    begins, ends, firsts = word_spans(data, offsets)
    texts = len(offsets) - 1
    edges = firsts + np.arange(texts + 1)
    tokens = np.empty(int(edges[-1]), np.uint64)
    closing = np.zeros(len(tokens), bool)
    closing[edges[1:] - 1] = True
    tokens[closing] = END
    tokens[~closing] = word_hashes(data, begins, ends)
    return tokens, edges


def grams_of(tokens: np.ndarray, edges: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 2 .. order, the hash of the n-gram that ends at each token; start marks fill up."""
    back = [tokens]
    place = np.arange(len(tokens)) - np.repeat(edges[:-1], np.diff(edges))
    for n in range(1, order):
        shifted = np.full(len(tokens), START, np.uint64)
        shifted[n:] = tokens[: max(len(tokens) - n, 0)]
        shifted[place < n] = START
        back.append(shifted)
    out = []
    for n in range(2, order + 1):
        h = np.full(len(tokens), n, np.uint64)
        for part in reversed(back[:n]):
            h = mix64(h * np.uint64(BASE) + part)
        out.append(h)
    return out


def gram_keys(hashes: list[np.ndarray], buckets: int) -> np.ndarray:
    """Bucket and low half of each n-gram's hash in one number, of all orders end to end."""
    bucket, lows = address(np.concatenate(hashes), buckets)
    return (bucket.astype(np.uint64) << np.uint64(32)) | lows


def _two_hashes(lows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 32-bit hashes of (n-gram, level), the second one odd."""
    h = mix64(lows.astype(np.uint64) * np.uint64(BASE) + np.uint64(level * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
    return h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)


def _position(one: np.ndarray, two: np.ndarray, probe: int, size: int) -> np.ndarray:
    """The probe's bit: steps of the second hash from the first, scaled from 32 bits to the size."""
    return (((one + two * np.uint64(probe)) & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)


def fill_segment(lows: np.ndarray, levels: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """Packed bits of (n-gram, level) for each level from 0 to the n-gram's own; half of the bits are set at the best filling."""
    pairs = float((levels + 1).sum())
    size = max(64, int(np.ceil(pairs * probes / np.log(2) / 64)) * 64)
    if size >= 1 << 32:
        raise ValueError("a segment of so many n-grams needs more buckets")
    flags = np.zeros(size, bool)
    for level in range(int(levels.max(initial=-1)) + 1):
        one, two = _two_hashes(lows[levels >= level], level)
        for probe in range(probes):
            flags[_position(one, two, probe, size)] = True
    return np.packbits(flags, bitorder="little")


def probe_levels(bits: np.ndarray, lows: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """Level of each n-gram as the bits read, probed from 0 up until a bit is missing; -1 if not held."""
    out = np.full(len(lows), -1, np.int64)
    size = 8 * len(bits)
    alive, level = np.arange(len(lows)), 0
    while size and len(alive):
        one, two = _two_hashes(lows[alive], level)
        for probe in range(probes):
            at = _position(one, two, probe, size)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            alive, one, two = alive[hit], one[hit], two[hit]
        out[alive] = level
        level += 1
    return out


def pack_lows(lows: np.ndarray) -> bytes:
    """Rising numbers as the first and three bytes for each step, or four where a step needs them."""
    steps = np.diff(lows)
    if len(steps) and int(steps.max()) >= 1 << 24:
        return b"\x04" + lows.astype("<u4").tobytes()
    return b"\x03" + lows[:1].astype("<u4").tobytes() + steps.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def unpack_lows(packed: bytes) -> np.ndarray:
    if packed[0] == 4:
        return np.frombuffer(packed, "<u4", offset=1)
    steps = np.zeros(((len(packed) - 5) // 3, 4), np.uint8)
    steps[:, :3] = np.frombuffer(packed, np.uint8, offset=5).reshape(-1, 3)
    first = np.frombuffer(packed, "<u4", 1, 1).astype(np.uint64)
    return np.cumsum(np.concatenate([first, steps.view("<u4").ravel()])).astype(np.uint32)


class Fitted:
    """Shares of the lower order by order and power of two of the context's count."""

    def __init__(self, shares: np.ndarray, train_texts: int, words: int, total: int):
        self.shares, self.train_texts, self.words, self.total = shares, train_texts, words, total

    def base(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 1.0) / (self.total + self.words + 1.0)


def _context_bin(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1.0)).astype(np.int64), BINS - 1)


def score_tokens(tokens: np.ndarray, edges: np.ndarray, counts: np.ndarray, grams: list[np.ndarray], fitted: Fitted, order: int, leave_one_out: bool = False):
    """Probability of each token by its count and those of the n-grams that end at it; or, leaving out one occurrence, the log-likelihood of each share, order and bin."""
    if not len(tokens):
        return np.zeros((order - 1, BINS, len(SHARES))) if leave_one_out else np.zeros(0)
    one = 1.0 if leave_one_out else 0.0
    starts = np.zeros(len(tokens), bool)
    starts[edges[:-1]] = True
    context = np.empty(len(tokens))
    context[1:] = counts[:-1]
    context[starts] = fitted.train_texts
    lower = fitted.base(np.maximum(counts - one, 0.0))
    seen = counts > 0
    sums = np.zeros((order - 1, BINS, len(SHARES)))
    for n, read in enumerate(grams):
        # an n-gram cannot be known unless its shorter one is
        known = np.where(seen & (context > 0), read, 0.0)
        seen = known > 0
        part = np.clip(np.minimum(known, context) - one, 0.0, None)
        whole = np.maximum(context - one, 0.0)
        usable = whole > 0
        ratio = np.divide(part, whole, out=np.zeros(len(part)), where=usable)
        bins = _context_bin(whole)
        if leave_one_out:
            own, base, seats = ratio[usable], lower[usable], bins[usable]
            own -= base
            for i, share in enumerate(SHARES):
                sums[n, :, i] = np.bincount(seats, np.log(base + (1 - share) * own), BINS)
        share = np.where(usable, fitted.shares[n][bins], 1.0)
        lower = (1 - share) * ratio + share * lower
        if n + 2 < order:
            context = np.concatenate([[0.0], known[:-1]])
            context[starts] = 0.0
            # the second word's context is two start marks and the first word
    return sums if leave_one_out else lower


def run_heads(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal sorted keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


def by_segment(keys: np.ndarray, buckets: int):
    """Of sorted distinct keys, each bucket with its low halves and their places."""
    edge = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
    for b in np.flatnonzero(np.diff(edge)).tolist():
        part = slice(int(edge[b]), int(edge[b + 1]))
        yield b, keys[part].astype(np.uint32), part


def _count_block(order: int, blocks: int):
    def count(rows: pa.Table) -> pa.Table:
        block = rows.column("__block")[0].as_py()
        data, offsets = flat_text(rows.column("__text"))
        tokens, edges = tokens_of(data, offsets)
        train = np.repeat(pc.fill_null(rows.column("__train"), False).to_numpy(), np.diff(edges))
        out = []

        def send(kind: int, owner: np.ndarray, values: np.ndarray, counts: np.ndarray) -> None:
            seat, edge = split_sorted(owner, blocks)
            for b in np.flatnonzero(np.diff(edge)).tolist():
                own = seat[edge[b] : edge[b + 1]]
                out.append((block, b, kind, values[own].tobytes(), counts[own].astype(np.uint32).tobytes()))

        words, which = np.unique(tokens, return_inverse=True)
        send(1, address(words, blocks)[0], words, np.bincount(which, train, len(words)))
        own_grams = [g[train] for g in grams_of(tokens, edges, order)]
        keys = np.sort(gram_keys(own_grams, blocks))
        heads = run_heads(keys)
        counts = np.diff(np.append(heads, len(keys))).astype(np.uint32)
        for b, lows, part in by_segment(keys[heads], blocks):
            own = counts[part]
            # most n-grams of a block stand in it once: their counts travel as bytes
            out.append((block, b, 2, pack_lows(lows), own.astype(np.uint8 if own.max() < 256 else np.uint32).tobytes()))
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=["block", "bucket", "kind", "values", "counts"])

    return count


def _answer(probes: int):
    def answer(rows: pa.Table) -> pa.Table:
        """One bucket: counts of words for each block that asked, what there is of each level, and the filter's segment."""
        bucket = rows.column("bucket")[0].as_py()
        kinds = np.array(rows.column("kind").to_pylist())
        blocks = np.array(rows.column("block").to_pylist())
        values, counts = rows.column("values").to_pylist(), rows.column("counts").to_pylist()
        out = []
        asked = np.flatnonzero(kinds == 1).tolist()
        if asked:
            each = [np.frombuffer(values[i], np.uint64) for i in asked]
            words, which = np.unique(np.concatenate(each), return_inverse=True)
            total = np.bincount(which, np.concatenate([np.frombuffer(counts[i], np.uint32) for i in asked]).astype(np.float64), len(words)).astype(np.int64)
            at = 0
            for i, own in zip(asked, each):
                out.append((int(blocks[i]), bucket, total[which[at : at + len(own)]].tobytes(), *[None] * 6))
                at += len(own)
            out.append((-1, bucket, None, int((total > 0).sum()), int(total.sum()), *[None] * 4))
        sent = np.flatnonzero(kinds == 2).tolist()
        if sent:
            each = [unpack_lows(values[i]) for i in sent]
            lows, which = np.unique(np.concatenate(each), return_inverse=True)
            weights = [np.frombuffer(counts[i], np.uint8 if len(counts[i]) == len(own) else np.uint32).astype(np.float64) for i, own in zip(sent, each)]
            total = np.bincount(which, np.concatenate(weights), len(lows))
            levels = np.log2(total).astype(np.int64)
            for level in range(int(levels.max()) + 1):
                own = levels == level
                if own.any():
                    out.append((-1, bucket, None, None, None, level, int(own.sum()), int(total[own].sum()), None))
            out.append((-1, bucket, *[None] * 6, fill_segment(lows, levels, probes).tobytes()))
        types = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        names = ["block", "bucket", "counts", "words", "total", "level", "seen", "occurrences", "bits"]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names=names)

    return answer


def _ask_block(order: int, blocks: int):
    def ask(rows: pa.Table) -> pa.Table:
        """One block's question to the segments: its distinct n-grams."""
        block = rows.column("__block")[0].as_py()
        # sorting machine numbers takes a tenth of what the library's set of them does
        keys = np.sort(gram_keys(grams_of(*tokens_of(*flat_text(rows.column("__text"))), order), blocks))
        out = [(block, b, pack_lows(lows)) for b, lows, _ in by_segment(keys[run_heads(keys)], blocks)]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["block", "bucket", "lows"])

    return ask


def _probe_segment(probes: int):
    def probe(asks: pa.Table, segment: pa.Table) -> pa.Table:
        """A segment's bits read for every block that asked: one byte for each n-gram, its level and one, or 0."""
        bits = np.frombuffer(segment.column("bits")[0].as_py(), np.uint8) if len(segment) else np.zeros(0, np.uint8)
        told = [(probe_levels(bits, unpack_lows(x), probes) + 1).astype(np.uint8).tobytes() for x in asks.column("lows").to_pylist()]
        return pa.table([asks.column("block"), asks.column("bucket"), pa.array(told, pa.binary())], names=["block", "bucket", "levels"])

    return probe


def level_means(told: DataFrame) -> np.ndarray:
    """Mean count of the n-grams of each level."""
    seen = {row["level"]: row["c"] / row["n"] for row in told.where("level is not null").groupBy("level").agg(F.sum("seen").alias("n"), F.sum("occurrences").alias("c")).collect()}
    return np.array([seen.get(q, 2.0**q * 1.4) for q in range(256)])


def _blocked(docs: DataFrame, train: Column, id_col: str, text_col: str, blocks: int, *more: Column) -> DataFrame:
    return docs.select(block_of(blocks, F.col(id_col), F.col(text_col)).alias("__block"), F.col(text_col).cast("string").alias("__text"), train.alias("__train"), *more)


def count_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, probes: int = PROBES) -> tuple[DataFrame, int]:
    """What training rows hold, as a written table, and the number of its buckets: word counts for each block, levels, segments (bits)."""
    blocks = block_count(docs, text_col)
    bare = _blocked(docs, train, id_col, text_col, blocks)
    sent = bare.groupBy("__block").applyInArrow(_count_block(order, blocks), _COUNTS)
    return staged(sent.groupBy("bucket").applyInArrow(_answer(probes), _TOLD), "lm-counts"), blocks


def score_texts(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, probes: int = PROBES, counted: tuple[DataFrame, int] | None = None) -> DataFrame:
    """Rows with n_tokens, n_known, train_tokens, base_score and score (log10), learnt where ``train`` holds.

    ``counted`` is what ``count_texts`` gave for the same rows, if it is at hand.
    """
    taken = {f.name for f in NEW_COLUMNS.fields}
    carried = [c for c in docs.columns if c.lower() not in taken]
    told, blocks = counted or count_texts(docs, train, id_col, text_col, order, probes)
    rows = _blocked(docs, train, id_col, text_col, blocks, *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)])
    bare = rows.select("__block", "__text", "__train")
    # from here on there are bits: no count of an n-gram is read
    segments = told.where("bits is not null").select("bucket", "bits")
    asks = bare.select("__block", "__text").groupBy("__block").applyInArrow(_ask_block(order, blocks), _ASKS)
    levels = staged(asks.groupBy("bucket").cogroup(segments.groupBy("bucket")).applyInArrow(_probe_segment(probes), _LEVELS), "lm-levels")
    sizes = told.agg(F.sum("words").alias("v"), F.sum("total").alias("n")).first()
    texts = docs.agg(F.count(F.when(train, 1)).alias("n")).first()["n"]
    count_of = np.concatenate([[0.0], level_means(told)])
    guess = Fitted(np.full((order - 1, BINS), FIRST_GUESS), texts, sizes["v"] or 0, sizes["n"] or 0)
    nothing = F.lit(None).cast("binary")
    replies = told.where("counts is not null").select("block", "bucket", "counts", nothing.alias("levels")).unionByName(levels.select("block", "bucket", nothing.alias("counts"), "levels"))

    def known(rows: pa.Table, replies: pa.Table):
        data, offsets = flat_text(rows.column("__text"))
        tokens, edges = tokens_of(data, offsets)
        words, which = np.unique(tokens, return_inverse=True)
        order_, edge = split_sorted(address(words, blocks)[0], blocks)
        keys, seat = np.unique(gram_keys(grams_of(tokens, edges, order), blocks), return_inverse=True)
        gram_edge = np.searchsorted(keys, np.arange(blocks + 1, dtype=np.uint64) << np.uint64(32))
        counts, read = np.zeros(len(words)), np.zeros(len(keys), np.uint8)
        for bucket, blob, levels in zip(*(replies.column(c).to_pylist() for c in ("bucket", "counts", "levels"))):
            if blob is not None:
                counts[order_[edge[bucket] : edge[bucket + 1]]] = np.frombuffer(blob, np.int64)
            else:
                read[gram_edge[bucket] : gram_edge[bucket + 1]] = np.frombuffer(levels, np.uint8)
        return tokens, edges, counts[which], np.split(count_of[read][seat], order - 1)

    def fit(rows: pa.Table, replies: pa.Table) -> pa.Table:
        tokens, edges, counts, grams = known(rows, replies)
        keep = pc.fill_null(rows.column("__train"), False).to_numpy()
        size = np.diff(edges)
        mask = np.repeat(keep, size)
        own = np.concatenate([[0], np.cumsum(size[keep])])
        sums = score_tokens(tokens[mask], own, counts[mask], [g[mask] for g in grams], guess, order, leave_one_out=True)
        n, b, s = np.nonzero(sums)
        return pa.table([pa.array(n.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(s.astype(np.int32)), pa.array(sums[n, b, s])], names=["n", "b", "s", "value"])

    shares = guess.shares.copy()
    sums = np.zeros((order - 1, BINS, len(SHARES)))
    fits = bare.groupBy("__block").cogroup(replies.groupBy("block")).applyInArrow(fit, "n int, b int, s int, value double")
    # written, so that the shuffle files of the fit are freed before the scores' own
    for row in staged(fits.groupBy("n", "b", "s").agg(F.sum("value").alias("value")), "lm-fit").collect():
        sums[row["n"], row["b"], row["s"]] = row["value"]
    used = sums.any(axis=2)
    shares[used] = SHARES[sums.argmax(axis=2)][used]
    fitted = Fitted(shares, guess.train_texts, guess.words, guess.total)

    def score(rows: pa.Table, replies: pa.Table) -> pa.Table:
        tokens, edges, counts, grams = known(rows, replies)
        owner = np.repeat(np.arange(len(rows)), np.diff(edges))
        base = np.bincount(owner, np.log10(fitted.base(counts)), len(rows))
        full = np.bincount(owner, np.log10(score_tokens(tokens, edges, counts, grams, fitted, order)), len(rows))
        found = np.bincount(owner, counts > 0, len(rows)).astype(np.int64)
        new = [pa.array(np.diff(edges).astype(np.int64)), pa.array(found), pa.array(np.full(len(rows), fitted.total, np.int64)), pa.array(base), pa.array(full)]
        return pa.table([*[rows.column(f"c{i}") for i in range(len(carried))], *new], names=[*[f"c{i}" for i in range(len(carried))], *[f.name for f in NEW_COLUMNS.fields]])

    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + NEW_COLUMNS.fields)
    done = rows.groupBy("__block").cogroup(replies.groupBy("block")).applyInArrow(score, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *[f.name for f in NEW_COLUMNS.fields])
