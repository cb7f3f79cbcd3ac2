"""Importance resampling of documents towards a target's distribution of features.

Features are runs of 1 to ``longest`` words, counted in ``buckets`` by crc32. A bucket's
gain is 1000 times the log ratio of its smoothed share in the target to that in the
source, floored; a document's weight is the floored mean gain of its features. Gumbel
noise from the hash of its id turns the largest scores into a draw without replacement.

1. Each task adds up its buckets in one array; the sums, ``buckets`` numbers, come to the
   driver. The gains go back to all tasks as one array, and every document is scored
   from it and written as one row of numbers.
2. The cutoff is not found by sorting all scores. A quantile sketch gives a bracket;
   exact counts of the rows above and within it validate it, or show which side to
   widen. Only rows in the bracket are sketched again, until at most ``few`` are left,
   which are sorted. Equal scores are told apart in the same way by id.
3. The rows drawn are range-sorted and numbered by range offsets.

Definitions: words are runs of digits, letters a-z after lower-casing A-Z, and
characters from U+0080 on. A null or empty text has no features, weight 0. A null id is
hashed as no digits after the colon and comes after all others among equal scores. Rows
with equal score and id are ordered by features, weight and text, and what is left equal
(repeated rows) in any order. Ids are whole numbers; others fail in the cast. An empty
target has T = 0, so that all gains still are defined. Empty tables give empty results.
Input columns named like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.spread import with_index
from .exchange import slices, staged

BUCKETS = 10_000
LONGEST = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
FEW = 20_000
SKETCH_ERROR = 1e-3
KEPT_GAINS = 1 << 18

# bytes that make words stay, A-Z in lower case; all others part words
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NEW_COLUMNS = T.StructType().add("n_features", "long").add("weight", "long").add("score", "long").add("rank", "long")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


def features_of(words: list[bytes], longest: int) -> list[bytes]:
    """All runs of 1 to ``longest`` words, joined by one space, repeats included."""
    out = words
    for n in range(2, longest + 1):
        out = out + [b" ".join(run) for run in zip(*(words[i:] for i in range(n)))]
    return out


def bucket_sums(texts: DataFrame, text_col: str, buckets: int, longest: int) -> list[int]:
    """How many features of all texts fall into each bucket."""

    def count(batches):
        sums = np.zeros(buckets, np.int64)
        for batch in slices(batches, 0):
            kinds: Counter[bytes] = Counter()
            for text in batch.column(0).to_pylist():
                kinds.update(features_of(words_of(text), longest))
            for feature, times in kinds.items():
                sums[zlib.crc32(feature) % buckets] += times
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(sums[used])], names=["bucket", "n"])

    total = texts.select(F.col(text_col).cast("binary").alias("text")).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    sums = [0] * buckets
    for row in total.collect():  # one row for each bucket
        sums[row["bucket"]] = row["n"]
    return sums


def gains_of(source: list[int], target: list[int]) -> list[int]:
    size, total, goal = len(source), sum(source), sum(target)
    return [math.floor(1000 * math.log((t + 1.0) * (total + size) / ((s + 1.0) * (goal + size)))) for s, t in zip(source, target)]


class _GainOf(dict):
    """Gain by feature, worked out when first asked for; forgotten when there are many."""

    def __init__(self, gains: list[int]):
        super().__init__()
        self.gains = gains

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT_GAINS:
            self.clear()
        gain = self[feature] = self.gains[zlib.crc32(feature) % len(self.gains)]
        return gain


def noise_of(seed: int, id_: str | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{id_ or ''}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_texts(docs: DataFrame, gains: list[int], id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """All columns but the text, as they are, and __words, n_features, weight and score."""
    taken = {f.name for f in NEW_COLUMNS.fields} | ({text_col.lower()} - {id_col.lower()})
    carried = [c for c in docs.columns if c.lower() not in taken]
    size = len(carried)
    held = docs.sparkSession.sparkContext.broadcast(gains)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(id_col).cast("string").alias("__id"), F.col(text_col).cast("binary").alias("__text"))
    names = [*[f"c{i}" for i in range(size)], "n_words", "n_features", "weight", "score"]

    def score(batches):
        gain_of = _GainOf(held.value)
        for batch in slices(batches, size + 1):
            out = []
            for id_, text in zip(batch.column(size).to_pylist(), batch.column(size + 1).to_pylist()):
                words = words_of(text)
                features = features_of(words, longest)
                weight = sum(map(gain_of.__getitem__, features)) // len(features) if features else 0
                out.append((len(words), len(features), weight, weight + noise_of(seed, id_)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], *[pa.array([r[i] for r in out], pa.int64()) for i in range(4)]], names=names)

    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)])
    for name in names[size:]:
        schema = schema.add(name, "long")
    done = rows.mapInArrow(score, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], F.col("n_words").alias("__words"), "n_features", "weight", "score")


def kth_value(rows: DataFrame, name: str, k: int, few: int = FEW, error: float = SKETCH_ERROR) -> tuple[int, int]:
    """The k-th smallest (from 1) of a column of whole numbers without nulls, and how many rows are below it.

    Brackets come from a quantile sketch of the rows still in question and are
    validated by exact counts; a side that fails is widened to the bound before.
    """
    values = rows.select(F.col(name).cast("long").alias("v"))
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("n")).first()
    low, high, inside, below = ends["low"], ends["high"], ends["n"], 0
    if not 1 <= k <= inside:
        raise ValueError(f"k must be 1 to {inside}")
    while inside > few and low < high:
        part = values.where(F.col("v").between(low, high))
        share, slack = (k - below) / inside, 2 * error
        left, right = part.approxQuantile("v", [max(0.0, share - slack), min(1.0, share + slack)], error)
        # doubles hold whole numbers up to 2**53; beyond that one step to either side is not enough, and counts decide
        left = min(max(low, math.floor(left)), high)
        right = max(min(high, math.ceil(right)), left)
        if (left, right) == (low, high):
            left, right = low, low + (high - low) // 2
        outside = part.agg(F.count_if(F.col("v") < left).alias("under"), F.count_if(F.col("v") <= right).alias("upto")).first()
        under, upto = below + outside["under"], below + outside["upto"]
        if under >= k:  # the bracket lies too high
            high, inside = left - 1, outside["under"]
        elif upto < k:  # too low
            low, inside, below = right + 1, inside - outside["upto"], upto
        else:
            low, high, inside, below = left, right, upto - under, under
    if low == high:
        return low, below
    rest = sorted(row["v"] for row in values.where(F.col("v").between(low, high)).collect())  # few at most
    value = rest[k - below - 1]
    return value, below + sum(v < value for v in rest)


def draw(scored: DataFrame, share: int, id_col: str = "doc_id", drawable: Column | str = "__words >= 20", few: int = FEW) -> DataFrame:
    """Rows of ``score_texts`` (and __hash of the text) with rank: 1, 2, .. for the ``share`` percent of drawable rows with the largest scores, null for others."""
    drawable = F.expr(drawable) if isinstance(drawable, str) else drawable
    rows = scored.withColumn("__open", F.coalesce(drawable, F.lit(False)))
    pool = rows.where("__open")
    k = share * pool.count() // 100
    if k == 0:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    lost, above = kth_value(pool.select((-F.col("score")).alias("v")), "v", k, few)
    cutoff, rest = -lost, k - above
    # null ids come last: after all ids, and told apart from the largest one
    tied = pool.where(F.col("score") == cutoff).select(F.col(id_col).cast("long").alias("__id"))
    named = tied.where("__id is not null")
    before = F.col("score") > cutoff
    numbered = named.count()
    if rest >= numbered:
        least = F.lit(True) if rest > numbered else F.col(id_col).isNotNull()
    else:
        least = F.coalesce(F.col(id_col).cast("long") <= kth_value(named, "__id", rest, few)[0], F.lit(False))
    taken = F.col("__open") & (before | ((F.col("score") == cutoff) & least))
    order = [F.col("score").desc(), F.col(id_col).cast("long").asc_nulls_last(), "n_features", "weight", "__hash"]
    # rows that share the last id in may be more than are to be drawn: ranks beyond k are taken back
    ranked = with_index(rows.where(taken), *order, name="__place")
    rank = F.when(F.col("__place") < k, F.col("__place") + 1).cast("long")
    return ranked.select(*scored.columns, rank.alias("rank")).unionByName(rows.where(~taken).select(*scored.columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED, few: int = FEW) -> DataFrame:
    """All rows without their texts, with n_features, weight, score and rank (null: not drawn)."""
    gains = gains_of(bucket_sums(docs, text_col, buckets, longest), bucket_sums(target, target_text, buckets, longest))
    addressed = docs.withColumn("__hash", F.xxhash64(F.col(text_col).cast("string")))
    scored = score_texts(addressed, gains, id_col, text_col, longest, seed)
    done = draw(staged(scored, "resample-scores"), percent, id_col, F.col("__words") >= least_words, few)
    return done.drop("__words", "__hash")
