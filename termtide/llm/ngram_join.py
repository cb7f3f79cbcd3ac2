"""Jaccard self-join on word shingles by token-combination prefixes.

Two texts link when 100 * |intersection| >= percent * |union| of their shingle sets.
Let n be a set's size, M = n - ceil(n * percent / 100) the most shingles that it may
have apart from a partner, and D = floor(n * (100 - percent) / percent) the most that
both together may have apart.

Classes. Blocks of rows learn from buckets of the hash space how many texts have
each shingle: one, some (rare), or more than ``frequent`` (frequent). A set is ordered
by class, then by hash; the order is the same for all sets.

Rare keys. Partners have a common shingle among the first M + 1 of each. If the first
common one is rare, it is a key of both by itself. A set whose first M + 1 shingles
occur nowhere else has no partner, and most sets of a corpus end here.

Combined keys. If the first common shingle is frequent, no rare one is common, and the
r shingles of lower class are among those apart. Of the common ones, all frequent, the
first (D - r) + 2 have a pair that is adjacent in both sets, since fewer than (D - r) + 1
shingles can stand between; it lies within the first (M - r) + (D - r) + 2 frequent
shingles of each. So the prefix is extended to there, and adjacent pairs are its keys:
a number linear in n, where all combinations would be quadratic, and each pair is far
rarer than its shingles. That so many are common is sure from 67 per cent on; below it,
the frequent ones among the first M + 1 are keys by themselves.

Verification. Under each key the text with the fewest shingles of its own is the centre,
mostly the one that the others were made from. A text is first compared with the centre
with which it shares most keys, then, in further rounds, with a centre of another group,
drawn anew for each key and round. What links forms groups. Last, every two texts of one key that
are still in different groups are compared, unless they have been. So a group of copies
costs about its size, and no pair that could link is left out.

Definitions: words are runs of bytes other than 0x20 and 0x09-0x0D, lower-cased in A-Z.
A set has the distinct runs of ``size`` words, or the whole sequence if there are fewer;
a null or empty text, or one without words, has an empty set and links with nothing. Equal
texts with words link. Shingles are compared by 64-bit hashes and texts found equal by one.
A null id counts as larger than any number: a class has a null id only if all of its ids
are null. Repeated rows, and rows with equal ids, are separate members of one class.
Input columns named like a result column are replaced, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .components import components
from .exchange import ask_shared, block_count, block_of, flat_text, known_shared, mix64, numbers, staged, tell_shared
from .suffix_sort import ranges
from .words import BASE, shingle_sets, word_hashes, word_spans

FREQUENT = 64
PAIRS_FROM = 67
ROUNDS = 2
PARITY_WORDS = 16
CHUNK = 4096
SLICE = 1 << 20

_SETS = T.StructType().add("node", "long").add("n", "long").add("own", "long").add("shingles", T.ArrayType(T.LongType())).add("keys", T.ArrayType(T.LongType())).add("parity", T.ArrayType(T.LongType()))


def prefix_keys(hashes: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """Keys of one set of sorted hashes; classes: 0 in one text only, 1 rare, 2 frequent."""
    n = len(hashes)
    most = n - (n * percent + 99) // 100
    both = n * (100 - percent) // percent
    single = int((classes == 0).sum())
    if single > most:
        return np.zeros(0, np.uint64)
    if both == 0:
        # only an equal set can be a partner
        return mix64(np.array([hashes.sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
    rare, often = hashes[classes == 1], hashes[classes == 2]
    keys = mix64(rare[: most + 1 - single] ^ np.uint64(0xA5A5A5A5))
    lower = single + len(rare)
    if lower <= most and percent < PAIRS_FROM:
        keys = np.concatenate([keys, mix64(often[: most + 1 - lower] ^ np.uint64(0xA5A5A5A5))])
    elif lower <= most:
        often = often[: (most - lower) + (both - lower) + 2]
        keys = np.concatenate([keys, mix64(often[:-1] * np.uint64(BASE) + often[1:])])
    return keys


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of 1,024 classes of hashes, whether the set has an odd number of them, as 16 whole numbers.

    Where two sets differ in parity they differ in a shingle, so the number of
    places is at most the number of shingles that the two have apart.
    """
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) & (64 * PARITY_WORDS - 1), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _shingles(rows: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat_text(rows.column("text"))
    begins, ends, firsts = word_spans(data, offsets)
    return shingle_sets(word_hashes(data, begins, ends), firsts, size)


def _linked(percent: int) -> Column:
    common = F.size(F.array_intersect("a_set", "b_set")).cast("long")
    return common * 100 >= (F.size("a_set") + F.size("b_set") - common) * percent


def possible_pairs(rows: pa.Table, percent: int) -> pa.Table:
    """Pairs under one key that upper bounds of what is common leave over; the rows may be of many keys.

    Not common are the shingles that one text has alone, and those that make two
    sets differ in parity. Pairs are formed and dropped in slices. If the task is
    for two chunks of a key, pairs are formed between them, else among its rows.
    """
    key, node, label, chunk, n, own = (numbers(rows.column(c)) for c in ("key", "node", "label", "chunk", "n", "own"))
    order = np.lexsort((node, chunk, key))
    key, node, label, chunk, n, own = (x[order] for x in (key, node, label, chunk, n, own))
    bits = rows.column("parity").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), PARITY_WORDS)[order]
    place = np.arange(len(node))
    end = np.searchsorted(key, key, side="right")
    first, second = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
    if first == second:
        begin = place + 1
    else:
        _, which = np.unique(key, return_inverse=True)
        begin = np.where(chunk == first, end - np.bincount(which, chunk == second)[which].astype(np.int64), end)
    counts = end - begin
    edges = np.searchsorted(np.cumsum(counts), np.arange(0, int(counts.sum()) + SLICE, SLICE), side="right")
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for low, high in zip(np.unique(edges)[:-1].tolist(), np.unique(edges)[1:].tolist()):
        x, y = np.repeat(place[low:high], counts[low:high]), ranges(begin[low:high], counts[low:high])
        total, most = n[x] + n[y], np.minimum(n[x] - own[x], n[y] - own[y])
        good = (most * 100 >= (total - most) * percent) & (label[x] != label[y])
        x, y, total = x[good], y[good], total[good]
        differ = np.zeros(len(x), np.int64)
        for word in range(PARITY_WORDS):
            differ += np.bitwise_count(bits[x, word] ^ bits[y, word])
        most = (total - differ) // 2
        good = most * 100 >= (total - most) * percent
        found.append((node[x[good]], node[y[good]]))
    a, b = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (0, 1))
    return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    close = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    sized = pairs.join(sets.select(F.col("node").alias("a"), F.col("n").alias("a_n")), "a").join(sets.select(F.col("node").alias("b"), F.col("n").alias("b_n")), "b").where(close).select("a", "b")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
    return sized.join(left, "a").join(right, "b").where(_linked(percent)).select("a", "b")


def _labelled(keys: DataFrame, labels: DataFrame) -> DataFrame:
    """Keys with each node's group; a node without links is its own group. Keys of one group alone are left out."""
    named = keys.join(labels, "node", "left").select("key", "node", "n", "own", F.coalesce("label", "node").alias("label"))
    split = named.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least != most").select("key")
    return named.join(split, "key")


def link_classes(texts: DataFrame, size: int = 4, percent: int = 85, frequent: int = FREQUENT) -> tuple[DataFrame, DataFrame]:
    """Distinct texts (node, text) to (node, n) of all and (node, label) of those that link with another."""
    blocks = block_count(texts, "text")
    rows = texts.select(block_of(blocks, "node").alias("block"), "node", "text")

    def ask(part: pa.Table) -> pa.Table:
        values, edges = _shingles(part, size)
        return ask_shared(part.column("block")[0].as_py(), values, np.repeat(np.arange(len(part)), np.diff(edges)), blocks)

    def tell(part: pa.Table) -> pa.Table:
        return tell_shared(part, frequent)

    def keys_of(part: pa.Table, told: pa.Table) -> pa.Table:
        values, edges = _shingles(part, size)
        classes = known_shared(told, values, blocks)
        sets, keys, apart, odd = [], [], [], []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            own = prefix_keys(values[a:b], classes[a:b], percent) if b > a else values[:0]
            sets.append(values[a:b].view(np.int64) if len(own) else None)
            keys.append(own.view(np.int64))
            odd.append(parity(values[a:b]) if len(own) else None)
            apart.append(int((classes[a:b] == 0).sum()))
        return pa.table([part.column("node"), pa.array(np.diff(edges).astype(np.int64)), pa.array(apart, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))], names=["node", "n", "own", "shingles", "keys", "parity"])

    told = rows.groupBy("block").applyInArrow(ask, "block int, bucket int, lows binary, counts binary").groupBy("bucket").applyInArrow(tell, "block int, bucket int, lows binary, often binary")
    # the exchange names its columns block and bucket, too
    sets = staged(rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(keys_of, _SETS), "join-sets")
    indexed = sets.where("shingles is not null")
    every = indexed.select("node", "n", "own", F.explode(F.array_distinct("keys")).alias("key"))
    # a key that one text has alone joins nothing
    keys = staged(every.join(every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "key"), "join-keys")

    # the text with the fewest shingles of its own is what the others of a family were made from
    centres = keys.groupBy("key").agg(F.min_by("node", F.struct(F.col("own") / F.col("n"), "node")).alias("b"))
    shared = keys.withColumnRenamed("node", "a").join(centres, "key").where("a != b").groupBy("a", "b").agg(F.count("*").alias("c"))
    tried = shared.groupBy("a").agg(F.max(F.struct("c", "b")).alias("best")).select("a", F.col("best.b").alias("b"))
    tried = staged(tried, "join-tried")
    links = staged(_verified(tried, indexed, percent), "join-links")
    labels = components(links)
    for seed in range(1, ROUNDS):
        open_ = staged(_labelled(keys, labels), "join-open")
        if open_.isEmpty():
            break
        # another centre for each key and round: the node of the smallest hash, then its group's opposite
        chance = F.xxhash64("node", "key", F.lit(seed))
        centre = open_.groupBy("key").agg(F.min(F.struct(chance.alias("h"), "node", "label")).alias("x")).select("key", F.col("x.node").alias("b"), F.col("x.label").alias("b_label"))
        shared = open_.withColumnRenamed("node", "a").join(centre, "key").where("label != b_label").groupBy("a", "b").agg(F.count("*").alias("c"))
        more = shared.groupBy("a").agg(F.max(F.struct("c", "b")).alias("best")).select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()
        more = staged(more, "join-tried")
        tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).union(more)
        found = staged(_verified(more, indexed, percent), "join-links")
        links = links.union(found)
        labels = components(links)
    open_ = staged(_labelled(keys, labels), "join-open")
    # a key with very many texts is cut into chunks, and each task gets one chunk or two
    parts = open_.groupBy("key").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("parts"))
    chunk = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least("chunk", j).alias("i"), F.greatest("chunk", j).alias("j")))
    dealt = open_.join(parts, "key").withColumn("chunk", chunk).join(indexed.select("node", "parity"), "node").withColumn("to", F.explode(pairs))
    # small keys share a task
    task = F.when(F.col("parts") == 1, F.pmod("key", F.lit(blocks))).otherwise(F.col("key"))
    dealt = dealt.select(task.alias("task"), "key", "to.i", "to.j", "node", "label", "chunk", "n", "own", "parity")

    def possible(rows: pa.Table) -> pa.Table:
        return possible_pairs(rows, percent)

    rest = dealt.groupBy("task", "i", "j").applyInArrow(possible, "a long, b long").distinct()
    seen = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = staged(rest.join(seen, ["a", "b"], "left_anti"), "join-rest")
    links = links.union(staged(_verified(rest, indexed, percent), "join-links"))
    return sets.select("node", "n"), components(links)


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85, frequent: int = FREQUENT) -> DataFrame:
    """All rows with n_shingles and component_id, the smallest id that links reach."""
    carried = [c for c in docs.columns if c.lower() not in ("n_shingles", "component_id")]
    node = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    texts = staged(docs.select(node.alias("node"), F.col(text_col).cast("string").alias("text")).groupBy("node").agg(F.first("text").alias("text")), "join-texts")
    sizes, labels = link_classes(texts, size, percent, frequent)
    known = staged(sizes.join(labels, "node", "left").select("node", "n", F.when(F.col("n") > 0, F.coalesce("label", "node")).alias("label")), "join-known")
    ids = docs.select(node.alias("node"), F.col(id_col).alias("id")).groupBy("node").agg(F.min("id").alias("id"))
    least = known.where("label is not null").join(ids, "node").groupBy("label").agg(F.min("id").alias("least"))
    classes = staged(known.join(least, "label", "left").select("node", "n", "label", "least"), "join-classes")
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(id_col).alias("own"), node.alias("node"))
    done = rows.join(classes, "node")
    component = F.when(F.col("label").isNull(), F.col("own")).otherwise(F.col("least"))
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], F.col("n").alias("n_shingles"), component.alias("component_id"))
