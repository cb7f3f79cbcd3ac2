"""Scores of the n-gram filter and of the character models."""

import collections
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from termtide.llm import language_id, ngram_lm
from termtide.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def words(text):
    return [*WORD.findall((text or "").encode().lower()), None]


def exact(rows, train):
    counts = collections.Counter(w for row, t in zip(rows, train) if t for w in words(row[1]))
    total, kinds = sum(counts.values()), len(counts)
    return [(len(words(t)), sum(counts[w] > 0 for w in words(t)), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words(t))) for _, t, *_ in rows]


def test_query_has_exact_base_scores_and_a_better_model(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    got = {r.doc_id: r for r in QUERIES["op4_log_frequency_bloom_lm"](spark, sf).collect()}
    for (doc, _), out, want in zip(rows, held, exact(rows, [not h for h in held])):
        row = got[doc]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out, *want[:3])
        assert math.isclose(row.base_score, want[3], rel_tol=1e-9)
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def test_small_cases(spark):
    rows = [(1, "a b a", True, 1), (2, None, True, 2), (3, "", False, 3), (None, "A \x0b zz", None, 4), (1, "a b a", True, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, t boolean, score int")
    out = ngram_lm.score_texts(df.withColumn("bucket", F.col("score")), F.col("t"))
    assert out.columns == ["doc_id", "text", "t", "bucket", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = {r.bucket: r for r in out.collect()}
    for (_, _, _, key), want in zip(rows, exact(rows, [bool(r[2]) for r in rows])):
        assert (got[key].n_tokens, got[key].n_known, got[key].train_tokens) == want[:3]
        assert math.isclose(got[key].base_score, want[3], rel_tol=1e-9) and got[key].score <= 0
    assert ngram_lm.score_texts(df.limit(0), F.col("t")).collect() == []
    nothing = ngram_lm.score_texts(df, F.lit(False)).collect()
    assert len(nothing) == 5 and all(r.train_tokens == 0 and r.base_score == 0 for r in nothing)


def test_segments_never_read_a_count_too_low():
    rng = np.random.default_rng(3)
    # a segment grows with what it holds, there is no size from which levels are given up
    for size in (7, 300, 200_000):
        lows = np.unique(rng.integers(0, 1 << 32, size, dtype=np.uint32))
        levels = np.minimum(rng.geometric(0.6, len(lows)) - 1, 20)
        held = np.arange(len(lows)) % 3 > 0
        bits = ngram_lm.fill_segment(lows[held], levels[held])
        read = ngram_lm.probe_levels(bits, lows)
        assert (read[held] >= levels[held]).all()
        if size > 1000:
            # at half filling, a chance hit needs all probes
            assert (read[~held] >= 0).mean() < 0.03 and (read[held] > levels[held]).mean() < 0.03
            assert len(bits) < (levels[held] + 1).sum() * 1.2
    assert (ngram_lm.probe_levels(np.zeros(0, np.uint8), lows) == -1).all() and (ngram_lm.probe_levels(np.zeros(64, np.uint8), lows) == -1).all()


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for lows in ([0], [(1 << 32) - 1], [3, 1 << 31], np.unique(rng.integers(0, 1 << 32, 5_000)), np.arange(300)):
        lows = np.array(lows, np.uint32)
        assert (ngram_lm.unpack_lows(ngram_lm.pack_lows(lows)) == lows).all()


def interpolated(rows, train, order=3):
    """Scores in plain Python: exact counts by levels, shares of the grid by leaving one out, interpolation."""
    texts = [words(t) for t in rows]
    unigrams = collections.Counter(w for t, k in zip(texts, train) if k for w in t)
    total, kinds, n_texts = sum(unigrams.values()), len(unigrams), sum(train)

    def gram(t, i, n):
        return tuple("start" if i - j < 0 else t[i - j] for j in reversed(range(n)))

    counts = [collections.Counter(gram(t, i, n) for t, k in zip(texts, train) if k for i in range(len(t))) for n in range(2, order + 1)]
    by_level = collections.defaultdict(list)
    for c in counts:
        for value in c.values():
            by_level[int(math.log2(value))].append(value)
    mean = {q: sum(v) / len(v) for q, v in by_level.items()}
    read = lambda n, g: mean[int(math.log2(counts[n - 2][g]))] if counts[n - 2][g] else 0.0
    bin_of = lambda c: min(int(math.log2(max(c, 1.0))), ngram_lm.BINS - 1)

    def token(t, i, shares, one, sums=None):
        lower = (max(unigrams[t[i]] - one, 0) + 1) / (total + kinds + 1)
        seen, context = unigrams[t[i]] > 0, unigrams[t[i - 1]] if i else n_texts
        for n in range(2, order + 1):
            known = read(n, gram(t, i, n)) if seen and context > 0 else 0.0
            seen = known > 0
            whole = max(context - one, 0.0)
            if whole > 0:
                ratio = max(min(known, context) - one, 0.0) / whole
                if sums is not None:
                    for s, share in enumerate(ngram_lm.SHARES):
                        sums[n - 2, bin_of(whole), s] += math.log(lower + (1 - share) * (ratio - lower))
                share = shares[n - 2][bin_of(whole)]
                lower = (1 - share) * ratio + share * lower
            if n < order:
                before = 0.0
                if i:
                    before_context = unigrams[t[i - 2]] if i > 1 else n_texts
                    before = read(n, gram(t, i - 1, n)) if unigrams[t[i - 1]] > 0 and before_context > 0 else 0.0
                context = before
        return lower

    guess = np.full((order - 1, ngram_lm.BINS), ngram_lm.FIRST_GUESS)
    sums = np.zeros((order - 1, ngram_lm.BINS, len(ngram_lm.SHARES)))
    for t, k in zip(texts, train):
        for i in range(len(t) if k else 0):
            token(t, i, guess, 1.0, sums)
    shares, used = guess.copy(), sums.any(axis=2)
    shares[used] = ngram_lm.SHARES[sums.argmax(axis=2)][used]
    return [sum(math.log10(token(t, i, shares, 0.0)) for i in range(len(t))) for t in texts]


def _corpus(spark):
    rng = np.random.default_rng(8)
    rows = [(i, " ".join(f"w{w}" for w in np.minimum(rng.zipf(1.4, rng.integers(0, 60)), 40)), i % 4 != 1) for i in range(120)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, t boolean")


def test_scores_are_the_interpolation_where_no_probe_hits_by_chance(spark):
    rows, df = _corpus(spark)
    # so many probes that no chance hit is left
    got = {r.doc_id: r.score for r in ngram_lm.score_texts(df, F.col("t"), probes=40).collect()}
    for (i, _, _), want in zip(rows, interpolated([r[1] for r in rows], [r[2] for r in rows])):
        assert math.isclose(got[i], want, rel_tol=1e-9), i


def test_scores_come_from_the_bits(spark):
    """With empty segments all evidence of n-grams goes, whatever was counted."""
    rows, df = _corpus(spark)
    told, blocks = ngram_lm.count_texts(df, F.col("t"))
    assert told.where("bits is not null").count() > 1
    zeros = F.when(F.col("bits").isNotNull(), F.unhex(F.expr("repeat('00', octet_length(bits))")))
    empty = {r.doc_id: r for r in ngram_lm.score_texts(df, F.col("t"), counted=(told.withColumn("bits", zeros), blocks)).collect()}
    none = {r.doc_id: r for r in ngram_lm.score_texts(df, F.col("t"), counted=(told.withColumn("bits", F.lit(None).cast("binary")), blocks)).collect()}
    full = {r.doc_id: r for r in ngram_lm.score_texts(df, F.col("t"), counted=(told, blocks)).collect()}
    assert all(math.isclose(empty[i].score, none[i].score) for i in empty)
    # the words of the corpus are independent: n-grams tell what training has seen, and no more
    seen = [i for i, _, t in rows if t]
    assert sum(full[i].score for i in seen) > sum(empty[i].score for i in seen) + 10
    assert all(empty[i].score <= full[i].base_score + 1e-9 for i in empty)


def test_what_training_has_once_is_known(spark):
    rng = np.random.default_rng(5)
    # every word, and so every n-gram, stands once in training
    texts = [" ".join(f"w{i}" for i in range(60 * k, 60 * k + 60)) for k in range(30)]
    mixed = [" ".join(rng.permutation(t.split()).tolist()) for t in texts]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(100 + i, t, False) for i, t in enumerate(texts)] + [(200 + i, t, False) for i, t in enumerate(mixed)]
    # trigrams that stand once in training tell held-out copies from other orders of the same words
    got = {r.doc_id: r.score for r in ngram_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string, t boolean"), F.col("t")).collect()}
    assert all(math.isclose(got[i], got[100 + i], rel_tol=1e-9) for i in range(30))
    assert all(got[100 + i] > got[200 + i] + 1 for i in range(30))


def test_the_grid_of_shares_is_whole():
    assert ngram_lm.SHARES.tolist() == [0.01, 0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95, 0.99, 0.999]


def test_languages_are_told_apart(spark, sf):
    rows = QUERIES["op6_kneser_ney_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_characters_make_a_distribution_and_odd_rows_are_defined(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    models = language_id.learn(docs, F.lit(True), order=3, sample_rows=30)
    for context in (" th", "ent", "qx"):
        total = np.zeros(len(models.languages))
        for letter in "abcdefghijklmnopqrstuvwxyz äöüßéèêçñíóúà":
            codes, place, _ = language_id.codes_of([context + letter])
            total += np.exp(models.log_probabilities(language_id.gram_hashes(codes, place, 3))[-1].astype(float))
        assert (total > 0.95).all() and (total < 1.01).all()
    df = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 ..."), (4, "the thing that " * 2000), (4, "日本語")], "doc_id long, text string")
    got = sorted([(r.doc_id, r.lang_pred, r.rejected) for r in language_id.identify(df, models).collect()])
    assert got[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert (4, "en", False) in got and (4, got[3][1], got[3][2]) != got[4]
    assert language_id.identify(df.limit(0), models).collect() == []
    none = language_id.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(df, none).collect()} == {"und"}
