"""Toxicity scores by a factorization machine over hashed terms.

score = sigmoid(b + sum of w[i] + sum over pairs of <v[i], v[j]>) over the distinct
terms i of a text that the model knows: weights are additive evidence, factors
catch pairs such as an insult with a group that it is aimed at.

Learning uses a bounded sample of labelled rows, ``sample_rows`` at most, the ones
with the smallest hashes of their id; every other step covers whole tables and
whole texts. Terms are runs of letters and digits (bytes from 0x80 on count as
letters), lower-cased in A-Z and hashed to 64 bits, and the first bytes of long ones. The model takes the terms that
stand in ``min_rows`` sampled texts at least and whose presence differs between
the labels (chi-squared), ``max_terms`` at most, which bounds what is broadcast.

Definitions: a null or empty text has no terms and gets the score of the bias
alone. Of several texts with one id the one with the smallest hash is learnt from. Rows with a null label or a null training mark are not learnt from. If no
row, or only one label, can be learnt from, the score is the share of label 1, or
0 without any row. A document with several labels counts once for each of them.
Repeated rows are each scored. Input columns named like a result column are
replaced, all others are carried along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .exchange import flat_text, mix64, slices, staged
from .words import LETTERS_ONLY, word_hashes, word_spans

SAMPLE_ROWS = 20_000
MAX_TERMS = 1 << 14
MIN_ROWS = 4
CHI_SQUARED = 6.63
FACTORS = 8
EPOCHS = 25
LEAST_STEPS = 1_000
BATCH = 256
RATE = 0.1
SHRINK = 2e-4
SEED = 20
STEM_BYTES = 6
POSITIVE_WEIGHT = 2.0


def known_places(terms: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places in ``known``, a sorted array, of the terms that it has."""
    place = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
    return place[known[place] == terms] if len(known) else place[:0]


def term_sets(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms by text: (text, hash), or (text, index into ``known``, a sorted array) of known ones."""
    begins, ends, firsts = word_spans(data, offsets, LETTERS_ONLY)
    terms = word_hashes(data, begins, ends)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
    # a long word's beginning is a term, too: endings vary
    long_ = ends - begins > STEM_BYTES
    stems = mix64(word_hashes(data, begins[long_], begins[long_] + STEM_BYTES))
    terms, text = np.concatenate([terms, stems]), np.concatenate([text, text[long_]])
    if known is not None:
        place = np.minimum(np.searchsorted(known, terms), max(len(known) - 1, 0))
        hit = known[place] == terms if len(known) else np.zeros(len(terms), bool)
        terms, text = place[hit].astype(np.uint64), text[hit]
    order = np.lexsort((terms, text))
    terms, text = terms[order], text[order]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (text[1:] != text[:-1])
    return text[fresh], terms[fresh]


class Machine:
    """A fitted factorization machine: sorted term hashes, weights, factors, bias."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, factors: np.ndarray, bias: float):
        self.terms, self.weights, self.factors, self.bias = terms, weights, factors, bias

    def scores(self, text: np.ndarray, term: np.ndarray, texts: int) -> np.ndarray:
        logit = self.bias + np.bincount(text, self.weights[term], texts)
        for factor in self.factors.T:
            value = factor[term]
            logit += (np.bincount(text, value, texts) ** 2 - np.bincount(text, value * value, texts)) / 2
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def choose_terms(counts: DataFrame, n: int, positive: float, min_rows: int, max_terms: int) -> DataFrame:
    """The ``max_terms`` terms (term) whose presence depends on the label most, of (term, rows, toxic rows) that have each."""
    share = positive / n if n else 0.0
    expected = F.col("rows") * share
    variance = expected * (1 - share) * (n - F.col("rows")) / max(n, 1)
    chi = F.when(variance > 0, F.pow(F.col("toxic") - expected, 2) / variance).otherwise(0.0)
    good = counts.withColumn("chi", chi).where((F.col("rows") >= min_rows) & (F.col("chi") >= CHI_SQUARED))
    return good.orderBy(F.desc("chi"), "term").limit(max_terms).select("term")


def fit_machine(text: np.ndarray, term: np.ndarray, labels: np.ndarray, known: np.ndarray) -> Machine:
    """AdaGrad on the logistic loss; (text, term) are the known terms of each sampled text, by their place in ``known``."""
    share = float(labels.mean()) if len(labels) else 0.0
    edge = np.clip(share, 1e-13, 1 - 1e-13)
    bias = float(np.log(edge / (1 - edge)))
    if not 0 < share < 1:
        return Machine(np.zeros(0, np.uint64), np.zeros(0), np.zeros((0, FACTORS)), bias)
    edges = np.searchsorted(text, np.arange(len(labels) + 1))
    # toxic rows are the fewer ones, and one missed weighs as much as several wrongly suspected
    weights = np.where(labels > 0, max(1.0, min(POSITIVE_WEIGHT, (1 - share) / share)), 1.0)
    rng = np.random.default_rng(SEED)
    size = len(known)
    parts = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.01, (size, FACTORS))], axis=1)
    past, past_bias = np.full(parts.shape, 1e-6), 1e-6
    batches = -(-len(labels) // BATCH)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // batches))):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            counts = edges[rows + 1] - edges[rows]
            owner = np.repeat(np.arange(len(rows)), counts)
            begin = np.cumsum(counts) - counts
            own = term[np.repeat(edges[rows] - begin, counts) + np.arange(int(counts.sum()))]
            used, local = np.unique(own, return_inverse=True)
            values = parts[used]
            active = values[local]
            sums = np.stack([np.bincount(owner, active[:, f], len(rows)) for f in range(1 + FACTORS)], axis=1)
            squares = np.stack([np.bincount(owner, active[:, f] ** 2, len(rows)) for f in range(1, 1 + FACTORS)], axis=1)
            logit = bias + sums[:, 0] + ((sums[:, 1:] ** 2 - squares) / 2).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[rows]) * weights[rows]
            gradient = np.empty_like(active)
            gradient[:, 0] = error[owner]
            gradient[:, 1:] = error[owner, None] * (sums[owner, 1:] - active[:, 1:])
            total = np.stack([np.bincount(local, gradient[:, f], len(used)) for f in range(1 + FACTORS)], axis=1) / len(rows)
            total += SHRINK * values
            past[used] += total * total
            parts[used] = values - RATE * total / np.sqrt(past[used])
            slope = error.mean()
            past_bias += slope * slope
            bias -= RATE * slope / np.sqrt(past_bias)
    return Machine(known, parts[:, 0].copy(), parts[:, 1:].copy(), float(bias))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` rows of ``labels`` (id, label), matched with the texts of ``docs``."""
    spread = F.xxhash64(F.col(id_col))
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(label_col).cast("double").alias("__label"), spread.alias("__h"))
    # bounded by sample_rows, so it may be broadcast
    chosen = F.broadcast(chosen.orderBy("__h", "__id", "__label").limit(sample_rows))
    sample = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text")).join(chosen, "__id").select("__h", "__label", "__text")
    # several documents may have one id: the text of the smallest hash, so that the bound holds for texts, too
    sample = sample.groupBy("__h", "__label").agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"))

    def terms(batches):
        for batch in slices(batches, 2):
            data, offsets = flat_text(pa.chunked_array([batch.column("__text")]))
            text, hashes = term_sets(data, offsets)
            edges = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("__h"), batch.column("__label"), lists], names=["h", "label", "terms"])

    schema = T.StructType().add("h", "long").add("label", "double").add("terms", T.ArrayType(T.LongType()))
    rows = staged(sample.mapInArrow(terms, schema), "toxic-terms")
    size = rows.agg(F.count("*").alias("n"), F.sum("label").alias("positive")).first()
    counts = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").cast("double").alias("rows"), F.sum("label").alias("toxic"))
    chosen_terms = choose_terms(counts, size["n"], size["positive"] or 0.0, MIN_ROWS, MAX_TERMS)
    known = np.sort(chosen_terms.toArrow().column("term").to_numpy().view(np.uint64))

    def places(batches):
        for batch in batches:
            lists = [known_places(np.asarray(x, np.int64).view(np.uint64), known) for x in batch.column("terms").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), pa.array(lists, pa.list_(pa.int64()))], names=["h", "label", "terms"])

    few = rows.mapInArrow(places, schema).toArrow().sort_by([("h", "ascending"), ("label", "ascending")])
    lists = few.column("terms").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy()) if len(few) else np.zeros(0, np.int64)
    place = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64) if len(few) else np.zeros(0, np.int64)
    return fit_machine(np.repeat(np.arange(len(sizes)), sizes), place, few.column("label").to_numpy().astype(float), known)


def score_texts(docs: DataFrame, machine: Machine, text_col: str = "text", score_name: str = "score", predicted_name: str = "predicted") -> DataFrame:
    """All rows with a score between 0 and 1, and 1 or 0 for a score of 0.5 or more, or less."""
    carried = [c for c in docs.columns if c.lower() not in (score_name.lower(), predicted_name.lower())]
    held = docs.sparkSession.sparkContext.broadcast(machine)
    size = len(carried)

    def score(batches):
        model = held.value
        for batch in slices(batches, size):
            data, offsets = flat_text(pa.chunked_array([batch.column(size)]))
            values = model.scores(*_indexes(*term_sets(data, offsets, model.terms)), batch.num_rows)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(size)], pa.array(values), pa.array((values >= 0.5).astype(np.int32))], names=names)

    def _indexes(text, term):
        return text, term.astype(np.int64)

    names = [*[f"c{i}" for i in range(size)], "score", "predicted"]
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)]).add("score", "double").add("predicted", "integer")
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(text_col).cast("string").alias("__text"))
    done = rows.mapInArrow(score, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], F.col("score").alias(score_name), F.col("predicted").alias(predicted_name))
