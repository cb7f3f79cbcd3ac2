"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of character ``order``-grams. The highest order uses
counts, lower orders the number of different characters that stand before, each
with its own discount n1 / (n1 + 2 n2). What scoring needs is worked out once:
for every n-gram that any language has, the interpolated log-probability of its
last character in each language, and for every context the weight of the lower
order. Both are sorted arrays of 64-bit hashes with one row per n-gram and one
column per language, looked up by binary search, longest n-gram first.

A text gets the language of the lowest cross-entropy per character. The score is
the softmax of the log-likelihoods over up to ``EVIDENCE`` characters' worth, with a
temperature fitted so that it is the share of right answers, and 1 / languages at
least. Rejection is calibrated, too: a text whose cross-entropy is above what all but
``reject_share`` of its language's texts have is marked as rejected. Both are fitted on
sampled training rows that the models have not counted, one in ``CALIBRATION``.

Learning uses about ``sample_rows`` rows of each language, those whose id and text hash
lowest (of a language with fewer rows, all), which bounds the model; scoring
covers every row and whole texts. A language with fewer than ``LEAST_CALIBRATED`` rows
is counted whole and rejects nothing.

Definitions: text is lower-cased; a run of characters that are no letters counts
as one space. A null text, or one without letters, is ``und`` with score 0. Rows
with a null language are not learnt from. If nothing can be learnt, all rows are
``und``. Ties go to the language that sorts first. Repeated rows are each scored.
Input columns named like a result column are replaced, others are carried along.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .exchange import mix64, slices

ORDER = 4
SAMPLE_ROWS = 2_000
CALIBRATION = 4
LEAST_CALIBRATED = 40
EVIDENCE = 200
REJECT_SHARE = 0.01
UNKNOWN = "und"
_GAPS = re.compile(r"[\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def letters_of(text: str | None) -> str:
    """Lower-cased letters, one space for everything between, and one at each end; empty without letters."""
    plain = _GAPS.sub(" ", (text or "").lower()).strip()
    return f" {plain} " if plain else ""


def gram_hashes(codes: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order, the hash of the n-gram that ends at each character; 0 where the text is too short for it."""
    out = []
    for n in range(1, order + 1):
        h = np.full(len(codes), n, np.uint64)
        for back in range(n - 1, -1, -1):
            part = np.zeros(len(codes), np.uint64)
            part[back:] = codes[: len(codes) - back]
            h = mix64(h * _BASE + part)
        h[place < n - 1] = 0
        out.append(h)
    return out


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each one's place in its text, and its text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    return codes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes), owner


class Models:
    """Sorted hash arrays of all languages; see the module's text."""

    def __init__(self, languages: list[str], order: int, tables: list[tuple[np.ndarray, np.ndarray]], weights: list[tuple[np.ndarray, np.ndarray]], floor: float):
        self.languages, self.order, self.tables, self.weights, self.floor = languages, order, tables, weights, floor
        self.limits, self.temperature = np.full(len(languages), np.inf), 1.0

    def log_probabilities(self, hashes: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each character in each language."""
        n = len(hashes[0])
        out = np.zeros((n, len(self.languages)), np.float32)
        todo = np.arange(n)
        for k in range(self.order - 1, -1, -1):
            own = hashes[k][todo]
            keys, rows = self.tables[k]
            at = np.minimum(np.searchsorted(keys, own), max(len(keys) - 1, 0))
            hit = keys[at] == own if len(keys) else np.zeros(len(own), bool)
            out[todo[hit]] += rows[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                return out
            if k:
                # the context is the (k)-gram that ends one character earlier
                context = np.where(hashes[k][todo] == 0, 0, hashes[k - 1][todo - 1])
                keys, rows = self.weights[k]
                at = np.minimum(np.searchsorted(keys, context), max(len(keys) - 1, 0))
                known = np.flatnonzero(keys[at] == context) if len(keys) else np.zeros(0, np.int64)
                out[todo[known]] += rows[at[known]]
        out[todo] += self.floor
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text in each language, and the number of characters."""
        codes, place, owner = codes_of(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        step = 1 << 18
        for at in range(0, len(codes), step):
            low = max(0, at - self.order)
            logs = self.log_probabilities(gram_hashes(codes[low : at + step], place[low : at + step], self.order))[at - low :]
            # the first character of a slice may need what stands before it, which the overlap has
            for i in range(len(self.languages)):
                sums[:, i] -= np.bincount(owner[at : at + step], logs[:, i], len(texts))
        sizes = np.bincount(owner, minlength=len(texts))
        return sums / np.maximum(sizes, 1)[:, None], sizes

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy and rejection of each text."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), np.ones(len(texts), bool)
        entropy, sizes = self.entropies(texts)
        best = entropy.argmin(axis=1)
        least = entropy[np.arange(len(texts)), best]
        evidence = np.minimum(sizes, EVIDENCE)[:, None] * (entropy - least[:, None]) * self.temperature
        score = 1 / np.exp(-np.minimum(evidence, 700)).sum(axis=1)
        nothing = sizes == 0
        names = [UNKNOWN if e else self.languages[b] for b, e in zip(best.tolist(), nothing.tolist())]
        return names, np.where(nothing, 0.0, score), np.where(nothing, 0.0, least), nothing | (least > self.limits[best])


def kneser_ney(languages: list[str], order: int, language: np.ndarray, length: np.ndarray, hashes: np.ndarray, suffixes: np.ndarray, contexts: np.ndarray, counts: np.ndarray, alphabet: int) -> Models:
    """Models from n-gram counts: one entry per language and n-gram, with its suffix (n-gram less its first
    character) and context (less its last)."""
    many = len(languages)
    effective: list[tuple[np.ndarray, ...]] = []
    for n in range(1, order + 1):
        own = length == n
        lang, gram, suffix, context, count = language[own], hashes[own], suffixes[own], contexts[own], counts[own].astype(float)
        if n < order:
            # the number of different characters before it, from the next longer n-grams
            above = length == n + 1
            pairs = np.stack([language[above].astype(np.uint64), suffixes[above]], axis=1)
            kinds, before = np.unique(pairs, axis=0, return_counts=True)
            key = {(int(a), int(b)): int(c) for (a, b), c in zip(kinds.tolist(), before.tolist())}
            # text beginnings have nothing before them: count one
            count = np.array([key.get((int(a), int(b)), 1) for a, b in zip(lang, gram)], float)
        effective.append((lang, gram, suffix, context, count))
    floor = -float(np.log(alphabet + 1))
    tables, weights = [], [(np.zeros(0, np.uint64), np.zeros((0, many), np.float32))]
    lower: Models | None = None
    for n in range(1, order + 1):
        lang, gram, suffix, context, count = effective[n - 1]
        discount = np.zeros(many)
        for i in range(many):
            one, two = (count[lang == i] == 1).sum(), (count[lang == i] == 2).sum()
            discount[i] = min(max(one / (one + 2 * two), 0.1), 0.95) if one + two else 0.5
        keys, first, which = np.unique(context, return_index=True, return_inverse=True)
        total, kinds = np.zeros((len(keys), many)), np.zeros((len(keys), many))
        np.add.at(total, (which, lang), count)
        np.add.at(kinds, (which, lang), 1)
        gamma = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        grams, head, place = np.unique(gram, return_index=True, return_inverse=True)
        part = np.zeros((len(grams), many))
        at = which[head]
        part[place, lang] = np.maximum(count - discount[lang], 0) / total[which, lang]
        if n == 1:
            below = np.full((len(grams), many), np.exp(floor))
        else:
            keys_below, rows_below = tables[n - 2]
            below = np.exp(rows_below[np.searchsorted(keys_below, suffix[head])].astype(float))
        tables.append((grams, np.log(part + gamma[at] * below).astype(np.float32)))
        if n > 1:
            weights.append((keys, np.log(gamma).astype(np.float32)))
        elif len(keys):
            floor_weight = np.log(gamma[0])
    models = Models(languages, order, tables, weights, floor + (float(floor_weight.mean()) if len(languages) else 0.0))
    return models


def learn(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", order: int = ORDER, sample_rows: int = SAMPLE_ROWS, reject_share: float = REJECT_SHARE) -> Models:
    """Models of all languages among the rows where ``train`` holds."""
    usable = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key")).withColumn("h", F.pmod("key", F.lit(2**31 - 1)))
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Models([], order, [], [], 0.0)
    # the share of hashes that gives a language its rows, about sample_rows of them
    part, held = F.lit(False), F.lit(False)
    for name in languages:
        limit = int(min(1.0, sample_rows / sizes[name]) * (2**31 - 1))
        part = part | ((F.col("lang") == F.lit(name)) & (F.col("h") <= F.lit(limit)))
        if sizes[name] >= LEAST_CALIBRATED:
            held = held | ((F.col("lang") == F.lit(name)) & (F.pmod(F.xxhash64("key", F.lit("held")), F.lit(CALIBRATION)) == 0))
    # equal rows are one, so that the bound holds
    sample = usable.where(part).withColumn("held", held).dropDuplicates(["lang", "key"])
    counting, checking = (sample.where(c).select("lang", "text") for c in (~F.col("held"), F.col("held")))
    number = {name: i for i, name in enumerate(languages)}

    def count(batches):
        for batch in slices(batches, 1):
            texts = [letters_of(t) for t in batch.column(1).to_pylist()]
            codes, place, owner = codes_of(texts)
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)[owner] if len(codes) else np.zeros(0, np.int64)
            hashes = gram_hashes(codes, place, order)
            for n in range(1, order + 1):
                own = np.flatnonzero(hashes[n - 1])
                gram = hashes[n - 1][own]
                suffix = hashes[n - 2][own] if n > 1 else np.zeros(len(own), np.uint64)
                context = hashes[n - 2][own - 1] if n > 1 else np.zeros(len(own), np.uint64)
                order_ = np.lexsort((gram, lang[own]))
                gram, suffix, context, speech = gram[order_], suffix[order_], context[order_], lang[own][order_]
                fresh = np.ones(len(gram), bool)
                fresh[1:] = (gram[1:] != gram[:-1]) | (speech[1:] != speech[:-1])
                head = np.flatnonzero(fresh)
                counts = np.diff(np.append(head, len(gram)))
                as_long = lambda x: pa.array(x[head].view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(speech[head]), pa.array(np.full(len(head), n, np.int64)), as_long(gram), as_long(suffix), as_long(context), pa.array(counts)], names=["lang", "n", "gram", "suffix", "context", "c"])

    counted = counting.mapInArrow(count, "lang long, n long, gram long, suffix long, context long, c long")
    # bounded by the sample: the n-grams of about sample_rows texts of each language
    table = counted.groupBy("lang", "n", "gram").agg(F.first("suffix").alias("suffix"), F.first("context").alias("context"), F.sum("c").alias("c")).toArrow()
    column = lambda name: table.column(name).to_numpy()
    alphabet = len(np.unique(column("gram")[column("n") == 1]))
    models = kneser_ney(languages, order, column("lang"), column("n"), column("gram").view(np.uint64), column("suffix").view(np.uint64), column("context").view(np.uint64), column("c"), alphabet)
    _calibrate(checking, models, reject_share)
    return models


def _calibrate(sample: DataFrame, models: Models, reject_share: float) -> None:
    """Each language's limit of the cross-entropy, and the softmax temperature, from texts that were not counted."""
    held = sample.sparkSession.sparkContext.broadcast(models)
    number = {name: i for i, name in enumerate(models.languages)}

    def measure(batches):
        for batch in slices(batches, 1):
            entropy, sizes = held.value.entropies([letters_of(t) for t in batch.column(1).to_pylist()])
            lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
            rows = np.arange(len(lang))
            own = entropy[rows, lang]
            entropy[rows, lang] = np.inf
            gap = entropy.min(axis=1) - own if len(models.languages) > 1 else np.full(len(lang), 1.0)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(own), pa.array(gap), pa.array(sizes.astype(np.int64))], names=["lang", "own", "gap", "n"])

    rows = sample.mapInArrow(measure, "lang long, own double, gap double, n long").where("n > 0").toArrow()
    lang, own = rows.column("lang").to_numpy(), rows.column("own").to_numpy()
    margin = np.minimum(rows.column("n").to_numpy(), EVIDENCE) * rows.column("gap").to_numpy()
    for i in range(len(models.languages)):
        if (lang == i).any():
            models.limits[i] = np.quantile(own[lang == i], 1 - reject_share)
    if not len(lang):
        return
    # the likeliest temperature of a grid for two-way decisions by the margin
    grid = 2.0 ** np.arange(-6, 3)
    models.temperature = float(grid[np.argmin([np.logaddexp(0, -g * margin).sum() for g in grid])])


def identify(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """All rows with lang_pred, score, cross_entropy (nats per character) and rejected."""
    new = T.StructType().add("lang_pred", "string").add("score", "double").add("cross_entropy", "double").add("rejected", "boolean")
    carried = [c for c in docs.columns if c.lower() not in new.names]
    held, size = docs.sparkSession.sparkContext.broadcast(models), len(carried)
    names = [*[f"c{i}" for i in range(size)], *new.names]

    def decide(batches):
        for rows in slices(batches, size):
            found, score, entropy, rejected = held.value.decide([letters_of(t) for t in rows.column(size).to_pylist()])
            yield pa.RecordBatch.from_arrays([*[rows.column(i) for i in range(size)], pa.array(found, pa.string()), pa.array(score), pa.array(entropy), pa.array(rejected)], names=names)

    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carried)] + new.fields)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(text_col).cast("string").alias("__text"))
    done = rows.mapInArrow(decide, schema)
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)], *new.names)
