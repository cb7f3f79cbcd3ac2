"""Resampling against its rule in plain Python; the cutoff search against a sorted list; odd rows."""

import hashlib
import math
import random
import re
import zlib

import pytest

from termtide.llm import resample
from termtide.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, longest):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plainly(docs, target, buckets=10_000, longest=1, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for _, text in docs:
        for f in features(text, longest)[1]:
            s[bucket(f)] += 1
    for text in target:
        for f in features(text, longest)[1]:
            t[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    rows, pool = [], []
    for id_, text in docs:
        n_words, own = features(text, longest)
        weight = sum(gain[bucket(f)] for f in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
        rows.append([id_, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
        if n_words >= least:
            pool.append(rows[-1])
    pool.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for place, row in enumerate(pool[: percent * len(pool) // 100]):
        row[4] = place + 1
    return sorted(map(tuple, rows), key=repr)


def test_query_is_the_rule(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = QUERIES["op13_bracketed_resampling"](spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {f.dataType.simpleString() for f in got.schema.fields} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == plainly(docs, target)


@pytest.mark.parametrize("few", [1, 3, 1000])
def test_ties_nulls_repeats_and_longer_runs(spark, few):
    rng = random.Random(few)
    texts = ["", None, "One two, THREE", "жук one two one", "a b c d e f", "!!!", "x" * 30, "word " * 3_000]
    docs = [(rng.choice([None, 5, 5, 5, *range(6)]), rng.choice(texts)) for _ in range(90)]
    frame = spark.createDataFrame([(*r, 1, "w") for r in docs], "doc_id long, text string, Rank int, weight string")
    target = spark.createDataFrame([("one two",), (None,), ("жук",)], "text string")
    out = resample.resample(frame, target, buckets=50, longest=2, least_words=1, percent=40, few=few)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = out.collect()
    want = plainly(docs, ["one two", "", "жук"], buckets=50, longest=2, least=1, percent=40)
    assert sorted(map(tuple, got), key=repr) == want


def test_clashing_names_are_carried(spark):
    frame = spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, n_words int, c0 string")
    out = resample.resample(frame, frame.select("text"), least_words=1, percent=100)
    assert [tuple(r)[:3] for r in out.select("doc_id", "n_words", "c0").collect()] == [(1, 7, "x")]
    assert out.first()["rank"] == 1


def test_empty_tables(spark):
    frame = spark.createDataFrame([(i, "a b c") for i in range(10)], "doc_id long, text string")
    none = frame.limit(0)
    assert resample.resample(none, frame.select("text")).collect() == []
    got = resample.resample(frame, none.select("text"), least_words=3, percent=20).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2]


@pytest.mark.parametrize("seed", range(6))
def test_cutoff_search(spark, seed):
    rng = random.Random(seed)
    kind = [lambda: rng.randint(-5, 5), lambda: rng.randint(-(10**18), 10**18), lambda: int(rng.gauss(0, 100)) if rng.random() < 0.5 else 7][seed % 3]
    values = [kind() for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    ordered = sorted(values)
    for k in (1, 2, 50, 250, 499, 500):
        value, below = resample.kth_value(frame, "v", k, few=4, error=0.05)
        assert value == ordered[k - 1] and below == sum(v < value for v in values)
    with pytest.raises(ValueError):
        resample.kth_value(frame, "v", 501)
