"""Links between shingle sets against all pairs."""

import itertools
import re

import numpy as np
import pytest

from termtide.llm import ngram_join
from termtide.llm.components import components
from termtide.llm.words import shingle_sets, word_hashes, word_spans

WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(text, size):
    words = WORD.findall((text or "").encode().lower())
    return frozenset([tuple(words)]) if 0 < len(words) < size else frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min([x for x in (least.get(top(i)), d) if x is not None], default=None)
    return sorted(((rows[i][0], len(sets[i]), least[top(i)]) for i in range(len(rows))), key=str)


def found(df, **more):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_documents(df, **more).collect()], key=str)


def family(seed, members, length, edits):
    rng = np.random.default_rng(seed)
    base = [f"w{seed}x{i}" for i in rng.integers(0, 400, length)]
    out = []
    for _ in range(members):
        words = list(base)
        for _ in range(int(rng.integers(0, edits + 1))):
            words[int(rng.integers(0, length))] = f"n{rng.integers(0, 10**9)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("frequent", [2, 64])
def test_families_link_as_all_pairs_do(spark, frequent):
    line = " ".join(f"common{i}" for i in range(15))
    texts = [*family(1, 30, 120, 6), *family(2, 12, 60, 3), *family(3, 5, 300, 12)]
    texts += [f"{line} " + " ".join(f"own{i}x{j}" for j in range(i)) for i in range(12)]
    texts += [t.upper() for t in texts[:3]] + [texts[0], texts[0] + "  "]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, frequent=frequent) == brute(rows, 4, 85)


def test_other_sizes(spark):
    rows = list(enumerate([*family(4, 15, 80, 5), "a b c", "A b  c", "a b", "", None, "  ", "a b c d e f", "a b c d e g"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, size=5, percent=80, frequent=3) == brute(rows, 5, 80)


def test_null_ids_repeats_and_columns(spark):
    rows = [(None, "p q r s t", 1), (9, "p q r s t", 2), (4, "P q r s t", 3), (4, "u v", 4), (4, "u v", 5), (None, "", 6), (None, "only here", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, node int")
    out = ngram_join.link_documents(df)
    assert out.columns == ["doc_id", "text", "node", "n_shingles", "component_id"]
    assert {r.node: (r.n_shingles, r.component_id) for r in out.collect()} == {1: (2, 4), 2: (2, 4), 3: (2, 4), 4: (1, 4), 5: (1, 4), 6: (0, None), 7: (1, None)}
    assert ngram_join.link_documents(df.limit(0)).collect() == []


def test_chunks_find_the_pairs_of_one_task():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 50).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(40)]
    columns = {"key": np.zeros(40, np.int64), "node": np.arange(40), "label": np.arange(40), "chunk": np.arange(40) % 2, "n": np.array([len(s) for s in sets]), "own": np.zeros(40, np.int64)}
    table = pa.table({**{k: pa.array(v.astype(np.int64)) for k, v in columns.items()}, "parity": pa.array([ngram_join.parity(s) for s in sets], pa.list_(pa.int64()))})
    pairs = set()
    for i, j in ((0, 0), (0, 1), (1, 1)):
        part = table.filter(pa.compute.is_in(table["chunk"], pa.array([i, j]))).append_column("i", pa.array([i] * sum(c in (i, j) for c in columns["chunk"]))).append_column("j", pa.array([j] * sum(c in (i, j) for c in columns["chunk"])))
        pairs |= set(zip(*(c.to_pylist() for c in ngram_join.possible_pairs(part, 60).columns)))
    linked = {(a, b) for a in range(40) for b in range(a + 1, 40) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b]))}
    assert linked and linked <= pairs


def test_shingles_of_bytes():
    texts = ["A b c d e", "", "a b", "é\x1cü x\x0by z w", "a\nb c d"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    begins, ends, firsts = word_spans(data, offsets)
    assert [data[b:e].tobytes() for b, e in zip(begins, ends)] == [w for r in raw for w in WORD.findall(r)]
    values, edges = shingle_sets(word_hashes(data, begins, ends), firsts, 4)
    sets = [set(values[a:b].tolist()) for a, b in zip(edges, edges[1:])]
    assert list(map(len, sets)) == [len(shingles(t, 4)) for t in texts]
    assert len(sets[0] & sets[4]) == 1


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 90, 90: 90, 95: 90}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_first_common_shingle_is_a_key():
    """Any two sets that link share a key, whatever the classes of their shingles."""
    rng = np.random.default_rng(11)
    seen = 0
    for _ in range(400):
        size = int(rng.integers(1, 80))
        base = rng.integers(1, 2**62, size).astype(np.uint64)
        sets = []
        for _ in range(2):
            own = base[rng.random(size) > rng.choice([0, 0.05, 0.1])]
            sets.append(np.unique(np.concatenate([own, rng.integers(1, 2**62, rng.integers(0, 4)).astype(np.uint64)])))
        a, b = sets
        if not len(a) or not len(b) or 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
            continue
        seen += 1
        both, chance = np.intersect1d(a, b), rng.choice([0.0, 0.5, 1.0])
        often = set(both[rng.random(len(both)) < chance].tolist())
        classes = [np.array([2 if x in often else 1 if x in set(both.tolist()) else 0 for x in s.tolist()], np.int8) for s in sets]
        keys = [set(ngram_join.prefix_keys(s, c, 85).tolist()) for s, c in zip(sets, classes)]
        assert keys[0] & keys[1]
    assert seen > 100


@pytest.mark.parametrize("percent", [34, 50, 60, 66, 67, 85])
def test_every_linking_pair_of_frequent_shingles_has_a_common_key(percent):
    hashes = np.sort(np.random.default_rng(4).integers(0, 2**63, 9).astype(np.uint64))
    sets = [c for k in range(1, 8) for c in itertools.combinations(range(9), k)]
    members = [set(c) for c in sets]
    keys = [set(ngram_join.prefix_keys(hashes[list(c)], np.full(len(c), 2), percent).tolist()) for c in sets]
    lost = [
        (sets[a], sets[b])
        for a, b in itertools.combinations(range(len(sets)), 2)
        if 100 * len(members[a] & members[b]) >= percent * len(members[a] | members[b]) and not keys[a] & keys[b]
    ]
    assert lost == []
