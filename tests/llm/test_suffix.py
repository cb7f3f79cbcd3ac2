"""Suffix ordering and removal of repeats against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from termtide.llm.suffix_dedup import remove_repeats, window_runs
from termtide.llm.suffix_sort import deep_shallow

LOW = -(2**63)


def brute(rows, length=50):
    first = {}
    for key, text in sorted(((LOW if d is None else d), t or "") for d, t in rows):
        raw = text.encode()
        for i in range(len(raw) - length + 1):
            first.setdefault(raw[i : i + length], key)
    out = []
    for d, text in rows:
        raw, key = (text or "").encode(), LOW if d is None else d
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < key:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, **more):
    done = remove_repeats(df, **more)
    return sorted([tuple(r) for r in done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()], key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"ab", b"abab" * 9, b"c", b"the same words again and again", b"x" * 40]), min_size=1, max_size=30), st.integers(17, 60))
def test_order_is_that_of_the_strings(parts, depth):
    data = np.frombuffer(b"".join(parts) + b"z" * depth, np.uint8)
    starts = np.arange(len(data) - depth + 1)
    order, new = deep_shallow(data, starts, depth)
    raw = data.tobytes()
    strings = [raw[i : i + depth] for i in starts[order]]
    assert strings == sorted(strings) and sorted(order) == list(starts)
    assert [bool(x) for x in new] == [i == 0 or strings[i] != strings[i - 1] for i in range(len(strings))]


def test_runs_cover_every_window_once():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 101, 3000, dtype=np.uint8)
    offsets = np.array([0, 0, 49, 99, 100, 1500, 3000])
    begins, sizes, _, row = window_runs(data, offsets, 50)
    covered = sorted(p for b, s in zip(begins, sizes) for p in range(b, b + s))
    assert covered == [p for a, b in zip(offsets, offsets[1:]) for p in range(a, b - 49)]
    assert all(offsets[r] <= b and b + s + 49 <= offsets[r + 1] for b, s, r in zip(begins, sizes, row))


def test_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    assert found(df) == brute([tuple(r) for r in df.collect()])


@pytest.mark.parametrize("hot_rows", [1, 20_000])
def test_cases(spark, hot_rows):
    passage = "This passage of well over fifty bytes stands in many of the rows, été comme hiver. "
    rows = [(1, None), (2, ""), (None, passage * 2), (3, passage), (3, passage), (4, "ab" * 200), (5, "ab" * 150), (6, "a" * 30 + passage + "b" * 70), (7, "short"), (8, "b" * 70)]
    rows += [(10 + i, f"row {i} says {passage[i:]} and ends {i * 7919}") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, hot_rows=hot_rows) == brute(rows)


def test_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "x" * 60, 5, "a"), (2, "x" * 60, None, None)], "doc_id long, text string, N_removed int, block string")
    out = remove_repeats(df)
    assert out.columns[:3] == ["doc_id", "text", "block"]
    assert {r.doc_id: (r.n_removed, bytes(r.kept), list(r.spans), r.block) for r in out.collect()} == {1: (0, b"x" * 60, [], "a"), 2: (60, b"", [0, 60], None)}
    assert remove_repeats(df.limit(0)).collect() == []
