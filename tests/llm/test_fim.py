"""The learned index against its sequence, rewriting against the rule in plain Python, odd rows."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from termtide.llm import fim
from termtide.llm.rank_index import BOUND, fit


def plainly(id_, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digits = hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(digits[i : i + 8], 16) for i in (0, 8, 16, 24)]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return (n, "plain", None, None, sha(text), sha(text), text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm_rate else "psm"
    out = f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"
    return (n, form, len(p), len(m), sha(out), sha(text), out)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5_000), max_size=60), min_size=1, max_size=8), st.sampled_from([0, 1, 16, BOUND]))
def test_index_is_exact_and_bounded(steps, bound):
    sequences = [np.cumsum([0, *s]) for s in steps]
    values = np.concatenate(sequences)
    starts = np.cumsum([0, *map(len, sequences)])[:-1]
    index = fit(values, starts, bound)
    ranks = np.arange(len(values))
    assert (index.values(ranks) == values).all()
    assert np.abs(index.predict(ranks) - values).max() <= bound
    assert set(starts.tolist()) <= set(index.firsts.tolist())


def test_index_is_small_where_lines_are_alike():
    rng = np.random.default_rng(0)
    values = np.cumsum(rng.integers(78, 83, 100_000))
    index = fit(values, np.array([0]))
    assert len(index.firsts) < 3_000 and index.residuals.nbytes == 100_000
    with pytest.raises(ValueError):
        fit(values, np.array([0]), 128)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 10**12), st.text(alphabet="ab\n\rж😀<PSM>", max_size=40)), min_size=1, max_size=12))
def test_rewriting_is_the_rule(rows):
    raw = [t.encode() for _, t in rows]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    got = fim.rewrite_slice(data, offsets, [str(i) for i, _ in rows], 7, 100, 50)
    for (id_, text), row in zip(rows, got):
        want = plainly(id_, text)
        assert (*row[:6], row[6].decode()) == want
        assert fim.restored(row[1], row[6]).decode() == text


def test_rates():
    raw = "one\ntwo\nthree".encode()
    data = np.frombuffer(raw * 200, np.uint8)
    offsets = np.arange(201) * len(raw)
    ids = [str(i) for i in range(200)]
    assert {r[1] for r in fim.rewrite_slice(data, offsets, ids, 7, 0, 50)} == {"plain"}
    assert {r[1] for r in fim.rewrite_slice(data, offsets, ids, 7, 100, 0)} == {"psm"}
    some = [r[1] for r in fim.rewrite_slice(data, offsets, ids, 7, 60, 100)]
    assert {*some} == {"plain", "spm"} and 80 < some.count("spm") < 160


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no newline"), (None, "a\nb"), (6, "x <M> y\nz"), (7, "жж\n😀\nend"), (7, "жж\n😀\nend"), (7, "other\n"), (8, "long line " * 200_000 + "\nand one"), (9, "\n".join(map(str, range(50_000))))]
    docs = spark.createDataFrame([(*r, "f", 1) for r in rows], "doc_id long, text string, FORM string, n2 int")
    out = fim.rewrite(docs)
    assert out.columns == ["doc_id", "text", "n2", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output"]
    got = [(r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256, r.output) for r in out.collect()]
    assert got == [plainly(i, t) for i, t in rows]
    assert fim.rewrite(docs.limit(0)).collect() == []
