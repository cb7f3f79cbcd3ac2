"""Quality on held-out labels, and what odd rows give."""

import numpy as np

from termtide.llm import toxicity
from termtide.llm.queries import QUERIES


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op1_factorization_machine_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    good, bad = [r.score for r in held if r.toxic == 0], [r.score for r in held if r.toxic == 1]
    assert np.mean([[(b > g) + (b == g) / 2 for g in good] for b in bad]) > 0.88
    assert sum(r.predicted for r in held if r.toxic == 0) <= 0.02 * len(good)


def test_pairs_are_learnt_where_no_weight_can():
    rng = np.random.default_rng(1)
    first, second = rng.random(4000) < 0.5, rng.random(4000) < 0.5
    labels = (first & second).astype(float)
    rows = [np.flatnonzero([a, not a, b, not b]) for a, b in zip(first, second)]
    text = np.repeat(np.arange(4000), [len(r) for r in rows])
    term = np.concatenate(rows)
    machine = toxicity.fit_machine(text, term, labels, np.arange(1, 5, dtype=np.uint64))
    assert ((machine.scores(text, term, 4000) >= 0.5) == labels).mean() > 0.99


def test_odd_rows(spark):
    texts = [(i, "you idiot" if i % 4 == 0 else "kind words here") for i in range(200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    machine = toxicity.learn(docs, labels, sample_rows=150)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (1, "you IDIOT!", 3), (1, "words " * 50_000, 4), (1, "words " * 50_000, 5)], "doc_id long, text string, Score int")
    out = toxicity.score_texts(odd.withColumnRenamed("Score", "score"), machine)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = [(r.score, r.predicted) for r in out.collect()]
    assert got[0] == got[1] and got[2][1] == 1 and got[3] == got[4] and got[3][1] == 0
    assert toxicity.score_texts(odd.limit(0), machine).collect() == []
    empty = toxicity.learn(docs, labels.limit(0))
    assert {r.predicted for r in toxicity.score_texts(docs, empty).collect()} == {0}
