"""Edit matches against dynamic programming."""

import random

import pytest

from termtide.llm import decontaminate as dc
from termtide.llm.queries import QUERIES


def distance(item, text):
    before = list(range(len(item) + 1))
    best = before[-1]
    for letter in text:
        row = [0]
        for j, other in enumerate(item, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (other != letter)))
        best, before = min(best, row[-1]), row
    return best


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.25])
def test_every_match_within_budget(rate):
    rng = random.Random(4)
    hits = 0
    for _ in range(300):
        item = dc.normal("".join(rng.choice("abc ") for _ in range(rng.randint(1, 70)))) or "a"
        letters = list(item)
        for _ in range(rng.randint(0, 9)):
            i, kind = rng.randrange(len(letters) + 1), rng.random()
            letters[i : i + (kind > 0.4)] = [] if kind > 0.7 else ["b"]
        text = dc.normal("".join(rng.choice("abcd ") for _ in range(40)) + "".join(letters) + "".join(rng.choice("abcd ") for _ in range(40)))
        found = dc.Items([(7, item), (8, "zzzzzzzzzz")], rate).matches(text)
        least = distance(item, text)
        assert found == {} if least > int(len(item) * rate) else found[7][0] == least
        hits += bool(found)
    assert hits > 20


def test_tables(spark, sf):
    docs = {r.doc_id: dc.normal(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [(r.item_id, dc.normal(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_pigeonhole_decontamination"](spark, sf).collect()}
    assert {(d, i) for d, text in docs.items() for i, item in items if item in text} <= got


def test_odd_rows(spark):
    item = "The quick brown fox jumps over the lazy dog today"
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "b"), (2, f"So THE quick  brown fix jumps\nover the lazy dog today.", "c"), (2, f"x {item}", "d"), (None, item, "e"), (3, "clean text " * 5000, "f")], "doc_id long, text string, doc string")
    items = spark.createDataFrame([(10, item), (10, item.upper()), (11, None), (12, ""), (None, "lazy dog today")], "item_id long, text string")
    got = sorted([tuple(r)[:3] for r in dc.find_leaks(docs, items, block_bytes=40).collect()], key=str)
    # the one-item blocks of equal ids report each on their own
    assert set(got) == {(2, 10, 1), (2, 10, 0), (None, 10, 0), (2, None, 0), (None, None, 0)}
    assert sorted(r.doc for r in dc.without_leaks(docs, items).collect()) == ["a", "b", "f"]
    assert dc.without_leaks(docs, items).columns == docs.columns
    assert dc.find_leaks(docs, items.limit(0)).collect() == [] and dc.find_leaks(docs.limit(0), items).collect() == []
