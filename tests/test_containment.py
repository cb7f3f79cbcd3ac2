"""The containment search against comparing all with all, and its plan."""

import random

from pyspark.sql import functions as F

from termtide.operators import containment


def plan_of(df):
    return df._jdf.queryExecution().toString()


def brute_force(keywords, entities):
    lowered = {k.lower() for k in keywords if k is not None}
    return {(k, e) for k in lowered for e in entities if len(e) >= 3 and e in k}


def pairs(spark, keywords, entities):
    kw = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    ents = spark.createDataFrame([(e,) for e in entities], "entity string")
    rows = containment.entity_containment(kw, ents).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {tuple(r) for r in rows}


def test_random_texts(spark):
    rng = random.Random(7)
    letters = "abç é"
    keywords = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    entities = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(200)}
    assert pairs(spark, keywords, entities) == brute_force(keywords, entities)


def test_one_beginning_and_one_entity_are_everywhere(spark):
    """A third of the keywords holds one entity, all entities begin alike."""
    entities = ["the" + str(i) for i in range(400)] + ["the hamlet"]
    keywords = [f"see the hamlet {i}" for i in range(1000)] + [f"the{i} the{i + 1}" for i in range(300)] + ["the hamlet"] * 500
    assert pairs(spark, keywords, entities) == brute_force(keywords, entities)


def test_no_pairwise_join_and_no_python(spark, sf):
    from termtide.catalog.keyword_queries import scored

    for conf in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        try:
            plan = plan_of(scored(spark, sf))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert word not in plan, word


def test_longest_entity_is_the_same_with_and_without_broadcast(spark):
    rng = random.Random(3)
    entities = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) for _ in range(60)})
    keywords = ["".join(rng.choice("abcd") for _ in range(12)) for _ in range(400)] + ["abcabc"] * 200
    kw = spark.createDataFrame([(i, k) for i, k in enumerate(keywords)], "i int, keyword string")
    ents = spark.createDataFrame([(e,) for e in entities], "entity string")
    expected = {}
    for i, k in enumerate(keywords):
        hits = sorted((e for e in entities if e in k), key=lambda e: (-len(e), e))
        expected[i] = hits[0] if hits else None
    for conf in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", conf)
        try:
            got = {r.i: r.entity for r in containment.with_longest_entity(kw, ents).select("i", "entity").collect()}
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert got == expected


def test_entity_set_filters_types(spark):
    rows = [("Some Title", "page_title"), ("ab", "author"), ("Head", "heading"), (" PADDED ", "historical_person"), ("q", "question_phrase")]
    got = containment.entity_set(spark.createDataFrame(rows, "term string, term_type string"))
    assert sorted(r.entity for r in got.select(F.col("entity")).collect()) == ["padded", "some title"]
