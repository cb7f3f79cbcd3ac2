"""The merge when one keyword has a third of all rows, against a plain Python grouping."""

import random
import re

from termtide.operators import merge


def test_hot_keyword(spark):
    rng = random.Random(11)
    rows = []
    for i in range(6000):
        spelling = rng.choice(("Hot Ring!", "hot  ring", " HOT RING ")) if i % 3 == 0 else f"kw {rng.randint(0, 200)}"
        rows.append((i, spelling, f"t{rng.randint(0, 40)}", rng.choice("ab"), rng.choice((1, None)), rng.choice(("en", None)),
                     rng.choice((None, rng.randint(0, 99))), rng.choice((None, rng.random())), None, rng.choice((None, "LOW", "HIGH")), None, ""))
    ddl = ("ord bigint, keyword string, source_term string, source_endpoint string, location_code int, language_code string, search_volume bigint, "
           "cpc double, competition double, competition_level string, keyword_difficulty double, categories string")
    got = merge.merge_discovered(spark.createDataFrame(rows, ddl).repartition(8), "ord").collect()
    groups = {}
    for r in sorted(rows):
        norm = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", " ", r[1].lower())).strip()
        groups.setdefault((norm, r[4], r[5]), []).append(r)

    def largest(members, i):
        return max((m[i] for m in members if m[i] is not None), default=None)

    expected = {
        key: (members[0][1], largest(members, 6), largest(members, 7), next((m[9] for m in members if m[9]), None),
              "|".join(sorted({m[2] for m in members})), "|".join(sorted({m[3] for m in members})))
        for key, members in groups.items()
    }
    found = {(r.keyword_normalized, r.location_code, r.language_code): (r.keyword, r.search_volume, r.cpc, r.competition_level, r.source_terms, r.source_endpoints) for r in got}
    assert found == expected and len(got) == len(expected)
