"""What a log and a task hold must not grow faster than the input."""

import gzip
import json
import random
import re
import time
from collections import Counter
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from termtide import session
from termtide.catalog import fixtures, response_queries
from termtide.config import LANGUAGES
from termtide.operators import responses, terms
from termtide.plans import stages
from termtide.schemas import CALL_ENVELOPE, SERP_ENVELOPE
from termtide.sources import raw as raw_io, tables
from termtide.streaming import intake


def line(keyword, day):
    return json.dumps({
        "endpoint": "/v3/labs/keyword_ideas/live", "request": [{"keyword": keyword}], "collected_at": f"2024-06-{day:02d}T00:00:00Z",
        "response": {"status_code": 20000, "tasks": [{"status_code": 20000, "result": [{"items": [{"keyword": f"{keyword} {i}"} for i in range(50)]}]}]},
    })


def planned(df, capsys):
    capsys.readouterr()
    df.explain(True)
    text = capsys.readouterr().out
    return text[text.index("== Optimized Logical Plan =="):text.index("== Physical Plan ==")]


def test_log_is_compressed_and_read_back(spark, tmp_path):
    lines = [line(f"k{i}", i % 3 + 1) for i in range(300)]
    raw = raw_io.parse_raw(spark.createDataFrame([(v,) for v in lines], "value string"))
    folder = str(tmp_path / "log")
    for _ in range(2):
        raw_io.append_raw(raw, folder)
    size = sum(p.stat().st_size for p in Path(folder).rglob("part-*"))
    assert 5 * size < 2 * sum(map(len, lines))
    back = raw_io.read_raw(spark, folder).select(F.col("request")[0]["keyword"].alias("k"), F.size(F.col("response.tasks")[0]["result"][0]["items"]).alias("n"))
    assert sorted((r.k, r.n) for r in back.collect()) == sorted((f"k{i}", 50) for i in range(300) for _ in range(2))


def test_parts_follow_the_size_of_the_files(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).coalesce(1).write.parquet(path)
    size = sum(p.stat().st_size for p in Path(path).glob("*.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread_few_files(spark.read.parquet(path)).rdd.getNumPartitions() == cores
    monkeypatch.setattr(tables, "PART_BYTES", size // 40)
    dealt = tables.spread_few_files(spark.read.parquet(path))
    assert dealt.rdd.getNumPartitions() in (40, 41) and dealt.count() == 20000


def test_blank_lines_drop_out_and_lines_are_made_once(spark, capsys):
    rows = spark.createDataFrame([("a",), ("",), (None,), ("  ",), ("b",)], "k string")
    made = F.when(F.trim("k") != "", F.to_json(F.struct(F.concat(F.lit("/v3/"), "k").alias("endpoint")))).otherwise(F.col("k"))
    raw = raw_io.parse_raw(rows.select(made.alias("value")))
    assert sorted(r.endpoint for r in raw.collect()) == ["/v3/a", "/v3/b"]
    assert planned(raw, capsys).count("StructsToJson") == 1


def test_narrow_rows_are_collected(spark, sf, capsys):
    plan = planned(response_queries.discovery_log(spark, sf), capsys)
    collected = re.findall(r"collect_list\((.*?), 0, 0\)", plan)
    assert collected and not any("keyword_properties" in c for c in collected)


def test_stopwords_are_judged_by_word(spark, capsys):
    rows = [("The cat of the house sat", "en"), ("the cat of the house ran", "en"), ("Кот и пёс the end", "ru"), ("кот и пёс the end", "ru-RU"), (None, "en"), ("one", None)]
    found = terms.repeated_phrases(spark.createDataFrame(rows, "t string, lang string"), "t", "lang", sizes=(1, 2, 3, 4))
    got = {r.term: r.doc_count for r in found.collect()}
    assert got == {
        "the": 4, "cat": 2, "of": 2, "house": 2, "кот": 2, "и": 2, "пёс": 2, "end": 2,
        "cat of the house": 2, "кот и пёс": 2, "пёс the": 2, "the end": 2, "пёс the end": 2, "кот и пёс the": 2,
    }
    assert "RLIKE" not in planned(found, capsys).upper()


def event_tables(spark, folder):
    """Events of a few users, some in two runs, and parts of which one has no name."""
    kinds = ["purchase", "error", "view", "click", "signup"]
    events = [(i * 37, datetime(2024, 1, 1 + i % 9, 3, 4, 5, 678), i * 7 % 11 or None, kinds[i * 3 % 5]) for i in range(80)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string").write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(0, "red ring"), (1, None), (2, "tin bolt")], "p_partkey bigint, p_name string").write.parquet(f"{folder}/part.parquet")
    return folder


def test_result_pages_go_into_a_log_as_they_are(spark, tmp_path, capsys):
    sf = event_tables(spark, str(tmp_path))
    pages, parsed = response_queries.serp_pages(spark, sf), response_queries.serp_raw(spark, sf)
    assert "JsonToStructs" not in planned(pages, capsys) and "from_json" not in planned(pages, capsys)
    logs = []
    for name, rows in (("direct", pages), ("parsed", parsed)):
        raw_io.append_raw(rows, f"{tmp_path}/{name}")
        found = Path(f"{tmp_path}/{name}").rglob("part-*")
        logs.append(sorted((p.parent.name, v) for p in found for v in gzip.open(p, "rt").read().splitlines()))
    assert logs[0] == logs[1] and len(logs[0]) > 20


def test_result_pages_are_read_by_the_fields_that_they_need(spark, tmp_path, monkeypatch):
    log, master = f"{tmp_path}/log", f"{tmp_path}/master"
    lines = [
        {"endpoint": "/v3/serp/organic/live/advanced", "request": [{"keyword": f"k{i % 3}", "depth": 10}], "collected_at": f"2024-01-0{i % 4 + 1}T00:00:00Z",
         "response": {"status_code": 40000 if i == 5 else 20000, "tasks": [{"status_code": 20000, "status_message": "Ok", "result": [{"keyword": "k", "items": [
             {"type": ("video", "organic", "")[(i + j) % 3], "domain": f"d{j}.example", "keyword_info": {"cpc": 1.5}} for j in range(i)] or None}, None]}]}}
        for i in range(9)
    ]
    odd = [{"endpoint": "/v3/serp/organic/live", "collected_at": "2024-01-01T00:00:00Z"}, {"endpoint": "/v3/serp/organic/live", "request": [{"keyword": "k0"}]}]
    raw_io.append_raw(raw_io.parse_raw(spark.createDataFrame([(json.dumps(v),) for v in lines + odd], "value string")), log)
    Path(f"{tmp_path}/old-20240105.jsonl").write_text(json.dumps({**lines[4], "collected_at": None}) + "\n")
    for path in (log, str(tmp_path)):
        wide = responses.flatten_serp(raw_io.read_raw(spark, path, logs=["organic"]))
        narrow = responses.flatten_serp(raw_io.read_raw(spark, path, logs=["organic"], shape=SERP_ENVELOPE))
        assert wide.schema == narrow.schema and sorted(map(str, wide.collect())) == sorted(map(str, narrow.collect()))
    assert narrow.count() >= 1 and raw_io.read_raw(spark, f"{tmp_path}/none", shape=SERP_ENVELOPE).count() == 0
    shapes, read = [], raw_io.read_raw
    monkeypatch.setattr(raw_io, "read_raw", lambda *a, **k: shapes.append(k.get("shape")) or read(*a, **k))
    taken, flatten = [], responses.flatten_serp
    monkeypatch.setattr(responses, "flatten_serp", lambda raw: taken.extend(raw.select("request.keyword").distinct().collect()) or flatten(raw))
    scored = [(f"k{i}", f"k{i}", 1, "en", 1.0 - i / 10, True, 5.0, 0.0) for i in range(4)]
    columns = "keyword string, keyword_normalized string, location_code int, language_code string, opportunity_score double, passes_filters boolean, search_volume double, competition double"
    stages.write_version(spark.createDataFrame(scored, columns), master)
    rows = {r.keyword: r.serp_features for r in stages.refresh_serp(spark, master, log, 2).collect()}
    assert shapes == [SERP_ENVELOPE] and rows["k2"] is None and rows["k3"] is None and rows["k1"] == "organic|video"
    # items of other keywords' pages are not looked at
    assert sorted(r.keyword for r in taken) == [["k0"], ["k1"]]


def test_normal_forms_are_made_per_spelling(spark, sf, capsys):
    plan = planned(fixtures.metrics(spark, sf), capsys)
    # the grouping that reads the rows goes by the spelling itself
    assert re.search(r"Aggregate \[keyword#\d+, location_code#\d+, language_code#\d+\], \[[^\n]*sum\(l_quantity", plan)
    assert "regexp_replace" in plan


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def given_back(spark, before):
    """Whether no shuffle files are left but those before; they go a moment after the job."""
    until = time.time() + 20
    while not shuffle_files(spark) <= before and time.time() < until:
        time.sleep(0.2)
    return shuffle_files(spark) <= before


def test_append_gives_back_what_moved_its_lines(spark, tmp_path, capsys):
    raw = raw_io.parse_raw(spark.createDataFrame([(line(f"k{i % 7}", i % 3 + 1),) for i in range(60)], "value string"))
    before = shuffle_files(spark)
    raw_io.append_raw(raw, str(tmp_path / "log"))
    assert given_back(spark, before)
    # lines are moved, not envelopes
    made = raw_io.logged_lines(raw)
    assert made.columns == ["value", "log", "dt", "collected_at"] and dict(made.dtypes)["value"] == "string"
    again = [v for v in Path(tmp_path / "log").rglob("part-*")]
    assert sum(len(gzip.open(p, "rt").read().splitlines()) for p in again) == 60
    for p in again:
        found = gzip.open(p, "rt").read().splitlines()
        assert found == sorted(found) and all(json.loads(v)["collected_at"][:10].replace("-", "") == p.parent.name[3:] for v in found)


def test_a_passing_stage_goes_with_its_block(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.count("*").alias("n"))
    with session.passing_stage(rows, "t") as kept:
        path = Path(kept.inputFiles()[0].removeprefix("file:")).parent
        assert given_back(spark, before) and path.exists()
        assert kept.columns == rows.columns and sum(r.n for r in kept.collect()) == 1000
    assert not path.exists()
    try:
        with session.passing_stage(rows, "t") as kept:
            path = Path(kept.inputFiles()[0].removeprefix("file:")).parent
            raise KeyError
    except KeyError:
        assert not path.exists()


def line_tables(spark, folder):
    """Line items of odd names: quotes, and the very text that an empty list of items has."""
    brands, names = ['Brand#12 "items":[]', "Brand#3", "Brand#25", None], ['a "b" \\ c', '{"items":[]}', "tin\nbolt", None]
    parts = [(i, names[i % 4], brands[i // 4], "LARGE" if i % 3 else None, i * 7 if i % 5 else None) for i in range(16)]
    spark.createDataFrame(parts, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(0, 24), (1, 3), (2, None)], "s_suppkey bigint, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    lines = [
        (i % 9 * 400, i % 17, i % 3, i % 4, float(i % 5) if i % 11 else None, 1.0, i % 7 / 100, i % 3 / 100, "ANR"[i % 3], "O", datetime(2024, 1 + i % 12, 2))
        for i in range(300)
    ]
    columns = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
               "l_returnflag string, l_linestatus string, l_shipdate timestamp")
    spark.createDataFrame(lines, columns).write.parquet(f"{folder}/lineitem.parquet")
    return folder


def test_items_are_collected_as_the_text_of_their_line(spark, tmp_path, capsys):
    sf = line_tables(spark, str(tmp_path))
    log = response_queries.discovery_log(spark, sf)
    assert re.findall(r"collect_list\(item#\d+, 0, 0\)", planned(log, capsys))
    rows = fixtures.disc(spark, sf).collect()
    got = [json.loads(r.value) for r in log.collect()]
    results = [t["result"][0]["items"] for g in got for t in g["response"]["tasks"] if "result" in t]
    plain = [i.get("keyword") or i.get("keyword_data", {}).get("keyword") for items in results for i in items]
    assert len(rows) > 250 and sum(len(r) for r in results) > 100 and any('"items":[]' in (k or "") for k in plain)
    assert any('"items":[]' in g["request"][0].get("keyword", "") for g in got)
    # flattened, the rows come back whatever their texts are
    flat = responses.discovered(raw_io.parse_raw(log)).collect()
    key = lambda x: (x.keyword, x.source_endpoint, x.location_code, x.cpc, x.search_volume, x.competition, x.competition_level)
    assert len(flat) > 50 and not Counter(map(key, flat)) - Counter(map(key, rows))


def test_a_log_appended_twice_leaves_no_lines_beside_it(spark, tmp_path):
    sf, folder = line_tables(spark, str(tmp_path)), Path(session.shared_folder(spark).removeprefix("file:")) / "termtide"
    before, files = set(folder.glob("*")) if folder.exists() else set(), shuffle_files(spark)
    log = response_queries._logged(spark, sf, times=2)
    assert [p.name for p in set(folder.glob("*")) - before] == [log.rsplit("/", 1)[-1]] and given_back(spark, files)
    assert raw_io.read_raw(spark, log).count() == 2 * response_queries.discovery_log(spark, sf).count()


def test_a_stream_takes_in_a_log_with_nothing_left_of_its_making(spark, tmp_path):
    sf, folder = line_tables(spark, str(tmp_path)), Path(session.shared_folder(spark).removeprefix("file:")) / "termtide"
    events = [(i * 37, datetime(2024, 1, 1 + i % 9), i % 11, "view") for i in range(50)]
    spark.createDataFrame(events, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string").write.parquet(f"{sf}/events.parquet")
    before, files = set(folder.glob("*")), shuffle_files(spark)
    rows = response_queries.stream_intake(spark, sf)
    made = {p.name.split("-")[0] for p in set(folder.glob("*")) - before}
    assert made == {"discovered", "stream", "log"} and given_back(spark, files)
    wanted = responses.discovered(response_queries.discovery_raw(spark, sf)).drop("collected_at")
    assert rows.count() > 50 and sorted(map(str, rows.collect())) == sorted(map(str, wanted.collect()))


def brute_phrases(rows, sizes, min_docs):
    found = Counter()
    for text, lang in rows:
        stops = LANGUAGES["ru" if (lang or "")[:2] == "ru" else "en"].stopwords
        words = re.findall(r"[\w'’]+", (text or "").lower())
        ends = lambda w: len(w) == 1 or not (w[0] in stops or w[-1] in stops)
        found.update({" ".join(words[i : i + n]) for n in sizes for i in range(len(words) - n + 1) if ends(words[i : i + n])})
    return {k: v for k, v in found.items() if v >= min_docs}


def test_phrases_of_one_beginning_are_sent_as_one_row(spark, capsys):
    draw = random.Random(5)
    vocabulary = ["the", "of", "a", "cat", "cats", "ca", "house", "o'neil", "’x", "1984", "_", "кот", "и", "пёс", "é", "𐐷x"]
    rows = [(draw.choice([" ", ", ", "\n"]).join(draw.choices(vocabulary, k=draw.randrange(40))), draw.choice(["en", "ru", "ru-RU", "fr", None])) for _ in range(150)]
    rows += [("cat " * 30, "en"), ("cat", "en"), ("", "en"), (None, None), *rows[:20]]
    df = spark.createDataFrame(rows, "t string, lang string").repartition(3)
    for sizes, min_docs, parts in (((2, 3, 4), 2, None), ((4, 2), 3, 7), ((3,), 1, 2), ((1, 3, 2), 2, 5)):
        found = terms.repeated_phrases(df, "t", "lang", sizes=sizes, min_docs=min_docs, parts=parts)
        got = found.collect()
        assert len({r.term for r in got}) == len(got) > 20
        assert {r.term: r.doc_count for r in got} == brute_phrases(rows, sizes, min_docs)
    found = terms.repeated_phrases(df, "t", "lang", parts=5)
    text = found._jdf.queryExecution().executedPlan().toString()
    # rows meet once, by what the shortest phrase is; a beginning is one row, not one for each size
    assert re.findall(r"Exchange hashpartitioning\((\w+)#", text) == ["_head"]


def test_a_log_is_read_with_its_lines(spark, tmp_path):
    """The same envelopes as without, and the text that each was parsed from; a stream does as a table does."""
    log = str(tmp_path / "log")
    lines = [line(f"k{i % 4}", i % 3 + 1) for i in range(12)]
    raw_io.append_raw(raw_io.parse_raw(spark.createDataFrame([(v,) for v in lines], "value string")), log)
    odd = ['{"endpoint": "/v3/serp/organic/live", "request": [{"keyword": "k"}], "more": 1}', "", "  ", "not json", '{"request": 5, "endpoint": "/v3/x/live"}']
    Path(f"{log}/old-20240105.jsonl").write_text("\n".join(odd) + "\n")
    for path, some in ((log, {}), (log, {"logs": ["keyword_ideas"], "days": ["20240602"]}), (f"{log}/old-20240105.jsonl", {}), (f"{tmp_path}/none", {})):
        plain, with_line = raw_io.read_raw(spark, path, **some), raw_io.read_raw(spark, path, line=True, **some)
        assert sorted(with_line.columns) == sorted([*plain.columns, "line"])
        assert sorted(map(str, plain.collect())) == sorted(map(str, with_line.select(*plain.columns).collect()))
    rows = raw_io.read_raw(spark, log, shape=CALL_ENVELOPE, line=True)
    assert "response" not in rows.columns and rows.count() == 15
    assert all(json.loads(r.line)["request"][0]["keyword"] == r.request[0].keyword for r in rows.where("dt like '202406%'").collect())
    sink, checkpoint = str(tmp_path / "sink"), str(tmp_path / "cp")
    intake.run_available(raw_io.stream_raw(spark, log, shape=CALL_ENVELOPE, line=True), sink, checkpoint)
    assert sorted(map(str, spark.read.schema(rows.schema).parquet(sink).collect())) == sorted(map(str, rows.collect()))


def test_kept_responses_are_told_by_their_lines(spark, tmp_path, capsys):
    """One response for each key, the earliest, of equally early ones the same whatever came first; nothing of the response is parsed."""
    calls = [line("k", 3), line("k", 2), line("k", 2).replace("k 7", "other"), line("k", 2), line("q", 4), json.dumps({"endpoint": "/v3/labs/keyword_ideas/live", "request": [{"keyword": "t"}]})]
    found = []
    for order in (calls, calls[::-1]):
        log, sink, checkpoint = (session.new_folder(spark, n) for n in ("log", "sink", "cp"))
        for call in order:
            raw_io.append_raw(raw_io.parse_raw(spark.createDataFrame([(call,)], "value string")), log)
            intake.dedupe_available(intake.stream_raw(spark, log, shape=CALL_ENVELOPE, line=True), sink, checkpoint)
        raw = raw_io.read_raw(spark, log, shape=CALL_ENVELOPE, line=True)
        kept = intake.kept_responses(raw, intake.kept_keys(spark, sink))
        assert kept.columns == [*raw.columns, *[c for c in intake.REUSE_COLUMNS if c not in raw.columns]]
        found.append(sorted((r.subject, r.bucket, str(r.collected_at), r.line) for r in kept.collect()))
    assert found[0] == found[1] and [(s, b, t[:10]) for s, b, t, _ in found[0][:2]] == [("k", "2024-06", "2024-06-02"), ("q", "2024-06", "2024-06-04")]
    wide = raw_io.read_raw(spark, log)
    whole = intake.kept_responses(wide, intake.kept_keys(spark, sink))
    assert whole.columns == [*wide.columns, *[c for c in intake.REUSE_COLUMNS if c not in wide.columns]]


def test_the_deduped_log_is_read_by_its_calls(spark, tmp_path, monkeypatch):
    sf, read, taken = line_tables(spark, str(tmp_path)), raw_io.read_raw, []
    monkeypatch.setattr(raw_io, "read_raw", lambda *a, **k: taken.append(k) or read(*a, **k))
    rows = response_queries.stream_dedupe(spark, sf).collect()
    assert len({tuple(r)[:5] for r in rows}) == len(rows) > 10 and {r.responses for r in rows} == {1}
    assert taken == [{"shape": CALL_ENVELOPE, "line": True}]
