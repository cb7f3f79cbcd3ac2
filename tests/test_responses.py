"""Nested responses: edge cases of shapes, statuses and missing parts; files and streams."""

import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from termtide.operators import enrich, planning, responses
from termtide.schemas import CANDIDATES, DISCOVERED, ENTITIES, METRICS
from termtide.session import new_folder
from termtide.sources import raw as raw_io, tables
from termtide.streaming import intake


def envelope(endpoint, request, tasks, status=20000, at="2024-05-06T01:02:03Z"):
    return json.dumps({"endpoint": f"/v3/x/{endpoint}/live", "request": [request], "response": {"status_code": status, "tasks": tasks}, "collected_at": at})


def parsed(spark, *lines):
    return raw_io.parse_raw(spark.createDataFrame([(line,) for line in lines], "value string"))


MARKET = {"location_code": 2840, "language_code": "en"}


def test_discovery_shapes(spark):
    info = {"search_volume": 10, "cpc": 0.5, "competition": 0.25, "competition_level": "LOW", "categories": [11, 12]}
    items = [
        {"keyword": "own", "keyword_info": info, "keyword_properties": {"keyword_difficulty": 7}},
        {"keyword_data": {"keyword": "nested", "keyword_info": info, "keyword_properties": {"keyword_difficulty": 8}}},
        {"keyword": "both", "keyword_data": {"keyword": "other", "keyword_info": {"search_volume": 3}}, "keyword_info": info},
        {"keyword": "empty", "keyword_data": {}, "keyword_info": info},
        {"keyword": "bare", "keyword_info": None, "search_volume": 99},
        {"keyword": "", "keyword_info": info}, {"keyword_info": info}, None,
    ]
    raw = parsed(
        spark,
        envelope("keyword_suggestions", {"keyword": "seed", **MARKET}, [
            {"status_code": 20000, "result": [{"items": items}, {"items": None}, {}]},
            {"status_code": 40501, "result": [{"items": [{"keyword": "bad task"}]}]},
            {"result": [{"items": [{"keyword": "no status"}]}]}, {"status_code": 20000, "result": None},
        ]),
        envelope("keyword_ideas", {"keywords": ["a", "b"], **MARKET}, [{"result": [{"items": [{"keyword": "idea"}]}]}]),
        envelope("keywords_for_site", {"target": "t.example", **MARKET}, [{"result": [{"items": [
            {"keyword": "inline", "search_volume": 5, "competition": "HIGH", "keyword_info": {}}, {"keyword": "info", "keyword_info": info, "search_volume": 1}]}]}]),
        envelope("related_keywords", {"keyword": "seed"}, [{"result": [{"items": [{"keyword": "bad response"}]}]}], status=40000),
        envelope("related_keywords", {"keyword": "seed"}, None),
        "", "   ",
    )
    out = {r.keyword: r for r in responses.discovered(raw).collect()}
    assert set(out) == {"own", "nested", "both", "empty", "bare", "no status", "idea", "inline", "info"}
    assert (out["own"].search_volume, out["own"].categories, out["own"].keyword_difficulty, out["own"].competition) == (10, "11|12", 7.0, 0.25)
    assert out["nested"].keyword_difficulty == 8.0 and out["both"].search_volume == 3 and out["empty"].search_volume == 10
    assert out["bare"].search_volume is None and out["idea"].source_term == "<batch>"
    assert (out["inline"].search_volume, out["inline"].competition, out["inline"].source_term) == (5, None, "site:t.example")
    assert out["info"].search_volume == 10 and out["own"].location_code == 2840
    assert responses.flatten_labs(raw).count() == 7 and responses.flatten_site(raw).count() == 2
    assert responses.discovered(raw).columns == DISCOVERED.fieldNames()


def test_volume_shapes(spark):
    months = [{"year": 2024, "month": m, "search_volume": v} for m, v in ((1, 10), (3, None), (4, 20), (2, 10))]
    raw = parsed(
        spark,
        envelope("search_volume", {"keywords": ["a"], **MARKET}, [{"result": [
            {"items": [{"keyword": "listed", "monthly_searches": months, "competition": "HIGH", "competition_index": 90}, {"keyword": ""}, {}]},
            {"keyword": "itself", "search_volume": 4, "monthly_searches": None}, {"keyword": None}]}]),
    )
    rows = responses.flatten_volume(raw)
    out = {r.keyword: r for r in rows.collect()}
    assert rows.columns == METRICS.fieldNames() and set(out) == {"listed", "itself"}
    listed = out["listed"]
    assert (listed.latest_month_searches, listed.trend_3m, listed.trend_12m, listed.competition) == (20, 1.0, None, None)
    assert [m.month for m in listed.monthly_searches] == [4, 3, 2, 1] and out["itself"].monthly_searches == []


def test_result_pages(spark):
    def page(*items):
        return [{"result": [{"items": list(items)}, {"items": None}]}]

    organic = [{"type": "organic", "domain": f"d{i}"} for i in (1, 2, 2, 3, 4, 5)]
    raw = parsed(
        spark,
        envelope("organic", {"keyword": "k1"}, page(*organic, {"type": "video"}, {"type": None}, {"type": "organic"})),
        envelope("organic", {"keyword": "k2"}, page({"type": "people_also_ask"}, {"type": "paid"})),
        envelope("organic", {"keyword": "k3"}, None), envelope("organic", {"keyword": "k4"}, page({"type": "map"})),
    )
    out = {r.keyword: (r.serp_intent, r.serp_features, r.serp_top_domains) for r in responses.flatten_serp(raw).collect()}
    assert out == {
        "k1": ("video", "organic|video", "d1|d2|d2|d3|d4"), "k2": ("commercial", "paid|people_also_ask", ""),
        "k3": ("navigational_or_mixed", "", ""), "k4": ("local", "map", ""),
    }


def test_interest(spark):
    data = [{"values": [1, 5]}, {"values": [None, 7]}, {"values": [3, None]}, {"values": []}, {"values": None}, {"values": [4]}]
    graph = {"type": "google_trends_graph", "keywords": ["Aa", "BB"], "data": data}
    raw = parsed(spark, envelope("google_trends/explore", {"keywords": ["aa", "bb", "cc"]}, [{"result": [{"items": [
        {"type": "other", "data": data}, {"type": "google_trends_graph", "data": []}, graph]}]}]),
        envelope("google_trends/explore", {"keywords": ["none"]}, [{"result": None}]))
    out = {r.keyword: r["values"] for r in responses.interest_series(raw).collect()}
    # a missing value takes the point's first one
    assert out == {"aa": [1.0, 3.0, 4.0], "bb": [5.0, 7.0, 3.0, 4.0], "cc": [1.0, 3.0, 4.0], "none": []}
    row = {r.keyword: r for r in responses.trend_table(raw).collect()}["none"]
    assert (row.trend_interest_latest, row.trend_direction, row.trend_slope) == (None, None, None)


def test_attach_replaces_and_never_multiplies(spark):
    master = spark.createDataFrame(
        [("a", 1, "old", "x"), ("a", 2, "old", "y"), (None, 3, "old", "z")], "keyword string, location_code int, serp_intent string, serp_checked_at string"
    )
    serp = spark.createDataFrame(
        [("a", "video", "f1", "d", "2024-01-01"), ("a", "local", "f2", "e", "2024-02-01")],
        "keyword string, serp_intent string, serp_features string, serp_top_domains string, serp_checked_at string",
    )
    rows = enrich.attach_serp(master, serp).orderBy("location_code").collect()
    assert [(r.keyword, r.serp_intent, r.serp_checked_at) for r in rows] == [("a", "local", "2024-02-01"), ("a", "local", "2024-02-01"), (None, None, None)]


def test_raw_log_files(spark):
    folder = new_folder(spark, "t")
    assert raw_io.read_raw(spark, folder).count() == 0
    raw = parsed(spark, envelope("keyword_ideas", {"keywords": ["ü"]}, [{"result": []}]), envelope("explore", {"keyword": "q"}, None, at="2024-06-07T00:00:00Z"))
    raw_io.append_raw(raw, folder)
    raw_io.append_raw(raw, folder)
    back = raw_io.read_raw(spark, folder)
    assert back.count() == 4 and back.drop("log", "dt").exceptAll(raw.unionByName(raw)).count() == 0
    assert {(r.log, r.dt) for r in back.collect()} == {("keyword_ideas", "20240506"), ("x", "20240607")}
    assert spark.read.json(folder).select("log", F.col("dt").cast("string")).distinct().count() == 2


def test_stage_tables_by_market(spark):
    def rows(keyword, location):
        row = (keyword, "s", "e", location, "en", 1, 0.1, 0.2, "LOW", 1.0, "", None)
        return spark.createDataFrame([row], DISCOVERED)

    folder = new_folder(spark, "t")
    assert tables.read_optional_table(spark, folder, DISCOVERED) is None
    for keyword, location in (("a", 1), ("b", 2), ("c", 1)):
        tables.write_table(rows(keyword, location), folder, by_market=True)
    back = tables.read_table(spark, folder, DISCOVERED)
    assert sorted((r.keyword, r.location_code) for r in back.collect()) == [("b", 2), ("c", 1)] and back.columns == DISCOVERED.fieldNames()
    plan = back.where("location_code = 2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(location_code" in plan


def test_entity_csv_keeps_quotes_lines_and_spaces(spark):
    row = ("book", "1", "en", ' a "quoted", title ', "two\nlines; \\ and 'more'", None, None, "x", "https://h/1", None)
    folder = new_folder(spark, "t")
    tables.write_csv(spark.createDataFrame([row], ENTITIES), folder)
    back = tables.read_entities(spark, folder).collect()
    assert [tuple(r) for r in back] == [row]


def test_table_keeps_terms_that_look_like_nulls(spark):
    rows = [(t, "u", "", "", "en", "heading", 1, "", "h1") for t in ("NA", "", "null", "x,y")]
    folder = new_folder(spark, "t")
    tables.write_table(spark.createDataFrame(rows, CANDIDATES), folder)
    assert sorted(r.term for r in tables.read_table(spark, folder, CANDIDATES).collect()) == ["", "NA", "null", "x,y"]


def test_intake_takes_only_new_files_and_dedupes(spark):
    log, sink, checkpoint = (new_folder(spark, n) for n in ("log", "sink", "cp"))
    call = envelope("related_keywords", {"keyword": "k", **MARKET}, [{"result": [{"items": [{"keyword": "f1"}, {"keyword": "f2"}]}]}])
    raw_io.append_raw(parsed(spark, call), log)
    for expected in (2, 2):
        intake.run_available(intake.stream_raw(spark, log), sink, checkpoint, responses.discovered)
        assert spark.read.schema(DISCOVERED).parquet(sink).count() == expected
    later = call.replace('"k"', '"k2"')
    raw_io.append_raw(parsed(spark, call, later), log)
    intake.run_available(intake.stream_raw(spark, log), sink, checkpoint, responses.discovered)
    assert spark.read.schema(DISCOVERED).parquet(sink).count() == 6
    once, cp2 = new_folder(spark, "once"), new_folder(spark, "cp")
    intake.dedupe_available(intake.stream_raw(spark, log), once, cp2)
    assert sorted(r.subject for r in intake.kept_keys(spark, once).collect()) == ["k", "k2"]
    raw_io.append_raw(parsed(spark, call), log)
    intake.dedupe_available(intake.stream_raw(spark, log), once, cp2)
    assert intake.kept_keys(spark, once).count() == 2
    assert sorted(r.subject for r in intake.kept_responses(raw_io.read_raw(spark, log), intake.kept_keys(spark, once)).collect()) == ["k", "k2"]


def test_a_logged_call_is_not_planned_again(spark):
    terms = spark.createDataFrame([("b",), ("a",), ("c",)], "term string")
    plan = planning.plan_discovery(terms, ["x.example"])
    keyed = planning.with_reuse_key(plan, terms, location_code=MARKET["location_code"], language_code=MARKET["language_code"], bucket="2024-05")
    assert keyed.count() == 8
    calls = [("keyword_suggestions", {"keyword": "a"}), ("related_keywords", {"keyword": "b"}), ("keyword_ideas", {"keywords": ["c", "b", "a"]}), ("keywords_for_site", {"target": "x.example"})]
    raw = parsed(spark, *[envelope(e, {**r, **MARKET}, []) for e, r in calls])
    left = planning.without_logged(keyed, intake.reuse_key(raw)).collect()
    assert {(r.endpoint, r.subject) for r in left} == {("keyword_suggestions", "b"), ("keyword_suggestions", "c"), ("related_keywords", "a"), ("related_keywords", "c")}
    other = planning.without_logged(keyed, intake.reuse_key(raw.withColumn("collected_at", F.add_months("collected_at", 1).cast("timestamp"))))
    assert other.count() == 8


def test_late_responses_stay(spark, tmp_path):
    """Months out of order, one file per batch, a batch that fails and a restart: the earliest response of each key stays."""
    log, sink, checkpoint = (new_folder(spark, n) for n in ("log", "sink", "cp"))

    def append(*days):
        for at in days:
            call = envelope("related_keywords", {"keyword": "k", **MARKET}, [{"result": [{"items": [{"keyword": at}]}]}], at=f"{at}T00:00:00Z")
            raw_io.append_raw(parsed(spark, call), log)

    def kept():
        rows = intake.kept_responses(raw_io.read_raw(spark, log), intake.kept_keys(spark, sink))
        return sorted((r.bucket, r.collected_at.day, r.response.tasks[0].result[0]["items"][0].keyword) for r in rows.collect())

    append("2024-06-07")
    intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=1), sink, checkpoint)
    # the second batch cannot be written at first
    append("2024-01-03", "2024-06-09")
    blocked = tmp_path / "file"
    blocked.write_text("x")
    with pytest.raises(StreamingQueryException):
        intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=1), str(blocked), checkpoint)
    append("2023-11-30", "2024-06-05")
    intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=1), sink, checkpoint)
    assert kept() == [("2023-11", 30, "2023-11-30"), ("2024-01", 3, "2024-01-03"), ("2024-06", 5, "2024-06-05")]
    assert len([f for f in os.listdir(sink) if f.startswith("batch=")]) >= 5
    # the keys of batches are not read back: a later run works without them
    append("2024-06-01", "2024-01-04")
    other = new_folder(spark, "sink")
    intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=1), other, checkpoint)
    assert sorted((r.bucket, r.collected_at.day) for r in intake.kept_keys(spark, other).collect()) == [("2024-01", 3), ("2024-06", 1)]


def test_equally_early_responses_have_an_order(spark):
    """Whichever comes first, the one of the smaller content hash stays; null times come last."""
    calls = [envelope("organic/live", {"keyword": "k"}, [{"result": [{"items": [{"keyword": w}]}]}]) for w in "abcdef"]
    kept = set()
    for order in (calls, calls[::-1]):
        log, sink, checkpoint = (new_folder(spark, n) for n in ("log", "sink", "cp"))
        for call in order:
            raw_io.append_raw(parsed(spark, call), log)
        intake.dedupe_available(intake.stream_raw(spark, log, files_per_batch=2), sink, checkpoint)
        kept |= {r.digest for r in intake.kept_keys(spark, sink).collect()}
    assert len(kept) == 1


def test_months_are_forgotten_on_request(spark):
    log, sink, checkpoint = (new_folder(spark, n) for n in ("log", "sink", "cp"))
    for at in ("2022-01-05", "2024-06-07", "2024-06-09", "2022-01-06", "2024-05-01"):
        raw_io.append_raw(parsed(spark, envelope("organic/live", {"keyword": "k"}, [], at=f"{at}T00:00:00Z")), log)
        intake.dedupe_available(intake.stream_raw(spark, log), sink, checkpoint, forget_after="400 days")
    noted = spark.read.schema(intake.KEPT).parquet(sink)
    # the second response of 2022 comes after that month's state has gone
    assert noted.where("bucket = '2022-01'").count() == 1
    assert sorted(r.bucket for r in intake.kept_keys(spark, sink).collect()) == ["2022-01", "2024-05", "2024-06"]


def test_filters_reach_the_folders(spark, tmp_path):
    """Folders by log and day are pruned, in tables and in streams; older files beside them are read all the same."""
    log = str(tmp_path / "log")
    volume = envelope("search_volume/live", {"keywords": ["a"]}, [{"result": [{"keyword": "a", "search_volume": 3}]}])
    raw_io.append_raw(parsed(spark, volume, envelope("organic/live", {"keyword": "q"}, [], at="2024-06-07T00:00:00Z")), log)
    (tmp_path / "log" / "old").mkdir()
    (tmp_path / "log" / "old" / "20230401_volume.jsonl").write_text(volume.replace('"a"', '"b"') + "\n\n")
    (tmp_path / "log" / "logs-20230402.jsonl").write_text(envelope("organic/live", {"keyword": "r"}, []) + "\n")
    raw = raw_io.read_raw(spark, log)
    assert sorted((r.log, r.dt) for r in raw.collect()) == [("organic", "20240506"), ("organic", "20240607"), ("search_volume", "20240506"), ("search_volume", "20240506")]
    rows = responses.flatten_volume(raw)
    assert sorted(r.keyword for r in rows.collect()) == ["a", "b"]
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(log" in plan and "search_volume" in plan.split("PartitionFilters: [isnotnull(log")[1][:200]
    assert "PartitionFilters: [isnotnull(dt" in raw.where("dt = '20240607'")._jdf.queryExecution().toString()
    one = raw_io.read_raw(spark, log, days=["20240607"])
    assert [r.log for r in one.collect()] == ["organic"] and sum("log=" in f for f in one.inputFiles()) == 1
    plans, found = [], []

    def take(batch, _):
        plans.append(batch._jdf.queryExecution().toString())
        found.extend(r.keyword for r in batch.collect())

    stream = responses.flatten_volume(intake.stream_raw(spark, log))
    stream.writeStream.foreachBatch(take).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(found) == ["a", "b"]
    some = intake.stream_raw(spark, log, logs=["organic"], days=["20240607"])
    sink = str(tmp_path / "sink")
    intake.run_available(some.select("log", "dt"), sink, str(tmp_path / "cp2"))
    assert [tuple(r) for r in spark.read.parquet(sink).collect()] == [("organic", "20240607")]


def test_a_log_without_times_takes_its_files_day(spark, tmp_path):
    for day in ("20240105", "2024-02-06"):
        (tmp_path / f"{day}_organic.jsonl").write_text('{"endpoint": "/v3/serp/organic/live", "request": [{"keyword": "k"}], "response": {"status_code": 20000}}\n')
    days = [r.collected_at.strftime("%Y%m%d") for r in raw_io.read_raw(spark, str(tmp_path)).orderBy("collected_at").collect()]
    assert days == ["20240105", "20240206"]


def test_only_the_folders_of_a_log_are_read(spark):
    folder = new_folder(spark, "t")
    raw_io.append_raw(parsed(spark, envelope("search_volume/live", {"keywords": ["a"]}, []), envelope("organic/live", {"keyword": "q"}, [])), folder)
    some = raw_io.read_raw(spark, folder, logs=["search_volume"])
    assert some.count() == 1 and some.inputFiles() and all("log=search_volume" in f for f in some.inputFiles())
    assert raw_io.read_raw(spark, folder, logs=["none"]).count() == 0


def test_changed_entities(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "x")], "id int, t string, u string")
    new = spark.createDataFrame([(1, "a", ""), (2, "b", "x"), (4, "d", None), (3, "cx", "")], "id int, t string, u string")
    rows = intake.changed_entities(new, old, ["id"], ["t", "u"]).collect()
    assert {(r.id, r.change) for r in rows} == {(1, "changed"), (3, "changed"), (4, "new")}
