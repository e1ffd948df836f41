"""Literal cases of the engine's operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import backfill, claims, corpus, detect, extract, gates, ledger, packs, pages as pages_, queue, readings, rules, series, transcripts
from tidemark.sources import files
from tidemark.streaming.intake import replay_stream

OBS = "source string, series string, period string, value double"


def one(df):
    return [tuple(r) for r in df.collect()]


def test_monthly_and_quarterly_lookback(spark):
    monthly = [("s", "m", f"{2020 + k // 12}-{k % 12 + 1:02d}", 100.0 + k) for k in range(14)]
    quarterly = [("s", "q", f"{2020 + k // 4}-{k % 4 * 3 + 1:02d}", 10.0 + k) for k in range(6)]
    odd = [("s", "t", f"2020-q{k}", 1.0) for k in range(1, 5)]
    got = {r.series: r for r in series.stats_summary(spark.createDataFrame(monthly + quarterly + odd, OBS)).collect()}
    assert got["m"].yoy_base_period == "2020-02" and got["m"].yoy_pct == (113 - 101) / 101 * 100
    assert got["q"].quarterly and got["q"].yoy_base_period == "2020-04" and got["q"].trend == "↑"
    assert not got["t"].quarterly and got["t"].yoy_pct is None and got["t"].trend == "→"


def test_stats_guards(spark):
    rows = [("s", "zero", "2020-01", 0.0), ("s", "zero", "2020-02", 5.0), ("s", "one", "2020-01", 1.0)]
    got = {r.series: r for r in series.stats_summary(spark.createDataFrame(rows, OBS)).collect()}
    assert got["zero"].mom_pct is None and got["one"].trend == "—" and got["one"].prev is None


def test_calendar_yoy_uses_dates_not_places(spark):
    rows = [("s", "a", "2019-03-05", 50.0), ("s", "a", "2019-03", 40.0), ("s", "a", "2020-03", 60.0), ("s", "a", "2020-05", 1.0), ("s", "a", "2020-q1", 9.0)]
    assert one(series.calendar_yoy(spark.createDataFrame(rows, OBS)).select("period", "base_period", "value")) == [("2020-03", "2019-03", 50.0)]


@pytest.mark.parametrize(("state", "batch", "want"), [(None, ("2024-01", "a"), "new"), (("2024-01", "a"), ("2024-02", "b"), "new"), (("2024-01", "a"), ("2024-01", "a"), "same"), (("2024-01", "a"), ("2024-01", "b"), "revision"), (("2024-01", ""), ("2024-01", "b"), "same"), (("2024-01", None), ("2024-01", "b"), "same"), (("2024-02", "a"), ("2024-01", "b"), "same")])
def test_classify(spark, state, batch, want):
    s = spark.createDataFrame([("s", "x", *state)] if state else [], "source string, series string, last_period string, last_digest string")
    b = spark.createDataFrame([("s", "x", *batch)], "source string, series string, period string, digest string")
    assert detect.classify(b, s).first()["class"] == want


def test_stream_replay_equals_batch_replay_over_files(spark):
    import random

    r = random.Random(3)
    rows = [("s", f"x{k % 3}", f"2024-{r.randint(1, 5):02d}", r.choice("abc"), k) for k in range(60)]
    df = spark.createDataFrame(rows, "source string, series string, period string, digest string, seq long")
    want = sorted(one(detect.replay(df).select("source", "series", "period", "digest", "seq", "class")))
    assert sorted(one(replay_stream(df))) == want
    # Keyed state over nine files and as many micro-batches.
    assert sorted(one(replay_stream(df.withColumn("step", (F.col("seq") / 20).cast("int"))))) == want


def test_upsert_and_append_are_idempotent(spark, tmp_path):
    base = spark.createDataFrame([("a", "x", "2024-01", 1.0), ("b", "y", "2024-01", 2.0)], OBS)
    path = str(tmp_path / "obs")
    files.write_observations(base, path)
    delta = spark.createDataFrame([("a", "x", "2024-01", 9.0), ("a", "x", "2024-02", 3.0)], OBS)
    for k in range(2):
        files.upsert_observations(delta, path, str(tmp_path / f"staging{k}"))
        assert sorted(one(files.read_observations(spark, path))) == [("a", "x", "2024-01", 9.0), ("a", "x", "2024-02", 3.0), ("b", "y", "2024-01", 2.0)]
    log = str(tmp_path / "log")
    delta.limit(0).write.parquet(log)
    keys = ["source", "series", "period"]
    assert [files.append_new(delta.union(delta), log, keys) for _ in range(2)] == [2, 0]


def test_csv_series_files(spark, tmp_path):
    (tmp_path / "fred").mkdir()
    (tmp_path / "fred" / "UNRATE.csv").write_text('DATE,VALUE\n2024-01-01,3.7\n"2024-02-01","3.9"\n2024-03-01,.\n2024-04-01\n')
    assert sorted(one(files.read_csv_series(spark, str(tmp_path)))) == [("fred", "UNRATE", "2024-01-01", 3.7), ("fred", "UNRATE", "2024-02-01", 3.9)]


RELEASE = "release_id long, source string, title string, text string, url string"


@pytest.mark.parametrize(("source", "text", "key", "value", "yoy"), [
    ("cn_mof", "全国一般公共预算收入115396亿元，同比下降0.3%。", "mof_revenue", 115396.0, -0.3), ("cn_mof", "全国一般公共预算支出1,234.5亿元。", "mof_expenditure", 1234.5, None), ("cn_stats_inv", "基础设施投资（不含电力）同比增长4.6%", "inv_infra", None, 4.6),
    ("cn_stats_pmi", "制造业采购经理指数（PMI）为49.7%，比上月上升", "pmi_mfg", 49.7, None), ("cn_pbc", "广义货币(M2)余额330.29万亿元，同比增长8.3%。", "pbc_m2", 330.29, 8.3), ("jp_ppi", "The Producer Price Index Fell 0.4 percent from the previous month", "cgpi_mom", None, -0.4),
    ("jp_ppi", "Producer Price Index was unchanged 0.0 percent", "cgpi_mom", None, 0.0), ("jp_unrate", "the unemployment rate was 2.5%", "unrate", 2.5, None), ("jp_policy", "uncollateralized overnight call rate to remain at around 0.5 percent", "policy_rate", 0.5, None),
    ("de_cpi", "Inflation rate at +2.0%\n+0.3% on the previous month", "cpi_mom", None, 0.3), ("de_unrate", "0.5% lower than in the same month a year earlier", "employment_yoy", None, -0.5), ("de_unrate", "0.2% higher than in May", "employment_yoy", None, 0.2),
    ("jp_gdp", "国内総生産（ＧＤＰ） 0.1 0.2 0.3 0.4 0.5 (0.9) −1.2\n国内総生産（ＧＤＰ） 1 2 3 4 5.5\n", "gdp_qoq", None, -1.2), ("jp_gdp", "国内総生産（ＧＤＰ） 0.1 0.2 0.3 0.4 0.5\n国内総生産（ＧＤＰ） 1 2 3 4 5.5\n", "gdp_yoy", None, 5.5),
])
def test_extract(spark, source, text, key, value, yoy):
    got = extract.extract(spark.createDataFrame([(1, source, "t", text, None)], RELEASE)).where(F.col("metric_key") == key).first()
    assert (got.value, got.yoy) == (value, yoy) and str(got.yoy) != "-0.0"


def test_one_table_row_is_no_metric(spark):
    df = spark.createDataFrame([(1, "jp_gdp", "t", "国内総生産（ＧＤＰ） 0.1 0.2 0.3 0.4 0.5 1.2\n", None), (2, "cn_mof", "t", "nothing", None)], RELEASE)
    assert extract.extract(df).count() == 0


@pytest.mark.parametrize(("source", "title", "text", "url", "want"), [
    ("cn_mof", "2025年1-7月财政收支", "", None, "2025-07"), ("cn_mof", "2025年上半年", "", None, "2025-06"), ("cn_mof", "2025年前三季度", "", None, "2025-09"), ("cn_mof", "2025年一季度", "", None, "2025-03"), ("cn_mof", "2025年全年", "", None, "2025-12"), ("cn_mof", "2025年8月份", "", None, "2025-08"), ("cn_mof", "8月份", "", None, None),
    ("jp_gdp", "GDP for Apr.-Jun. 2026", "", None, "2026-q2"), ("jp_gdp", "2026", "in Q3 output", None, "2026-q3"), ("jp_cpi", "Consumer prices, July 2026", "", None, "2026-07"), ("jp_cpi", "Consumer prices in July", "", None, None), ("jp_policy", "July 2026", "", "https://x/k260131a.pdf", "2026-01"), ("jp_ppi", "t", "", "/cgpi2607.pdf", "2026-07"),
    ("de_gdp", "GDP, 2nd quarter of 2026", "", None, "2026-q2"), ("de_gdp", "GDP Q1 2026", "", None, "2026-q1"), ("de_cpi", "Inflation rate in July 2026", "May 2025", None, "2026-07"), ("de_cpi", "Inflation", "July 2026", None, None),
])
def test_periods(spark, source, title, text, url, want):
    assert extract.with_period(spark.createDataFrame([(1, source, title, text, url)], RELEASE)).first()["period"] == want


def cues(spark, *rows):
    return spark.createDataFrame([("v", k, a, b, t) for k, (a, b, t) in enumerate(rows)], "video_id string, ordinal int, start_ms long, end_ms long, text string")


def test_merge_rules(spark):
    got = lambda *rows: [r.text for r in transcripts.merge(cues(spark, *rows)).orderBy("start_ms").collect()]
    assert got((0, 1000, "a"), (1500, 2000, "b")) == ["a b"] and got((0, 1000, "a"), (1000, 2000, "b")) == ["a", "b"]
    assert got((0, 1000, "a。"), (1500, 2000, "b")) == ["a。", "b"] and got((0, 1000, "a"), (2501, 3000, "b")) == ["a", "b"]
    assert got((0, 4000, "a"), (4500, 8000, "b"), (8100, 9000, "c")) == ["a b", "c"] and got((0, 8100, "a"), (8200, 8300, "b")) == ["a", "b"]


def test_repeats(spark):
    segments = lambda n: spark.createDataFrame([("v", k, k, k, k, "x") for k in range(n)], "video_id string, start_ms long, end_ms long, raw_cue_start long, raw_cue_end long, text string")
    assert [transcripts.collapse_repeats(segments(n)).count() for n in (1, 3, 5, 6, 9)] == [1, 1, 1, 5, 5]


def test_fold_and_quotes(spark):
    df = spark.createDataFrame([("été　 a b﻿ ", "été a b")], "a string, b string")
    assert one(df.select(transcripts.fold(F.col("a")) == transcripts.fold(F.col("b")))) == [(True,)]
    seg = spark.createDataFrame([("v", 0, "Prices rose  in May")], "video_id string, ordinal int, text string")
    quotes = spark.createDataFrame([("1", "v", 0, "rose in May"), ("2", "v", 0, "rose in June"), ("3", "v", 1, "rose"), ("4", "v", 0, " ")], "quote_id string, video_id string, ordinal int, quote string")
    assert {r.quote_id: r.contained for r in transcripts.quote_check(quotes, seg).collect()} == {"1": True, "2": False, "3": False, "4": False}


def test_caption_formats(spark):
    vtt = "WEBVTT\nKind: x\n\nNOTE hi\n\n1\n00:00:01.000 --> 00:00:02.500 align:start\nHello\nthere\n\n00:00:03.000 --> 00:00:04.000\n\n"
    got = one(transcripts.vtt_cues(spark.createDataFrame([("v", vtt), ("w", vtt[6:])], "video_id string, body string")))
    assert got == [("v", 0, 1000, 2500, "Hello\nthere")]
    body = '{"events":[{"tStartMs":1,"dDurationMs":5,"segs":[{"utf8":"a"},{"utf8":"b"}]},{"tStartMs":4,"dDurationMs":9,"aAppend":1,"segs":[{"utf8":" c"}]},{"segs":[{"utf8":"\\n"}]},{"tStartMs":30,"dDurationMs":1,"aAppend":1,"segs":[{"utf8":"d"}]},{"tStartMs":40,"dDurationMs":2,"segs":[{"utf8":"e"}]}]}'
    got = one(transcripts.json3_cues(spark.createDataFrame([("v", body)], "video_id string, body string")))
    assert got == [("v", 0, 1, 13, "ab c"), ("v", 1, 30, 31, "d"), ("v", 2, 40, 42, "e")]


def test_chain_and_transitions(spark):
    t = lambda k: datetime.datetime(2024, 1, 1, k)
    events = spark.createDataFrame([(1, "claim", 1, None, "draft", t(0)), (2, "claim", 1, "draft", "active", t(1)), (3, "claim", 1, "draft", "active", t(2)), (4, "claim", 2, None, "active", t(0))], "evt_id long, entity_type string, entity_id long, from_status string, to_status string, occurred_at timestamp")
    entities = spark.createDataFrame([("claim", 1, "draft"), ("claim", 2, "draft"), ("claim", 3, "draft")], "entity_type string, entity_id long, initial_status string")
    assert sorted(one(ledger.chain_violations(events, entities).select("evt_id", "problem"))) == [(3, "discontinuous"), (4, "invalid_first")]
    assert sorted(one(ledger.status(entities, events).select("entity_id", "status"))) == [(1, "active"), (2, "active"), (3, "draft")]
    proposed = spark.createDataFrame([("generated_insight", 1, "ready", "published"), ("generated_insight", 2, "ready", "published"), ("claim", 1, "active", "draft")], "entity_type string, entity_id long, current string, to_status string")
    assert sorted(one(ledger.legality(proposed, spark.createDataFrame([(1,)], "entity_id long")).select("entity_id", "verdict"))) == [(1, "accepted"), (1, "illegal_transition"), (2, "artifact_missing")]


def test_inserts_are_idempotent(spark):
    batch = spark.createDataFrame([("m", "2024-01", "h", 1.0), ("m", "2024-01", "h", 1.0), ("m", "2024-02", "h", 2.0)], "metric_id string, observed_period string, content_sha256 string, value double")
    keys = ["metric_id", "observed_period", "content_sha256"]
    new = ledger.insert_new(batch, batch.limit(0), keys, "evi")
    assert new.count() == 2 and ledger.insert_new(batch, new, keys, "evi").count() == 0
    assert sorted(r.id for r in new.collect()) == sorted(r.id for r in ledger.insert_new(batch, batch.limit(0), keys, "evi").collect())


CLAIM = {"claim_text": "Prices rose", "claim_type": "fact", "layer": "system_evaluation", "speaker": None, "transcript_version_id": 1, "segment_start_ordinal": 0, "segment_end_ordinal": 0, "start_ms": 0, "end_ms": 5, "exact_quote": "prices rose", "timestamp_url": "u", "raw_caption_sha256": "s", "from_model": True}


@pytest.mark.parametrize(("change", "want"), [
    ({}, None), ({"exact_quote": ""}, "R1"), ({"start_ms": None}, "R1"), ({"layer": "speaker_statement", "speaker": "A"}, "R10"), ({"layer": "speaker_statement", "from_model": False}, "R4"), ({"layer": "speaker_statement", "from_model": False, "speaker": "A"}, None),
    ({"claim_text": "a because b, however c"}, "R5"), ({"claim_text": "因为a所以b"}, "R5"), ({"claim_text": "a！b！c！"}, "R5"), ({"segment_end_ordinal": 9}, "R3"), ({"end_ms": -1}, "R3"), ({"segment_start_ordinal": 1, "segment_end_ordinal": 1}, "R2"), ({"exact_quote": "prices fell"}, "R2"),
])
def test_claim_rules(spark, change, want):
    schema = "claim_text string, claim_type string, layer string, speaker string, transcript_version_id long, segment_start_ordinal long, segment_end_ordinal long, start_ms long, end_ms long, exact_quote string, timestamp_url string, raw_caption_sha256 string, from_model boolean"
    row = CLAIM | change
    segments = spark.createDataFrame([(1, 0, "When prices rose again"), (1, 1, "other")], "transcript_version_id long, ordinal long, text string")
    assert claims.judged(spark.createDataFrame([tuple(row.values())], schema), segments).first()["rule_id"] == want


def test_rules_skip_nulls_and_zero_divisors(spark):
    stats = spark.createDataFrame([("s", "a", 10.0, None, 1.0, None), ("s", "b", 0.0, None, None, 3.0)], "source string, series string, value double, prev double, mom_pct double, yoy_pct double")
    rule = "rule_id string, source string, series string, field string, op string, lo double, hi double, invert boolean, flag string, note string"
    fire = lambda *r: [x.rule_id for x in rules.single_rules(stats, spark.createDataFrame([(str(k), *x, "f", None) for k, x in enumerate(r)], rule)).collect()]
    assert sorted(fire(("s", "a", "value", "gt", 9.0, None, None), ("s", "a", "yoy_pct", "gt", 0.0, None, None), ("s", "b", "yoy_pct", "range", 3.0, 3.0, False), ("s", "b", "yoy_pct", "range", 3.0, 4.0, True))) == ["0", "2"]
    cross = spark.createDataFrame([("1", "s", "a", "value", "ratio", "s", "b", "value", "gt", 0.0, "f", "n"), ("2", "s", "a", "value", "minus", "s", "b", "value", "gt", 5.0, "f", "n")], "rule_id string, a_source string, a_series string, a_field string, how string, b_source string, b_series string, b_field string, op string, threshold double, flag string, note string")
    assert one(rules.cross_rules(stats, cross, stats).select("rule_id", "text")) == [("2", "**f** — n（a(10.0) minus b(0.0) = 10.0）")]
    assert rules.cross_rules(stats, cross, stats.where("series = 'c'")).count() == 0


def test_display_values(spark):
    df = spark.createDataFrame([(1234567.8, None), (12.349, None), (None, 3.14159), (None, None)], "v double, y double")
    assert [r[0] for r in df.select(readings.shown_value(F.col("v"), F.col("y"))).collect()] == ["1,234,568", "12.35", "3.14% 同比", "—"]


def test_redaction_and_exit_classes(spark):
    df = spark.createDataFrame([("see https://a.b/c?d=1 Bearer abc.defgh api_key=xyz12345 in /home/u/f.txt, token=short",)], "t string")
    assert one(df.select(corpus.redact(F.col("t")))) == [("see <redacted-url> <redacted> api_key=<redacted> in <redacted-path> token=short",)]
    codes = spark.createDataFrame([("Sign in to continue", 1), ("Private video", 1), ("", 0), ("", 101), ("boom", 2)], "e string, c int")
    assert [r[0] for r in codes.select(corpus.exit_class(F.col("e"), F.col("c"))).collect()] == ["auth_required", "unavailable", "success", "retryable", "tool_error"]


def test_shape_of_documents(spark):
    deep = '{"mechanism_chain": [{"kind": "observed", "statement": "long enough", "supporting_ids": ["evi_1", "x", 5]}], "odd": {"a": {"b": 1}}, "what_changed": [{"current_value": true}]}'
    docs = spark.createDataFrame([(1, "[1]"), (2, "nonsense"), (3, '{"headline": 5}'), (4, deep), (5, None)], "doc_id long, body string")
    got = {}
    for r in gates.shape_errors(docs).collect():
        got.setdefault((r.doc_id, r.location), []).append(r.error)
    assert got[1, "$"] == got[2, "$"] == got[5, "$"] == ["not an object"] and [k for k in got if k[0] == 1] == [(1, "$")]
    assert got[3, "$.headline"] == ["not string"] and len(got[3, "$"]) == 11
    assert got[4, "$.mechanism_chain[0].supporting_ids[1]"] == ["not of the form asked for"] and got[4, "$.mechanism_chain[0].supporting_ids[2]"] == ["not string"]
    assert got[4, "$.odd"] == ["field is not known"] and not any(k[1].startswith("$.odd.") for k in got) and got[4, "$.what_changed[0].current_value"] == ["not number or null"]


@pytest.mark.parametrize(("a", "b", "same"), [
    ("1,234.50", "1234.5", True), ("1e40", "10000000000000000000000000000000000000000", True), ("0.000000001", "0", False), ("12345678901234567", "12345678901234568", False), ("-0.50", "-5e-1", True), ("+7", "7.000", True), ("0", "0.00", True), ("1e99999999999999999999", "1", False),
])
def test_numbers_are_compared_exactly(spark, a, b, same):
    x, y = spark.createDataFrame([(a,), (b,)], "t string").select(gates.number_key(F.col("t")).alias("k")).collect()
    assert (x.k == y.k) == same


def test_numbers_in_documents_of_any_size(spark):
    body = '{"headline": "grew by 1e40 or 0.000000001, 2.50 and 12345678901234567", "next_checks": [{"threshold": 1E+400}, {"threshold": 2.5}, {"threshold": null}]}'
    docs = spark.createDataFrame([(1, "p", body), (2, "p", None)], "doc_id long, pack_id string, body string")
    stated = spark.createDataFrame([("p", x) for x in ("2.5", "0", "12345678901234568")], "pack_id string, t string").select("pack_id", gates.number_key(F.col("t")).alias("number"))
    errors = sorted(r.error.split()[-1] for r in gates.untraceable_numbers(docs, stated).collect())
    assert errors == ['"Infinity"', "0.000000001", "12345678901234567", "1e40"]


def test_packs_that_differ_in_a_late_decimal_have_other_hashes(spark):
    def packed(value):
        e = spark.createDataFrame([("p", "evi_1", "a:b", "2024-01", value, None, "EUR", "Office", True, [("2024-01", value)])], "pack_id string, evi_id string, metric_id string, observed_period string, value double, previous_value double, unit string, publisher string, official_primary boolean, history array<struct<period:string,value:double>>")
        none = lambda s: spark.createDataFrame([], s)
        items = spark.createDataFrame([("p", "rit_1", "q", "t", 1)], "pack_id string, item_id string, queue_source string, title string, priority int")
        held = packs.members(items, e, none("pack_id string, claim_id long, evidence_ids array<string>"), none("pack_id string, forecast_id long, claim_id long, status string"))
        spreads = none("pack_id string, id string, formula string, a double, b double, value double, unit string, note string")
        return packs.canonical(items, e, held, spreads, none("pack_id string, flag string")).first()

    a, b = packed(1.001), packed(1.002)
    assert a.pack_sha256 != b.pack_sha256 and a.n_allowed == 2 and '"value":"1001e-3"' in a.pack_json and '"cross_book_signal_present":false' in a.pack_json


@pytest.mark.parametrize(("ref", "want"), [
    ("g", "http://a/b/c/g"), ("./g", "http://a/b/c/g"), ("g/", "http://a/b/c/g/"), ("/g", "http://a/g"), ("//g", "http://g"), ("?y", "http://a/b/c/d;p?y"), ("g?y", "http://a/b/c/g?y"), ("#s", "http://a/b/c/d;p?q#s"), ("g#s", "http://a/b/c/g#s"), ("", "http://a/b/c/d;p?q"),
    (".", "http://a/b/c/"), ("./", "http://a/b/c/"), ("..", "http://a/b/"), ("../", "http://a/b/"), ("../g", "http://a/b/g"), ("../..", "http://a/"), ("../../g", "http://a/g"), ("../../../g", "http://a/g"), ("/./g", "http://a/g"), ("/../g", "http://a/g"), ("g..", "http://a/b/c/g.."), ("./g/.", "http://a/b/c/g/"), ("g:h", "g:h"), ("g/../h", "http://a/b/c/h"),
])
def test_references_are_resolved(spark, ref, want):
    df = spark.createDataFrame([("http://a/b/c/d;p?q", ref)], "base string, ref string")
    assert one(df.select(pages_.url_join(F.col("base"), F.col("ref")))) == [(want,)]


def test_anchors_of_all_forms_and_the_first_match(spark):
    html = "<a href='x'>one</a><A CLASS=k HREF=\"y?a=1&amp;b=2\"><b> t</b>wo </A><a href=z>th<i>ree</i></a><!-- <a href='n'>no</a> --><a name='q'>no</a><a href='w'><img></a>"
    pages = spark.createDataFrame([(1, "https://s/d/", html)], "page_id long, url string, html string")
    links = pages_.anchors(pages)
    assert sorted(one(links.select("title", "link"))) == [("one", "https://s/d/x"), ("three", "https://s/d/z"), ("two", "https://s/d/y?a=1&b=2")]
    assert one(pages_.discover(links, "^t", None, "y\\?").select("title")) == [("two",)] and one(pages_.discover(links, "^t", None, "/z$")) == []
    assert one(pages_.anchors(pages, base=F.lit("https://o/")).where("title = 'one'").select("link")) == [("https://o/x",)]


def test_character_references(spark):
    texts = ["&copy; &#8217; &hellip;", "&#x1F600;&#128;", "&amp;lt; &nosuch; & &;", "&#55296;&#99999999999;", None, "plain", "&eacute;t&eacute &notin;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(pages_.unescape(F.col("t"))).collect()] == ["© ’ …", "😀€", "&lt; &nosuch; & &;", "\ufffd\ufffd", None, "plain", "été ∉"]


def test_briefs(spark):
    body = "---\nsource: fred\nperiod: 2024-01\n---\n# x\n- **flag one** note\n- plain\n- **flag two**\n"
    assert one(backfill.parse_briefs(spark.createDataFrame([(1, body), (2, "no front matter")], "brief_id long, body string"))) == [(1, "fred", "2024-01", "flag one|flag two"), (2, None, None, "")]


def test_release_dates(spark):
    urls = ["https://x/2019/05/a", "/202013/x", "/cgpi2107.pdf", "/2018/", "/2010/05/", "/none", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(pages_.release_date(F.col("u"), 2021)).collect()]
    assert got == [datetime.date(2019, 5, 1), None, datetime.date(2021, 7, 1), datetime.date(2018, 12, 31), datetime.date(2010, 12, 31), None, None]
