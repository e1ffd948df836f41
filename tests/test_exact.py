"""Exact numbers, places by ranges, bounded merging of long chains, and rules of bundles."""

import random
from decimal import Decimal, getcontext

import pytest
from pyspark.sql import functions as F

from tidemark.operators import claims, numbers, packs, readings, series, transcripts
from tidemark.sources.tables import ranked


def test_differences_are_those_of_decimals(spark):
    getcontext().prec = 800
    r = random.Random(11)
    digits = lambda: "".join(r.choice("0123456789") for _ in range(r.randint(1, 40)))
    text = lambda: r.choice(["", "-", "+"]) + digits() + r.choice(["", ".", "." + digits()]) + r.choice(["", f"e{r.randint(-60, 60)}", f"E+{r.randint(0, 200)}"])
    pairs = [(text(), text()) for _ in range(400)] + [("1e30", "0.1"), ("0.3", "0.1"), ("5", "5"), ("-0", "0"), ("1e300", "1e-300"), ("9" * 30, "1"), ("1", "1,000.50")]
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    rows = df.select("k", numbers.key(numbers.difference(numbers.decimal(F.col("a")), numbers.decimal(F.col("b")))).alias("got"))
    got = {x.k: x.got for x in rows.collect()}

    def key(d):
        sign, ds, e = d.as_tuple()
        whole = "".join(map(str, ds)).lstrip("0")
        short = whole.rstrip("0")
        return "0" if not whole else f"{'-' if sign else ''}{short}e{e + len(whole) - len(short)}"

    for k, (a, b) in enumerate(pairs):
        assert got[k] == key(Decimal(a.replace(",", "")) - Decimal(b.replace(",", ""))), (a, b)


def test_odd_numbers(spark):
    rows = ["1e999999999", "n/a", "", None, "1e99999999999999999999", "--1", "1.2.3", " 1,5 "]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "k int, t string")
    key = {x.k: x.v for x in df.select("k", numbers.number_key(F.col("t")).alias("v")).collect()}
    assert [key[k] for k in range(8)] == ["1e999999999", None, None, None, None, None, None, "15e0"]
    less = numbers.difference(numbers.decimal(F.col("t")), numbers.decimal(F.lit("1")))
    assert {x.v["digits"] if x.v else None for x in df.where("k < 6").select(less.alias("v")).collect()} == {None}  # beyond MOST_DIGITS, or no number


@pytest.mark.parametrize(("a", "b", "want"), [(0.3, 0.1, 0.2), (1e30, 1.0, 1e30), (1e30, 1e30, 0.0), (-1.5, 2.25, -3.75), (1e308, -1e308, float("inf")), (5e-324, 0.0, 5e-324), (float("nan"), 1.0, None), (123456.78, 0.01, 123456.77)])
def test_spreads_are_exact(spark, a, b, want):
    obs = spark.createDataFrame([("s", "a", "p", a), ("s", "b", "p", b)], "source string, series string, period string, value double")
    pairs = spark.createDataFrame([("x", "s", "a", "s", "b")], "id string, a_source string, a_series string, b_source string, b_series string")
    assert series.derived_spread(obs, pairs).first().value == want
    evidence = spark.createDataFrame([("k", "a", a), ("k", "b", b)], "pack_id string, metric_id string, value double")
    wanted = spark.createDataFrame([("k", "x", "a", "b", "u", "n")], "pack_id string, id string, metric_a string, metric_b string, unit string, note string")
    assert packs.derived(evidence, wanted).first().value == want


def test_places_by_ranges(spark):
    r = random.Random(1)
    rows = [(r.randint(0, 40), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "x int, k int")
    got = [(x.place, x.x, x.k) for x in ranked(df, F.desc("x"), F.col("k"), into="place").orderBy("place").collect()]
    assert got == [(n + 1, *row) for n, row in enumerate(sorted(rows, key=lambda t: (-t[0], t[1])))]
    assert ranked(df.limit(0), F.col("x"), into="place").count() == 0
    shown = spark.createDataFrame([("s", f"x{k}", "n", "us", 1.0, None, None, None, None) for k in range(5)], "source string, series string, name string, economy string, value double, yoy_pct double, mom_pct double, trend string, period string")
    plan = readings.report(shown)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def plain_merge(cues, gap_ms=1500, span_ms=8000):
    out = []
    for k, (start, end, text) in enumerate(cues):
        if out and 0 < start - out[-1][1] <= gap_ms and out[-1][4][-1] not in "。！？!?" and end - out[-1][0] <= span_ms:
            out[-1][1], out[-1][3], out[-1][4] = end, k, text
            out[-1][5].append(text)
        else:
            out.append([start, end, k, k, text, [text]])
    return [(s, e, a, b, " ".join(t)) for s, e, a, b, _, t in out]


def test_long_chains_are_cut_as_cue_by_cue(spark):
    r = random.Random(6)
    videos, rows = {}, []
    for v, n in enumerate((20_000, 500, 60, 1, 40)):
        at, cues = 0, []
        for _ in range(n):
            start = at + r.choice([1, 5, 200, 1500] if v != 2 else [0, 1, 1501, 3])
            at = start + r.choice([0, 3, 40, 900] if v != 4 else [9000, 10, 8000])
            cues.append((start, at, r.choice("abc") + ("。" if v != 0 and r.random() < 0.1 else "")))
        videos[f"v{v}"] = plain_merge(cues)
        rows += [(f"v{v}", k, *c) for k, c in enumerate(cues)]
    df = spark.createDataFrame(rows, "video_id string, ordinal int, start_ms long, end_ms long, text string")
    got = {}
    for x in transcripts.merge(df).orderBy("video_id", "start_ms", "raw_cue_start").collect():
        got.setdefault(x.video_id, []).append((x.start_ms, x.end_ms, x.raw_cue_start, x.raw_cue_end, x.text))
    assert got == videos


def test_an_empty_start_segment_fails_the_first_rule(spark):
    fields = {"claim_text": "x", "claim_type": "fact", "layer": "system_evaluation", "transcript_version_id": 1, "segment_start_ordinal": 0, "segment_end_ordinal": 0, "start_ms": 0, "end_ms": 1, "exact_quote": "x", "timestamp_url": "u", "raw_caption_sha256": "h"}
    segments = spark.createDataFrame([(1, 0, ""), (1, 1, "  "), (1, 2, "an x here")], "transcript_version_id long, ordinal long, text string")
    rows = [(k, *{**fields, "segment_start_ordinal": k, "segment_end_ordinal": k}.values(), None, True) for k in range(3)]
    schema = "candidate long, claim_text string, claim_type string, layer string, transcript_version_id long, segment_start_ordinal long, segment_end_ordinal long, start_ms long, end_ms long, exact_quote string, timestamp_url string, raw_caption_sha256 string, speaker string, from_model boolean"
    assert {x.candidate: x.rule_id for x in claims.judged(spark.createDataFrame(rows, schema), segments).collect()} == {0: "R1", 1: "R2", 2: None}
    import json

    whole = [{**fields, "segment_start_ordinal": k, "segment_end_ordinal": k} for k in range(3)] + [7, {**fields, "layer": "speaker_statement"}]
    body = {"claims": whole, "edges": [{"layer": "speaker_reasoning", "exact_quote": "q"}], "concepts": [{"status": "canonical"}, {"status": "canonical", "concept_source": "s"}], "evaluations": [{"evaluator": "macro_bridge", "external_evidence": {"publisher": "p", "observed_period": "o"}}, None], "forecasts": []}
    bundle = spark.createDataFrame([("b", True, json.dumps(body)), ("c", True, "{}"), ("d", True, "no json"), ("e", True, None)], "bundle_id string, from_model boolean, body string")
    got = sorted((x.kind, x["index"], x.verdict) for x in claims.bundle_items(bundle, segments).collect())
    assert got == [("claims", 0, "R1"), ("claims", 1, "R2"), ("claims", 2, "accepted"), ("claims", 3, "R1"), ("claims", 4, "R10"), ("concepts", 0, "R7"), ("concepts", 1, "accepted"), ("edges", 0, "R6"), ("evaluations", 0, "R8"), ("evaluations", 1, "R8")]


def test_only_unsettled_texts_are_normalised(spark):
    import re
    import unicodedata

    r = random.Random(3)
    pool = [*"aeAcks ", "é", "e\u0301", "\u0301", "\u0323", "\u0344", "ｶ", "か", "\u3099", "가", "\u1100", "\u1161", "\u11a8", "\u212b", "\u2126", "ﬁ", "中", "\U0001d15e", "\u09c7", "\u09be", "\ufb1d", "😀", "\u0958"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(0, 9))) for _ in range(800)]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {x.k: x.v for x in df.select("k", transcripts.nfc(F.col("t")).alias("v")).collect()}
    assert [got[k] for k in range(len(texts))] == [unicodedata.normalize("NFC", t) for t in texts]
    pattern = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", transcripts.unsettled()))
    short = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", transcripts.ELSEWHERE))
    assert not [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x30000))) if pattern.match(c) and not short.match(c)]
    assert all(unicodedata.is_normalized("NFC", t) for t in texts if not pattern.search(t)) and not pattern.search("Plain text, größer 中文")


def test_a_resumed_replay_equals_the_whole_one(spark):
    from tidemark.operators import ledger

    r = random.Random(9)
    kinds = ["draft", "active", "superseded"]
    log = [(k, "claim", r.randint(0, 30), r.choice([None, *kinds]), r.choice(kinds), r.randint(0, 12)) for k in range(400)]
    schema = "evt_id long, entity_type string, entity_id long, from_status string, to_status string, occurred_at int"
    events = spark.createDataFrame(log, schema)
    entities = spark.createDataFrame([("claim", k, r.choice([None, "draft"])) for k in range(32)], "entity_type string, entity_id long, initial_status string")
    flat = lambda df: sorted(map(tuple, df.collect()), key=repr)
    for cut, held in ((6, 5), (0, 1), (13, 10**6), (6, 10**6)):  # some events late, all in the tail, none, ties at the cut
        first = (F.col("occurred_at") < cut) & (F.col("evt_id") % held != held - 1) if held > 1 else F.lit(False)
        before = events.where(first)
        state, violations, late = ledger.resumed(ledger.replayed(before), events.where(~first), events, entities)
        standing = ledger.chain_violations(before, entities).join(late, ledger.ENTITY, "left_anti")
        assert flat(state) == flat(ledger.replayed(events))
        assert flat(standing.unionByName(violations)) == flat(ledger.chain_violations(events, entities))


def test_digests_of_members_do_not_depend_on_their_number_in_a_task(spark):
    import hashlib

    rows = [(p, "claims", str(k), f"{{{k}}}") for p, n in (("a", 2500), ("b", 3), ("c", 1000)) for k in range(n)]
    df = spark.createDataFrame(rows, "pack_id string, section string, id string, json string").repartition(7)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for each in (10, 1000):
        want = {}
        for p in "abc":
            mine = sorted((i, j) for q, _, i, j in rows if q == p)
            chunks = {}
            for i, j in mine:
                chunks.setdefault(int(hashlib.md5(i.encode()).hexdigest()[:8], 16) % -(-len(mine) // each), []).append(j)
            want[p] = (len(mine), sha("\n".join(sha("\n".join(chunks[c])) for c in sorted(chunks))))
        assert {x.pack_id: (x.n, x.sha256) for x in packs.digested(df, each).collect()} == want


def test_members_and_forecasts_come_once_without_comparing_what_packs_make_of_them(spark):
    own = spark.createDataFrame([("p", 1), ("q", 1), ("q", 2), ("q", 2)], "pack_id string, claim_id long")
    rows = [(10, 1, "F"), (10, 1, "F"), (2, 2, "O"), (30, 3, None), (31, None, "O")]
    forecasts = spark.createDataFrame(rows, "forecast_id long, claim_id long, status string")
    asked = spark.createDataFrame([("p", 30), ("p", 30), ("p", 31), ("q", 10), ("q", -2)], "pack_id string, forecast_id long")
    related = packs.related_forecasts(own, forecasts, asked)
    assert sorted(map(tuple, related.collect()), key=repr) == [("p", 10, 1, "F"), ("p", 30, 3, None), ("p", 31, None, "O"), ("q", 10, 1, "F"), ("q", 2, 2, "O")]
    # What packs share is made distinct before they meet it, not each pack's own copy after.
    assert related._jdf.queryExecution().optimizedPlan().toString().startswith("Union")

    claims = spark.createDataFrame([("p", 1, ["e2", "e1"]), ("q", 1, ["e2", "e1"]), ("q", 2, [])], "pack_id string, claim_id long, evidence_ids array<string>")
    evidence = spark.createDataFrame([("p", "e1"), ("q", "e1")], "pack_id string, evi_id string")
    items = spark.createDataFrame([("p", "rit_1"), ("q", "rit_2")], "pack_id string, item_id string")
    held = packs.members(items, evidence, claims, related)
    named = sorted((x.pack_id, x.id, x.json) for x in held.where("section = 'allowed'").collect())
    assert named == [("p", "1", None), ("p", "10", None), ("p", "30", None), ("p", "31", None), ("p", "e1", None), ("p", "rit_1", None), ("q", "1", None), ("q", "10", None), ("q", "2", None), ("q", "e1", None), ("q", "rit_2", None)]
    full = held.withColumn("json", F.coalesce("json", "id"))
    flat = lambda df: sorted(map(tuple, df.collect()))
    assert flat(packs.digested(held, 2)) == flat(packs.digested(full, 2))
    assert sorted(x.json for x in held.where("section = 'forecasts' and pack_id = 'p'").collect()) == ['{"id":"10","claim_id":"1","status":"F"}', '{"id":"30","claim_id":"3","status":null}', '{"id":"31","claim_id":null,"status":"O"}']


def test_accepted_claims_are_those_that_no_rule_names_and_only_quotes_left_are_folded(spark):
    good = dict(candidate=0, claim_text="grew", claim_type="fact", layer="fact", transcript_version_id=1, segment_start_ordinal=0, segment_end_ordinal=0, start_ms=0, end_ms=5, exact_quote="Prices rose", timestamp_url="u", raw_caption_sha256="h", speaker="A", from_model=True)
    changes = [
        {}, {"claim_type": ""}, {"timestamp_url": None}, {"transcript_version_id": None}, {"transcript_version_id": 9}, {"layer": "speaker_statement"}, {"layer": "speaker_statement", "from_model": None}, {"layer": "speaker_statement", "from_model": False, "speaker": " None"},
        {"claim_text": "BUT rose; fell; rose!"}, {"claim_text": "ALTHOUGH it rose but fell"}, {"claim_text": "butter, thoughtful"}, {"claim_text": "因为 it rose, however"}, {"claim_text": "因为\n所以"}, {"claim_text": "a\n。b\n；c\n?"}, {"claim_text": "a。b?"}, {"claim_text": "été; été"},
        {"segment_start_ordinal": -1}, {"segment_start_ordinal": 1}, {"segment_end_ordinal": 5}, {"end_ms": -1}, {"segment_start_ordinal": 4, "segment_end_ordinal": 4}, {"exact_quote": " \ufeff\t"}, {"exact_quote": "\u2003"}, {"exact_quote": "rose  fast"}, {"exact_quote": "fell"},
        {"segment_start_ordinal": 2, "segment_end_ordinal": 2, "exact_quote": "cafe"}, {"segment_start_ordinal": 2, "segment_end_ordinal": 2, "exact_quote": "café"}, {"segment_start_ordinal": 3, "segment_end_ordinal": 3, "exact_quote": "Prices"},
    ]
    rows = [tuple((good | c | {"candidate": k}).values()) for k, c in enumerate(changes)]
    schema = "candidate long, claim_text string, claim_type string, layer string, transcript_version_id long, segment_start_ordinal long, segment_end_ordinal long, start_ms long, end_ms long, exact_quote string, timestamp_url string, raw_caption_sha256 string, speaker string, from_model boolean"
    df = spark.createDataFrame(rows, schema)
    segments = spark.createDataFrame([(1, 0, "Prices rose fast"), (1, 1, "no"), (1, 2, "a cafe\u0301"), (1, 3, "Pri\ufeffces"), (1, 4, "")], "transcript_version_id long, ordinal int, text string")
    want = sorted(x.candidate for x in claims.judged(df, segments).where("rule_id is null").collect())
    got = claims.accepted(df, segments)
    assert sorted(x.candidate for x in got.collect()) == want and {0, 10, 23, 26} <= set(want) and not {5, 8, 9, 12, 13, 21, 22, 24} & set(want)
    assert sorted(got.columns) == sorted(df.columns)
