"""Intake and stateful replay: restarts, replayed batches, and replay from a state."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import detect
from tidemark.sources.tables import shared
from tidemark.streaming.intake import Intake, land_steps, replay_stream

ROWS = "source string, series string, period string, value string, seq long, step int"
SNAPSHOT = "source string, series string, period string, digest string, seq long"
FIRST = [(f"s{k % 4}", f"x{k % 4}", f"2024-{1 + k // 4:02d}", f"{k}.5", 0, 0) for k in range(20)]
SECOND = [(f"s{k}", f"x{k}", "2024-05", f"{100 + k}", 1, 1) for k in range(3)] + [("s3", "x3", "2024-06", "n/a", 1, 1), ("s3", "x3", "2024-05", "7", 1, 1), ("s4", "x4", None, "1", 1, 1), ("s5", "x5", "2024-01", "3", 1, 1), ("s5", "x5", "2024-01", "4", 1, 1)]


def held(intake):
    tables = (intake.observations(), intake.state(), intake.changes().drop("batch"), intake.failures().drop("batch"))
    return [sorted(map(tuple, t.collect()), key=repr) for t in tables]


def test_a_killed_intake_goes_on_as_if_it_had_not_been(spark):
    rows = spark.createDataFrame(FIRST + SECOND, ROWS)
    source = land_steps(rows, "test-in")
    whole = Intake(spark, shared(spark, "test-whole"))
    whole.run(source, files_per_batch=1)
    broken, batches = Intake(spark, shared(spark, "test-broken")), []

    def dies(batch, number):
        batches.append(number)
        if len(batches) == 2:
            broken.land(batch, number)  # all is written, but the batch is never marked as done
            raise RuntimeError("executor lost")
        broken.land(batch, number)

    with pytest.raises(Exception, match="executor lost"):
        broken.run(source, files_per_batch=1, land=dies)
    broken.run(source, files_per_batch=1)
    assert held(broken) == held(whole)
    observations, state, changes, failures = held(whole)
    assert ("s0", "x0", "2024-05", 100.0) in [o[:4] for o in observations] and ("s3", "x3", "2024-05", 19.5) in [o[:4] for o in observations]
    assert ("s5", "x5", "2024-01", 4.0) in [o[:4] for o in observations] and not [o for o in observations if o[0] == "s4"]
    assert failures == [("s3", 1, 2, 1, "parse_failed"), ("s4", 1, 1, 1, "parse_failed")]
    assert sorted((c[0], c[5]) for c in changes if c[4] == 1) == [("s0", "revision"), ("s1", "revision"), ("s2", "revision"), ("s5", "new")]
    before = held(whole)
    whole.compact(1)
    assert held(whole) == before


def test_a_batch_that_is_run_again_changes_nothing(spark):
    intake = Intake(spark, shared(spark, "test-again"))
    one, two = (spark.createDataFrame(x, ROWS).drop("step") for x in (FIRST, SECOND))
    intake.land(one, 0)
    intake.land(two, 1)
    before = held(intake)
    intake.land(two, 1)
    assert held(intake) == before
    intake.land(one.limit(0), 2)
    assert held(intake) == before


def test_all_forms_of_replay_agree_from_a_state(spark):
    r = random.Random(8)
    rows = [("s", f"x{k % 4}", f"2024-{r.randint(1, 4):02d}", r.choice("abc"), k) for k in range(80)]
    state = spark.createDataFrame([("s", "x0", "2024-03", "a"), ("s", "x1", "2024-09", "b"), ("s", "x2", "2024-02", ""), ("s", "none", "2024-01", "c")], "source string, series string, last_period string, last_digest string")
    df = spark.createDataFrame(rows, SNAPSHOT)
    plain = {(s, x): (p, g) for s, x, p, g in map(tuple, state.collect())}
    want = []
    for s, x, p, g, k in rows:
        last, known = plain.get((s, x), (None, None))
        cls = "new" if last is None or p > last else "revision" if p == last and known and g != known else "same"
        want.append((s, x, p, g, k, cls))
        if cls != "same":
            plain[s, x] = (p, g)
    assert sorted(map(tuple, detect.replay(df, state).collect())) == sorted(want)
    steps = df.withColumn("step", (F.col("seq") / 30).cast("int"))
    assert sorted(map(tuple, replay_stream(steps, 1, state).collect())) == sorted(want)
