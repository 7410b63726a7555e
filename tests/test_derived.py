"""Derived state against a rebuild after every batch, replays, failed batches and resets."""

import pytest
from pyspark.sql import functions as F

from sievework.streaming.derived import DerivedState

FACTS = "id long, k string, v double"


def totals(facts):
    """Keys whose facts add up to less than nothing have no row."""
    return facts.groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("total")).where("total >= 0")


@pytest.fixture
def state(tmp_path):
    return DerivedState(str(tmp_path / "state"), FACTS, "k string, n long, total double", ["k"], ["id"], totals, buckets=8)


BATCHES = [
    [(1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.0), (3, None, 1.0), (None, "a", 9.0)],
    [(1, "a", 1.0), (4, "a", 5.0), (5, "c", 1.0)],
    [],
    [(6, "b", -10.0), (4, "z", 7.0), (7, "d", 0.0)],  # b vanishes; fact 4 is known under another key
    [(8, "b", 9.0), (9, "c", 3.0)],
]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def expected(batches):
    seen = {}
    for batch in batches:
        for i, k, v in sorted((r for r in batch if None not in r[:2]), key=str):
            seen.setdefault(i, (k, v))
    sums = {}
    for k, v in seen.values():
        n, t = sums.get(k, (0, 0.0))
        sums[k] = (n + 1, t + v)
    return sorted((k, n, t) for k, (n, t) in sums.items() if t >= 0)


def test_equals_a_rebuild_after_every_batch(spark, state):
    for epoch, batch in enumerate(BATCHES):
        state.merge(spark.createDataFrame(batch, FACTS), epoch)
        assert rows(state.current(spark)) == expected(BATCHES[: epoch + 1]) == rows(totals(state.known_facts(spark)))
    assert rows(state.current(spark, 1)) == expected(BATCHES[:2])
    # only the keys that a batch touches are derived again
    touched = spark.read.parquet(f"{state.folder}/touched")
    assert {(r.epoch, r.k) for r in touched.collect()} == {(0, "a"), (0, "b"), (1, "a"), (1, "c"), (3, "b"), (3, "d"), (4, "b"), (4, "c")}


def test_replay_and_failed_batch(spark, state):
    first, second = (spark.createDataFrame(b, FACTS) for b in BATCHES[:2])
    state.merge(first, 0)
    state.merge(first, 0)
    assert rows(state.current(spark)) == expected(BATCHES[:1])

    def broken(facts):
        raise RuntimeError("lost")

    fails = DerivedState(state.folder, state.facts, state.derived, state.key, state.id, broken, state.buckets)
    with pytest.raises(RuntimeError):
        fails.merge(second, 1)
    # its facts are written, and nobody sees them
    assert rows(state.current(spark)) == expected(BATCHES[:1]) == rows(totals(state.known_facts(spark)))
    state.merge(second, 1)
    assert rows(state.current(spark)) == expected(BATCHES[:2])


def test_reset_under_new_rules(spark, state):
    for epoch, batch in enumerate(BATCHES[:2]):
        state.merge(spark.createDataFrame(batch, FACTS), epoch)
    counts = DerivedState(state.folder, state.facts, state.derived, state.key, state.id, lambda f: f.groupBy("k").agg(F.count("*").alias("n"), F.lit(0.0).alias("total")), state.buckets)
    counts.reset(spark, 2)
    assert rows(counts.current(spark)) == [("a", 2, 0.0), ("b", 1, 0.0), ("c", 1, 0.0)]
    counts.merge(spark.createDataFrame([(10, "c", 1.0)], FACTS), 3)
    assert rows(counts.current(spark)) == [("a", 2, 0.0), ("b", 1, 0.0), ("c", 2, 0.0)]
    assert len(rows(counts.known_facts(spark))) == 5


def test_as_a_stream(spark, state, tmp_path):
    for i, batch in enumerate(BATCHES):
        spark.createDataFrame(batch, FACTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(FACTS).parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(state.merge).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert rows(state.current(spark)) == expected(BATCHES)
