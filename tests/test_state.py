"""State kept from batch to batch: folds, bounded reads, unique ids over runs and replays."""

import random

from pyspark.sql import functions as F

from marketlake.session import scratch_dir
from marketlake.streaming import state, tables
from marketlake.streaming.state import FOLD_EVERY, FoldedState
from marketlake.streaming.tables import KeyedTable, run_number

SCHEMA = "conn string, _end bigint"


def test_folded_state_equals_all_that_was_added(spark):
    rng = random.Random(0)
    st = FoldedState(scratch_dir(spark, "state"), ["conn"], "_end")
    seen: dict = {}
    for batch in range(2 * FOLD_EVERY + 3):
        held = st.before(spark, SCHEMA, "r", batch)
        got = {} if held is None else {r.conn: r._end for r in held.collect()}
        assert got == seen, batch
        if held is not None:  # a bounded number of folders, however old the stream
            assert len({f.rsplit("/", 1)[0] for f in held.inputFiles()}) <= FOLD_EVERY + 1
        if batch == 5:
            continue  # a batch that failed and was passed over
        rows = [(rng.choice(["a", "b", None, f"c{batch}"]), rng.randint(0, 1000)) for _ in range(rng.randint(0, 3))]
        least: dict = {}
        for c, e in rows:
            least[c] = min(e, least.get(c, e))
        df = spark.createDataFrame([(c, e) for c, e in least.items()], SCHEMA)
        st.write(df, "r", batch)
        st.write(df, "r", batch)  # a replay replaces itself
        st.write(spark.createDataFrame([("other", 1)], SCHEMA), "q", batch)  # another run is not seen
        for c, e in least.items():
            seen[c] = min(e, seen.get(c, e))


def test_a_missing_fold_is_made_up_for(spark, monkeypatch):
    monkeypatch.setattr(state, "FOLD_EVERY", 3)
    st = FoldedState(scratch_dir(spark, "state"), [], "_end")
    for batch in range(10):
        if batch % 3:  # the batches that would write folds never ask
            held = st.before(spark, "_end bigint", "r", batch)
            assert (held.first()[0] if held is not None else None) == 100 - batch + 1
        st.write(spark.createDataFrame([(100 - batch,)], "_end bigint"), "r", batch)


def _rows(spark, keys, frame):
    return spark.createDataFrame([(k, f"q{frame}", frame, i) for i, k in enumerate(keys)],
                                 "condition_id string, question string, frame_no bigint, pos int")


def test_ids_are_unique_over_batches_and_runs_and_stable_on_replay(spark):
    root = scratch_dir(spark, "t")
    rng = random.Random(1)
    for mode in ("append", "insert_ignore", "upsert"):
        t = KeyedTable(spark, root, f"t_{mode}", key=[] if mode == "append" else ["condition_id"], mode=mode)
        for batch in range(4):
            for run in ("one", "two"):
                keys = [rng.choice([f"k{rng.randint(0, 60)}", None]) for _ in range(rng.randint(0, 90))]
                t.write_batch(_rows(spark, keys, batch).repartition(5), batch, ["frame_no", "pos"], run)
                if batch == 2:
                    before = sorted((r._seq, r.id) for r in t.log().filter(F.col("_run") == run).collect())
                    if run == "two":
                        tables._next.clear()  # a new process
                    t.write_batch(_rows(spark, keys, batch).repartition(2), batch, ["frame_no", "pos"], run)
                    assert sorted((r._seq, r.id) for r in t.log().filter(F.col("_run") == run).collect()) == before
        log = t.log()
        assert log.count() == log.select("id").distinct().count() > 100
        if mode != "append":
            rows = t.read()
            assert rows.count() == rows.select("id").distinct().count()
            named = {r.condition_id: r.id for r in rows.filter("condition_id IS NOT NULL").collect()}
            first = log.filter("condition_id IS NOT NULL").groupBy("condition_id").agg(
                F.min_by("id", F.struct("_at", "_run", "_batch_id", "_seq")).alias("id"))
            assert named == {r.condition_id: r.id for r in first.collect()}
            t.compact()
            t.write_batch(_rows(spark, ["k1", "k2", "new"], 9), 9, ["frame_no", "pos"], "one")
            again = {r.condition_id: r.id for r in t.read().collect() if r.condition_id}
            assert {k: again[k] for k in named} == named and again["new"] not in named.values()


def test_runs_that_claim_the_same_number_part(spark):
    root = scratch_dir(spark, "t")
    assert run_number(spark, root, "a") == 0 and run_number(spark, root, "b") == 1
    # Another process claims at the same time: it has written the same number as c will see.
    spark.createDataFrame([("x", 2), ("c", 2)], "run string, number bigint").write.mode("append").parquet(f"{root}/_runs")
    assert run_number(spark, root, "c") == 3
    tables._numbers.clear()
    assert [run_number(spark, root, r) for r in ("a", "b", "c")] == [0, 1, 3]
