import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from transqa.operators.infer import Task


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def shout(endpoint="e", when=None, name="shout"):
    return Task(name, endpoint, F.concat(F.lit("say "), F.col("text")), "out", when)


def answers(df, *outs):
    rows = df.orderBy("id").select("id", *[f"{o}.answer" for o in outs or ["out"]]).collect()
    return [tuple(r)[1:] if len(r) > 2 else r[1] for r in rows]


def test_each_distinct_prompt_is_asked_once(spark, counting, inference):
    calls = counting()
    run = inference(calls)
    df = docs(spark, ["a", "b", "a", None, "c", "a"])
    result = run.run(df, [shout()])
    assert answers(result) == ["e:say a", "e:say b", "e:say a", None, "e:say c", "e:say a"]
    assert calls.prompts == [("e", "say a"), ("e", "say b"), ("e", "say c")]
    # Using the result again, filtering it and running again call nobody.
    assert result.where(F.length("out.answer") > 3).count() == 5
    assert answers(run.run(df, [shout()])) == answers(result)
    assert len(calls.prompts) == 3
    # New rows cost their new prompts only.
    run.run(docs(spark, ["a", "d"]), [shout()])
    assert calls.prompts[-1] == ("e", "say d") and len(calls.prompts) == 4


def test_endpoints_and_tasks_do_not_share_answers(spark, counting, inference):
    calls = counting()
    run = inference(calls)
    df = docs(spark, ["a"])
    run.run(df, [shout("x")])
    run.run(df, [shout("y")])
    run.run(df, [shout("x", name="other")])
    assert len(calls.prompts) == 3


def test_endpoint_may_be_a_column(spark, counting, inference):
    calls = counting()
    df = docs(spark, ["a", "b"]).withColumn("endpoint", F.explode(F.array(F.lit("x"), F.lit("y"))))
    result = inference(calls).run(df, [shout(F.col("endpoint"))])
    got = result.orderBy("id", "endpoint").select("out.answer").collect()
    assert [r[0] for r in got] == ["x:say a", "y:say a", "x:say b", "y:say b"]


def test_rows_outside_the_condition_are_kept_unasked(spark, counting, inference):
    calls = counting()
    df = docs(spark, ["a", "b", "c"])
    result = inference(calls).run(df, [shout(when=F.col("id") > 0)])
    assert answers(result) == [None, "e:say b", "e:say c"]
    assert len(calls.prompts) == 2


def test_many_tasks_in_one_pass(spark, counting, inference):
    calls = counting()
    first = Task("first", "e", F.substring("text", 1, 1), "one")
    second = Task("second", "f", F.col("text"), "two", F.col("id") != 1)
    result = inference(calls).run(docs(spark, ["ab", "ac", "ab", None]), [first, second])
    assert answers(result, "one", "two") == [
        ("e:a", "f:ab"), ("e:a", None), ("e:a", "f:ab"), (None, None),
    ]
    assert calls.prompts == [("e", "a"), ("f", "ab")]


def test_only_carried_columns_come_back(spark, counting, inference):
    result = inference(counting()).run(docs(spark, ["a"]), [shout()], carry=["id"])
    assert result.columns == ["id", "out"]


def test_a_failed_call_is_a_row_and_is_tried_again(spark, counting, inference, tmp_path):
    marker = tmp_path / "up"

    def answer(endpoint, prompt, marker=str(marker)):
        import os

        if prompt == "say bad" and not os.path.exists(marker):
            raise RuntimeError("overloaded")
        return "fine"

    calls = counting(answer)
    run = inference(calls, threads_per_task=2)
    df = docs(spark, ["good", "bad"])
    row = run.run(df, [shout()]).where("id = 1").first()
    assert row["out"]["answer"] is None and row["out"]["error"] == "RuntimeError: overloaded"
    marker.write_text("")
    row = run.run(df, [shout()]).where("id = 1").first()
    assert row["out"]["answer"] == "fine" and row["out"]["error"] is None
    assert len(calls.prompts) == 3


def test_calls_are_spread_over_the_wished_partitions(spark, counting, inference):
    run = inference(counting(), parallelism=7)
    df = docs(spark, [str(i) for i in range(300)])
    assert run.unanswered(df, [shout()]).rdd.getNumPartitions() == 7
    run.answer(df, [shout()])
    sizes = run.store.open().groupBy(F.input_file_name()).count().collect()
    assert len(sizes) == 7


def test_rounds_make_the_same_answers(spark, counting, inference):
    calls = counting()
    df = docs(spark, [str(i % 40) for i in range(100)])
    result = inference(calls, rounds=3, parallelism=2).run(df, [shout()])
    assert answers(result) == [f"e:say {i % 40}" for i in range(100)]
    assert len(calls.prompts) == 40


@pytest.fixture
def at_scale(spark):
    """Plans as for data too large to broadcast or to merge partitions of."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("tasks", [1, 2])
def test_hot_calls_are_spread_and_complete(spark, counting, inference, tasks, at_scale):
    calls = counting()
    texts = ["same" if i % 3 else str(i) for i in range(600)]
    df = docs(spark, texts)
    run = inference(calls, hot_rows=50)
    chosen = [shout(), Task("head", "h", F.substring("text", 1, 1), "head")][:tasks]
    hot = run.answer(df, chosen)
    found = hot.table.collect()
    assert len(found) >= 1 and max(r.salts for r in found) == 8
    result = run.run(df, chosen)
    assert "_salt" in result._jdf.queryExecution().optimizedPlan().toString()
    assert answers(result) == [f"e:say {t}" for t in texts]
    if tasks == 2:
        assert answers(result, "head") == [f"h:{t[0]}" for t in texts]
    # The rows of the hot call end up in several partitions.
    parts = result.where("text = 'same'").select(F.spark_partition_id()).distinct().count()
    assert parts > 1


@pytest.mark.parametrize("tasks", [1, 2])
def test_thousands_of_hot_calls_stay_off_the_driver(spark, counting, inference, tasks):
    # 2,000 calls each shared by 3 rows, all of them hot at hot_rows=3.
    texts = [f"t{i % 2000}" for i in range(6000)]
    df = docs(spark, texts)
    run = inference(counting(), hot_rows=3)
    chosen = [shout(), Task("head", "h", F.substring("text", 1, 2), "head")][:tasks]
    hot = run.answer(df, chosen)
    assert hot.table.count() == 2000 + (tasks == 2) * 10  # heads t0 to t9
    result = run.run(df, chosen)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    # Hot keys come from a table by a join, not as literal digests in the plan.
    assert "_salts" in plan and not re.search(r"[0-9a-f]{64}", plan)
    assert answers(result) == [f"e:say {t}" for t in texts]
    if tasks == 2:
        assert answers(result, "head") == [f"h:{t[:2]}" for t in texts]


def test_repeated_answers_do_not_repeat_rows(spark, counting, inference):
    run = inference(counting())
    df = docs(spark, ["a", "b"])
    run.answer(df, [shout()])
    run.store.append(run.store.open().where("answer = 'e:say a'"))
    assert run.store.open().count() == 3
    assert answers(run.run(df, [shout()])) == ["e:say a", "e:say b"]


def test_old_answers_can_be_left_out(spark, counting, inference):
    calls = counting()
    run = inference(calls)
    df = docs(spark, ["a"])
    old = run.store.open().schema
    key = df.select(shout().key).first()[0]
    long_ago = datetime(2020, 1, 1)
    row = (key, "old", long_ago, 1, 5, 3, None, "shout", "e", long_ago.date())
    run.store.append(spark.createDataFrame([row], old))
    assert answers(run.run(df, [shout()])) == ["old"] and not calls.prompts
    recent = replace(run, store=replace(run.store, reuse_days=7))
    assert answers(recent.run(df, [shout()])) == ["e:say a"] and len(calls.prompts) == 1
    plan = recent.store.for_tasks([shout()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_nothing_to_ask(spark, counting, inference):
    calls = counting()
    run = inference(calls)
    empty = spark.createDataFrame([], "id int, text string")
    assert run.run(empty, [shout()]).count() == 0
    assert answers(run.run(docs(spark, [None, None]), [shout()])) == [None, None]
    assert not calls.prompts


def test_rows_may_hold_maps_and_variants(spark, counting, inference):
    df = docs(spark, ["a"] * 60).withColumns(
        {"m": F.create_map(F.lit("k"), F.lit("v")), "v": F.parse_json(F.lit("[1]"))}
    )
    result = inference(counting(), hot_rows=10).run(df, [shout()])
    assert result.where("out.answer = 'e:say a'").count() == 60


def test_a_lost_worker_loses_no_answer(spark, counting, inference, tmp_path):
    marker = tmp_path / "died"

    def answer(endpoint, prompt, marker=str(marker)):
        import os

        if prompt == "say 30" and not os.path.exists(marker):
            open(marker, "w").close()
            os._exit(1)
        return prompt

    df = docs(spark, [str(i) for i in range(60)])
    run = inference(counting(answer), parallelism=3)
    assert answers(run.run(df, [shout()])) == [f"say {i}" for i in range(60)]
    assert marker.exists() and run.store.open().count() == 60


def mixed_rows(spark):
    """Prompts of one row, of several, and one answered before, over four partitions."""
    texts = [f"only {i}" for i in range(40)] + ["twice", "twice", "old", None] + ["often"] * 20
    return docs(spark, texts).repartition(4), texts


@pytest.mark.parametrize("shared_keys", [0, 1_000_000])
@pytest.mark.parametrize("rounds", [1, 3])
def test_shared_and_single_prompts_are_each_asked_once(
    spark, counting, inference, monkeypatch, shared_keys, rounds
):
    from transqa.operators import infer

    monkeypatch.setattr(infer, "SPREAD_CHARS", 0)
    monkeypatch.setattr(infer, "SHARED_KEYS", shared_keys)
    calls = counting()
    run = inference(calls, rounds=rounds)
    df, texts = mixed_rows(spark)
    run.run(docs(spark, ["old"]), [shout()])
    assert answers(run.run(df, [shout()])) == [None if t is None else f"e:say {t}" for t in texts]
    assert calls.prompts == sorted(("e", f"say {t}") for t in {*texts} - {None})


def test_prompts_of_one_row_are_sent_from_where_they_lie(spark, counting, inference):
    run = inference(counting())
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("id"), "text")
    keys = run.store.tables.replace(run._keys(df, [shout()]), "keys")
    alone = run._pending(df, [shout()], 0, None, keys.select(F.xxhash64("key").alias("_mark")), 0)
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
    marks = keys.where("copies > 1").select(F.xxhash64("key").alias("_mark")).distinct()
    mixed = run._pending(df, [shout()], 0, None, marks, 1)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan.split("Aggregate")[0] and "LeftSemi" in plan


def test_python_holds_a_slice_of_prompts_at_a_time():
    import pyarrow as pa

    from transqa.operators.infer import ARROW_SCHEMA, _caller

    class Echo:
        def complete(self, endpoint, prompt):
            return prompt

    columns = {c: [f"{c}{i}" for i in range(200)] for c in ("key", "task", "endpoint", "prompt")}
    out = list(_caller(Echo, 1)(iter([pa.RecordBatch.from_pydict(columns)])))
    assert [b.num_rows for b in out] == [64, 64, 64, 8]
    assert all(b.schema == ARROW_SCHEMA for b in out)
    assert pa.Table.from_batches(out)["answer"].to_pylist() == columns["prompt"]
