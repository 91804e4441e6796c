"""Batch inference over prompt columns: the one place that calls a model.

A model call costs far more than a shuffle, so the plan is built around making
each call once:

1. a narrow job finds the digests of all tasks' prompts, counts the rows behind each
   and marks those with a stored answer; no text moves for it;
2. prompts that one row alone asks, which are most, are sent from where they lie; only
   those that several rows share are reduced to distinct ones, map side first;
3. they go to the client by ``mapInArrow``, which the optimizer can neither repeat nor
   move, a few at a time; loads too small to fill the cores, and any with a wished number of
   partitions, are spread first;
4. answers are appended to a table, and only then joined back to the rows.

Step 4 makes the returned DataFrame free of calls: using it twice costs a join,
not a model.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone
from functools import reduce
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transqa.functions.text import col
from transqa.operators.joins import salts_for, spread_left_join
from transqa.sources.tables import StageTables

ANSWER_TYPE = "struct<answer:string,error:string>"
ANSWERS_SCHEMA = (
    "key string, answer string, started_at timestamp, duration_ms bigint, "
    "in_chars int, out_chars int, error string, task string, endpoint string, day date"
)
PARTITION_COLUMNS = ("task", "endpoint", "day")
ARROW_SCHEMA = pa.schema([
    ("key", pa.string()), ("answer", pa.string()), ("started_at", pa.timestamp("us", "UTC")),
    ("duration_ms", pa.int64()), ("in_chars", pa.int32()), ("out_chars", pa.int32()),
    ("error", pa.string()), ("task", pa.string()), ("endpoint", pa.string()), ("day", pa.date32()),
])
CHUNK = 64
#: Shared keys that are told to every executor as hashes; beyond it all prompts are shuffled.
SHARED_KEYS = 1_000_000
#: Characters to send per core below which spreading the calls costs little.
SPREAD_CHARS = 64 << 20


class ModelClient(Protocol):
    """What a model service must offer; one is made per Spark task.

    With more than one thread per task, ``complete`` is called from all of them.
    """

    def complete(self, endpoint: str, prompt: str) -> str: ...


ClientFactory = Callable[[], ModelClient]


@dataclass(frozen=True)
class Task:
    """One prompt column to be answered into ``out``.

    Rows outside ``when``, which must not be NULL, and rows whose prompt is NULL are
    never sent. ``name`` becomes the span name, and ``endpoint`` may be a column, so that rows
    choose their model.
    """

    name: str
    endpoint: str | Column
    prompt: Column
    out: str
    when: Column | None = None

    @property
    def endpoint_column(self) -> Column:
        return self.endpoint if isinstance(self.endpoint, Column) else F.lit(self.endpoint)

    @property
    def key(self) -> Column:
        """Digest that names the call: NULL when there is nothing to ask."""
        digest = call_key(F.lit(self.name), self.endpoint_column, self.prompt)
        return digest if self.when is None else F.when(self.when, digest)

    def only(self, condition: Column) -> Task:
        """The same task, asked for fewer rows."""
        return replace(self, when=condition if self.when is None else self.when & condition)


def call_key(task: Column | str, endpoint: Column | str, prompt: Column | str) -> Column:
    """Digest of a call; NULL when its prompt is."""
    return F.sha2(F.concat(col(task), F.lit("|"), col(endpoint), F.lit("|"), col(prompt)), 256)


@dataclass(frozen=True)
class HotKeys:
    """Calls that very many rows share, as a narrow table ``(key, salts)``.

    The table is written by the job that finds distinct prompts and read by the joins
    that attach answers; no key passes through the driver. With ``rows`` rows a call
    at least, there are at most rows / ``rows`` of them.
    """

    table: DataFrame | None = None
    rows: int = 200_000


@dataclass(frozen=True)
class AnswerStore:
    """The answers table, partitioned by task, endpoint and day of the call.

    Runs that write at the same time need a table each, as Spark's file commits do.

    ``reuse_days`` looks for answers in the newest days only. A stream needs that, or
    each of its batches would read the digests of all answers ever given; an older
    prompt is then asked anew.
    """

    tables: StageTables
    table: str = "answers"
    reuse_days: int | None = None
    since: date | None = None

    def pinned(self) -> AnswerStore:
        """The same store with its cutoff day fixed, in UTC as the days of the calls are.

        Asking and joining then see the same answers, whatever day it is by then.
        """
        if self.reuse_days is None or self.since is not None:
            return self
        return replace(self, since=datetime.now(timezone.utc).date() - timedelta(days=self.reuse_days))

    def open(self) -> DataFrame:
        answers = self.tables.create_or_load(self.table, ANSWERS_SCHEMA, PARTITION_COLUMNS)
        since = self.pinned().since
        return answers if since is None else answers.where(F.col("day") >= F.lit(since))

    def for_tasks(self, tasks: Sequence[Task]) -> DataFrame:
        """Answers of the tasks, from their partitions alone."""
        rows = self.open().where(F.col("task").isin(*{t.name for t in tasks}))
        endpoints = {t.endpoint for t in tasks if isinstance(t.endpoint, str)}
        if any(not isinstance(t.endpoint, str) for t in tasks):
            return rows
        return rows.where(F.col("endpoint").isin(*endpoints))

    def latest(self, tasks: Sequence[Task]) -> DataFrame:
        """One answer per key: a good one before an error, then the newest.

        A retried Spark task may call again for a prompt it had already asked,
        so a key can have several rows.
        """
        order = F.struct(F.col("error").isNull().alias("good"), F.col("started_at"))
        return (
            self.for_tasks(tasks)
            .groupBy("key")
            .agg(F.max_by(F.struct("answer", "error"), order).alias("reply"))
        )

    def append(self, answers: DataFrame) -> None:
        self.tables.append(answers, self.table, PARTITION_COLUMNS)


@dataclass(frozen=True)
class Inference:
    """How calls are made: the client, the store and the load put on the service.

    ``parallelism`` is the number of partitions calls are spread over; with
    ``threads_per_task`` it bounds the calls in flight. ``rounds`` splits the work
    into that many appends, so a lost driver repeats at most one round. A call
    shared by ``hot_rows`` rows or more is spread when answers are joined.
    """

    client_factory: ClientFactory
    store: AnswerStore
    parallelism: int | None = None
    threads_per_task: int = 1
    rounds: int = 1
    hot_rows: int = 200_000

    def run(
        self, df: DataFrame, tasks: Sequence[Task], carry: Sequence[str] | None = None
    ) -> DataFrame:
        """Answer the tasks' prompts for every row; adds one struct column per task.

        ``carry`` names the columns to keep; leaving texts out of it keeps them
        out of the join.
        """
        run = replace(self, store=self.store.pinned())
        hot = run.answer(df, tasks)
        return attach_answers(df, tasks, run.store, carry, hot)

    def answer(self, df: DataFrame, tasks: Sequence[Task]) -> HotKeys:
        """Call the model for prompts that have no good answer yet.

        One narrow job writes the digest of every prompt with the rows behind it and
        whether it has a good answer. The calls shared by many rows are then read from it
        as a table ``(key, salts)``, and so is which prompts must be reduced to distinct
        ones. A round's prompts are chosen by their digests before any text moves.
        """
        stage = f"{self.store.table}_prompts"
        keys = self.store.tables.replace(self._keys(df, tasks), stage)
        hot = self.store.tables.replace(
            keys.where(F.col("copies") >= self.hot_rows).select(
                "key", salts_for(F.col("copies"), self.hot_rows).alias("salts")),
            f"{self.store.table}_hot",
        )
        shared = F.col("answered") | (F.col("copies") > 1)
        load = keys.agg(
            F.count_if(shared).alias("shared"), F.count_if(~F.col("answered")).alias("pending"),
            F.count_if("answered").alias("answered"),
            F.sum(F.when(~F.col("answered"), F.col("chars"))).alias("chars"),
            F.max("part").alias("part"),
        ).first()
        if load["pending"]:
            cores = df.sparkSession.sparkContext.defaultParallelism
            spread = (
                self.parallelism is not None
                or load["part"] + 1 < cores
                or load["chars"] < cores * SPREAD_CHARS
            )
            done = keys.where("answered").select("key") if load["answered"] else None
            marks = None
            if load["shared"] <= SHARED_KEYS:
                marks = keys.where(shared).select(F.xxhash64("key").alias("_mark")).distinct()
            for number in range(self.rounds):
                batch = self._pending(df, tasks, number, done, marks, load["shared"])
                self.store.append(self._call(self._spread(batch) if spread else batch))
        self.store.tables.drop(stage)
        return HotKeys(hot, self.hot_rows)

    def _keys(self, df: DataFrame, tasks: Sequence[Task]) -> DataFrame:
        """Digest of each distinct prompt, its rows, length and whether it has a good answer."""
        found = (
            all_prompts(df, tasks)
            .select("key", F.length("prompt").alias("chars"), F.spark_partition_id().alias("part"))
            .groupBy("key")
            .agg(F.count("*").alias("copies"), F.max("chars").alias("chars"), F.max("part").alias("part"))
        )
        return found.join(self._answered(tasks), "key", "left").select(
            "key", "copies", "chars", "part", F.col("answered").isNotNull().alias("answered"))

    def _answered(self, tasks: Sequence[Task]) -> DataFrame:
        good = self.store.for_tasks(tasks).where(F.col("error").isNull())
        return good.select("key").distinct().withColumn("answered", F.lit(True))

    def _pending(
        self, df: DataFrame, tasks: Sequence[Task], number: int, done: DataFrame | None,
        marks: DataFrame | None, shared: int,
    ) -> DataFrame:
        """The prompts of a round, each once: those of one row from where they lie.

        ``marks`` hashes the digests that several rows share or that are answered. A
        digest that only hashes like one of them takes the way of the shared ones, which
        goes by whole digests. Without marks all prompts take that way.
        """
        rows = all_prompts(df, tasks)
        if self.rounds > 1:
            rows = rows.where(F.pmod(F.xxhash64("key"), F.lit(self.rounds)) == number)
        if marks is not None and not shared:
            return rows
        several = rows
        if marks is not None:
            rows = rows.withColumn("_mark", F.xxhash64("key"))
            several = rows.join(F.broadcast(marks), "_mark", "left_semi").drop("_mark")
        several = several.groupBy("key").agg(
            *[F.first(c).alias(c) for c in ("task", "endpoint", "prompt")])
        if done is not None:
            several = several.join(done, "key", "left_anti")
        if marks is None:
            return several
        return rows.join(F.broadcast(marks), "_mark", "left_anti").drop("_mark").unionByName(several)

    def unanswered(self, df: DataFrame, tasks: Sequence[Task]) -> DataFrame:
        """Distinct prompts still to be sent, spread as for calling.

        Both sides of the join are partitioned by key: only digests of the stored
        answers are shuffled for it.
        """
        marked = distinct_prompts(df, tasks).join(self._answered(tasks), "key", "left")
        return self._spread(
            marked.where(F.col("answered").isNull()).select("key", "task", "endpoint", "prompt"))

    def _spread(self, prompts: DataFrame) -> DataFrame:
        """Exactly the wished number of partitions.

        Hashing something else than the bare key keeps this shuffle from being
        merged into the one before, which adaptive execution may make smaller.
        """
        session = prompts.sparkSession
        count = self.parallelism or session.sparkContext.defaultParallelism
        return prompts.repartition(count, F.xxhash64("key"))

    def _call(self, prompts: DataFrame) -> DataFrame:
        call = _caller(self.client_factory, self.threads_per_task)
        return prompts.select("key", "task", "endpoint", "prompt").mapInArrow(call, ANSWERS_SCHEMA)


def all_prompts(df: DataFrame, tasks: Sequence[Task]) -> DataFrame:
    """``(key, task, endpoint, prompt)`` of every row and task with something to ask."""
    # A prompt is built once per row: its digest is taken from the finished column.
    prompts = [t.prompt if t.when is None else F.when(t.when, t.prompt) for t in tasks]
    conditions = [t.when for t in tasks]
    if all(c is not None for c in conditions):
        df = df.where(_either(conditions))
    if len(tasks) == 1:
        rows = df.select(
            F.lit(tasks[0].name).alias("task"),
            tasks[0].endpoint_column.alias("endpoint"),
            prompts[0].alias("prompt"),
        )
    else:
        asked = [
            F.struct(
                F.lit(t.name).alias("task"), t.endpoint_column.alias("endpoint"), p.alias("prompt")
            )
            for t, p in zip(tasks, prompts)
        ]
        rows = df.select(F.explode(F.array(*asked)).alias("p")).select("p.*")
    return rows.where(F.col("prompt").isNotNull()).select(
        call_key("task", "endpoint", "prompt").alias("key"), "task", "endpoint", "prompt"
    )


def distinct_prompts(df: DataFrame, tasks: Sequence[Task]) -> DataFrame:
    """Distinct ``(key, task, endpoint, prompt)`` over all tasks, and their ``copies``.

    Duplicates are dropped by digest before and after the shuffle, so
    a prompt shared by a third of all rows travels once per input partition.
    """
    return all_prompts(df, tasks).groupBy("key").agg(
        *[F.first(c).alias(c) for c in ("task", "endpoint", "prompt")],
        F.count("*").alias("copies"),
    )


def attach_answers(
    df: DataFrame,
    tasks: Sequence[Task],
    store: AnswerStore,
    carry: Sequence[str] | None = None,
    hot: HotKeys = HotKeys(),
) -> DataFrame:
    """Join stored answers to rows.

    Rows outside every task's ``when`` skip the join in a branch of their own; in
    the join they would all carry a NULL key and meet in one partition. However
    many tasks there are, rows are shuffled once: answers are first gathered per
    distinct set of keys, for which only digests move.
    """
    columns = list(df.columns if carry is None else carry)
    outs = [t.out for t in tasks]
    answers = store.latest(tasks)
    conditions = [t.when for t in tasks]
    split = all(c is not None for c in conditions)
    asked = df.where(_either(conditions)) if split else df
    row_hash = _row_hash(df) if hot.table is not None else F.lit(0)

    if len(tasks) == 1:
        replies = answers.select(F.col("key").alias("_set"), F.col("reply").alias(outs[0]))
        rows = asked.select(*columns, tasks[0].key.alias("_set"), row_hash.alias("_row"))
        joined = spread_left_join(rows, replies, "_set", hot.table, F.col("_row"))
    else:
        keys = F.array(*[t.key for t in tasks])
        rows = asked.select(*columns, keys.alias("_keys"), row_hash.alias("_row"))
        key_set = F.sha2(F.array_join("_keys", "|", "-"), 256)
        # Never NULL, which spares a filter that would digest every row again.
        rows = rows.withColumn("_set", F.coalesce(key_set, F.lit("")))
        # Distinct sets of keys and the rows behind each, in one aggregate that the
        # gathering and the choice of hot sets share (Spark reuses its exchange).
        sets = rows.groupBy("_set").agg(F.first("_keys").alias("_keys"), F.count("*").alias("copies"))
        gathered = _gather(sets, answers, outs, hot)
        hot_sets = None
        if hot.table is not None:
            hot_sets = sets.where(F.col("copies") >= hot.rows).select(
                F.col("_set").alias("key"), salts_for(F.col("copies"), hot.rows).alias("salts"))
        joined = spread_left_join(rows.drop("_keys"), gathered, "_set", hot_sets, F.col("_row"))
    joined = joined.select(*columns, *outs)
    if not split:
        return joined
    nothing = F.lit(None).cast(ANSWER_TYPE)
    idle = df.where(~_either(conditions)).select(*columns, *[nothing.alias(o) for o in outs])
    return joined.unionByName(idle)


def _gather(sets: DataFrame, answers: DataFrame, outs: Sequence[str], hot: HotKeys) -> DataFrame:
    """Answers of each distinct set of keys, side by side."""
    members = (
        sets.select("_set", F.posexplode_outer("_keys").alias("slot", "key"))
        .where(F.col("key").isNotNull())
    )
    found = spread_left_join(members, answers, "key", hot.table, F.xxhash64("_set"))
    by_slot = [
        F.max(F.when(F.col("slot") == i, F.col("reply"))).alias(out) for i, out in enumerate(outs)
    ]
    return found.groupBy("_set").agg(*by_slot)


def _row_hash(df: DataFrame) -> Column:
    """A hash of the row, to tell apart rows that share a call."""
    plain = [
        f.name for f in df.schema.fields
        if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()
    ]
    return F.xxhash64(*plain) if plain else F.lit(0)


def _either(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _caller(
    factory: ClientFactory, threads: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sends a batch's prompts a slice at a time: Python holds no more texts and answers than that."""
    def call(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = factory()

        def ask(row: dict) -> dict:
            started = datetime.now(timezone.utc)
            clock = time.perf_counter()
            answer, error = None, None
            try:
                answer = client.complete(row["endpoint"], row["prompt"])
            except Exception as failure:  # noqa: BLE001 - a failed call is a row, not a failed job
                error = f"{type(failure).__name__}: {failure}"
            return {
                "key": row["key"], "answer": answer, "started_at": started,
                "duration_ms": round((time.perf_counter() - clock) * 1000),
                "in_chars": len(row["prompt"]), "out_chars": None if answer is None else len(answer),
                "error": error, "task": row["task"], "endpoint": row["endpoint"],
                "day": started.date(),
            }

        step = CHUNK * max(threads, 1)
        with ThreadPoolExecutor(max(threads, 1)) as pool:
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    rows = batch.slice(start, step).to_pylist()
                    done = pool.map(ask, rows) if threads > 1 else map(ask, rows)
                    yield pa.RecordBatch.from_pylist(list(done), ARROW_SCHEMA)

    return call
