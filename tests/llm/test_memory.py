"""What tasks hold and intermediate tables leave: bounded, whatever ran before."""

import os
import time
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from transqa.llm import minhash, passages, sentencepiece
from transqa.llm import shingles as sh
from transqa.llm.common import CLEANUP, stored
from transqa.llm.sentencepiece import NORMAL, UNKNOWN, Codec, Model


class Plain:
    """A table whose kernel is handed back."""

    def mapInArrow(self, kernel, schema):
        return kernel


def test_a_worker_holds_one_codec(spark):
    def model(extra):
        pieces = ["<unk>", "a", "b", extra]
        return Model(pieces, [0.0] * 4, [UNKNOWN, NORMAL, NORMAL, NORMAL], False, True, 0)

    first = sentencepiece._codec(sentencepiece._Shared(spark, model("c")))
    assert sentencepiece._codec(sentencepiece._Shared(spark, model("c"))) is first
    other = sentencepiece._codec(sentencepiece._Shared(spark, model("d")))
    assert isinstance(other, Codec) and "d" in other.by_text and "d" not in first.by_text
    assert len(sentencepiece._codecs) == 1


def test_sketches_of_short_sets():
    n, size = 5000, 4
    values = np.arange(n * size, dtype=np.uint64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n)), sh.lists(values, np.arange(n + 1) * size)], ["id", "full"])
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in minhash._sketches(Plain())(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == n
    assert peak < 60e6


def test_stored_leaves_no_shuffle_files(spark):
    def files():
        folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    old = files()
    rows = spark.range(1000).withColumn("k", F.col("id") % 100).groupBy("k").count()
    kept = stored(rows, "counted")
    until = time.time() + 20
    while files() - old and time.time() < until:
        time.sleep(0.2)
    assert not files() - old
    assert kept.count() == 100
    assert spark.conf.get(CLEANUP, None) is None


def test_surroundings_are_hashed_once_per_kind(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(passages, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    part = " ".join(f"p{i}" for i in range(60))
    texts = [(i, f"{part} " + " ".join(f"e{i % 2}x{j}" for j in range(30))) for i in range(40)]
    got = passages.repeated_passages(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r.doc_id: r.n_shared for r in got.collect()} == dict.fromkeys(range(40), 90)
    assert "keys" not in kept["around"].columns + kept["open_floats"].columns
    rows = kept["surroundings"]
    assert rows.count() == rows.select("right", "full").distinct().count() < kept["open_floats"].count()
