import itertools

from pyspark.sql import functions as F

from transqa.operators import routing


def python_status(lang, semantic, complete):
    if (lang or "").strip() == "en":
        return "SKIPPED"
    passed = [bool(semantic), bool(complete)]
    return "APPROVED" if all(passed) else "NEEDS_REVIEW" if any(passed) else "REJECTED"


CASES = list(itertools.product(["en", " en\n", "fr", "EN", None], [True, False, None], [True, False, None]))


def routed(spark):
    df = spark.createDataFrame(
        [(i, *c) for i, c in enumerate(CASES)],
        "doc_id long, detected_language string, s boolean, c boolean",
    )
    status = routing.status("detected_language", F.col("s"), F.col("c"))
    return df.withColumn("status", status).withColumns(
        {"semantic_preservation_rationale": F.lit("s"), "completeness_rationale": F.lit("c")}
    )


def test_status_of_every_combination(spark):
    rows = routed(spark).orderBy("doc_id").collect()
    assert [r["status"] for r in rows] == [python_status(*c) for c in CASES]


def test_statuses_partition_the_documents(spark):
    counts = routing.status_counts(routed(spark)).collect()
    assert sum(r["count"] for r in counts) == len(CASES)
    assert [r["count"] for r in counts] == sorted((r["count"] for r in counts), reverse=True)


def test_review_queue_is_a_top_k(spark):
    queue = routing.review_queue(routed(spark), "doc_id", 10)
    want = [i for i, c in enumerate(CASES) if python_status(*c) in ("REJECTED", "NEEDS_REVIEW")][:10]
    assert [r["doc_id"] for r in queue.collect()] == want
    assert "TakeOrderedAndProject" in queue._jdf.queryExecution().executedPlan().toString()


def test_results_follow_the_key_and_not_the_position(spark):
    paths = [("/a/x.pdf", "one"), ("/b/x.pdf", "two"), ("/c/y.pdf", "three")]
    translations = spark.createDataFrame(paths, "source_path string, extracted_text string")
    scores = spark.createDataFrame(
        [(p, f"status {t}", "s", "c") for p, t in reversed(paths[:2])],
        "source_path string, status string, semantic_preservation_rationale string, "
        "completeness_rationale string",
    )
    rows = routing.attach_results(translations, scores, "source_path").collect()
    assert {r["extracted_text"]: r["status"] for r in rows} == {
        "one": "status one", "two": "status two", "three": None,
    }
