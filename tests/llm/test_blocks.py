"""Blocks of the search index are bounded, whatever terms their documents share."""

from transqa.llm.search import build_index


def test_a_common_term_gathers_no_block(spark):
    docs = spark.createDataFrame([(i, f"the same words everywhere {i % 3}") for i in range(1000)], "doc_id long, text string")
    index = build_index(docs, block=8)
    sizes = [len(r.key) for r in index.blocks.collect()]
    assert sum(sizes) == index.count == 1000 and max(sizes) <= 8
