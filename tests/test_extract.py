import json

from pyspark.sql import functions as F

from transqa.functions.elements import document_elements, elements_text, page_count
from transqa.functions.judgment import parse_judgment
from transqa.operators.extract import extract_text, parse_html, parse_with, with_text
from transqa.sources.files import scan_files, table_as_files, write_text_files


def parsed(spark, documents):
    rows = [(f"/in/{i}.pdf", json.dumps(d)) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "source_path string, j string").select(
        "source_path", F.parse_json("j").alias("parsed_result")
    )


DOCUMENTS = [
    {"document": {"elements": [
        {"type": "title", "content": "T", "id": 7}, {"type": "table", "content": "no"},
        {"type": "text", "content": "a"}, {"type": "text", "content": None},
        {"type": "section_header", "content": ""}, {"type": "text"}, {"type": "text", "content": "b"},
    ], "pages": [{"id": 0, "image_uri": "u"}, {"id": 1}]}},
    {"document": {"elements": [], "pages": []}},
    {"document": {}},
    {"document": {"elements": [{"type": "table", "content": "x"}]}},
]


def test_text_of_elements(spark):
    rows = extract_text(parsed(spark, DOCUMENTS)).orderBy("source_path").collect()
    assert [r["extracted_text"] for r in rows] == ["T\n\na\n\n\n\nb", "", "", ""]
    assert [r["num_pages"] for r in rows] == [2, 0, None, None]
    assert rows[0]["file_name"] == "0.pdf" and rows[0]["parsed_at"] is not None


def test_time_can_be_fixed(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    row = extract_text(parsed(spark, DOCUMENTS[:1]), as_of=at).first()
    assert str(row["parsed_at"]) == "2024-01-01 00:00:00"


def test_empty_text_is_dropped_only_on_demand(spark):
    docs = extract_text(parsed(spark, DOCUMENTS))
    assert with_text(docs).count() == 4
    assert with_text(docs, 1).count() == 1


def test_html_keeps_document_order(spark):
    html = (
        "<html><title>A &amp; B</title><script>var t='<p>no</p>';</script><!-- <p>no</p> -->"
        "<P class='x'>one <b>bold</b></P><pre>no</pre><h1>Head</h1><ul><li>item</li></ul><p>two\n</p>"
    )
    files = table_as_files(spark.createDataFrame([("http://x/y", html)], "u string, h string"), "u", "h")
    result = parse_html(files)
    elements = result.select(F.explode(document_elements("parsed_result")).alias("e")).select("e.*")
    assert [tuple(r) for r in elements.collect()] == [
        ("title", "A & B"), ("text", "one bold"), ("section_header", "Head"),
        ("list_item", "item"), ("text", "two"),
    ]
    assert result.select(page_count("parsed_result")).first()[0] == 1
    assert result.select(elements_text(document_elements("parsed_result"), ["list_item"])).first()[0] == "item"


def test_files_by_glob_and_own_parser(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.pdf").write_bytes(b"%PDF one")
    (tmp_path / "sub" / "b.pdf").write_bytes(b"%PDF two")
    (tmp_path / "c.txt").write_bytes(b"no")

    def parser():
        def parse(content):
            element = {"type": "text", "content": bytes(content).decode()}
            return json.dumps({"document": {"elements": [element], "pages": [{"id": 0}]}})

        return parse

    assert scan_files(spark, str(tmp_path)).count() == 1
    files = scan_files(spark, str(tmp_path), recursive=True)
    assert files.columns == ["path", "content"]
    rows = extract_text(parse_with(files, parser)).orderBy("file_name").collect()
    assert [(r["file_name"], r["extracted_text"], r["num_pages"]) for r in rows] == [
        ("a.pdf", "%PDF one", 1), ("b.pdf", "%PDF two", 1),
    ]


def test_broken_parser_output_gives_no_document(spark):
    files = spark.createDataFrame([("/a.pdf", bytearray(b"x"))], "path string, content binary")
    row = extract_text(parse_with(files, lambda: lambda content: "not json")).first()
    assert row["parsed_result"] is None and row["extracted_text"] == ""
    found = parse_with(files, lambda: lambda content: "not json").first()
    assert found["parse_error"] == "no JSON"


def test_a_bad_file_does_not_end_the_parse(spark):
    def parser():
        def parse(content):
            if content == b"bad":
                raise ValueError("torn")
            return '{"document": {"elements": []}}'

        return parse

    files = spark.createDataFrame(
        [("/a", bytearray(b"bad")), ("/b", bytearray(b"good"))], "path string, content binary")
    rows = parse_with(files, parser).orderBy("source_path").collect()
    assert [(r["source_path"], r["parsed_result"] is None, r["parse_error"]) for r in rows] == [
        ("/a", True, "ValueError: torn"), ("/b", False, None)]


def test_judge_replies(spark):
    ok = '{"passed": true, "rationale": "r"}'
    cases = [
        (ok, True, "r", None),
        (f"```json\n{ok}\n```", True, "r", None),
        (f"```json {ok}```", None, None, "judge_json"),
        (f"```\n{ok}", True, "r", None),
        (ok[:-3], None, None, "judge_json"),
        ('{"rationale": "r"}', False, "r", None),
        ('{"passed": "true"}', False, "No rationale provided", None),
        ('{"passed": 1, "rationale": null}', False, "No rationale provided", None),
        ('{"passed": null, "rationale": "r"}', False, "r", None),
        (f"[{ok}]", None, None, "judge_json"),
        ("", None, None, "judge_json"),
        ("true", None, None, "judge_json"),
        (None, None, None, "null_input"),
    ]
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, r string")
    got = rows.orderBy("i").select(parse_judgment("r").alias("f")).select("f.*").collect()
    assert [tuple(r) for r in got] == [c[1:] for c in cases]


def test_rows_are_written_as_files_in_a_folder_per_task(spark, tmp_path):
    texts = ["a", "b\nc", "", "a", None, "ü"] * 5
    df = spark.createDataFrame([(t,) for t in texts], "html string").repartition(3)
    write_text_files(df, "html", str(tmp_path / "out"))
    # A commit moves folders, not files: none lies in the top folder.
    assert not list((tmp_path / "out").glob("*.txt"))
    assert 1 < len(list((tmp_path / "out").glob("task=*"))) <= 3
    found = scan_files(spark, str(tmp_path / "out"), "*.txt", recursive=True)
    got = sorted(bytes(r[0]).decode() for r in found.select("content").collect())
    assert got == sorted(f"{t or ''}\n" for t in texts)
