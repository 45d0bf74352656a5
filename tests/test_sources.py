"""Sheets (CSV), markdown trees, JSON lookups."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.operators import evaluate as E
from tidemark.sources import derived as S
from tidemark.sources import tables as TB


def test_site_sheet_and_question_sheet_from_csv(spark):
    d = tempfile.mkdtemp(prefix="sheet-")
    with open(os.path.join(d, "sites.csv"), "w") as fh:
        fh.write("URL,Note\nhttps://www.uni.example/de/a.html,x\n,empty\nhttp://http://b.ch/,odd\nhttps://uni.example/b,dup\n")
    sheet = TB.read_sheet(spark, os.path.join(d, "sites.csv")).coalesce(1).withColumn("row", F.monotonically_increasing_id())
    assert sorted(r.domain for r in S.site_list(sheet).collect()) == ["b.ch", "uni.example"]
    assert {r.domain: r.base_url for r in S.domain_map(sheet).collect()} == {"uni.example": "https://www.uni.example", "b.ch": "http://http:"}
    with open(os.path.join(d, "q.csv"), "w") as fh:
        fh.write(" Question ,Relevant_Doc_1,relevant doc 2,Other\nq1, https://uni.example/a ,,x\n  ,https://uni.example/c,,y\nq3,,https://uni.example/d,z\n")
    qs, rel = E.questions_long(TB.read_sheet(spark, os.path.join(d, "q.csv")))
    assert sorted(r.question for r in qs.collect()) == ["q1", "q3"]
    assert sorted((r.pos, r.url) for r in rel.collect()) == [(1, "https://uni.example/a"), (2, "https://uni.example/d")]


def test_markdown_tree_and_forced_domain(spark):
    root = tempfile.mkdtemp(prefix="md-")
    for rel, text in [("uni.example/en.md", "# T\nbody"), ("uni.example/sub/x.md", "x"), ("b.ch/index.md", "i")]:
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        with open(os.path.join(root, rel), "w") as fh:
            fh.write(text)
    with open(os.path.join(root, "ignore.txt"), "w") as fh:
        fh.write("no")
    got = sorted((r.file_path, r.domain, r.text) for r in TB.markdown_tree(spark, root).collect())
    assert got == [("b.ch/index.md", "b.ch", "i"), ("uni.example/en.md", "uni.example", "# T\nbody"), ("uni.example/sub/x.md", "uni.example", "x")]
    forced = sorted(r.file_path for r in TB.markdown_tree(spark, os.path.join(root, "uni.example"), force_domain="uni.example").collect())
    assert forced == ["uni.example/en.md", "uni.example/sub/x.md"]


def test_json_map_and_list(spark):
    d = tempfile.mkdtemp(prefix="json-")
    with open(os.path.join(d, "ts.json"), "w") as fh:
        json.dump({"uni.example/en.html": "2025-04-10T10:56:48", "b.ch/x.html": None}, fh)
    with open(os.path.join(d, "done.json"), "w") as fh:
        json.dump(["a.md", "b.md"], fh)
    m = {r.key: r.value for r in TB.read_json_map(spark, os.path.join(d, "ts.json")).collect()}
    assert m == {"uni.example/en.html": "2025-04-10T10:56:48", "b.ch/x.html": None}
    assert sorted(r.file_path for r in TB.read_json_list(spark, os.path.join(d, "done.json")).collect()) == ["a.md", "b.md"]


def test_shared_table_follows_its_files(spark, tmp_path):
    from tidemark.session import shared_table

    path = str(tmp_path / "in")
    build = lambda: spark.read.parquet(path + "/t.parquet")
    spark.range(3).coalesce(1).write.parquet(path + "/t.parquet")
    first = shared_table(spark, ("test-shared",), path, build)
    assert first.count() == 3 and shared_table(spark, ("test-shared",), path, build) is first
    spark.range(5).coalesce(1).write.mode("overwrite").parquet(path + "/t.parquet")
    assert shared_table(spark, ("test-shared",), path, build).count() == 5
