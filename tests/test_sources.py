import os
import random

import pytest
from pyspark.sql import functions as F

from sluice.functions import text as T
from sluice.sources import readers, sinks


def test_csv_mark_and_required(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿name,n\nx,1\n\"y\"\"z\",\n".encode())
    df = readers.read_csv(spark, str(path), required=["name"])
    assert [tuple(r) for r in df.collect()] == [("x", "1"), ('y"z', None)]
    with pytest.raises(ValueError, match="missing columns other"):
        readers.read_csv(spark, str(path), required=["other"])


def test_json_lines(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"key": "a", "n": 1}\nbroken\n{"n": 2}\n{"key": "", "n": 3}\n')
    schema = spark.createDataFrame([], "key string, n long").schema
    assert [tuple(r) for r in readers.read_jsonl_lenient(spark, str(path), schema, "key").collect()] == [("a", 1)]
    with pytest.raises(Exception):
        readers.read_jsonl_strict(spark, str(path), schema).collect()


def test_listings(spark, tmp_path):
    for name in ("m__law__y100-115__20240101.csv", "m__law__y100-115__20240201.csv", "m__med__y100-115__20230101.csv", "vlm/q.md", "ocr/q.md", "ocr/r.md", "p.PNG", "none.txt"):
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_text("" if name.endswith("txt") else "text")
    listing = readers.files(spark, str(tmp_path))
    assert [(r.category, r.ts) for r in readers.latest_manifests(listing).collect()] == [("law", "20240201"), ("med", "20230101")]
    wanted = spark.createDataFrame([("q",), ("r",), ("none",)], "stem string")
    got = {r.stem: r.markdown and r.markdown.split("/")[-2] for r in readers.resolve_markdown(wanted, listing).collect()}
    assert got == {"q": "vlm", "r": "ocr", "none": None}
    assert readers.images(listing).count() == 1
    assert readers.folder_counts(listing, readers.empty_files(spark, str(tmp_path))).agg(F.sum("n"), F.sum("n_empty")).first()[:] == (8, 1)


def test_catalog_pages(spark):
    html = '<label for="chk_113_101_0201">Anatomy <b>I</b></label><a href="f?t=Q&amp;code=113&amp;c=101&amp;s=0201">q</a><a href="f?t=S&code=113&c=101&s=0201">a</a><a href="f?t=M&code=113&c=102&s=0301">m</a>'
    rows = readers.catalog_links(spark.createDataFrame([(html,)], "html string")).collect()
    assert [(r.subject, r.name, r.has_question, r.has_answer, r.has_correction, r.notes) for r in rows] == [("0201", "Anatomy I", True, True, False, ""), ("0301", None, False, False, True, "link without label; no question link")]
    options = readers.option_list(spark.createDataFrame([('<option value="113020">A</option><option value="099010">B</option>',)], "h string"), "h", 100, 115)
    assert [tuple(r) for r in options.collect()] == [("113020", "A")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", None)], "b int, a string, c string")
    sinks.write_jsonl(df, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").first()[0] == '{"a":"é","b":1,"c":null}'
    sinks.append_events(df, f"{tmp_path}/j")
    assert spark.read.text(f"{tmp_path}/j").count() == 2
    sinks.write_csv(df, f"{tmp_path}/c", ["a", "z"])
    assert readers.read_csv(spark, f"{tmp_path}/c").columns == ["a", "z"]
    text = sinks.stage_text(df)
    assert text.first()[:] == ("1", "é", "")
    assert sinks.typed(text, {"b": "int"}).first()[:] == (1, "é", None)
    assert sinks.evolve(df, {"d": "int", "a": "string"}).columns == ["b", "a", "c", "d"]
    bad = spark.createDataFrame([(1, "x", 5), (1, "y", 6)], "k int, role string, ref int")
    found = sinks.constraint_violations(bad, [["k"]], {"role": ["x"]}, {"ref": (spark.createDataFrame([(5,)], "id int"), "id")})
    assert {r.violated: r.n for r in found.collect()} == {"unique k": 1, "values role": 1, "reference ref": 1}
    assert spark.read.parquet(sinks.rewrite_versioned(df, f"{tmp_path}/v")).count() == 1


def test_bad_lines_are_named(spark, tmp_path):
    """Line numbers over files that are read in many splits."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("a int, b string")
    good = '{"a": 1, "b": "%s"}\n' % ("x" * 50)
    for name, bad in (("one.jsonl", 3000), ("two.jsonl", None), ("three.jsonl", 1)):
        lines = [good] * 4000
        if bad:
            lines[bad - 1] = '{"a": "no number"\n'
            lines[3500] = "[\n"
        lines[10] = "\n"
        (tmp_path / name).write_text("".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        found = {r.path.rsplit("/", 1)[1]: r.line for r in readers.first_bad_lines(spark, str(tmp_path), schema).collect()}
        assert found == {"one.jsonl": 3000, "three.jsonl": 1}
        with pytest.raises(ValueError, match="one.jsonl:3000:"):
            readers.read_jsonl_strict(spark, str(tmp_path), schema)
        assert readers.read_jsonl_strict(spark, str(tmp_path / "two.jsonl"), schema).count() == 3999
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bytes_that_are_not_utf8(spark, tmp_path):
    rng = random.Random(1)
    for i in range(60):
        (tmp_path / f"{i}.md").write_bytes(b"a\xe9\xff " + bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0x80, 0xFF, 0xED, 0xA0]) for _ in range(12)))
    for r in readers.markdown_documents(spark, str(tmp_path)).collect():
        assert r.text == (tmp_path / r.path.rsplit("/", 1)[1]).read_bytes().decode("utf-8", "replace")


def test_html_text(spark):
    text = "<p>a &amp; b&nbsp;&#21644;&#x4e2d; &copy; &lt;x&gt;\n\n <b>c</b>&unknown;</p>"
    assert spark.createDataFrame([(text,), (None,)], "t string").select(T.html_text(F.col("t")).alias("t")).collect()[0].t == "a & b 和中 © <x> c&unknown;"
