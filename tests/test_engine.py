import gzip
import json
import os

from pyspark.sql import functions as F

import __spark_entry__
from folioforge import cli
from folioforge.operators import assemble, decide
from folioforge.plans import pipeline
from folioforge.schema import STATS
from folioforge.sources import files, links, sinks
from folioforge.streaming import ingest

META = "bibcode string, meta_bibcode string, index_date string, ft_source string, meta_mtime long, fulltext_mtime long"


def test_links(spark, tmp_path):
    (tmp_path / "l").write_text("b1\t/a/b/1.txt\tP\n\nshort\tx\n  b2\t\t/a/b/2.pdf\tQ\n")
    got = links.read(spark, str(tmp_path / "l"), send=True).collect()
    assert [tuple(r) for r in got] == [("b1", "/a/b/1.txt", "P", "FORCE_TO_SEND"), ("b2", "/a/b/2.pdf", "Q", "FORCE_TO_SEND")]
    words = spark.createDataFrame([("b3  /a/b/3.xml P",)], "value string")
    assert links.read_words(words).first()["ft_source"] == "/a/b/3.xml"


def test_decisions(spark):
    records = [(k, f"/d/e/{k}.txt", "P", None) for k in "abcdefghij"] + [("k", "/d/e/zero.txt", "P", "FORCE_TO_EXTRACT"), ("l", "/d/e/gone.txt", "P", "FORCE_TO_SEND"), ("m", "bad", "P", None)]
    rows = spark.createDataFrame(records, "bibcode string, ft_source string, provider string, update_reason string")
    stats = spark.createDataFrame([(f"/d/e/{k}.txt", True, 5, 100) for k in "abcdefghij"] + [("/d/e/zero.txt", True, 0, 1)], STATS)
    date = "2020-01-01T00:00:00Z"
    meta = spark.createDataFrame(
        [
            ("b", "b", None, "/d/e/b.txt", 200, 200), ("c", "c", "junk", "/d/e/c.txt", 200, 200), ("d", "d", date, None, 200, 200), ("e", "e", date, "/d/e/x.txt", 200, 200),
            ("f", "f", date, "/d/e/f.txt", 50, 60), ("g", "g", date, "/d/e/g.txt", 200, 150), ("h", "h", date, "/d/e/h.txt", 200, 200), ("i", "i", date, "/d/e/i.txt", 200, None),
        ],
        META,
    )
    out = {r["bibcode"]: r for r in decide.decide(rows, meta, stats).collect()}
    expected = {
        "a": "NOT_EXTRACTED_BEFORE", "b": "STALE_META", "c": None, "d": "MISSING_FULL_TEXT", "e": "DIFFERING_FULL_TEXT", "f": "STALE_CONTENT", "g": "STALE_CONTENT",
        "h": None, "i": None, "k": "IGNORE_ZERO_BYTE_FT_SOURCE", "l": "IGNORE_NON_EXISTENT_FT_SOURCE", "m": None,
    }
    assert {k: out[k]["update_reason"] for k in expected} == expected
    assert "unreadable" in out["c"]["error"] and "missing" in out["i"]["error"] and "absolute" in out["m"]["error"] and out["h"]["error"] is None
    assert [k for k in sorted(out) if out[k]["selected"]] == list("abdefg") + ["j"]


def test_ingest_end_to_end(spark, tmp_path):
    folder = tmp_path / "src" / "x"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_text("Introduction\n\nTHIS IS A TITLE")
    (folder / "b.xml").write_text("<x><body>one</body><ack>thanks</ack></x>")
    (folder / "c.txt").write_text("")
    base = str(folder)
    rows = spark.createDataFrame([("a", f"{base}/a.txt,{base}/a.txt", "P", None), ("b", f"{base}/b.xml", "P", None), ("c", f"{base}/c.txt", "P", None), ("s", f"{base}/a.txt", "P", "FORCE_TO_SEND")], "bibcode string, ft_source string, provider string, update_reason string")
    stats = files.stats(spark.createDataFrame([(f"{base}/{n}",) for n in ("a.txt", "b.xml", "c.txt", "none")], "path string"))
    prior = spark.createDataFrame([("s", "stored", "", [], ["f"])], "bibcode string, fulltext string, acknowledgements string, dataset array<string>, facility array<string>")
    out = pipeline.ingest(rows, spark.createDataFrame([], META), stats, prior).persist()
    got = {r["bibcode"]: r for r in out.collect()}
    assert set(got) == {"a", "b", "s"}
    assert got["a"]["fulltext"] == "Introduction THIS IS A TITLE Introduction THIS IS A TITLE" and got["a"]["ft_source"].count(",") == 1
    assert got["b"]["acknowledgements"] == "thanks" and got["s"]["fulltext"] == "stored"
    root = str(tmp_path / "out")
    sinks.write_files(out, root)
    assert gzip.open(f"{root}/b/fulltext.txt.gz").read() == b"one"
    assert oct(os.stat(f"{root}/b/meta.json").st_mode)[-3:] == "640"
    assert json.loads(open(f"{root}/b/meta.json").read())["UPDATE"] == "NOT_EXTRACTED_BEFORE"
    assert sinks.read_file(f"{root}/b/fulltext.txt.gz") == "one"
    sinks.write_tables(out, root + "/t")
    assert spark.read.parquet(root + "/t/fulltext").count() == 3
    stored = spark.read.parquet(root + "/t/meta")
    assert "fulltext" not in stored.first()["value"]


def test_records_listed_twice_and_urls(spark):
    rows = [("a", "/x/y/a.txt", None, 1), ("a", "/x/y/a.txt", None, 2), ("a", "/x/y/b.txt,/x/y/a.txt", "P", 3), ("u", "http://h/p", "P", 4)]
    records = spark.createDataFrame([(b, s, p, str(k), "", "", "http" if s[0] == "h" else "txt") for b, s, p, k in rows], "bibcode string, ft_source string, provider string, update_reason string, meta_path string, index_date string, file_format string")
    content = spark.createDataFrame([("/x/y/a.txt", bytearray(b"hello")), ("/x/y/b.txt", bytearray(b"more"))], "path string, content binary")
    got = {r["update_reason"]: r["fulltext"] for r in pipeline.extracted(records, content).collect()}
    assert got == {"1": "hello", "2": "hello", "3": "more hello", "4": None}
    web = pipeline.extracted(records.where("file_format = 'http'"), get=lambda url, headers: (200, f"page  of {url}"))
    assert [r["fulltext"] for r in web.collect()] == ["page of http://h/p"]
    gone = pipeline.extracted(records.where("file_format = 'http'"), get=lambda url, headers: (404, "")).first()
    assert gone["fulltext"] is None and gone["error"] == "no content"


def test_blank_lines_are_not_reported(spark):
    lines = spark.createDataFrame([("\t \t",), ("",), ("a\tb",), (None,), (" a\tb\tc ",)], "value string")
    assert [r[0] for r in links.skipped(lines).collect()] == ["a\tb"]


def test_force_send_is_not_written_twice(spark):
    rows = spark.createDataFrame([("a", "FORCE_TO_SEND"), ("b", "FORCE_TO_SEND"), ("a", "STALE_META")], "bibcode string, update_reason string")
    there = spark.createDataFrame([("a", True, True)], "bibcode string, has_meta boolean, has_fulltext boolean")
    assert sorted(tuple(r) for r in sinks.unsent(rows, there).collect()) == [("a", "STALE_META"), ("b", "FORCE_TO_SEND")]


def test_messages_and_audit(spark):
    rows = spark.createDataFrame([("a", "x\ny", "", [], ["f"])], "bibcode string, fulltext string, acknowledgements string, dataset array<string>, facility array<string>")
    assert tuple(assemble.message(rows).first()) == ("a", "x y", None, None, ["f"])
    there = spark.createDataFrame([("a", True, False, "d")], "bibcode string, has_meta boolean, has_fulltext boolean, index_date string")
    audited = assemble.audit(spark.createDataFrame([("a",), ("b",)], "bibcode string"), there)
    assert {tuple(r) for r in audited.collect()} == {("a", "missing_ft"), ("b", "missing_dir")}


def test_prior_content(spark):
    meta = spark.createDataFrame([("a", "k"), ("b", None)], "bibcode string, acknowledgements string")
    texts = spark.createDataFrame([("a", "t", "z")], "bibcode string, fulltext string, acknowledgements string")
    got = {r["bibcode"]: (r["fulltext"], r["acknowledgements"]) for r in files.prior_content(meta, texts).collect()}
    assert got == {"a": ("t", "k"), "b": ("", None)}


def test_streamed_links(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1").write_text("a\t/a/b/c.txt\tP\n")
    out = str(tmp_path / "out")
    ingest.run(ingest.stream_links(spark, str(tmp_path / "in")), lambda b: b, out, str(tmp_path / "state")).awaitTermination()
    (tmp_path / "in" / "2").write_text("b\t/a/b/d.txt\tP\n")
    ingest.run(ingest.stream_links(spark, str(tmp_path / "in")), lambda b: b, out, str(tmp_path / "state")).awaitTermination()
    assert [r[0] for r in spark.read.parquet(out).orderBy("bibcode").select("bibcode").collect()] == ["a", "b"]


def test_command_line(spark, tmp_path):
    folder = tmp_path / "d" / "e"
    folder.mkdir(parents=True)
    (folder / "a.txt").write_text("seen at HST")
    (tmp_path / "links").write_text(f"a\t{folder}/a.txt\tP\nb\t{folder}/none.txt\tP\n")
    out = str(tmp_path / "o")
    assert cli.main(["-f", str(tmp_path / "links"), "-o", out], spark) == 0
    assert spark.read.parquet(out + "/messages").first()["body"] == "seen at HST"
    assert cli.main(["-f", str(tmp_path / "links"), "-o", out], spark) == 0
    assert spark.read.parquet(out + "/messages").count() == 1  # nothing has changed
    assert cli.main(["-f", str(tmp_path / "links"), "-o", out, "--force-send"], spark) == 0
    assert [r["body"] for r in spark.read.parquet(out + "/messages").collect()] == ["seen at HST"] * 2
    assert cli.main(["-f", str(tmp_path / "links"), "-o", out, "-ner", "--names", "HST"], spark) == 0
    assert json.loads(spark.read.parquet(out + "/facility_ner").first()["value"]) == {"facility-ft": ["HST"]}


def test_entry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert callable(__spark_entry__.entry)


def test_plans_stay_in_the_jvm(spark):
    rows = spark.createDataFrame([("a b",)], "text string")
    plan = links.parse(rows, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    stats = spark.createDataFrame([], STATS)
    records = rows.select(F.col("text").alias("bibcode"), F.col("text").alias("ft_source"), F.lit("p").alias("provider"), F.lit(None).cast("string").alias("update_reason"))
    plan = decide.decide(records, spark.createDataFrame([], META), stats)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
