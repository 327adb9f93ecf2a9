import os
import subprocess

import pytest
from pyspark.sql import functions as F

from folioforge.operators import extract as X
from folioforge.operators import ner
from folioforge.operators.tree import parse, select
from folioforge.plans import queries
from folioforge.sources import remote

DEEP = 3000


def article(broken=False):
    """An article of our own: entities, formulas, a table in a paragraph, nested sections; broken: end tags that match nothing."""
    stray = "</sup></nothing>" if broken else ""
    return (
        f'<paper><body><sec id="1"><head>Tides</head>{stray}<par>Flow&hellip; of <formula>x<sub>2</sub></formula>water &nosuch;&#955;and '
        "<table><row>12</row></table>ice</par></sec><sec><sec><par>Deeper&eacute;</par></sec></sec>"
        '<named-content content-type="dataset" xlink:href=" set 9 "/><named-content content-type="dataset" xlink:href="None"/></body>'
        '<back><ack>We thank <named-content content-type="facility" xlink:href="dish-4">the dish</named-content></ack> and others'
        "<app-group>More on tides</app-group><bibliography><ref>ref 1</ref></bibliography></back></paper>"
    )


@pytest.mark.parametrize("broken", [False, True])
def test_xml_fields(broken):
    assert X.xml_fields(article(broken)) == {
        "fulltext": "Tides Flow... of water and ice Deeper\u00e9\nMore on tides",
        "acknowledgements": "We thank the dish",
        "dataset": ["set 9"],
        "facility": ["dish-4"],
    }


def test_deep_nesting():
    raw = "<q>" * DEEP + "no rule finds this" + "</q>" * DEEP
    assert X.xml_fields(raw) == {"fulltext": "", "acknowledgements": ""}  # by way of both parsers
    assert X.xml_fields("<body>" + raw + "</body>")["fulltext"] == "no rule finds this"
    assert X.html_text(raw) == "no rule finds this"


@pytest.mark.parametrize("name", ["utf-8", "iso-8859-7", "windows-1251", "utf-16"])
def test_charsets(name):
    text = "\u03c9\u03c1\u03b1" if name == "iso-8859-7" else "\u0447\u0430\u0441"
    raw = f'<?xml version="1.0" encoding="{name}"?><body>{text}</body>'.encode(name)
    assert X.extract_one("xml", raw)["fulltext"] == text


def test_a_bad_document_stops_nothing(spark, monkeypatch):
    def failing(text, *_):
        if "bad" in text:
            raise RuntimeError("unreadable")
        return {"fulltext": text}

    monkeypatch.setattr(X, "xml_fields", failing)
    rows = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "id int, t string")
    got = {r["id"]: r["x"] for r in rows.select("id", X.fields_udf("xml")("t").alias("x")).collect()}
    assert got[1]["fulltext"] == "good" and got[1]["error"] is None
    assert got[2]["fulltext"] is None and got[2]["error"] == "RuntimeError: unreadable"
    assert got[3]["fulltext"] is None and got[3]["error"] is None
    halves = X.field_udf(lambda t: t if t == "good" else 1 / 0)
    assert [r[0] for r in rows.orderBy("id").select(halves("t")).collect()] == ["good", None, None]


def test_later_paths_are_dropped_after_a_duplicate():
    raw = '<a><body>one two <app-group>two</app-group></body><section type="x">three</section></a>'
    assert X.xml_fields(raw)["fulltext"] == "one two two"
    assert X.xml_fields('<a><body>one</body><section type="x">three</section></a>')["fulltext"] == "one\nthree"


def test_no_content_and_malformed():
    assert X.xml_fields("<a><x>y</x></a>") == {"fulltext": "", "acknowledgements": ""}
    assert X.xml_fields("<body>a <b>b </i> c")["fulltext"] == "a b c"


def test_elsevier_keeps_acknowledgment_in_the_body():
    raw = '<ja:article xmlns:ja="u"><ja:body view="all"><ce:p>TEXT</ce:p><ce:acknowledgment>THANK YOU</ce:acknowledgment></ja:body><ja:appendices>APP</ja:appendices><ce:bibliography>B</ce:bibliography></ja:article>'
    out = X.xml_fields(raw, "elsevier")
    assert out["fulltext"] == "TEXT THANK YOU\nAPP" and out["acknowledgements"] == "THANK YOU"


def test_tei():
    out = X.xml_fields('<TEI><text><body><p>a</p></body><back><div type="acknowledgement">t</div></back></text></TEI>', "teixml")
    assert out == {"fulltext": "a", "acknowledgements": "t"}


HTML = '<html><head><title>Title</title></head><body><p>Abstract A<h3><a>1 Introduction</a></h3><p>INTRO &amp; x<br>y <a href="t/table1.html">link</a><p><a href="table1.html">again</a><h2>References</h2><ul><li>r</ul><p>END</body></html>'


def test_html():
    assert X.html_text(HTML) == "Title Abstract A INTRO x y link again END"
    linked = "<html><body><table><tr><td>ONLY IN TABLE</table></body></html>"
    assert X.html_files([("/x/a.html", HTML), ("/x/table1.html", linked), ("/x/other.html", "")]) == "Title Abstract A INTRO x y ONLY IN TABLE END"
    with pytest.raises(ValueError):
        X.html_text(HTML, {"table1.html": "<p>none"})
    assert X.html_text("<h2>References</h2>") == "References"


def test_summary():
    assert X.section_summary("<a><body><sec>x</sec><sec>y <b>z</b></sec></body></a>") == "y z"
    assert X.section_summary("<a><body><p>x</p><p>y</p></body></a>") == "y"
    assert X.section_summary("<a/>") is None


def test_xpath():
    root = parse('<a><b key="k1"><c><p>1</p></c></b><p k="v">2 Abstract</p></a>')
    assert [n.content() for n in select(root, 'a//b[@key="k1"]//p')] == ["1"]
    assert [n.content() for n in select(root, '//p[contains(., "Abstract") and not(@k="w")] | //c')] == ["1", "2 Abstract"]
    assert [n.tag for n in select(root, '//*[local-name()="c"]')] == ["c"]


def test_sniff():
    assert X.sniff("é".encode()) == "é" and X.sniff("é".encode("cp1252")) == "é"
    assert X.sniff('<meta charset="iso-8859-1">é'.encode("latin-1")).endswith("é")
    assert X.sniff(b"\xef\xbb\xbfa") == "a" and X.sniff("a".encode("utf-16")) == "a"


def test_dispatch(spark):
    rows = [("xml", "Elsevier", b"<x><body>a</body><acknowledgment>k</acknowledgment></x>"), ("txt", None, b"a  b\xff"), ("doc", "P", b"x"), ("html", "P", None), ("html", "P", b"<p>a")]
    out = X.extract(spark.createDataFrame(rows, "file_format string, provider string, content binary")).collect()
    assert [r["fulltext"] for r in out] == ["a", "a b", None, None, "a"]
    assert [r["error"] for r in out] == [None, None, "unsupported format: doc", "no content", None]
    assert out[0]["acknowledgements"] == "k"
    empty = spark.createDataFrame([], "file_format string, provider string, content binary")
    assert X.extract(empty).count() == 0


def test_remote_back_ends():
    assert remote.http_text("http://x", lambda u, h: (200, "a\u00a0 b"))["fulltext"] == "a b"
    with pytest.raises(OSError):
        remote.http_text("http://x", lambda u, h: (404, ""))
    calls = []

    def slow_once(command, content, seconds):
        calls.append(command[0])
        if calls == ["pdftotext"]:
            raise subprocess.TimeoutExpired("pdftotext", seconds)
        return b"text \xff  here"

    assert remote.pdf_text(b"%PDF", run=slow_once)["fulltext"] == "text here"
    assert calls == ["pdftotext", "gs", "pdftotext"]
    assert remote.run_tool(["cat", "{}"], b"x") == b"x"
    with pytest.raises(OSError):
        remote.run_tool(["false"], b"")
    assert remote.service_text(b"x", None) == {"fulltext": ""}
    assert remote.service_text(b"x", lambda c, s: 1 / 0) == {"fulltext": ""}
    assert remote.service_text(b"x", lambda c, s: "<TEI> a")["fulltext"] == "<TEI> a"
    assert remote.pdf_text_plain(b"x", lambda c: "a " + "b" * 300)["fulltext"] == "a "


def test_facilities(spark):
    model = ner.gazetteer(["Very Large Array", "Array", "HST"])
    rows = spark.createDataFrame([("b", "HST, HST and Very Large Array", ""), ("c", None, "no Arrays")], "bibcode string, acknowledgements string, fulltext string")
    out = {r[0]: (r[1], r[2]) for r in ner.facilities(rows, model, model).collect()}
    assert out == {"b": (["HST", "Very Large Array"], None), "c": (None, [])}


def test_facilities_of_odd_texts(spark, tmp_path):
    texts = [None, "", " ", "the \U0002ebf0the der\U0002ee5d", "\u4e00and \xb2que _der the-and"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: r[1] for r in queries.facility_ner(spark, str(tmp_path)).collect()}
    assert got == {"D0": None, "D1": "", "D2": "", "D3": "der,the", "D4": "and,the"}


def test_a_worker_holds_few_documents(spark, monkeypatch):
    def measured(text, *_):
        with open("/proc/self/statm") as f:
            return {"fulltext": text + "x", "acknowledgements": f.read().split()[1]}

    monkeypatch.setattr(X, "xml_fields", measured)
    monkeypatch.setitem(X.EXTRACTORS, "xml", measured)
    rows = spark.range(3000, numPartitions=1).select("id", F.concat(F.repeat(F.lit("word "), 8000), F.col("id").cast("string")).alias("t"))
    held = rows.select(X.fields_udf("xml")("t").alias("x")).select(F.length("x.fulltext").alias("n"), "x.acknowledgements")
    files = rows.select("id", F.lit("xml").alias("file_format"), F.lit("P").alias("provider"), F.col("t").alias("content"))
    for df in (held, X.extract(files).select(F.length("fulltext").alias("n"), "acknowledgements")):
        n, least, most = df.agg(F.count("n"), F.min(F.col("acknowledgements").cast("long")), F.max(F.col("acknowledgements").cast("long"))).first()
        assert n == 3000 and (most - least) * os.sysconf("SC_PAGE_SIZE") < 40e6, (least, most)


def test_a_document_is_extracted_once(spark):
    files = spark.createDataFrame([("a", "xml", "P", "<x><body>b</body></x>")], "bibcode string, file_format string, provider string, content string")
    got = X.extract(files).where("error IS NULL AND fulltext <> ''")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("one(") == 1
    assert got.first()["fulltext"] == "b"
