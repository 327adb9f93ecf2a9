import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import entities, markup, paths, textclean

ODD = ["a b", "a\x0bb\x0c\r", "x\x00y\xadz", "t\tn\nu\x85", "p\ue000q\ufdd0\ufeff", "\U0001fffe\U0001d400", "", "  lead  and \u3000 trail ", "w" * 99 + " " + "v" * 100, "ﬁ¹Å"]


def column(spark, texts, f):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r[1] for r in sorted(rows.select("i", f(F.col("t"))).collect())]


def test_cleaning_equals_its_specification(spark):
    assert column(spark, ODD, textclean.translate) == [textclean.py_translate(t) for t in ODD]
    assert column(spark, ODD, textclean.trim_words) == [textclean.py_trim_words(t) for t in ODD]
    assert column(spark, [*ODD, None], textclean.normalise) == [*[unicodedata.normalize("NFKC", t) for t in ODD], None]
    runs = ["x" * 200, "y" * 201 + " z", "a  b\n" + "ü" * 300]
    assert column(spark, runs, textclean.drop_long_runs) == [textclean.py_drop_long_runs(t) for t in runs] == ["x" * 200, " z", "a  b\n"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=60), min_size=20, max_size=40))
def test_cleaning_on_any_text(spark, texts):
    assert column(spark, texts, textclean.clean) == [textclean.py_clean(t) for t in texts]


def test_cleaning_computes_each_step_once(spark):
    rows = spark.createDataFrame([(t,) for t in [*ODD, "z\U0002ffff\U0001f600\ue000 \x1c\x7f", "\x0b \x01", None]], "t string")
    for f, expected in ((textclean.clean, textclean.py_clean), (lambda c: textclean.clean(c, translated=False), lambda t: textclean.py_clean(t, False))):
        out = rows.select("t", f(F.col("t")).alias("c"))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_replace(") <= 2 and plan.count("BatchEvalPython") == 1 and "ArrowEvalPython" not in plan
        assert all(r["c"] == (None if r["t"] is None else expected(r["t"])) for r in out.collect())


def test_decode_leaves_out_what_is_not_utf8(spark):
    rows = spark.createDataFrame([(bytearray(b"a\xff\xc3b\xc3\xa9"),), (None,)], "c binary")
    assert [r[0] for r in rows.select(textclean.decode_utf8("c")).collect()] == ["abé", None]


def test_entities():
    assert len(entities.ENTITIES) == 1881
    assert entities.decode_entities("A&amp;A &gt; &quot; &#65; &#x41; &nope; &angst; &agr;") == "AA > '" + " " * 4 + "\u212b \u03b1"
    assert entities.decode_entities(None) is None
    assert entities.decode_entities("a & b &c") == "a & b &c"


def test_native_entities_equal_the_table(spark):
    texts = ["", "&", "&&copy;;", "a&copy;b&#12;c", "&copy &copy;", "&unknown;x", "&é;y"]
    known = {"copy": "©"}
    expected = [re.sub(r"&(#\d+|#x[0-9a-fA-F]+|\w+);", lambda m: known.get(m[1], ""), t) for t in texts]
    assert column(spark, texts, lambda c: markup.decode_few_references(c, known)) == expected


@pytest.mark.parametrize(
    ("f", "text", "expected"),
    [
        (markup.unwrap_body, "x<!--body\n<sec>1 endbody 2</sec>endbody-->y", "x<sec>1 endbody 2</sec>y"),
        (markup.unwrap_body, "<!-- no such thing -->", "<!-- no such thing -->"),
        (markup.strip_comments, "one<!---->two<!-- <!-- three -->four<!-- open", "onetwofour<!-- open"),
        (markup.strip_cdata, "<f><![CDATA[x]]>1<![CDATA[]]></f>", "<f>1</f>"),
        (markup.strip_instructions, "<?a?><?b\n?>1 <? c", "1 <? c"),
        (markup.expand_empty_tags, "<br/><img src='u/v' /><p>1</p>", "<br></br><img src='u/v' ></img><p>1</p>"),
        (markup.declare_utf8, "<?xml version='1.0' encoding=\"utf-16\"?><a encoding=\"b\"/>", "<?xml version='1.0' encoding=\"UTF-8\"?><a encoding=\"b\"/>"),
    ],
)
def test_markup(spark, f, text, expected):
    assert column(spark, [text, None], f) == [expected, None]


SOURCES = ["/a/b/c.txt", "/a/b/c.txt,/a/b/d.txt", "/a/b/c,1.txt,/a/b/d,2.txt", "/a.+/b/x,/a.+/b/y,", "/a/b/c/d/e.pdf"]


def test_sources(spark):
    assert column(spark, [*SOURCES, "http://x/y", "/short", None], paths.split_sources) == [*map(paths.py_split_sources, SOURCES), None, None, None]
    with pytest.raises(ValueError):
        paths.py_split_sources("x")


def test_paths(spark):
    assert column(spark, ["test4", "fta", "2015TEST"], paths.pair_path) == ["/te/st/4/", "/ft/a/", "/20/15/TE/ST/"]
    assert paths.py_pair_path("a.b/c") == column(spark, ["a.b/c"], paths.pair_path)[0]
    formats = column(spark, ["/a/b/x.TXT", "/a/b/.hidden", "/a/b/noext", "http://host/page", "/a/b.c/d", "/a/b/x.tar.GZ"], paths.file_format)
    assert formats == ["txt", "", "", "http", "", "gz"]


def test_date_forms(spark):
    forms = ["2020-01-02T00:00:00Z", "2020-01-02", "Thu, 2 Jan 2020 00:00:00 UTC", "2 Jan 2020", "Jan 2, 2020", "January 2, 2020", "2020/01/02", "01/02/2020", "20200102", "20200102T000000", " 2020-01-02 "]
    assert {str(x)[:10] for x in column(spark, forms, paths.parse_date)} == {"2020-01-02"}
    assert set(column(spark, ["12", "soon", "", "2020-13-45"], paths.parse_date)) == {None}


def test_dates(spark):
    assert [x is not None for x in column(spark, ["2020-01-02T03:04:05Z", "junk", None], paths.parse_date)] == [True, False, False]
    stamp = spark.range(1).select(paths.index_date().alias("d")).first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z", stamp)
    assert spark.range(1).select(paths.http_date(paths.modified_time(F.lit(0.5)))).first()[0] == "Thu, 01 Jan 1970 00:00:00 UTC"
