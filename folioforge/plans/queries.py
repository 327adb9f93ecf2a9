"""Registered queries: each operator on the driver's tables, with the SQL that must give the same."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import markup, paths, textclean
from ..operators import assemble, decide, extract, ner
from ..sources import links
from ..streaming import ingest
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Spark's white space class, for RE2
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def words_sql(text: str, limit: int = 100) -> str:
    return f"array_to_string(list_filter(regexp_split_to_array({text}, '{WS}'), lambda w: length(w) > 0 AND length(w) < {limit}), ' ')"


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text


@query(f"SELECT doc_id, {words_sql('nfc_normalize(text)')} AS fulltext FROM documents")
def txt_extract(spark, sf_dir):
    return extract.extract_text(table(spark, sf_dir, "documents")).select("doc_id", "fulltext")


@query("SELECT doc_id, concat('a b', text, 'c', chr(9), 'd') AS cleaned FROM documents")
def clean_translate(spark, sf_dir):
    odd = F.concat(F.lit("a b"), F.col("text"), F.lit("­\u0001​c\t﻿d"))
    return table(spark, sf_dir, "documents").select("doc_id", textclean.translate(odd).alias("cleaned"))


@query("SELECT doc_id, concat('fi1', text, chr(197)) AS cleaned FROM documents")
def clean_normalise(spark, sf_dir):
    odd = F.concat(F.lit("ﬁ¹"), F.col("text"), F.lit("Å"))
    return table(spark, sf_dir, "documents").select("doc_id", textclean.normalise(odd).alias("cleaned"))


@query(f"SELECT doc_id, {words_sql("concat(text, ' ', repeat('x', 99), ' ', repeat('y', 100), chr(160), 'z')")} AS cleaned FROM documents")
def clean_trimwords(spark, sf_dir):
    long = F.concat(F.col("text"), F.lit(" " + "x" * 99 + " " + "y" * 100 + " z"))
    return table(spark, sf_dir, "documents").select("doc_id", textclean.trim_words(long).alias("cleaned"))


@query("SELECT doc_id, concat(text, ' ', repeat('x', 200), '  z') AS cleaned FROM documents")
def pdfbox_trim(spark, sf_dir):
    long = F.concat(F.col("text"), F.lit(" " + "x" * 200 + " " + "y" * 201 + " z"))
    return table(spark, sf_dir, "documents").select("doc_id", textclean.drop_long_runs(long).alias("cleaned"))


@query(f"SELECT doc_id, {words_sql('text')} AS fulltext FROM documents")
def utf8_decode(spark, sf_dir):
    raw = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FFC3")))
    return table(spark, sf_dir, "documents").select("doc_id", textclean.trim_words(textclean.decode_utf8(raw)).alias("fulltext"))


_DECODED = r"regexp_replace(replace(replace(replace(html, '&quot;', ''''), '&copy;', chr(169)), '&middot;', chr(183)), '&(#\d+|#x[0-9a-fA-F]+|\w+);', '', 'g')"


@query(f"SELECT page_id, {_DECODED} AS decoded FROM pages")
def entity_decode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.decode_references("html").alias("decoded"))


@query(f"SELECT page_id, {_DECODED} AS decoded FROM pages")
def entity_decode_native(spark, sf_dir):
    known = {"quot": "'", "copy": "©", "middot": "·"}
    return table(spark, sf_dir, "pages").select("page_id", markup.decode_few_references(F.col("html"), known).alias("decoded"))


@query(r"SELECT page_id, regexp_replace(html, '<!--[\s\S]*?-->', '', 'g') AS stripped FROM pages")
def strip_comments(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.strip_comments(F.col("html")).alias("stripped"))


@query("SELECT page_id, concat(html, 'tail') AS stripped FROM pages")
def strip_cdata(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.strip_cdata(F.concat("html", F.lit("<![CDATA[<b>\n]x]]>tail"))).alias("stripped"))


@query("SELECT page_id, concat('head', html) AS stripped FROM pages")
def strip_instructions(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", markup.strip_instructions(F.concat(F.lit("<?xml a='>'\n?>head"), "html")).alias("stripped"))


@query("SELECT page_id, concat('<g a=\"1\"></g>', html) AS expanded FROM pages")
def expand_empty_tags(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.concat(markup.expand_empty_tags(F.lit('<g a="1"/>')), "html").alias("expanded"))


@query("SELECT doc_id, concat('<body><p>', text, '</p></body> ') AS unwrapped FROM documents")
def unwrap_body(spark, sf_dir):
    hidden = F.concat(F.lit("<!-- body <body><p>"), "text", F.lit("</p></body> endbody -->"))
    return table(spark, sf_dir, "documents").select("doc_id", markup.unwrap_body(hidden).alias("unwrapped"))


# Trees


# the tag inside a script's string is text, all others end a text node
_NODES = f"""replace(regexp_replace(replace(regexp_replace({_DECODED}, '<!--.*?-->', '', 'g'), '"</p>"', '"~"'), '<[^>]*>', ' ', 'g'), '"~"', '"</p>"')"""


@query(f"SELECT page_id, {words_sql(f'nfc_normalize({_NODES})')} AS fulltext FROM pages")
def html_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", extract.html_fulltext("html").alias("fulltext"))


def _plain(text="text"):
    """Text that can stand in markup: without its own signs."""
    return F.regexp_replace(text, r"[<>&]", "")


_PLAIN = "regexp_replace(text, '[<>&]', '', 'g')"


@query(f"SELECT doc_id, {words_sql(f"concat({_PLAIN}, ' end')")} AS fulltext FROM documents")
def html_references(spark, sf_dir):
    html = F.concat(F.lit("<html><body><p>"), _plain(), F.lit("</p><h2>References</h2><ul><li>r</li></ul><p>end</p></body></html>"))
    return table(spark, sf_dir, "documents").select("doc_id", extract.html_fulltext(html).alias("fulltext"))


@query(f"SELECT doc_id, {words_sql(f"concat('before tail ', {_PLAIN})")} AS fulltext FROM documents")
def html_introduction(spark, sf_dir):
    html = F.concat(F.lit("<html><body><p>before</p><h3><a>1 Introduction</a></h3><p>tail</p><p>"), _plain(), F.lit("</p></body></html>"))
    return table(spark, sf_dir, "documents").select("doc_id", extract.html_fulltext(html).alias("fulltext"))


@query(f"SELECT doc_id, {words_sql(f"concat('see ', {_PLAIN}, ' end')")} AS fulltext FROM documents")
def html_table_inline(spark, sf_dir):
    main = F.lit('<html><body><p>see <a href="x/table1.html">here</a></p><p>end <a href="table1.html">again</a></p></body></html>')
    linked = F.concat(F.lit("<html><body><div><table><tr><td>"), _plain(), F.lit("</td></tr></table></div></body></html>"))
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", extract.html_with_tables(main, F.array(F.lit("table1.html")), F.array(linked)).alias("fulltext"))


def _given(sql: str) -> str:
    """Null where the text is."""
    return f"CASE WHEN text IS NOT NULL THEN {sql} END"


def _article(close: str = "</article>"):
    return F.concat(
        F.lit("<article><body><sec><p>"), _plain(), F.lit(" <inline-formula>f</inline-formula>kept</p><table><tr><td>t</td></tr></table></sec>"), F.lit('<named-content content-type="dataset" xlink:href="SET/'),
        F.col("doc_id").cast("string"), F.lit('"/><ack>moved</ack></body><back><ack><p>Thanks '), "source", F.lit('</p><named-content content-type="facility" xlink:href="F'),
        F.col("doc_id").cast("string"), F.lit('"/><named-content content-type="facility"/></ack></back>' + close),
    )


def _fields(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", extract.xml_extract(_article()).alias("x"))


@query(f"SELECT doc_id, {_given(words_sql(f"concat({_PLAIN}, ' kept')"))} AS fulltext FROM documents")
def xml_fulltext(spark, sf_dir):
    return _fields(spark, sf_dir).select("doc_id", "x.fulltext")


@query(f"SELECT doc_id, {_given("'moved'")} AS acknowledgements FROM documents")
def xml_acknowledgements(spark, sf_dir):
    return _fields(spark, sf_dir).select("doc_id", "x.acknowledgements")


@query(f"SELECT doc_id, {_given("'SET/' || doc_id")} AS dataset, {_given("'F' || doc_id")} AS facility FROM documents")
def xml_links(spark, sf_dir):
    return _fields(spark, sf_dir).select("doc_id", F.array_join("x.dataset", ",").alias("dataset"), F.array_join("x.facility", ",").alias("facility"))


@query(f"SELECT doc_id, {_given(words_sql(f"concat({_PLAIN}, ' THANK YOU')"))} AS fulltext, {_given("'THANK YOU'")} AS acknowledgements FROM documents")
def elsevier_extract(spark, sf_dir):
    raw = F.concat(F.lit('<ja:article xmlns:ja="x"><ja:body view="all"><ce:p>'), _plain(), F.lit("</ce:p><ce:acknowledgment>THANK YOU</ce:acknowledgment></ja:body></ja:article>"))
    docs = table(spark, sf_dir, "documents").select("doc_id", extract.elsevier_extract(raw).alias("x"))
    return docs.select("doc_id", "x.fulltext", "x.acknowledgements")


@query(f"SELECT doc_id, {words_sql(_PLAIN)} AS fulltext, {_given("concat('by ', source)")} AS acknowledgements FROM documents")
def tei_extract(spark, sf_dir):
    raw = F.concat(F.lit('<TEI xmlns="urn:tei"><text><body>'), _plain(), F.lit('</body><back><div type="acknowledgement">by '), "source", F.lit("</div></back></text></TEI>"))
    docs = table(spark, sf_dir, "documents").select("doc_id", extract.tei_extract(raw).alias("x"))
    return docs.select("doc_id", "x.fulltext", "x.acknowledgements")


@query(f"SELECT doc_id, {words_sql(_PLAIN)} AS summary FROM documents")
def section_summary(spark, sf_dir):
    raw = F.concat(F.lit("<article><body><sec>first</sec><sec>"), _plain(), F.lit("</sec></body></article>"))
    return table(spark, sf_dir, "documents").select("doc_id", extract.summary(raw).alias("summary"))


@query(f"SELECT doc_id, CASE WHEN text IS NULL THEN 'no content' WHEN doc_id % 4 = 3 THEN 'unsupported format: doc' END AS error, CASE WHEN doc_id % 4 < 3 THEN {words_sql(_PLAIN)} END AS fulltext FROM documents")
def dispatch_formats(spark, sf_dir):
    kind = F.col("doc_id") % 4
    kinds = F.when(kind == 0, "txt").when(kind == 1, "html").when(kind == 2, "xml").otherwise("doc")
    content = F.when(kind == 1, F.concat(F.lit("<p>"), _plain())).when(kind == 2, F.concat(F.lit("<x><body>"), _plain(), F.lit("</body></x>"))).otherwise(_plain())
    docs = table(spark, sf_dir, "documents").select("doc_id", kinds.alias("file_format"), F.lit("P").alias("provider"), F.encode(content, "UTF-8").alias("content"))
    return extract.extract(docs).select("doc_id", "error", "fulltext")


# Records


def _links(spark, sf_dir):
    """A link for each document; some are short, some hold several files."""
    doc = F.col("doc_id").cast("string")
    path = F.concat(F.lit("/data/full/"), doc, F.when(F.col("doc_id") % 5 == 0, ".pdf").when(F.col("doc_id") % 5 == 1, ".XML").when(F.col("doc_id") % 5 == 2, ".a.html").otherwise(".txt"))
    more = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit(",/data/full/"), doc, F.lit(",b.txt"))).otherwise("")
    provider = F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.concat(F.lit("\t"), "source"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("D"), doc, F.lit("\t"), path, more, provider).alias("value"))


_PATH = "'/data/full/' || doc_id || CASE doc_id % 5 WHEN 0 THEN '.pdf' WHEN 1 THEN '.XML' WHEN 2 THEN '.a.html' ELSE '.txt' END"
_SOURCE = f"{_PATH} || CASE WHEN doc_id % 7 = 0 THEN ',/data/full/' || doc_id || ',b.txt' ELSE '' END"
_LINKED = f"(SELECT doc_id, 'D' || doc_id AS bibcode, {_SOURCE} AS ft_source, source AS provider FROM documents WHERE doc_id % 11 <> 0)"


@query(f"SELECT * FROM {_LINKED}")
def links_parse(spark, sf_dir):
    return links.parse(_links(spark, sf_dir))


@query("SELECT count(*) AS n FROM documents WHERE doc_id % 11 = 0")
def links_skipped(spark, sf_dir):
    return links.skipped(_links(spark, sf_dir)).agg(F.count("*").alias("n"))


@query(f"SELECT bibcode, 'FORCE_TO_EXTRACT' AS extract, 'FORCE_TO_SEND' AS send FROM {_LINKED}")
def force_flags(spark, sf_dir):
    parsed = links.parse(_links(spark, sf_dir))
    both = decide.force(parsed, extract=True, send=True).select("bibcode", F.col("update_reason").alias("extract"))
    return both.join(decide.force(parsed, send=True).select("bibcode", F.col("update_reason").alias("send")), "bibcode")


@query(f"SELECT * FROM {_LINKED} ORDER BY doc_id LIMIT 100")
def queue_limit(spark, sf_dir):
    return links.first_records(links.parse(_links(spark, sf_dir)), 100, "doc_id")


@query(f"SELECT doc_id, 0 AS pos, {_PATH} AS path FROM {_LINKED} UNION ALL SELECT doc_id, 1 AS pos, '/data/full/' || doc_id || ',b.txt' AS path FROM {_LINKED} WHERE doc_id % 7 = 0")
def split_sources(spark, sf_dir):
    parsed = links.parse(_links(spark, sf_dir))
    return assemble.explode_sources(parsed, paths.split_sources(F.col("ft_source"))).select("doc_id", "pos", "path")


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xml' WHEN 2 THEN 'html' ELSE 'txt' END AS file_format FROM documents WHERE doc_id % 11 <> 0")
def file_format(spark, sf_dir):
    first = F.element_at(paths.split_sources(F.col("ft_source")), 1)
    return links.parse(_links(spark, sf_dir)).select("doc_id", paths.file_format(first).alias("file_format"))


@query("SELECT doc_id, '/extract/' || array_to_string(regexp_extract_all('20' || doc_id || 'TEST', '..?'), '/') || '/meta.json' AS meta_path FROM documents")
def pairtree_path(spark, sf_dir):
    key = F.concat(F.lit("20"), F.col("doc_id").cast("string"), F.lit("TEST"))
    return table(spark, sf_dir, "documents").select("doc_id", paths.meta_path(key, "/extract/").alias("meta_path"))


def _decided(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    records = links.parse(_links(spark, sf_dir)).withColumn("update_reason", F.when(F.col("doc_id") % 13 == 0, "FORCE_TO_EXTRACT").when(F.col("doc_id") % 13 == 1, "FORCE_TO_SEND"))
    d = F.col("doc_id")
    path = F.concat(F.lit("/data/full/"), d.cast("string"), F.when(d % 5 == 0, ".pdf").when(d % 5 == 1, ".XML").when(d % 5 == 2, ".a.html").otherwise(".txt"))
    stats = docs.where(d % 17 != 0).select(path.alias("path"), F.lit(True).alias("exists"), F.when(d % 19 == 0, 0).otherwise(10).cast("long").alias("size"), (1000 + d % 3).alias("mtime"))
    key = F.concat(F.lit("D"), d.cast("string"))
    source = F.when(d % 4 == 1, "/data/full/other").when(d % 4 == 2, F.lit(None)).otherwise(F.concat(path, F.when(d % 7 == 0, F.concat(F.lit(",/data/full/"), d.cast("string"), F.lit(",b.txt"))).otherwise("")))
    date = F.when(d % 23 == 0, F.lit(None)).when(d % 23 == 1, "junk").otherwise("2020-01-01T00:00:00Z")
    meta = table(spark, sf_dir, "labels").select("doc_id").distinct().select(key.alias("bibcode"), key.alias("meta_bibcode"), date.alias("index_date"), source.alias("ft_source"), (1000 + d % 2).alias("meta_mtime"), F.when(d % 6 == 0, 1000).otherwise(1001).cast("long").alias("fulltext_mtime"))
    return decide.decide(records, meta, stats)


_DECIDED = f"""(SELECT d.doc_id, d.bibcode, CASE
  WHEN d.doc_id % 17 <> 0 AND d.doc_id % 19 = 0 THEN 'IGNORE_ZERO_BYTE_FT_SOURCE'
  WHEN d.doc_id % 17 = 0 THEN 'IGNORE_NON_EXISTENT_FT_SOURCE'
  WHEN d.doc_id % 13 = 0 THEN 'FORCE_TO_EXTRACT'
  WHEN d.doc_id % 13 = 1 THEN 'FORCE_TO_SEND'
  WHEN l.doc_id IS NULL THEN 'NOT_EXTRACTED_BEFORE'
  WHEN d.doc_id % 23 = 0 THEN 'STALE_META'
  WHEN d.doc_id % 23 = 1 THEN NULL
  WHEN d.doc_id % 4 = 2 THEN 'MISSING_FULL_TEXT'
  WHEN d.doc_id % 4 = 1 THEN 'DIFFERING_FULL_TEXT'
  WHEN 1000 + d.doc_id % 3 > 1000 + d.doc_id % 2 OR 1000 + d.doc_id % 2 > CASE WHEN d.doc_id % 6 = 0 THEN 1000 ELSE 1001 END THEN 'STALE_CONTENT'
  END AS update_reason, CASE WHEN d.doc_id % 5 = 0 THEN 'PDF' ELSE 'Standard' END AS route
  FROM {_LINKED} d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id)"""


@query(f"SELECT * FROM {_DECIDED}")
def update_decision(spark, sf_dir):
    return _decided(spark, sf_dir).select("doc_id", "bibcode", "update_reason", "route")


@query(f"SELECT doc_id FROM {_DECIDED} WHERE update_reason NOT LIKE 'IGNORE%'")
def needs_update(spark, sf_dir):
    return _decided(spark, sf_dir).where("selected").select("doc_id")


@query(f"SELECT route, update_reason, count(*) AS n FROM {_DECIDED} GROUP BY ALL")
def route_counts(spark, sf_dir):
    return _decided(spark, sf_dir).groupBy("route", "update_reason").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, file_format FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xml' WHEN 2 THEN 'html' ELSE 'txt' END AS file_format FROM {_LINKED}) UNION ALL SELECT doc_id, 'pdf-grobid' FROM {_LINKED} WHERE doc_id % 5 = 0")
def grobid_branch(spark, sf_dir):
    first = F.element_at(paths.split_sources(F.col("ft_source")), 1)
    records = links.parse(_links(spark, sf_dir)).withColumn("file_format", paths.file_format(first))
    return decide.with_grobid(records, "http://service").select("doc_id", "file_format")


@query("SELECT conv_id, string_agg(text, ' ' ORDER BY turn, text) AS fulltext FROM conversations GROUP BY conv_id")
def multi_file_concat(spark, sf_dir):
    return assemble.concat_texts(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


def _records(spark, sf_dir):
    d = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        d, F.concat(F.lit("D"), d.cast("string")).alias("bibcode"), "source", F.concat(F.col("text"), F.lit("\nAPPENDIX")).alias("fulltext"),
        F.when(d % 3 == 0, "").when(d % 3 == 1, "Thanks").alias("acknowledgements"), F.when(d % 2 == 0, F.array(F.lit("a"))).otherwise(F.array().cast("array<string>")).alias("dataset"),
        F.lit(None).cast("array<string>").alias("facility"),
    )


@query(f"SELECT 'D' || doc_id AS bibcode, {words_sql("text || chr(10) || 'APPENDIX'")} AS body, CASE WHEN doc_id % 3 = 1 THEN 'Thanks' END AS acknowledgements, CASE WHEN doc_id % 2 = 0 THEN 'a' END AS dataset, NULL::VARCHAR AS facility FROM documents")
def master_message(spark, sf_dir):
    sent = assemble.message(_records(spark, sf_dir))
    return sent.withColumns({c: F.when(F.col(c).isNotNull(), F.array_join(c, ",")) for c in ("dataset", "facility")})


@query("""SELECT 'D' || doc_id AS bibcode, '{"meta_path":"/m","ft_source":"/s","bibcode":"D' || doc_id || '","provider":"' || source || '"' || CASE WHEN doc_id % 2 = 0 THEN ',"dataset":["a"]' ELSE ',"dataset":[]' END || CASE doc_id % 3 WHEN 0 THEN ',"acknowledgements":""' WHEN 1 THEN ',"acknowledgements":"Thanks"' ELSE '' END || '}' AS value FROM documents""")
def meta_json(spark, sf_dir):
    none = F.lit(None).cast("string")
    rows = _records(spark, sf_dir).withColumns({"meta_path": F.lit("/m"), "ft_source": F.lit("/s"), "provider": F.col("source"), "update_reason": none, "file_format": none, "index_date": none})
    return rows.select("bibcode", assemble.meta_json().alias("value"))


@query("SELECT d.doc_id, (d.doc_id % 2 = 0 AND l.doc_id IS NOT NULL AND l.doc_id % 5 <> 0) AS recovered, CASE WHEN d.doc_id % 2 = 0 AND l.doc_id % 5 <> 0 THEN 'old' END AS fulltext FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id")
def force_send_recover(spark, sf_dir):
    d = F.col("doc_id")
    key = F.concat(F.lit("D"), d.cast("string")).alias("bibcode")
    records = table(spark, sf_dir, "documents").select("doc_id", key, F.when(d % 2 == 0, "FORCE_TO_SEND").otherwise("STALE_META").alias("update_reason"))
    prior = table(spark, sf_dir, "labels").select("doc_id").distinct().select(key, F.when(d % 5 == 0, "").otherwise("old").alias("fulltext"), F.lit("").alias("acknowledgements"), F.array(F.lit("x")).alias("dataset"), F.array(F.lit("y")).alias("facility"))
    return decide.recover(records, prior).select("doc_id", "recovered", "fulltext")


_NAMES = ("the", "and", "que", "der")


@query(f"SELECT 'D' || doc_id AS bibcode, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: w IN {_NAMES}))), ',') AS found FROM documents")
def facility_ner(spark, sf_dir):
    model = ner.gazetteer(_NAMES)
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("bibcode"), F.col("text").alias("fulltext"), F.lit(None).cast("string").alias("acknowledgements"))
    return ner.facilities(docs, model, model, empty_too=True).select("bibcode", F.array_join("facility_ft", ",").alias("found"))


@query("SELECT CASE WHEN l.doc_id IS NULL THEN 'missing_dir' WHEN l.doc_id % 3 = 0 THEN 'missing_meta' WHEN l.doc_id % 3 = 1 THEN 'missing_ft' WHEN l.doc_id % 5 = 0 THEN 'missing_date' ELSE 'ok' END AS status, count(*) AS n FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id GROUP BY ALL")
def audit_counts(spark, sf_dir):
    d = F.col("doc_id")
    key = F.concat(F.lit("D"), d.cast("string")).alias("bibcode")
    there = table(spark, sf_dir, "labels").select("doc_id").distinct().select(key, (d % 3 != 0).alias("has_meta"), (d % 3 != 1).alias("has_fulltext"), F.when(d % 5 != 0, "2020").alias("index_date"))
    return assemble.counts(assemble.audit(table(spark, sf_dir, "documents").select(key), there))


@query("SELECT d.doc_id FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id")
def audit_missing(spark, sf_dir):
    key = F.col("doc_id").alias("bibcode")
    return assemble.not_extracted(table(spark, sf_dir, "documents").select(key), table(spark, sf_dir, "labels").select(key)).select(F.col("bibcode").alias("doc_id"))


@query("SELECT d.doc_id FROM documents d SEMI JOIN labels l ON d.doc_id = l.doc_id")
def audit_present(spark, sf_dir):
    key = F.col("doc_id").alias("bibcode")
    return assemble.extracted(table(spark, sf_dir, "documents").select(key), table(spark, sf_dir, "labels").select(key)).select(F.col("bibcode").alias("doc_id"))


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def count_by_provider(spark, sf_dir):
    return assemble.counts(table(spark, sf_dir, "documents"), "source")


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS index_date, strftime(ts, '%a, %d %b %Y %H:%M:%S UTC') AS http_date, ts = ts AS parsed FROM events")
def date_functions(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    iso = paths.index_date(ts)
    return table(spark, sf_dir, "events").select("event_id", iso.alias("index_date"), paths.http_date(ts).alias("http_date"), (paths.parse_date(iso) == ts).alias("parsed"))


@query("SELECT doc_id // 100 AS batch, '[' || string_agg('\"D' || doc_id || '\"', ',' ORDER BY 'D' || doc_id) || ']' AS bibcodes FROM labels GROUP BY doc_id // 100")
def written_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").select("doc_id", F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("bibcode"))
    return assemble.written_keys(rows, F.floor(F.col("doc_id") / 100))


_ONE = f"CASE WHEN text IS NULL THEN 'no content' WHEN d.doc_id % 5 = 0 THEN 'unsupported format: pdf' END"


@query(f"""
SELECT bibcode, update_reason, CASE WHEN d.doc_id % 5 = 0 OR text IS NULL THEN NULL WHEN d.doc_id % 7 = 0 THEN {words_sql(_PLAIN)} || ' ' || {words_sql(_PLAIN)} ELSE {words_sql(_PLAIN)} END AS fulltext,
  CASE WHEN d.doc_id % 7 = 0 THEN {_ONE} || '; ' || {_ONE} ELSE {_ONE} END AS error
FROM {_DECIDED} d JOIN documents t ON d.doc_id = t.doc_id WHERE update_reason NOT LIKE 'IGNORE%'""")
def ingest_files(spark, sf_dir):
    decided = _decided(spark, sf_dir).where("selected")
    raw = F.when(F.col("file_format") == "xml", F.concat(F.lit("<x><body>"), _plain(), F.lit("</body></x>"))).otherwise(_plain())
    held = decided.select("doc_id", "file_format", F.explode(paths.split_sources(F.col("ft_source"))).alias("path")).join(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return pipeline.extracted(decided, held.select("path", F.encode(raw, "UTF-8").alias("content"))).select("bibcode", "update_reason", "fulltext", "error")


@query(f"SELECT doc_id, {words_sql('nfc_normalize(text)')} AS fulltext FROM documents")
def stream_extract(spark, sf_dir):
    folder = f"{spark.conf.get('spark.checkpoint.dir', None) or tempfile.gettempdir() + '/folioforge-streams'}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "documents").schema
    stream = ingest.stream_text(ingest.stream_table(spark, f"{sf_dir}/documents.parque[t]", schema)).select("doc_id", "fulltext")  # a pattern may match a file or a folder
    ingest.run(stream, lambda batch: batch, f"{folder}/out", f"{folder}/state").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("doc_id", "fulltext")
