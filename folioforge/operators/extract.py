"""Extraction of full text and fields, as pure functions on strings and as operators on columns.

Texts are cleaned by one call per document; formats with trees go through one that parses, prunes,
selects and cleans. Documents go to Python by the hundred
(``textclean.row_udf``), not in Arrow batches. A failing document gets an ``error`` and leaves the others alone.
"""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from ..functions.entities import decode_entities
from ..functions.markup import py_prepare
from ..functions.textclean import PROFILES, clean, py_clean, row_udf
from ..schema import CONTENT_TYPE
from .rules import DROPPED, HTML_INTRODUCTION, HTML_REFERENCES, MOVED, RULES
from .tree import Node, bare, parse, select

EMPTY = {"fulltext": None, "acknowledgements": None, "dataset": None, "facility": None, "error": None}


def sniff(content: bytes) -> str:
    """Bytes to text: byte order mark, declared charset, UTF-8, then Windows-1252; what can't be read is left out."""
    for mark, name in ((b"\xef\xbb\xbf", "utf-8"), (b"\xff\xfe", "utf-16-le"), (b"\xfe\xff", "utf-16-be")):
        if content.startswith(mark):
            return content[len(mark) :].decode(name, "ignore")
    declared = re.search(rb"(?:charset|encoding)\s*=\s*[\"']?\s*([A-Za-z0-9._:-]+)", content[:4096])
    if declared:
        try:
            return content.decode(declared[1].decode(), "ignore")
        except LookupError:
            pass
    try:
        return content.decode("utf-8")
    except UnicodeDecodeError:
        return content.decode("cp1252", "ignore")


def _joined(texts: Iterable[str]) -> str:
    return " ".join(t.strip() for t in texts)


# HTML


def html_text(raw: str, tables: dict[str, str] | None = None) -> str:
    """Text of an HTML article; tables: names and HTML of linked files, put in place of the first link to each."""
    root = parse(decode_entities(raw), html=True)
    for path in HTML_INTRODUCTION:
        if found := select(root, path):
            for child in found[0].children[: found[0].index()]:
                child.detach()
            break
    if found := select(root, HTML_REFERENCES):
        if (after := found[0].following()) is not None:
            after.detach()
            found[0].detach()
    for name, html in (tables or {}).items():
        inner = select(parse(decode_entities(html), html=True), "//table")
        if not inner:
            raise ValueError(f"no table in {name}")
        links = [a for a in select(root, "//a") if name in a.attrs.get("href", "")]
        if links:
            holder = inner[0].parent
            holder.detach()
            holder.tail = ""
            holder.parent = links[0].parent
            links[0].parent.children[links[0].index()] = holder
            for other in links[1:]:
                other.detach()
    return py_clean(_joined(t for t in root.texts() if not t.isspace()), *PROFILES["html"])


def html_files(files: list[tuple[str, str]]) -> str:
    """The first file's text, with the tables of those after it whose path holds ``table``."""
    tables = {path.rsplit("/", 1)[-1]: html for path, html in files[1:] if "table" in path}
    return html_text(files[0][1], tables)


# XML


def _strict(markup: str) -> Node:
    """The tree of well-formed markup; without recursion, as documents may be nested to any depth."""
    root = Node("root")
    todo = [(ET.fromstring(markup), root)]
    while todo:
        e, parent = todo.pop()
        node = Node(bare(e.tag.rsplit("}", 1)[-1]), {bare(k.rsplit("}", 1)[-1]): v for k, v in e.attrib.items()}, parent)
        node.text, node.tail = e.text or "", e.tail or ""
        parent.children.append(node)
        todo.extend((c, node) for c in reversed(e) if isinstance(c.tag, str))
    return root


def _lenient(markup: str) -> Node:
    return parse(py_prepare(markup))


def _exact(markup: str) -> Node:
    try:
        return _strict(py_prepare(markup, lenient=False))
    except ET.ParseError:
        return Node("root")


PARSERS: dict[str, Callable[[str], Node]] = {"lenient": _lenient, "strict": _exact}


def xml_tree(raw: str, rules: dict, parsers: Iterable[str] = ("lenient", "strict")) -> Node:
    """The first parser's tree in which any rule finds something (else the last one's), pruned.

    Tables, figures, formulas and bibliographies go and their tails stay; acknowledgements move behind
    the element that holds them.
    """
    root = Node("root")
    decoded = decode_entities(raw)
    for name in parsers:
        root = PARSERS[name](decoded)
        for node in select(root, DROPPED):
            node.detach_keeping_tail()
        for node in select(root, MOVED):
            holder = node.parent
            if holder is not None and holder.parent is not None:
                # a move takes the tail along, as the parser's own tree does
                node.detach()
                node.place_after(holder)
        if any(select(root, p) for rule in rules.values() for p in rule["paths"]):
            break
    return root


def xml_string(root: Node, path: str, every: bool) -> str:
    found = select(root, path)
    text = " ".join(_joined(n.texts()) for n in (found if every else found[:1]))
    return py_clean(text, *PROFILES["xml"]) if found else ""


def xml_list(root: Node, path: str, attribute: str) -> list[str]:
    values = (n.attrs.get(bare(attribute)) for n in select(root, path))
    cleaned = [py_clean(v, *PROFILES["xml"]) for v in values if v is not None]
    return [v for v in cleaned if v not in ("None", "")]


def xml_fields(raw: str, kind: str = "xml", parsers: Iterable[str] = ("lenient", "strict")) -> dict:
    """All fields that the rules of ``kind`` name.

    Texts of several paths are joined by a line end. Once a text is held by an earlier one, it and all later
    paths of that field are passed over.
    """
    rules = RULES[kind]
    root = xml_tree(raw, rules, parsers)
    out: dict = {}
    for name, rule in rules.items():
        got, unique = [], True
        for path in rule["paths"]:
            value = xml_string(root, path, name == "fulltext") if rule["kind"] == "string" else xml_list(root, path, rule["attribute"])
            if not value:
                continue
            unique = unique and not any(value in s for s in got)
            if unique:
                got.append(value)
        if rule["kind"] == "string":
            out[name] = "\n".join(got)
        elif got:
            out[name] = got[0]
    return out


def section_summary(raw: str) -> str | None:
    """The last section of the body, or its last paragraph, cleaned; null without either."""
    root = xml_tree(raw, RULES["xml"])
    found = select(root, "//body/sec") or select(root, "//body/p")
    return py_clean(found[-1].content()) if found else None


# Registry and dispatch


def _text_of(content, profile: str) -> str:
    return py_clean(content, *PROFILES[profile])


def _as_text(content) -> str:
    return sniff(bytes(content)) if isinstance(content, (bytes, bytearray, memoryview)) else content


def _plain(content) -> str:
    return bytes(content).decode("utf-8", "ignore") if isinstance(content, (bytes, bytearray, memoryview)) else content


#: format -> content (bytes or text) -> fields; PDF and the like are added by ``register``
EXTRACTORS: dict[str, Callable[..., dict]] = {
    "txt": lambda c: {"fulltext": _text_of(_plain(c), "txt")},
    "ocr": lambda c: {"fulltext": _text_of(_plain(c), "ocr")},
    "http": lambda c: {"fulltext": _text_of(_text_of(_plain(c), "http"), "http")},
    "html": lambda c: {"fulltext": html_text(_as_text(c))},
    "xml": lambda c: xml_fields(_as_text(c), "xml"),
    "elsevier": lambda c: xml_fields(_as_text(c), "elsevier"),
    "teixml": lambda c: xml_fields(_as_text(c), "teixml"),
}


def register(name: str, extractor: Callable[..., dict]) -> None:
    """Add a format; the function is sent to the workers with the plan."""
    EXTRACTORS[name] = extractor


def extractor_of(file_format: Column, provider: Column) -> Column:
    """Name of the extractor: XML of one provider has its own."""
    return F.when((file_format == "xml") & (provider == "Elsevier"), "elsevier").otherwise(file_format)


def extract_one(name: str | None, content, extractors: dict[str, Callable[..., dict]] | None = None) -> dict:
    """Fields of one document; what fails becomes its error."""
    if content is None:
        return EMPTY | {"error": "no content"}
    run = (extractors or EXTRACTORS).get(name)
    if run is None:
        return EMPTY | {"error": f"unsupported format: {name}"}
    try:
        return EMPTY | run(content)
    except Exception as e:
        return EMPTY | {"error": f"{type(e).__name__}: {e}"}


def extract(docs: DataFrame, content: str = "content") -> DataFrame:
    """Add fulltext, acknowledgements, dataset, facility and error to rows with file_format, provider and content.

    Null content or an unknown format: an error, and null fields. Columns of those names in the input are replaced.
    """
    added = ("fulltext", "acknowledgements", "dataset", "facility", "error")
    keep = [c for c in docs.columns if c not in added and c != content]
    extractors = dict(EXTRACTORS)

    def one(name, content):
        return extract_one(name, bytes(content) if isinstance(content, bytearray) else content, extractors)

    # not deterministic: whatever is asked of the result, a document is extracted once
    got = row_udf(one, CONTENT_TYPE).asNondeterministic()(extractor_of(F.col("file_format"), F.coalesce("provider", F.lit(""))), F.col(content))
    rows = docs.select(F.struct(*keep).alias("row"), got.alias("got"))
    return rows.select("row.*", *[F.col("got").getField(c).alias(c) for c in added])


def extract_text(docs: DataFrame, text: str = "text", profile: str = "txt") -> DataFrame:
    """Plain text and OCR: cleaning alone."""
    translated, _, normalised, trimmed = PROFILES[profile]
    return docs.withColumn("fulltext", clean(F.col(text), translated, normalised, trimmed))


def field_udf(function: Callable[[str], object], kind: DataType = StringType()):
    """A function of one text as a UDF; nulls stay null, and a text that it fails on gives null."""

    def one(text):
        try:
            return None if text is None else function(text)
        except Exception:
            return None

    return row_udf(one, kind)


def fields_udf(kind: str):
    """All fields of XML of a kind, with an error where a text fails."""
    extractor = {kind: lambda text: xml_fields(text, kind)}
    return row_udf(lambda text: EMPTY if text is None else extract_one(kind, text, extractor), CONTENT_TYPE)


html_fulltext = field_udf(html_text)
xml_extract, elsevier_extract, tei_extract = (fields_udf(k) for k in ("xml", "elsevier", "teixml"))
summary = field_udf(section_summary)


def _with_tables(main: str | None, names, tables) -> str | None:
    """Main HTML with linked tables: arrays of file names and of their HTML. Null for a null or failing document."""
    try:
        return None if main is None else html_text(main, dict(zip(names, tables, strict=True)))
    except Exception:
        return None


html_with_tables = row_udf(_with_tables, StringType())
