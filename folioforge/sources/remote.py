"""Back ends outside Spark: HTTP, PDF tools and a PDF service, each called once a document and replaceable."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Callable, Sequence

from ..functions.textclean import PROFILES, py_clean, py_drop_long_runs
from ..operators.extract import register

HEADERS = {"User-Agent": "folioforge", "Accept": "text/plain"}
PDF_SECONDS = 30
SERVICE_SECONDS = 120
Fetch = Callable[[str, dict], tuple[int, str]]


def fetch(url: str, headers: dict) -> tuple[int, str]:
    import requests

    got = requests.get(url, headers=headers, timeout=SERVICE_SECONDS)
    return got.status_code, got.text


def http_text(url: str, get: Fetch = fetch, since: str | None = None) -> dict:
    """Fields of a page; any status but 200 is an error."""
    status, body = get(url, HEADERS | ({"If-Modified-Since": since} if since else {}))
    if status != 200:
        raise OSError(f"HTTP status {status} for {url}")
    once = py_clean(body, *PROFILES["http"])
    return {"fulltext": py_clean(once, *PROFILES["http"])}


def run_tool(command: Sequence[str], content: bytes, seconds: float = PDF_SECONDS) -> bytes:
    """Standard output of a tool given a file; its standard error if it fails."""
    if not content:
        raise OSError("exit status 127: no file")
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(content)
        f.flush()
        done = subprocess.run([*command[:1], *[x.replace("{}", f.name) for x in command[1:]]], capture_output=True, timeout=seconds, check=False)
    if done.returncode:
        raise OSError(done.stderr.decode("utf-8", "replace") or f"exit status {done.returncode}")
    return done.stdout


def pdf_text(content: bytes, tool: Sequence[str] = ("pdftotext", "-q", "{}", "-"), strip: Sequence[str] | None = ("gs", "-q", "-o", "-", "-sDEVICE=pdfwrite", "-dFILTERVECTOR", "{}"), seconds: float = PDF_SECONDS, run=run_tool) -> dict:
    """Fields of a PDF; if the tool takes too long, drawings are stripped first and it is tried again."""
    try:
        out = run(tool, content, seconds)
    except subprocess.TimeoutExpired:
        if strip is None:
            raise
        out = run(tool, run(strip, content, seconds), seconds)
    return {"fulltext": py_clean(out, *PROFILES["pdf"])}


def pdf_text_plain(content: bytes, parse: Callable[[bytes], str]) -> dict:
    """The other tool: its parser is given, its cleaning only drops long runs."""
    return {"fulltext": py_drop_long_runs(parse(content))}


def service_text(content: bytes, post: Callable[[bytes, float], str] | None) -> dict:
    """Fields from a PDF service; no service or any failure gives an empty text."""
    try:
        body = post(content, SERVICE_SECONDS) if post else ""
    except Exception:
        body = ""
    return {"fulltext": py_clean(body, *PROFILES["pdf"])}


def post_to(url: str) -> Callable[[bytes, float], str]:
    def post(content: bytes, seconds: float) -> str:
        import requests

        got = requests.post(url, files={"input": content}, timeout=seconds)
        got.raise_for_status()
        return got.text

    return post


def enable_pdf(service: str | None = None, **options) -> None:
    """Register pdf and pdf-grobid with the dispatcher."""
    register("pdf", lambda c: pdf_text(bytes(c), **options))
    register("pdf-grobid", lambda c: service_text(bytes(c), post_to(service) if service else None))
