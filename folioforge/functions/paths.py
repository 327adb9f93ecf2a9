"""Paths as columns: multi-file sources, pair-tree directories, formats; and the dates that go with them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PREFIX = r"^/[^/]*/[^/]*/"


def split_sources(source: Column) -> Column:
    """Absolute paths joined by commas, taken apart at the prefix that they share.

    The prefix runs to the third slash, so commas inside names are kept; null where the source has
    no such prefix.
    """
    prefix = F.regexp_extract(source, _PREFIX, 0)
    parts = F.split(source, F.concat(F.lit("\\Q"), prefix, F.lit("\\E")), F.lit(-1))
    names = F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.regexp_replace(F.concat(prefix, x), ",$", ""))
    return F.when(source.rlike(_PREFIX), names)


def source_error(source: Column) -> Column:
    return F.when(~source.rlike(_PREFIX), F.concat(F.lit("not an absolute path below two folders: "), source))


def py_split_sources(source: str) -> list[str]:
    if not source.startswith("/") or source.count("/") < 3:
        raise ValueError(f"not an absolute path below two folders: {source}")
    prefix = "/".join(source.split("/", 3)[:3]) + "/"
    return [f"{prefix}{x}".removesuffix(",") for x in source.split(prefix) if x]


def pair_path(key: Column) -> Column:
    """Two characters to a folder, with a slash at both ends; the public pair-tree escapes for ``. / :``."""
    safe = F.translate(key, "./:", ",=+")
    return F.concat(F.lit("/"), F.array_join(F.regexp_extract_all(safe, F.lit("(?s).{1,2}"), F.lit(0)), "/"), F.lit("/"))


def py_pair_path(key: str) -> str:
    safe = key.translate(str.maketrans("./:", ",=+"))
    return "/" + "".join(safe[i : i + 2] + "/" for i in range(0, len(safe), 2))


def meta_path(key: Column, root: str | Column) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.concat(F.regexp_replace(root, "/$", ""), pair_path(key), F.lit("meta.json"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def file_format(first: Column) -> Column:
    """Extension of the first file, lower case and without its dot; ``http`` for a bare URL; else ''."""
    name = F.regexp_replace(base_name(first), r"^\.+", "")
    ext = F.when(F.instr(name, ".") > 0, F.lower(F.element_at(F.split(name, r"\.", -1), -1))).otherwise("")
    return F.when((ext == "") & F.contains(first, F.lit("http://")), "http").otherwise(ext)


def modified_time(seconds: Column) -> Column:
    """Whole seconds, as file systems state them."""
    return F.timestamp_seconds(F.floor(seconds))


#: other forms than ISO 8601 that dates are read in, tried in this order
DATE_FORMS = (
    "d MMM yyyy HH:mm:ss zzz",
    "d MMM yyyy HH:mm:ss",
    "d MMM yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
)


def parse_date(text: Column) -> Column:
    """ISO 8601, or one of ``DATE_FORMS`` (after a day of the week or not), to timestamp; null where it can't be read."""
    trimmed = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9}, *", "")
    digits = F.when(trimmed.rlike(r"^\d{1,7}$"), F.lit(None)).otherwise(trimmed)  # a bare number isn't a year
    others = [F.try_to_timestamp(trimmed, F.lit(form)) for form in DATE_FORMS]
    compact = trimmed.rlike(r"^\d{8}(T\d{6})?$")
    return F.when(compact, F.coalesce(*others[-2:])).otherwise(F.coalesce(F.try_to_timestamp(digits), *others[:-2]))


def index_date(now: Column | None = None) -> Column:
    now = F.current_timestamp() if now is None else now
    return F.date_format(F.to_utc_timestamp(now, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def http_date(at: Column) -> Column:
    return F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss zzz")
