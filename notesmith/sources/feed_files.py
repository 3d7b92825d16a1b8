"""Feed files (RSS 2.0 and Atom) as rows, with what cannot be read as rows of its own (O-S1).

Spark lists the files and hands each one over whole (``binaryFile``), whatever the file system; a task reads its files one after the
other with the XML parser's events. An entry's place is its number in its file, so the order does not depend on how
files are packed into tasks. A file that breaks off gives the entries before the break and one row with the error.
"""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notesmith.session import ship_package

#: Elements that are entries, and the fields read of them, by the names used in feeds.
ENTRIES = ("item", "entry")
FIELDS = {"title": "title", "link": "link", "description": "description", "content:encoded": "content", "content": "content", "summary": "description",
          "author": "author", "dc:creator": "creator", "pubDate": "published", "published": "published", "updated": "updated"}
#: The fields of a row.
NAMES = ("title", "link", "description", "content", "author", "creator", "published", "updated")
#: Bytes that the parser is given at once.
STEP = 1 << 20
SCHEMA = "file string, place long, error string, " + ", ".join(f"{n} string" for n in NAMES)


def parse_feed(data: bytes) -> Iterator[tuple[dict[str, str] | None, str | None]]:
    """(entry, None) per entry in order, and (None, error) last if the file breaks off."""
    path: list[str] = []
    entry: dict[str, str] | None = None
    inside = 0  # depth of the entry
    text: list[str] = []
    done: list[dict[str, str]] = []

    def put(name: str, value: str) -> None:
        if name and name not in entry:
            entry[name] = value

    def start(tag: str, attrs: dict[str, str]) -> None:
        nonlocal entry, inside
        if entry is None:
            if tag in ENTRIES:
                entry, inside = {}, len(path) + 1
        elif len(path) == inside:
            text.clear()
            if tag == "link" and attrs.get("href") and attrs.get("rel", "alternate") == "alternate":
                put("link", attrs["href"])
        elif path[inside] == "author":
            text.clear()  # an Atom author has a name inside
        else:
            text.append(f"<{tag}" + "".join(f" {k}={quoteattr(v)}" for k, v in attrs.items()) + ">")
        path.append(tag)

    def end(tag: str) -> None:
        nonlocal entry
        path.pop()
        if entry is None:
            return
        if len(path) == inside - 1:
            done.append(entry)
            entry = None
        elif len(path) == inside:
            if not (tag == "link" and not "".join(text).strip()):
                put(FIELDS.get(tag, ""), "".join(text))
            text.clear()
        elif path[inside] == "author":
            if tag == "name":
                put("author", "".join(text))
        else:
            text.append(f"</{tag}>")

    def chars(data: str) -> None:
        if entry is not None and len(path) > inside:
            text.append(escape(data) if len(path) > inside + 1 and path[inside] != "author" else data)

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    error = None
    for at in range(0, max(len(data), 1), STEP):
        try:
            parser.Parse(data[at:at + STEP], at + STEP >= len(data))
        except (expat.ExpatError, ValueError, LookupError) as e:
            error = str(e)
        yield from ((x, None) for x in done)
        done.clear()
        if error is not None:
            yield None, error
            return


def read_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """``SCHEMA``: one row per entry (``error`` null), and one per file that could not be read to its end (Spark passes empty files over)."""
    ship_package(spark)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, data in zip(pdf["path"], pdf["content"]):
                out = [{"file": file, "place": k, "error": error, **(entry or {})} for k, (entry, error) in enumerate(parse_feed(bytes(data)))]
                yield pd.DataFrame(out, columns=["file", "place", "error", *NAMES]).astype(object).where(lambda d: d.notna(), None)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(rows, SCHEMA)


def feed_errors(rows: DataFrame) -> DataFrame:
    """(stage, file, error): the files that broke off, in the shape of an ingest's errors."""
    return rows.where("error is not null").select(F.lit("feed").alias("stage"), "file", "error")
