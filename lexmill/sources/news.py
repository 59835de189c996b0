"""News XML entries as documents.

A malformed entry must become a bad record, not a failed job. Spark's XPath
functions fail the job on malformed XML and parse the entry again for every
field, so each entry is read once by expat inside an Arrow batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.schemas import PARSED_NEWS
from lexmill.sources.archives import entries_read, ranged

# Fixed values of the news format.
ITEM_TAG = "newsitem"
ID_ATTRIBUTE = "itemid"
FIELD_TAGS = ("title", "headline", "text")
ENTRY_SUFFIX = "newsML.xml"
ID_RANGE = range(-(2**63), 2**63)  # of a doc_id

ENTRIES_PER_BATCH = 2_000


def doc_name(doc_id: Column) -> Column:
    return F.concat(doc_id.cast("string"), F.lit(ENTRY_SUFFIX))


class _ItemReader:
    """Collects id and field texts of the news items of one entry."""

    def __init__(self) -> None:
        self.items: list[dict] = []
        self._open: list[tuple[int, dict]] = []
        self._fields: list[tuple[int, list[str]]] = []
        self._depth = 0

    def start(self, tag: str, attributes: dict) -> None:
        self._depth += 1
        if tag == ITEM_TAG:
            item = {"id": attributes.get(ID_ATTRIBUTE, "")}
            self.items.append(item)
            self._open.append((self._depth, item))
        elif tag in FIELD_TAGS:
            for _, item in self._open:
                if tag not in item:
                    item[tag] = []
                    self._fields.append((self._depth, item[tag]))

    def end(self, tag: str) -> None:
        while self._fields and self._fields[-1][0] == self._depth:
            self._fields.pop()
        if self._open and self._open[-1][0] == self._depth:
            self._open.pop()
        self._depth -= 1

    def data(self, text: str) -> None:
        for _, parts in self._fields:
            parts.append(text)


def parse_item(content: bytes) -> tuple:
    """(doc_id, title, headline, text, error) of one entry.

    The last news item wins. Reading stops at the first item that lacks a field
    or has no integer id; the item before it, if any, then stands.
    """
    reader = _ItemReader()
    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = reader.start
    parser.EndElementHandler = reader.end
    parser.CharacterDataHandler = reader.data
    try:
        parser.Parse(content, True)
    except (expat.ExpatError, LookupError, ValueError) as exc:
        return None, None, None, None, f"malformed XML: {exc}"
    found, error = None, "no news item"
    for item in reader.items:
        missing = [tag for tag in FIELD_TAGS if tag not in item]
        if missing:
            error = f"missing {missing[0]}"
            break
        if not re.fullmatch(r"[+-]?\d+", item["id"]) or int(item["id"]) not in ID_RANGE:
            error = f"bad item id {item['id']!r}"
            break
        found = (int(item["id"]), *("".join(item[tag]) for tag in FIELD_TAGS))
    return (*found, None) if found else (None, None, None, None, error)


def parse_entries(entries: DataFrame) -> DataFrame:
    """Parsed entries, good and bad, of ``entries(zip_path, entry_name, content)``."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = pd.DataFrame(
                [parse_item(bytes(content)) for content in batch["content"]],
                columns=PARSED_NEWS.names[2:],
            )
            parsed["doc_id"] = parsed["doc_id"].astype("Int64")
            parsed.insert(0, "entry_name", batch["entry_name"].values)
            parsed.insert(0, "zip_path", batch["zip_path"].values)
            yield parsed

    return entries.select("zip_path", "entry_name", "content").mapInPandas(parse, PARSED_NEWS)


def parse_archives(entries: DataFrame) -> DataFrame:
    """Parsed entries of a ``catalogue`` of archives.

    Unpacks and parses in one step, so that the unpacked XML never leaves the
    Python worker. Where a lenient reading ended is a record without an entry.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = entries_read(batches)
        while rows := [(path, name, *parse_item(xml)) for path, name, xml in islice(read, ENTRIES_PER_BATCH)]:
            parsed = pd.DataFrame(rows, columns=PARSED_NEWS.names)
            parsed["doc_id"] = parsed["doc_id"].astype("Int64")
            yield parsed

    cut = entries.where("name is null").select(
        F.col("path").alias("zip_path"),
        *(F.lit(None).cast(PARSED_NEWS[c].dataType).alias(c) for c in PARSED_NEWS.names[1:-1]),
        F.concat(F.lit("archive cut short: "), "damage").alias("error"),
    )
    return ranged(entries).mapInPandas(parse, PARSED_NEWS).unionByName(cut)


def parse_news(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents, bad_records) of archive entries.

    Both come from one lazy parse; stage or persist the entries first when both
    are used and unpacking is costly.
    """
    parsed = parse_entries(entries)
    documents = parsed.where(F.col("error").isNull()).select(
        "doc_id", doc_name(F.col("doc_id")).alias("doc_name"), "title", "headline", "text"
    )
    bad_records = parsed.where(F.col("error").isNotNull()).select("zip_path", "entry_name", "error")
    return documents, bad_records
