"""ZIP archives as a DataFrame of entries.

Reading takes two steps. The directory of every archive becomes a small staged
table, one row an entry with its place in the file; then ranges of entries, of
about ``RANGE_BYTES``, are dealt to tasks that seek and inflate them one by one.
Neither the size of an archive nor the number of archives is bounded by a task.

Python's ``zipfile`` reads the directories and the entries. Only an archive whose
directory cannot be read is walked along the headers before its entries, in a
stream, so that what precedes the damage can be had.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.schemas import ARCHIVE_ENTRIES
from lexmill.session import stage

# Fixed values of the ZIP format.
LOCAL_HEADER = "<4s5H3I2H"
LOCAL_HEADER_SIZE = 30
LOCAL_SIGNATURE = b"PK\x03\x04"
# what may follow the entries: extra data record, directory, its end, in ZIP64 form too
DIRECTORY_SIGNATURES = (b"PK\x06\x08", b"PK\x01\x02", b"PK\x05\x06", b"PK\x06\x06")
DESCRIPTOR_SIGNATURE = b"PK\x07\x08"
STORED, DEFLATED = 0, 8
FLAG_ENCRYPTED, FLAG_DESCRIPTOR, FLAG_UTF8 = 0x1, 0x8, 0x800
IN_EXTRA = 0xFFFFFFFF  # a size that is in the ZIP64 extra field

CHUNK = 1 << 20
BATCH_BYTES = 16 << 20
RANGE_BYTES = 64 << 20


class DamagedArchive(ValueError):
    """An archive or an entry cannot be read to its end."""


class Entry(NamedTuple):
    """Where an entry is: what its directory, or a walk to it, says."""

    name: str
    offset: int
    method: int
    flags: int
    crc: int
    packed: int
    size: int


def open_archive(path: str) -> BinaryIO:
    """A file to read and seek in, on any file system that Arrow knows."""
    local = re.fullmatch(r"(?:file:/*(?=/))?(/.*)", path)
    if local:
        return open(local[1], "rb")
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


# --- directories ------------------------------------------------------------------------------


def directory(file: BinaryIO, damage: list[str]) -> list[Entry]:
    """The entries of an archive; ``damage`` gets what keeps it from being read to its end."""
    try:
        with zipfile.ZipFile(file) as archive:
            return [
                Entry(i.orig_filename, i.header_offset, i.compress_type, i.flag_bits, i.CRC, i.compress_size, i.file_size)
                for i in archive.infolist()
            ]
    except (zipfile.BadZipFile, OSError, ValueError):
        found = []
        try:
            found.extend(walk(file))
        except _Ended as end:
            found, reason = end.args
            damage.append(reason)
        return found


class _Ended(Exception):
    """A walk met damage: the entries before it, and what it is."""


def walk(file: BinaryIO) -> list[Entry]:
    """The entries before a directory, by their own headers; each is read to its end and checked."""
    found: list[Entry] = []
    size = file.seek(0, io.SEEK_END)
    file.seek(0)
    start = file.read(4)
    if len(start) < 4 and LOCAL_SIGNATURE.startswith(start):
        raise _Ended(found, "archive ends before its first entry")
    if start not in (LOCAL_SIGNATURE, *DIRECTORY_SIGNATURES):
        return found  # no archive, no entries
    at = 0
    while True:
        file.seek(at)
        header = file.read(LOCAL_HEADER_SIZE)
        if header[:4] in DIRECTORY_SIGNATURES:
            return found
        if len(header) < LOCAL_HEADER_SIZE:
            raise _Ended(found, "archive ends before its directory")
        if header[:4] != LOCAL_SIGNATURE:
            raise _Ended(found, "no entry or directory")
        try:
            entry, at = _walked(file, at, header, size)
        except DamagedArchive as exc:
            raise _Ended(found, str(exc)) from exc
        found.append(entry)


def _walked(file: BinaryIO, at: int, header: bytes, end: int) -> tuple[Entry, int]:
    """The entry at ``at``, and where the next header is."""
    _, _, flags, method, _, _, crc, packed, size, name_len, extra_len = struct.unpack(LOCAL_HEADER, header)
    name, extra = file.read(name_len), file.read(extra_len)
    body = at + LOCAL_HEADER_SIZE + name_len + extra_len
    if body > end:
        raise DamagedArchive("archive ends inside a header")
    if flags & FLAG_ENCRYPTED:
        raise DamagedArchive("encrypted entry")
    described = flags & FLAG_DESCRIPTOR
    if not described and IN_EXTRA in (packed, size):
        size, packed = _wide_sizes(extra, packed, size)
    if method == STORED and not described:
        found_crc, used, content = _measured(file, packed, None)
        if used < packed:
            raise DamagedArchive("archive ends inside an entry")
    elif method == DEFLATED:
        found_crc, used, content = _measured(file, None if described else packed, zlib.decompressobj(-zlib.MAX_WBITS))
    else:
        raise DamagedArchive(f"compression method {method}, flags {flags:#x}")
    after = body + used
    if described:
        file.seek(after)
        tail = file.read(24)
        if tail[:4] == DESCRIPTOR_SIGNATURE:
            after, tail = after + 4, tail[4:]
        crc = int.from_bytes(tail[:4], "little")
        # sizes of 4 or, in a ZIP64 archive, 8 bytes; they are known by now
        forms = [struct.pack("<QQ", used, content)]
        if used < 1 << 32 > content:
            forms.append(struct.pack("<II", used, content))
        fitting = [f for f in forms if tail[4 : 4 + len(f)] == f]
        if not fitting:
            raise DamagedArchive("archive ends inside a data descriptor, or its sizes are wrong")
        after += 4 + len(fitting[0])
    if found_crc != crc:
        raise DamagedArchive("checksum mismatch")
    text = name.decode("utf-8" if flags & FLAG_UTF8 else "cp437", "replace")
    return Entry(text, at, method, flags, crc, used, content), after


def _measured(file: BinaryIO, packed: int | None, inflater) -> tuple[int, int, int]:
    """Checksum, packed bytes and content bytes of the entry at the file's place; ``packed`` is None if unknown."""
    crc = used = content = 0
    while packed is None or used < packed:
        chunk = file.read(CHUNK if packed is None else min(CHUNK, packed - used))
        if not chunk:
            break
        used += len(chunk)
        try:
            while True:
                some = inflater.decompress(chunk, CHUNK) if inflater else chunk
                crc, content = zlib.crc32(some, crc), content + len(some)
                chunk = inflater.unconsumed_tail if inflater else b""
                if not chunk:
                    break
        except zlib.error as exc:
            raise DamagedArchive(str(exc)) from exc
        if inflater and inflater.eof:
            return crc, used - len(inflater.unused_data), content
    if inflater:
        raise DamagedArchive("archive ends inside an entry")
    return crc, used, content


def _wide_sizes(extra: bytes, packed: int, size: int) -> tuple[int, int]:
    """(size, packed) with what the ZIP64 extra field has of them."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return (next(wide, size) if size == IN_EXTRA else size), (next(wide, packed) if packed == IN_EXTRA else packed)
        at += 4 + length
    return size, packed


# --- entries ------------------------------------------------------------------------------------


def entry_content(file: BinaryIO, entry: Entry) -> zipfile.ZipExtFile:
    """A reader of an entry's content, which checks it."""
    file.seek(entry.offset)
    header = file.read(LOCAL_HEADER_SIZE)
    if len(header) < LOCAL_HEADER_SIZE or header[:4] != LOCAL_SIGNATURE:
        raise DamagedArchive("no entry where the directory has one")
    if entry.flags & FLAG_ENCRYPTED:
        raise DamagedArchive("encrypted entry")
    name_len, extra_len = struct.unpack(LOCAL_HEADER, header)[-2:]
    file.seek(name_len + extra_len, io.SEEK_CUR)
    info = zipfile.ZipInfo(entry.name)
    info.compress_type, info.CRC = entry.method, entry.crc
    info.compress_size, info.file_size = entry.packed, entry.size
    return zipfile.ZipExtFile(file, "r", info)


def read_entry(file: BinaryIO, entry: Entry, keep: bool = True) -> bytes:
    """The content of an entry, or nothing once it is checked."""
    try:
        reader = entry_content(file, entry)
        if keep:
            content, size = reader.read(), None
        else:
            content, size = b"", 0
            while chunk := reader.read(CHUNK):
                size += len(chunk)
    except DamagedArchive:
        raise
    except (zipfile.BadZipFile, zlib.error) as exc:
        reason = "checksum mismatch" if "CRC" in str(exc) else str(exc)
        raise DamagedArchive(reason) from exc
    except (EOFError, NotImplementedError, OSError) as exc:
        raise DamagedArchive(f"archive ends inside an entry ({exc})") from exc
    if (len(content) if keep else size) != entry.size:
        raise DamagedArchive("archive ends inside an entry")
    return content


def archive_entries(data: bytes, lenient: bool = False, damage: list[str] | None = None) -> Iterator[tuple[str, bytes]]:
    """(name, content) of each entry of one archive in memory, in the order of its directory.

    Lenient reading ends an archive at the first damage, strict reading raises
    there. ``damage`` gets what ended a lenient reading. A file that is no archive
    has no entries; one that is too short to tell is damaged.
    """
    damage = [] if damage is None else damage
    file, cut = io.BytesIO(data), []
    for entry in directory(file, cut):
        try:
            content = read_entry(file, entry)
        except DamagedArchive as exc:
            if not lenient:
                raise
            damage.append(str(exc))
            return
        yield entry.name, content
    if cut and not lenient:
        raise DamagedArchive(cut[0])
    damage.extend(cut)


def named_entries(
    path: str, data: bytes, lenient: bool, damage: list[str] | None = None
) -> Iterator[tuple[str, bytes]]:
    """Entries of one archive; damage is reported with the archive's path."""
    try:
        yield from archive_entries(bytes(data), lenient, damage)
    except DamagedArchive as exc:
        raise DamagedArchive(f"{path}: {exc}") from exc


def batches_of(rows: Iterator[tuple[str, str, bytes]]) -> Iterator[pd.DataFrame]:
    """Entries in batches of about ``BATCH_BYTES``."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2])
        if size >= BATCH_BYTES:
            yield pd.DataFrame(held, columns=ARCHIVE_ENTRIES.names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=ARCHIVE_ENTRIES.names)


def unzip(archives: DataFrame, lenient: bool = False) -> DataFrame:
    """Entries of the archives in ``archives(path, content)``, each of which is in one row's memory."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from batches_of(
            (path, name, content)
            for batch in batches
            for path, data in zip(batch["path"], batch["content"])
            for name, content in named_entries(path, data, lenient)
        )

    return archives.select("path", "content").mapInPandas(unpack, ARCHIVE_ENTRIES)


# --- files --------------------------------------------------------------------------------------

CATALOGUE = (
    "path string, number long, range long, name string, offset long, method int, flags int, crc long, packed long, size long, "
    "damage string"
)
FIELDS = ["name", "offset", "method", "flags", "crc", "packed", "size"]


def list_zips(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, ...) of every ZIP under ``path``. Contents are read only if they are asked for."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def catalogue(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """The entries of every ZIP under ``path``, staged, and a row without a name where an archive ends in damage.

    ``number`` counts the entries of an archive, ``range`` its ranges. Strict reading raises
    at a damaged directory here, at a damaged entry when it is read. Lenient reading checks
    every entry first, in a pass of its own, and leaves out what is not before the first damage.
    """

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in CATALOGUE.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                damage: list[str] = []
                with open_archive(path) as file:
                    entries = directory(file, damage)
                if damage and not lenient:
                    raise DamagedArchive(f"{path}: {damage[0]}")
                rows, before = [], 0
                for number, entry in enumerate(entries):
                    rows.append((path, number, before // RANGE_BYTES, *entry, None))
                    before += entry.packed + LOCAL_HEADER_SIZE
                rows += [(path, len(entries), -1, None, *[None] * (len(FIELDS) - 1), reason) for reason in damage]
                for at in range(0, len(rows), 100_000):
                    some = pd.DataFrame(rows[at : at + 100_000], columns=names)
                    yield some.astype({c: "Int64" for c in FIELDS[1:]})

    files = list_zips(spark, path).select("path")
    found = stage(files.repartition(spark.sparkContext.defaultParallelism, "path").mapInPandas(listed, CATALOGUE), "zip-catalogue")
    if not lenient:
        return found
    bad = ranged(found).mapInPandas(_checked, "path string, first long, reason string")
    first = bad.groupBy("path").agg(F.min(F.struct("first", "reason")).alias("bad"))
    joined = found.join(stage(first, "zip-damage"), "path", "left")
    before = joined.where("bad is null or number < bad.first").drop("bad")
    ends = joined.where("number = bad.first").withColumns({c: F.lit(None).cast(found.schema[c].dataType) for c in FIELDS})
    ends = ends.withColumns({"range": F.lit(-1).cast("long"), "damage": F.col("bad.reason")}).drop("bad")
    return stage(before.unionByName(ends), "zip-catalogue")


def ranged(entries: DataFrame) -> DataFrame:
    """A catalogue's entries, each range in one task, in the order of the file."""
    spark = entries.sparkSession
    named = entries.where("name is not null")
    total = named.agg(F.sum(F.col("packed") + LOCAL_HEADER_SIZE)).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // RANGE_BYTES))
    return named.repartition(tasks, "path", "range").sortWithinPartitions("path", "number")


def each_entry(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, BinaryIO, Entry]]:
    """The entries of catalogue rows with their open archive; one archive is open at a time."""
    path, file = None, None
    try:
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.path != path:
                    if file is not None:
                        file.close()
                    path, file = row.path, open_archive(row.path)
                yield path, row.number, file, Entry(row.name, *(int(getattr(row, c)) for c in FIELDS[1:]))
    finally:
        if file is not None:
            file.close()


def _checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The damaged entries of a range."""
    for path, number, file, entry in each_entry(batches):
        try:
            read_entry(file, entry, keep=False)
        except DamagedArchive as exc:
            yield pd.DataFrame([(path, number, str(exc))], columns=["path", "first", "reason"])


def entries_read(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, str, bytes]]:
    """(path, name, content) of catalogue rows; damage is reported with the archive's path."""
    for path, _, file, entry in each_entry(batches):
        try:
            yield path, entry.name, read_entry(file, entry)
        except DamagedArchive as exc:
            raise DamagedArchive(f"{path}: {exc}") from exc


def read_zips(spark: SparkSession, path: str, lenient: bool = False) -> DataFrame:
    """One row per entry of every ZIP under ``path``; an entry must fit a row (2 GB)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from batches_of(entries_read(batches))

    return ranged(catalogue(spark, path, lenient)).mapInPandas(read, ARCHIVE_ENTRIES)
