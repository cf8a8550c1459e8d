"""Members of .tar.gz archives.

Spark has no reader for tar files, so this is the one step done in Python inside
tasks. It only unpacks: an archive is streamed, hashed while it is read and its
members leave in bounded Arrow batches; all parsing happens in Spark afterwards.
A gzip stream cannot be split, so one archive is one task. A member too large for a
batch is not held whole: its articles leave one by one as their ends are read.
"""

from __future__ import annotations

import codecs
import gzip
import hashlib
import io
import re
import sys
import tarfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio_sync.functions.names import MEMBER_SUFFIX

# Tasks get this module's code with the function they run, so that the package need
# not be installed where the Python workers are.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MEMBERS_SCHEMA = (
    "archive_path string, member_name string, first_article int, xml string, member_error string,"
    " archive_md5 string, archive_error string"
)
# What a task holds of an archive at a time: the rows of a batch, and a member that is read whole.
BATCH_BYTES = 4 << 20
MEMBER_BYTES = 16 << 20
# What is wrong with the archive itself. Other read errors may pass: they fail the
# task, so that Spark tries it again, and the run if they persist.
DAMAGED = (tarfile.TarError, zlib.error, EOFError, gzip.BadGzipFile, FileNotFoundError)


class _HashingReader:
    """File object that feeds every byte it hands out to an MD5 digest."""

    def __init__(self, raw):
        self.raw, self.md5 = raw, hashlib.md5(usedforsecurity=False)

    def read(self, size: int = -1) -> bytes:
        data = self.raw.read(size) if size >= 0 else self.raw.read()
        self.md5.update(data)
        return data

    def finish(self) -> str:
        while self.read(1 << 20):
            pass
        return self.md5.hexdigest()


def open_stream(location: str):
    """A sequential reader for a local or remote path, which may hold any characters."""
    import pyarrow.fs as pafs

    location = re.sub("^file:/+", "/", location)
    remote = re.match("([a-z0-9]+)://([^/]*)/(.*)", location)
    if not remote:
        return pafs.LocalFileSystem().open_input_stream(location, compression=None)
    scheme, host, path = remote.groups()
    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    filesystem, base = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return filesystem.open_input_stream(f"{base.rstrip('/')}/{path}", compression=None)


def encoding_of(data: bytes) -> str:
    """The encoding that the start of an XML document declares (UTF-8 if it does not)."""
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return "utf-16"
    declared = re.match(rb"""\s*<\?xml[^>]*encoding=["']([A-Za-z0-9._-]+)["']""", data)
    encoding = declared.group(1).decode().lower() if declared else "utf-8"
    try:
        codecs.lookup(encoding)
    except LookupError:
        encoding = "utf-8"
    return "utf-8-sig" if encoding == "utf-8" else encoding


def decode_xml(data: bytes) -> str:
    """Text of an XML document in the encoding it declares.

    Bytes that the encoding does not allow are a UnicodeError."""
    return data.decode(encoding_of(data)).replace("\r\n", "\n").replace("\r", "\n")


def _decoded(data: bytes) -> tuple[str | None, str | None]:
    """Text and error of a member, one of which is None."""
    try:
        return decode_xml(data), None
    except UnicodeError as error:
        return None, f"{type(error).__name__}: {error}"


# What decides where an article begins and ends. Comments hide tags, and in an article CDATA sections too.
_MARK = re.compile(
    r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|(?P<empty><article(?:\s[^<>]*)?/>)|(?P<half><article\s[^<>]*\Z)|(?P<start><article[\s>])"
    r"|(?P<end></article\s*>)|(?P<open><!--|<!\[CDATA\[|</article\s*\Z)")
_LONGEST_OPENING = len("<![CDATA[")


def article_pieces(chunks: Iterator[str]) -> Iterator[str]:
    """The articles of a document that arrives in chunks, by the rule that splits a whole one.

    No more is held than an article, or a comment, and a chunk. An article without an end tag
    ends where the next one starts, or with the document."""
    text, at, begin, last = "", 0, None, False
    while not last:
        chunk = next(chunks, None)
        last = chunk is None
        keep = at if begin is None else begin
        text, at = text[keep:] + (chunk or ""), at - keep
        begin = None if begin is None else 0
        while True:
            mark = _MARK.search(text, at)
            if mark is None:
                # a mark may have begun in the last few characters
                at = max(at, len(text) if last else len(text) - _LONGEST_OPENING)
                break
            if begin is None and text.startswith("<![", mark.start()):
                at = mark.start() + 2
                continue
            if mark.lastgroup in ("open", "half") and not last:
                at = mark.start()
                break
            if mark.lastgroup == "open":
                if text.startswith("<!", mark.start()) and begin is not None:  # never closed: no markup behind it counts
                    yield text[begin:mark.start()]
                    begin = None
                at = mark.start() + 2
            elif mark.lastgroup in ("start", "half") or (mark.lastgroup == "empty" and begin is not None and text[mark.start() + 8] != "/"):
                if begin is not None:
                    yield text[begin:mark.start()]
                    begin = None
                if mark.lastgroup == "empty":
                    yield mark.group()
                else:
                    begin = mark.start()
                at = mark.end()
            else:
                if mark.lastgroup == "empty" and begin is None:
                    yield mark.group()
                elif mark.lastgroup == "end" and begin is not None:
                    yield text[begin:mark.end()]
                    begin = None
                at = mark.end()
    if begin is not None:
        yield text[begin:]


def _chunks(stream, size: int = 1 << 20) -> Iterator[str]:
    """Decoded text of a member, with newlines as in `decode_xml`."""
    data = stream.read(size)
    decoder = io.IncrementalNewlineDecoder(codecs.getincrementaldecoder(encoding_of(data))(), translate=True)
    while data:
        yield decoder.decode(data)
        data = stream.read(size)
    yield decoder.decode(b"", final=True)


def _large_member(name: str, stream) -> Iterator[tuple[str, int, str | None, str | None]]:
    """The articles of a member one by one; what follows bytes that cannot be decoded is lost."""
    number = 0
    try:
        for piece in article_pieces(_chunks(stream)):
            yield name, number, piece, None
            number += 1
    except UnicodeError as error:
        yield name, number, None, f"{type(error).__name__}: {error}"
        return
    if not number:
        yield name, 0, "", None


def _member_texts(location: str, status: dict, member_bytes: int) -> Iterator[tuple[str, int, str | None, str | None]]:
    """(name, number of the first article, xml, error) of each XML member or of its articles;
    leaves the digest and any error in `status`."""
    wanted = re.compile(MEMBER_SUFFIX, re.IGNORECASE)
    try:
        with open_stream(location) as raw:
            reader = _HashingReader(raw)
            try:
                with gzip.open(reader) as unzipped:
                    with tarfile.open(fileobj=unzipped, mode="r|") as tar:
                        for member in tar:
                            if member.isfile() and wanted.search(member.name):
                                stream = tar.extractfile(member)
                                if member.size > member_bytes:
                                    yield from _large_member(member.name, stream)
                                else:
                                    yield member.name, 0, *_decoded(stream.read())
                            tar.members = []  # the list of what was passed is not needed
                    while unzipped.read(1 << 20):  # to the checksum at the end
                        pass
            finally:
                status["md5"] = reader.finish()
    except DAMAGED as error:
        status["error"] = f"{type(error).__name__}: {error}"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ("archive_path", "member_name", "first_article", "xml", "member_error", "archive_md5", "archive_error")
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int32() if name == "first_article" else pa.string()) for name, column in zip(names, zip(*rows))],
        names=names,
    )


def _expanding(member_bytes: int):
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                archive = row["archive_path"]
                rows, size, status = [], 0, {}
                for name, first, xml, error in _member_texts(row["location"], status, member_bytes):
                    rows.append((archive, name, first, xml, error, None, None))
                    size += sys.getsizeof(xml)  # characters take up to four bytes
                    if size >= BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
                rows.append((archive, None, None, None, None, status.get("md5"), status.get("error")))
                yield _batch(rows)

    return expand


def expand_archives(
    archives: DataFrame, tasks: int, spread: int | None = None, member_bytes: int = MEMBER_BYTES
) -> DataFrame:
    """Members of the archives in (`archive_path`, `location`).

    A member of more than `member_bytes` gives a row per article instead of one in all;
    `first_article` is the number of a row's first article in its member. A member that cannot
    be decoded has a `member_error` and no text, from the place on where that shows if it is a large one. Each archive
    also gives one status row without a member: its MD5 digest, and the error if it
    is damaged or absent. The archives are dealt out evenly
    over `tasks`. When archives are fewer than cores, `spread` moves the members on
    to that many partitions before they are parsed.
    """
    placed = archives.select("archive_path", "location").repartition(tasks)
    members = placed.mapInArrow(_expanding(member_bytes), MEMBERS_SCHEMA)
    if spread:
        members = members.repartition(spread, F.xxhash64("archive_path", "member_name", "first_article"))
    return members


def archive_status(members: DataFrame) -> DataFrame:
    """The status rows of expanded archives."""
    return members.where(F.col("member_name").isNull()).select(
        "archive_path", "archive_md5", "archive_error"
    )
