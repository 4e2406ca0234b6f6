"""WARC archives as a Spark data source.

Writing: every record is one gzip member; its extra field holds the member's length. Files are rolled at `roll_bytes`; a file that
is not named in a commit is not part of the archive. Reading: whole files are dealt into partitions of about `split_bytes`. Equality, IN and null
filters on the record type and on header columns are pushed down. A reader inflates a member's headers first; if they fail the filters, or no payload is asked for, it goes on to
the next member by the length without inflating the rest.

Archives of others are read too: `*.warc.gz` whose members do not tell their length (the rest of a member is then inflated and passed over),
several records in one member, and plain `*.warc`, whose records are skipped by their length. Of an HTTP message the payload is what
follows its head, transfer encodings as they are; of any other record it is the whole block. Revisits have none.

Defined cases: null payloads are empty; a null target or reference leaves the header out and is read as null; control characters
in a target are percent-encoded; an empty table gives an archive without records, a folder without archives is an error; repeated rows give
records of their own; ties go to the smaller id; very long payloads are inflated in steps and skipped where nobody asks for them; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, IsNotNull, IsNull,
                                    WriterCommitMessage)

from offerscope.operators.skew import salted_join

SCHEMA = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long,"
          " payload binary")
# Names of the format.
HEADERS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HEAD_BYTES = 4096
OWN_FILE = re.compile(r"part-[0-9a-f]{32}\.warc\.gz").fullmatch


def _deflate(data: bytes) -> bytes:
    """A gzip member whose extra field SL holds its compressed and plain length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    extra = b"SL" + struct.pack("<HQQ", 16, len(body), len(data))
    return (b"\x1f\x8b\x08\x04" + struct.pack("<IBBH", 0, 0, 255, len(extra)) + extra + body
            + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF))


def record(row: dict) -> bytes:
    """One record; a revisit carries the HTTP head only."""
    payload, kind = bytes(row["payload"] or b""), row["record_type"]
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {row['payload_bytes']}\r\n\r\n").encode()
    block = http + payload if kind == "response" else http
    lines = ["WARC/1.1"]
    for column, name in HEADERS.items():
        if row[column] is not None:
            value = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", row[column])
            lines.append(f"{name}: {'sha1:' * (column == 'payload_digest')}{value}")
    if kind == "revisit":
        lines.append(f"WARC-Profile: {PROFILE}")
    lines += [f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcWriter(DataSourceWriter):
    def __init__(self, path: str, roll_bytes: int):
        self.path, self.roll_bytes = path, roll_bytes

    def write(self, iterator) -> Written:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        files, out = [], None
        for row in iterator:
            if out is None or out.tell() >= self.roll_bytes:
                if out is not None:
                    out.close()
                files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                out = store.open_output_stream(f"{root}/{files[-1]}", compression=None)
            out.write(_deflate(record(row.asDict())))
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        store, root = fs.FileSystem.from_uri(self.path)
        store.create_dir(root, recursive=True)
        names = sorted(name for m in messages if m is not None for name in m.files)
        with store.open_output_stream(f"{root}/_commit-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        """Files of an aborted write are in no commit, so no reader sees them."""


class WarcReader(DataSourceReader):
    def __init__(self, path: str, columns: list[str], split_bytes: int, verify: bool):
        self.path, self.columns, self.split_bytes, self.verify, self.tests = path, columns, split_bytes, verify, []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0]
            if isinstance(f, (EqualTo, In, IsNotNull, IsNull)) and len(f.attribute) == 1 and column in HEADERS:
                if isinstance(f, (IsNull, IsNotNull)):
                    self.tests.append((column, None, isinstance(f, IsNull)))
                else:
                    self.tests.append((column, {f.value} if isinstance(f, EqualTo) else set(f.value), None))
            else:
                yield f

    def partitions(self):
        store, root = fs.FileSystem.from_uri(self.path)
        listed = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        commits = [info for info in listed if info.base_name.startswith("_commit-")]
        names: set[str] = set()
        for info in commits:
            with store.open_input_stream(info.path) as data:
                names.update(json.loads(data.read()))
        files = [i for i in listed if i.base_name.endswith((".warc", ".warc.gz"))
                 and (i.base_name in names or not (commits and OWN_FILE(i.base_name)))]
        if not files and not commits:
            raise FileNotFoundError(f"no archive in {self.path}")
        out, size = [], 0
        for info in sorted(files, key=lambda i: i.path):
            if not out or size + info.size > self.split_bytes:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(info.path)
            size += info.size
        return out or [Files([])]

    def _passes(self, fields: dict[str, str | None]) -> bool:
        for column, values, null in self.tests:
            value = fields[column]
            if null is not None and (value is None) != null or values is not None and value not in values:
                return False
        return True

    def read(self, partition) -> Iterator[tuple]:
        store, _ = fs.FileSystem.from_uri(self.path)
        for path in partition.paths:
            with store.open_input_file(path) as data:
                yield from self._zipped(data) if path.endswith(".gz") else self._records(Bytes(data, data.size()))

    def _zipped(self, data) -> Iterator[tuple]:
        size = data.size()
        while (begin := data.tell()) < size:
            head = data.read(12)
            if head[:3] != b"\x1f\x8b\x08":
                raise ValueError("not a gzip member")
            extra = data.read(struct.unpack("<H", head[10:])[0]) if head[3] & 4 else b""
            if extra[:2] == b"SL":
                packed, _ = struct.unpack("<QQ", extra[4:20])
                member = Inflated(data, -15, packed)
                yield from self._records(member, first_only=True)
                data.seek(begin + 12 + len(extra) + packed + 8)
            else:
                data.seek(begin)
                member = Inflated(data, 31, size - begin)
                yield from self._records(member)
                data.seek(begin + member.finish())

    def _records(self, stream: Bytes | Inflated, first_only: bool = False) -> Iterator[tuple]:
        """Records of a stream; without `first_only` the rest of each is passed over."""
        while stream.more():
            head = stream.until(b"\r\n\r\n")
            if not head.strip():
                return
            raw = _fields(head.lstrip())
            length, left = int(raw["content-length"]), int(raw["content-length"])
            fields = {column: raw.get(name.lower()) for column, name in HEADERS.items()}
            sha1 = (fields["payload_digest"] or "").startswith("sha1:")
            fields["payload_digest"] = (fields["payload_digest"] or "").removeprefix("sha1:") or None
            if self._passes(fields):
                payload, http, revisit = None, {}, fields["record_type"] == "revisit"
                if length and raw.get("content-type", "").startswith("application/http"):
                    message = stream.until(b"\r\n\r\n", left)
                    left -= len(message)
                    http = _fields(message)
                told = http.get("content-length", "")
                fields["payload_bytes"] = int(told) if told.isdigit() else None if revisit else left
                if not revisit and ("payload" in self.columns or self.verify):
                    payload = stream.take(left)
                    left = 0
                    if self.verify and (len(payload) != fields["payload_bytes"] or sha1 and digest(payload) != fields["payload_digest"]):
                        raise ValueError(f"payload of {fields['record_id']} is not what its headers say")
                fields["payload"] = payload
                yield tuple(fields[c] for c in self.columns)
            if first_only:
                return
            stream.skip(left + 4)


class Bytes:
    """What a plain file holds from here on."""

    def __init__(self, data, size: int):
        self.data, self.size, self.buffer = data, size, b""

    def _fill(self, wanted: int) -> bool:
        got = self.data.read(wanted)
        self.buffer += got
        return bool(got)

    def more(self) -> bool:
        return bool(self.buffer) or self._fill(HEAD_BYTES)

    def until(self, mark: bytes, limit: int | None = None) -> bytes:
        """Everything up to and with the mark, or to the end or limit."""
        begin = 0
        while (at := self.buffer.find(mark, begin)) < 0 and (limit is None or len(self.buffer) < limit):
            begin = max(0, len(self.buffer) - len(mark))
            if not self._fill(HEAD_BYTES):
                break
        end = at + len(mark) if at >= 0 else len(self.buffer)
        return self.take(end if limit is None else min(end, limit))

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self._fill(max(HEAD_BYTES, n - len(self.buffer))):
            pass
        got, self.buffer = self.buffer[:n], self.buffer[n:]
        return got

    def skip(self, n: int) -> None:
        inside = min(n, len(self.buffer))
        self.buffer = self.buffer[inside:]
        self.data.seek(min(self.size, self.data.tell() + n - inside))


class Inflated(Bytes):
    """What one gzip member holds, inflated as far as somebody reads."""

    def __init__(self, data, window: int, packed: int):
        super().__init__(data, packed)
        self.inflate, self.begin, self.rest = zlib.decompressobj(window), data.tell(), b""

    def _fill(self, wanted: int) -> bool:
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.data.read(min(max(HEAD_BYTES, min(wanted, 1 << 20)), self.begin + self.size - self.data.tell()))
            before = self.rest
            got = self.inflate.decompress(self.rest, wanted)
            self.rest = self.inflate.unconsumed_tail
            if got:
                self.buffer += got
                return True
            if not before and not self.rest:
                return False  # cut off
        return False

    def skip(self, n: int) -> None:
        while n > 0 and self.more():
            n -= len(self.take(min(n, 1 << 20)))

    def finish(self) -> int:
        """Packed length of the whole member."""
        while self.more():
            self.buffer = b""
        return self.data.tell() - self.begin - len(self.inflate.unused_data)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class WarcSource(DataSource):
    """Format "warc"; options path, roll_bytes, split_bytes, verify (inflate payloads and compare them with their headers)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], [f.name for f in schema.fields], int(self.options.get("split_bytes", 64 << 20)),
                          self.options.get("verify", "false") == "true")

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only added to")
        return WarcWriter(self.options["path"], int(self.options.get("roll_bytes", 64 << 20)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32_of_hex(hexadecimal):
    """Upper-case base 32 of 20 bytes given as 40 hexadecimal digits."""
    def digit(i):
        two = F.conv(F.substring(hexadecimal, F.floor(i * 5 / 4).cast("int") + 1, F.lit(2)), 16, 10).cast("int")
        five = F.floor(two / F.pow(F.lit(2), 3 - F.pmod(i * 5, F.lit(4)))).cast("int").bitwiseAND(31)
        return F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), five + 1, F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), digit), "")


def records(df: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """Rows of a page table as records: of equal payloads of at least so many bytes the smallest id is the response, others revisit it.

    A null id is larger than any other; rows of the same id and payload are all the response.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(url).alias("target_uri"), body.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    first = rows.where(F.col("payload_bytes") >= least).groupBy("sha1", "payload_bytes").agg(
        F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").drop("n")
    # The copies of one payload meet its first record without their bytes, spread by id; payloads move by id and digest.
    narrow = rows.where(F.col("payload_bytes") >= least).select(F.concat_ws(":", "sha1", "payload_bytes").alias("key"), "id", "sha1").distinct()
    known = salted_join(narrow, first.select(F.concat_ws(":", "sha1", "payload_bytes").alias("key"), "first"), "key", ["id"])
    known = known.select(F.col("id").alias("of"), F.col("sha1").alias("digest"), "first")
    rows = rows.join(known, F.col("id").eqNullSafe(F.col("of")) & (F.col("sha1") == F.col("digest")), "left")
    again = F.coalesce(~F.col("id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))
    return rows.select(name.alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri",
                       F.when(again, F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))).alias("refers_to"),
                       base32_of_hex(F.col("sha1")).alias("payload_digest"), "payload_bytes",
                       F.when(again, F.lit(None)).otherwise(F.col("payload")).alias("payload"))


def id_of(record_id: str):
    return F.expr(f"try_cast(regexp_extract({record_id}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
