"""WARC archives with a two-level capture index.

*Writing.*  A record is text (headers, then an HTTP response whose body is the payload
in UTF-8), so Spark's text sink writes the archives, with the blank lines that end a
record as line separator and its usual commit of finished files.  Of captures with the
same payload (by SHA-1, from a minimum size up) the one with the largest id is the
response and the others are revisits of it without body; captures below that size are
always responses.

*Reading.*  Files are dealt to tasks and parsed record by record by their lengths, so a
task holds one record, never a file.

*Index.*  The first level is a table of compressed blocks of captures in the order of
their reversed-host key (``net,example)/path``); range partitions of that order are the
shards.  The second level is the sparse directory, the first and last key of each block.
A lookup searches the directory by bisection, opens only the blocks found, and
reads the byte ranges they name.  The directory is broadcast within a checked size and
otherwise joined by shard.

The archives live in a folder that all executors reach under the same path or URL
(anything pyarrow can open).  Defined cases: a null payload is empty; a null URL has the
key ``-`` and no target header; control characters and spaces in URLs are percent-encoded; repeated ids
are kept as separate records (equal largest ids of one payload are all responses);
an empty table gives archives without records; further columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framewell.llm.common import join_sized, pick, settle_sized
from framewell.plans.settle import settle

EOL = "\r\n"
FILE_BYTES = 32 * 1024 * 1024
DIRECTORY_BYTES = 32 * 1024 * 1024
BATCH_BYTES = 4_000_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "file string, offset bigint, bytes bigint, kind string, record_id bigint, refers_to bigint, url string, payload_bytes bigint, payload_digest string"


def url_key(url: Column) -> Column:
    """Sort key of a URL: host in lower case and reversed, then path and query; no scheme, port, user or fragment."""
    parts = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?([^#]*)"
    host = F.lower(F.regexp_extract(url, parts, 1))
    rest = F.regexp_extract(url, parts, 2)
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.coalesce(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path), F.lit("-"))


def encoded(url: Column) -> Column:
    for code in [*range(0x21), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def planned(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``id, url, body, digest, bytes, refers_to``: null in ``refers_to`` marks a response."""
    rows = pages.select("id", "url", F.coalesce("body", F.lit("")).alias("body"))
    rows = rows.withColumns({"digest": F.sha1("body"), "bytes": F.octet_length("body")})
    repeated = (
        rows.where(F.col("bytes") >= least_bytes)
        .groupBy(F.unhex("digest").alias("_same"))
        .agg(F.max("id").alias("_kept"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    joined = join_sized(rows, repeated, F.unhex("digest") == F.col("_same"), F.lit(40), "repeated")
    return joined.withColumn("refers_to", F.when(F.col("_kept") != F.col("id"), F.col("_kept"))).drop("_same", "_kept")


def record_text(date: str) -> Column:
    """The record of a planned row, without the blank lines that end it."""
    revisit = F.col("refers_to").isNotNull()
    name = lambda c: F.concat(F.lit("<urn:capture:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"), F.lit(EOL * 2)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("bytes"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("id"))),
        F.lit(f"WARC-Date: {date}"),
        F.when(F.col("url").isNotNull(), F.concat(F.lit("WARC-Target-URI: "), encoded(F.col("url")))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), name(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(EOL, *lines), F.lit(EOL * 2), block)


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one record per row into a new folder, in files of about ``FILE_BYTES``."""
    pages = pick(pages, id=id_col, url=url_col, body=payload_col)
    plan = planned(pages, least_bytes)
    size = pages.agg(F.avg(F.octet_length("body")).alias("b")).first()["b"] or 0
    per_file = max(1, int(FILE_BYTES / (size + 500)))
    plan.select(record_text(date).alias("value")).write.option("lineSep", EOL * 2).option("maxRecordsPerFile", per_file).text(path)


def _open(url: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(url)
    return where, path


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8").split(":", 1) for line in lines if b":" in line)
    return {k.lower(): v.strip(" ") for k, v in pairs}


def _named(value: str | None) -> int | None:
    found = (value or "").removeprefix("<urn:capture:").removesuffix(">")
    return int(found) if found.lstrip("-").isdigit() else None


def parse_record(data: bytes) -> tuple:
    """``kind, record_id, refers_to, url, payload_bytes, payload_digest`` of one record; the digest is computed
    from the payload of responses and must agree with the header."""
    head, _, block = data.partition(b"\r\n\r\n")
    warc = _headers(head.split(b"\r\n"))
    if not head.startswith(b"WARC/") or int(warc["content-length"]) > len(block):
        raise ValueError("not a WARC record")
    http_head, _, body = block[: int(warc["content-length"])].partition(b"\r\n\r\n")
    size = int(_headers(http_head.split(b"\r\n"))["content-length"])
    digest = warc["warc-payload-digest"].removeprefix("sha1:")
    if warc["warc-type"] == "response" and (len(body) != size or hashlib.sha1(body).hexdigest() != digest):
        raise ValueError(f"{warc['warc-record-id']}: the payload does not match its digest")
    return warc["warc-type"], _named(warc["warc-record-id"]), _named(warc.get("warc-refers-to")), warc.get("warc-target-uri"), size, digest


def records_in(stream) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of every record of an open stream, one at a time."""
    offset, data = 0, b""
    while True:
        while b"\r\n\r\n" not in data:
            more = stream.read(1 << 20)
            if not more:
                if data.strip():
                    raise ValueError("the archive ends inside a record")
                return
            data += more
        head = data.index(b"\r\n\r\n") + 4
        whole = head + int(_headers(data[:head].split(b"\r\n"))["content-length"])
        parts, have = [data], len(data)
        while have < whole + 4:
            more = stream.read(max(1 << 20, whole + 4 - have))
            if not more:
                raise ValueError("the archive ends inside a record")
            parts.append(more)
            have += len(more)
        data = b"".join(parts)
        yield offset, data[:whole]
        offset, data = offset + whole + 4, data[whole + 4 :]


def _batch(rows: list[tuple]) -> pd.DataFrame:
    names = [f.split()[0] for f in RECORD.split(", ")]
    out = pd.DataFrame(rows, columns=names)
    return out.astype({c: "Int64" for c in ("offset", "bytes", "record_id", "refers_to", "payload_bytes")})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives in a folder, with its file, offset and length."""
    found = spark.read.format("binaryFile").load(path).select("path", "length")  # lists the files, contents stay unread
    count = found.count()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["path"]:
                where, name = _open(url)
                with where.open_input_stream(name) as stream:
                    rows = []
                    for offset, data in records_in(stream):
                        rows.append((url, offset, len(data), *parse_record(data)))
                        if len(rows) >= 5000:
                            yield _batch(rows)
                            rows = []
                    yield _batch(rows)

    return found.select("path").repartition(max(1, count)).mapInPandas(run, RECORD)


def build_index(records: DataFrame, *, block: int = 2000) -> DataFrame:
    """The first level: ``shard, block, first_key, last_key, captures, data`` with ``data`` a compressed block."""
    keyed = records.select(url_key(F.col("url")).alias("key"), "record_id", "file", "offset", "bytes")
    ranged = keyed.repartitionByRange("key", "record_id", "file", "offset").sortWithinPartitions("key", "record_id", "file", "offset")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept, number = [], 0

        def packed(rows: pd.DataFrame) -> pd.DataFrame:
            lines = [json.dumps(r) for r in rows[["key", "file", "offset", "bytes"]].values.tolist()]
            data = zlib.compress("\n".join(lines).encode())
            keys = rows["key"]
            return pd.DataFrame({"shard": rows["shard"].iloc[:1], "block": [number], "first_key": [keys.iloc[0]], "last_key": [keys.iloc[-1]], "captures": [len(rows)], "data": [data]})

        rest = None
        for batch in batches:
            rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            while len(rest) >= block:
                yield packed(rest.iloc[:block].reset_index(drop=True))
                number, rest = number + 1, rest.iloc[block:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield packed(rest)

    made = ranged.withColumn("shard", F.spark_partition_id()).mapInPandas(
        run, "shard int, block int, first_key string, last_key string, captures bigint, data binary"
    )
    return settle(made, "captures")


def lookup(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Captures of the distinct ``key`` values: ``key, file, offset, bytes``.

    Searches the sparse directory by bisection and opens only the blocks found.
    """
    wanted = settle(keys.select("key").where(F.col("key").isNotNull()).distinct(), "wanted")
    weight = F.octet_length("first_key") + F.octet_length("last_key") + 24
    directory, size = settle_sized(index.select("shard", "block", "first_key", "last_key"), weight, "directory")
    if size <= DIRECTORY_BYTES:
        # in the order of the UTF-8 bytes, which is Spark's order of strings
        rows = sorted((r["first_key"].encode(), r["last_key"].encode(), r["shard"], r["block"]) for r in directory.collect())
        shared = keys.sparkSession.sparkContext.broadcast(rows)

        def search(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            entries = shared.value
            lasts = [e[1] for e in entries]
            for batch in batches:
                hits = []
                for key in batch["key"]:
                    data = key.encode()
                    at = bisect.bisect_left(lasts, data)  # the first block that ends at or after the key
                    while at < len(entries) and entries[at][0] <= data:
                        hits.append((entries[at][2], entries[at][3]))
                        at += 1
                yield pd.DataFrame(sorted(set(hits)), columns=["shard", "block"])

        blocks = wanted.mapInPandas(search, "shard int, block int").distinct()
    else:
        bounds = directory.groupBy("shard").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high"))
        in_shard = wanted.join(F.broadcast(bounds), F.col("key").between(F.col("low"), F.col("high"))).select("key", "shard")
        met = in_shard.join(directory, "shard").where(F.col("key").between(F.col("first_key"), F.col("last_key")))
        blocks = met.select("shard", "block").distinct()
    opened = index.join(blocks, ["shard", "block"], "left_semi").select("data")

    def lines(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                rows = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
                yield pd.DataFrame(rows, columns=["key", "file", "offset", "bytes"])

    captures = opened.mapInPandas(lines, "key string, file string, offset bigint, bytes bigint")
    return captures.join(wanted, "key", "left_semi")


def fetch(captures: DataFrame) -> DataFrame:
    """The records behind captures, by range reads; the captures of a file and stretch are read by one task."""
    stretch = F.floor(F.col("offset") / FILE_BYTES)
    dealt = captures.repartition("file", stretch).sortWithinPartitions("file", "offset")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, stream = None, None
        try:
            for batch in batches:
                rows = []
                for url, offset, size in zip(batch["file"], batch["offset"], batch["bytes"], strict=True):
                    if url != current:
                        if stream is not None:
                            stream.close()
                        where, name = _open(url)
                        current, stream = url, where.open_input_file(name)
                    rows.append((url, offset, size, *parse_record(stream.read_at(size, offset))))
                yield _batch(rows)
        finally:
            if stream is not None:
                stream.close()

    return dealt.select("file", "offset", "bytes").mapInPandas(run, RECORD)
