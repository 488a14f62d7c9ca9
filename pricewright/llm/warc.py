"""WARC archives: writing captures, reading them back, and assembling transactions.

write() turns each capture into a request, a response (or revisit) and a metadata record. A WARC record is text that
ends in an empty line, so Spark's own text writer makes the files, with that as its line separator: they land
wherever Spark can write, one task a file, and a lost task is simply run again. read() parses the files by each
record's Content-Length, unpacking a file as it goes. assemble() joins the records of a capture through
WARC-Concurrent-To, whichever of them names the other, and emits one nested row for each.

Of records with equal payloads of at least `least` bytes the one with the largest id is the response, the others are
revisits of it, which carry no payload but its digest and length; smaller ones are all responses.

Defined cases of writing: a null payload counts as empty; a null target is written as an empty one and read as null;
a null id comes below all others and has no capture-id field; rows that repeat an id yield one capture each, told
apart by digest and target in their identifiers, and rows that agree in those as well share identifiers, since they
are copies of one record; a payload may contain line ends and text that looks like a record.
Defined cases of reading: of a file that is cut off or damaged the records before the break are read, and no error is
raised; bytes of a header that aren't UTF-8 are read as Latin-1; a payload that isn't UTF-8 is in payload_raw, with null in
payload; a header field given several times counts with its last value, but for WARC-Concurrent-To, of which all
count; a record without a usable Content-Length is passed over; a response without request or metadata is emitted with
null in their place.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import named, written

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
END = "\r\n"
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, concurrent_to array<string>, refers_to string, target string, date string, digest string, payload_bytes long, digest_ok boolean, payload string, payload_raw binary, fields map<string,string>"


def digest(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits of the hex digest at a time, in base 32, with the digits renamed."""
    hexed = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit(END)), F.lit("")) for k, v in pairs])


def _record(kind: str, block: Column, *pairs: tuple[str, Column]) -> Column:
    """A record without the empty line at its end."""
    head = [("WARC-Type", F.lit(kind)), *pairs, ("WARC-Date", F.lit(DATE)), ("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit("WARC/1.1" + END), _lines(*head), F.lit(END), block)


def _name(i: Column, times: Column, digested: Column, mark: Column) -> Column:
    """What identifiers end in: the id and 1, or for a repeated or null id what tells its rows apart."""
    return F.when(i.isNotNull() & times.isNull(), F.concat_ws(".", i.cast("string"), F.lit("1"))).otherwise(F.concat_ws(".", F.coalesce(i.cast("string"), F.lit("")), digested, F.hex(mark)))


def roles(captures: DataFrame, id_column: str, target: str, payload: str, least: int = 0) -> DataFrame:
    """_id, _target and _payload of `captures`, _bytes, _digest, _key (of its identifiers) and _response (the _key of the capture
    that this one revisits, else null). What rows share is found on ids and digests alone, so payloads are shuffled once;
    the join is on id and digest, so a payload that a third of the rows share is dealt out by their ids."""
    df = captures.select(named(id_column).alias("_id"), named(target).alias("_target"), F.coalesce(named(payload), F.lit("")).alias("_payload"))
    df = df.withColumn("_mark", F.xxhash64(F.coalesce("_target", F.lit(""))))
    df = df.withColumns({"_bytes": F.octet_length("_payload").cast("long"), "_digest": digest(F.col("_payload"))})
    thin = df.groupBy(F.col("_id").alias("_i"), F.col("_digest").alias("_d")).agg(F.count("*").alias("_n"), F.min("_mark").alias("_m"))
    times = thin.groupBy(F.col("_i").alias("_j")).agg(F.sum("_n").alias("_times")).where("_times > 1")
    last = thin.groupBy(F.col("_d").alias("_e")).agg(F.max(F.struct(F.col("_i").isNotNull().alias("o"), "_i", "_m")).alias("_last"), F.sum("_n").alias("_all")).where("_all > 1").drop("_all")
    last = last.join(times.withColumnsRenamed({"_j": "_k", "_times": "_last_times"}), F.col("_last._i").eqNullSafe(F.col("_k")), "left").drop("_k")
    shared = thin.select("_i", "_d").join(last, F.col("_d") == F.col("_e"), "left").join(times, F.col("_i").eqNullSafe(F.col("_j")), "left")
    shared = shared.where("_last is not null or _times is not null").drop("_e", "_j")
    joined = df.join(shared, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_d")), "left")
    other = F.col("_last").isNotNull() & ~F.col("_last._i").eqNullSafe(F.col("_id")) & (F.col("_bytes") >= least)
    return joined.withColumns(
        {
            "_key": _name(F.col("_id"), F.col("_times"), F.col("_digest"), F.col("_mark")),
            "_response": F.when(other, _name(F.col("_last._i"), F.col("_last_times"), F.col("_digest"), F.col("_last._m"))),
        }
    ).drop("_i", "_d", "_last", "_last_times", "_times", "_mark")


def write(captures: DataFrame, path: str, id_column: str = "page_id", target: str = "url", payload: str = "html", least: int = 0, records_per_file: int = 3000, compression: str = "gzip") -> None:
    df = roles(captures, id_column, target, payload, least)
    uri = lambda what, k=F.col("_key"): F.concat(F.lit(f"<urn:capture:{what}:"), k, F.lit(">"))
    to = F.coalesce(F.regexp_replace(F.col("_target"), "[\\r\\n]", ""), F.lit(""))
    host = F.coalesce(F.regexp_extract(to, "^[a-z]+://([^/?#]*)([^?#]*)", 1), F.lit(""))
    line = F.concat(F.lit("GET "), F.when(to == "", F.lit("/")).otherwise(to), F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END + END))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("_bytes").cast("string"), F.lit(END + END))
    common = [("WARC-Target-URI", to), ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest")))]
    here = ("WARC-Record-ID", uri("response"))
    response = F.when(
        F.col("_response").isNull(),
        _record("response", F.concat(http, F.col("_payload")), here, *common, ("Content-Type", F.lit("application/http; msgtype=response"))),
    ).otherwise(
        _record("revisit", http, here, *common, ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("WARC-Refers-To", uri("response", F.col("_response"))), ("Content-Type", F.lit("application/http; msgtype=response")))
    )
    request = _record("request", line, ("WARC-Record-ID", uri("request")), ("WARC-Concurrent-To", here[1]), ("WARC-Target-URI", to), ("Content-Type", F.lit("application/http; msgtype=request")))
    about = _lines(("capture-id", F.col("_id").cast("string")), ("payload-bytes", F.col("_bytes").cast("string")))
    metadata = _record("metadata", about, ("WARC-Record-ID", uri("metadata")), ("WARC-Concurrent-To", here[1]), ("WARC-Target-URI", to), ("Content-Type", F.lit("application/warc-fields")))
    rows = df.select(F.explode(F.array(request, response, metadata)).alias("value"))
    rows.write.option("lineSep", END + END).option("maxRecordsPerFile", 3 * records_per_file).option("compression", compression).text(path)


def _fields(lines: list[bytes]) -> list[tuple[str, str]]:
    """Names in lower case and values; a line that starts with a space goes on with the value before it."""
    out: list[tuple[str, str]] = []
    for raw in lines:
        try:
            line = raw.decode()
        except UnicodeDecodeError:
            line = raw.decode("latin-1")
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, _, v = line.partition(":")
            out.append((k.strip().lower(), v.strip()))
    return out


def records(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """(header fields, block) of each whole record of an archive, compressed or not; memory holds one record unpacked."""
    stream = io.BytesIO(data)
    archive = gzip.GzipFile(fileobj=stream) if data[:2] == b"\x1f\x8b" else stream
    try:
        while line := archive.readline():
            if not line.startswith(b"WARC/"):
                continue
            lines = []
            while (line := archive.readline()).strip():
                lines.append(line.rstrip(b"\r\n"))
            head = _fields(lines)
            told = dict(head).get("content-length", "")
            if line and told.isascii() and told.isdigit():
                block = archive.read(int(told))
                if len(block) == int(told):
                    yield head, block
    except (EOFError, OSError, zlib.error):
        return  # the file ends or breaks here


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _row(head: list[tuple[str, str]], block: bytes, with_payload: bool) -> dict:
    of = dict(head)
    kind, told = of.get("warc-type"), of.get("warc-payload-digest", "").removeprefix("sha1:") or None
    row = {"record_id": of.get("warc-record-id"), "type": kind, "concurrent_to": [v for k, v in head if k == "warc-concurrent-to"], "refers_to": of.get("warc-refers-to"), "target": of.get("warc-target-uri") or None, "date": of.get("warc-date"), "digest": told}
    if kind not in ("response", "revisit"):
        return row | {"fields": list(dict(_fields(block.splitlines())).items())}
    http, _, body = block.partition(b"\r\n\r\n")
    fields = dict(_fields(http.splitlines()[1:]))
    row["fields"] = list(fields.items())
    if kind == "revisit":
        length = fields.get("content-length", "")
        return row | {"payload_bytes": int(length) if length.isascii() and length.isdigit() else None}
    row |= {"payload_bytes": len(body), "digest": base32_sha1(body)}
    row["digest_ok"] = told is None or row["digest"] == told
    if with_payload:
        try:
            row["payload"] = body.decode()
        except UnicodeDecodeError:
            row["payload_raw"] = body
    return row


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record. payload_bytes and digest are taken from the payload where the record has one (digest_ok:
    they don't contradict its header) and from its header fields where it is a revisit."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.string()
        schema = pa.schema([("record_id", text), ("type", text), ("concurrent_to", pa.list_(text)), ("refers_to", text), ("target", text), ("date", text), ("digest", text), ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("payload", text), ("payload_raw", pa.binary()), ("fields", pa.map_(text, text))])
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for head, block in records(content.as_py()):
                    rows.append(_row(head, block, with_payload))
                    held += len(block) * with_payload + 500
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(parse, RECORD)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row for each capture: capture (identifier of its response or revisit), target, date, response,
    request, metadata."""
    found = written(found, "records")  # the archives are parsed once
    main = found.where(F.col("type").isin("response", "revisit")).select(
        F.col("record_id").alias("capture"), "target", "date", F.struct("type", "record_id", "refers_to", "digest", "payload_bytes", "digest_ok", "payload", "payload_raw").alias("response")
    )
    # Links that a request or metadata record names, and those that the capture names.
    sides = found.where(F.col("type").isin("request", "metadata")).select("type", F.struct("record_id", "date", F.map_entries("fields").alias("fields")).alias("side"), "concurrent_to")
    named = found.where(F.col("type").isin("response", "revisit") & (F.size("concurrent_to") > 0)).select(F.col("record_id").alias("_to"), F.explode("concurrent_to").alias("_id")).distinct()
    links = sides.select("type", "side", F.explode("concurrent_to").alias("_to")).unionByName(sides.join(named, F.col("side.record_id") == F.col("_id")).select("type", "side", "_to"))
    # A capture has one of each; should an archive hold more, the first by identifier.
    one = links.groupBy("_to").agg(*[F.min(F.when(F.col("type") == kind, F.col("side"))).alias(kind) for kind in ("request", "metadata")])
    return main.join(one, F.col("capture") == F.col("_to"), "left").drop("_to")
