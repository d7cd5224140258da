"""WARC archives compressed record by record with a Zstandard dictionary.

A dictionary is trained on a bounded sample of the records. Each archive file begins with it in a skippable frame
(magic 0x184D2A5D), and every record is a frame of its own, so that any record can be read with the file's head alone.
Files are written by Spark's own text writer and committer, hence to any file system and safely when executors are
lost: a frame is one line, and the line separator is an empty skippable frame, which every Zstandard reader passes
over. Of records with equal payloads that with the largest id is a response, and the others revisit it.

Defined results: a null payload is the empty one; rows that repeat the largest id of a payload are responses too; a
null URL is written as about:blank; other columns are ignored; an empty table writes no record.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm import labelled
from chronofold.llm.session import bounded_batches

#: Fixed values of the formats: frame magics, and the profile of a revisit.
DICTIONARY_MAGIC, SKIPPABLE_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0x184D2A50, 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty skippable frame; all its bytes are ASCII.
SEPARATOR = struct.pack("<II", SKIPPABLE_MAGIC, 0)
#: Records that the dictionary is trained on, and bytes of all of them; its size; the level of compression.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 1000, 32 << 20, 65536, 5
DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(id_: object) -> str:
    """The identifier of a record; a null id has one of its own."""
    return "<urn:null>" if id_ is None else f"<urn:page:{quote(str(id_), safe='')}>"


def record(id_: object, url: str | None, payload: bytes, refers_to: object | None) -> bytes:
    """One WARC record; a revisit has no payload of its own but keeps its digest and length."""
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", urn(id_)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", urn(refers_to))]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + (payload if refers_to is None else b"")
    fields.append(("Content-Length", str(len(block))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(magic, whole frame) of each frame, by its own headers; a skippable frame comes without its head."""
    at = 0
    while at < len(data):
        begin, (magic,) = at, struct.unpack_from("<I", data, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
            (size,) = struct.unpack_from("<I", data, at + 4)
            yield magic, data[at + 8 : at + 8 + size]
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"not a Zstandard frame at byte {at}")
        flags = data[at + 4]
        single = flags >> 5 & 1
        at += 5 + (1 - single) + (0, 1, 2, 4)[flags & 3] + (single, 2, 4, 8)[flags >> 6]
        last = 0
        while not last:
            block = int.from_bytes(data[at : at + 3], "little")
            last = block & 1
            at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        at += 4 * (flags >> 2 & 1)
        yield magic, data[begin:at]


def train(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> bytes:
    """A dictionary trained on SAMPLE_RECORDS whole records, chosen by a hash of the id, or as many as SAMPLE_BYTES hold."""
    n = pages.count()
    share = min(1.0, 1.2 * SAMPLE_RECORDS / max(n, 1))
    rows = pages.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    chosen = rows.select(id_col, url_col, F.coalesce(payload_col, F.lit("")).alias("payload")).limit(SAMPLE_RECORDS)
    rows = labelled.within_bytes(chosen, id_col, "payload", SAMPLE_BYTES).collect()
    samples = [record(r[0], r[1], r[2].encode(), None) for r in sorted(rows, key=lambda r: str(r[0]))]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 4), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to train on: a plain record serves as content
        return b"".join([*samples[:4], record(0, None, b"", None)])


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> None:
    """Write one archive file a partition under path.

    Equal payloads are found by their SHA-256; only digests that occur more than once meet the rows again, in a join
    that Spark may broadcast by its own size check or else sort, splitting a digest that very many rows share."""
    spark = pages.sparkSession
    bounded_batches(spark)
    shipped = spark.sparkContext.broadcast(train(pages, id_col, url_col, payload_col))
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    refers = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.join(shared, "digest", "left").select("id", "url", "payload", refers.alias("refers_to"))

    def run(batches):
        content, compressor = shipped.value, None
        for batch in batches:
            out = []
            if compressor is None and batch.num_rows:
                compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_checksum=True)
                out.append(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
            for r in range(batch.num_rows):
                id_, url, payload, refers_to = (batch.column(c)[r].as_py() for c in range(4))
                out.append(compressor.compress(record(id_, url, payload, refers_to)))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    lines = rows.mapInArrow(run, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", SEPARATOR.decode()).text(path)


def read(spark: SparkSession, path: str, id_type: str = "bigint", with_payload: bool = False) -> DataFrame:
    """A row for each record of the archives under path: page_id, payload_bytes, payload_digest, record_type, refers_to, url and, if asked for, payload (null for revisits). A response whose payload does not match its digest is an error."""
    bounded_batches(spark)
    schema = f"page_id {id_type}, payload_bytes bigint, payload_digest string, record_type string, refers_to {id_type}, url string" + ", payload binary" * with_payload
    number = id_type in ("tinyint", "smallint", "int", "bigint")

    def as_id(text: str | None):
        if text is None or text == urn(None):
            return None
        text = unquote(text[len("<urn:page:") : -1])
        return int(text) if number else text

    def rows_of(content: bytes):
        decompressor = zstandard.ZstdDecompressor()
        for magic, frame in frames(memoryview(content)):
            if magic == DICTIONARY_MAGIC:
                decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(frame.tobytes()))
            elif magic == FRAME_MAGIC:
                fields, payload = parse(decompressor.decompress(frame))
                kind, sha = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["X-Payload-Length"]) if kind == "revisit" else len(payload)
                if kind == "response" and digest(payload) != sha:
                    raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
                row = (as_id(fields["WARC-Record-ID"]), size, sha, kind, as_id(fields.get("WARC-Refers-To")), unquote(fields["WARC-Target-URI"]))
                yield (*row, payload if kind == "response" else None) if with_payload else row

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for row in rows_of(content.as_py()):
                    rows.append(row)
                    if len(rows) == 512:
                        yield table(rows)
                        rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kind = pa.int64() if id_type == "bigint" else pa.int32() if id_type == "int" else pa.int16() if id_type == "smallint" else pa.int8() if id_type == "tinyint" else pa.string()
        kinds = [kind, pa.int64(), pa.string(), pa.string(), kind, pa.string(), pa.binary()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names[: len(rows[0])])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
