"""WARC archives of pages: monolithic gzip files made into one gzip member per record.

Crawlers and pipes often leave a WARC file as one gzip stream, from which no record can be read
without inflating all before it. ``normalise`` inflates each such file once, from front to
back, writes every record as a gzip member of its own, and a sidecar index with the offset and
length of each member. Any record can then be read alone, and an archive by many tasks.

Spark's text writer makes the monolithic files: a row is a record, its line separator the blank
lines that end one, and its compression one gzip stream per file. Its reader inflates them as a
stream and hands over pieces between blank lines, which are put together again by the records'
lengths, so a task holds one record and not a file.

Members are written with ``pyarrow.fs`` to the shared folder of the session (a local or mounted
path, hdfs, s3 or gs). A lost or repeated task leaves a file that no index names: the index,
committed by Spark, says which files count.
"""

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogue_engine.scratch import new_folder, written

BLANK = "\r\n\r\n"
# Payloads from this size on are written once.
LEAST_REVISIT = 1000
# Records per monolithic file: a gzip stream is the work of one task.
ARCHIVE_RECORDS = 20_000
# Bytes of members a task reads back, about.
READ_BYTES = 1 << 25
# Bytes read at once.
AHEAD = 1 << 22
# Rows handed on at once.
ROWS = 2000

INDEX = (
    "archive string, offset long, length long, record_id string, record_type string, "
    "target_uri string, refers_to string, payload_digest string, problem string"
)
READ = (
    "record_id string, record_type string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, intact boolean, payload binary"
)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_id_of(record_id: Column) -> Column:
    """The page_id in a record id; null for a page without one."""
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(key, response) of the pages whose payload another page is the response for.

    Of pages with equal payloads of ``least`` bytes or more, that with the largest page_id is the
    response. ``key`` is the struct of page_id and the SHA-256 of the payload; rows that agree in
    both are one page. Null ids are smaller than all others. Only ids and hashes move. The largest
    id of a group is a partial aggregate; the join has one row per group on its other side, so
    Spark can split a group that makes up much of the table.
    """
    keys = (
        pages.where(F.octet_length("html") >= least)
        .select("page_id", F.sha2("html", 256).alias("sha"))
        .distinct()
    )
    groups = (
        keys.groupBy("sha")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("pages"))
        .where("pages > 1")
        .select("sha", "response")
    )
    others = keys.join(groups, "sha").where("page_id is null or page_id < response")
    return others.select(F.struct("page_id", "sha").alias("key"), "response")


def records(
    pages: DataFrame, least: int = LEAST_REVISIT, date: str = "1970-01-01T00:00:00Z"
) -> DataFrame:
    """One column ``record``: the WARC record of each page, without the blank lines that end it.

    A null html is an empty payload. A revisit has the HTTP header and no payload; its
    Content-Length there is that of the payload it stands for. Line ends in a url are
    percent-encoded, a null url has no header line. Pages have no time, so all have ``date``.
    """
    # written, so that Spark knows its size and need not move the payloads when it is small
    other = written(revisits(pages, least))
    plain = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    keyed = plain.withColumn("key", F.struct("page_id", F.sha2("html", 256).alias("sha")))
    joined = keyed.join(other, "key", "left")
    again = F.col("response").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("html").cast("string"),
        F.lit(BLANK),
    )
    size = F.octet_length(F.col("http")) + F.when(again, F.lit(0)).otherwise(F.octet_length("html"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("html"))),
        F.when(
            again,
            F.concat(
                line("WARC-Refers-To", _record_id(F.col("response"))),
                line(
                    "WARC-Profile",
                    F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                ),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        F.lit("Content-Length: "),
        size.cast("string"),
        F.lit(BLANK),
        F.col("http"),
        F.when(again, F.lit("")).otherwise(F.col("html")),
    )
    return joined.withColumn("http", http).select(record.alias("record"))


def write_monolithic(found: DataFrame, path: str, per_file: int = ARCHIVE_RECORDS) -> None:
    """Write records as WARC files that are one gzip stream each."""
    (
        found.write.option("compression", "gzip")
        .option("lineSep", BLANK)
        .option("maxRecordsPerFile", per_file)
        .text(path)
    )


class Cutter:
    """Cuts a stream of bytes into WARC records. It holds one record at a time."""

    def __init__(self) -> None:
        self.held = bytearray()
        self.need = 0  # bytes of the record at the front, 0 while its header is not whole
        self.offset = 0  # where the front lies in the stream
        self.problem: str | None = None

    def feed(self, data: bytes) -> Iterator[bytes]:
        if self.problem:
            return
        looked = max(0, len(self.held) - 3)
        self.held += data
        while True:
            if not self.need:
                end = self.held.find(b"\r\n\r\n", looked)
                if end < 0:
                    return
                size = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", self.held[:end].lower())
                if not size or not self.held.startswith(b"WARC/"):
                    self.problem = f"no record at byte {self.offset} of the inflated file"
                    self.held.clear()
                    return
                self.need = end + 4 + int(size[1]) + 4
            if len(self.held) < self.need:
                return
            yield bytes(self.held[: self.need])
            del self.held[: self.need]
            self.offset += self.need
            self.need = looked = 0

    def finish(self) -> str | None:
        """What is wrong with the stream, once all of it has been fed."""
        if not self.problem and self.held.strip():
            return f"record cut short at byte {self.offset} of the inflated file"
        return self.problem


def header_of(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields by lower-case name, and the block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return fields, rest[: int(fields.get("content-length", 0))]


def payload_of(fields: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """What a block carries, behind the HTTP header where it has one, and the size that header
    gives; without one, the size of the block."""
    if not fields.get("content-type", "").startswith("application/http"):
        return block, len(block)
    head, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"\r\ncontent-length:[ \t]*(\d+)", head.lower())
    return payload, int(size[1]) if size else len(payload)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    """Hadoop writes file:/a for file:///a."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def _digest(fields: dict[str, str]) -> str | None:
    found = fields.get("warc-payload-digest")
    return found.removeprefix("sha1:") if found else None


def normalise(spark: SparkSession, path: str, folder: str, level: int = 6) -> DataFrame:
    """Rewrite the gzip WARC files under ``path`` with one member per record.

    Writes ``<folder>/archives/*.warc.gz`` and the index, ``<folder>/index``, and returns the index.
    Each file is inflated once, by one task. A file that stops in the middle of a record, or holds
    something else, gives its whole records and a row of the index with ``problem``. Files that
    already have many members are read as well. A gzip stream that cannot be inflated is an error
    of the job, or skipped if ``spark.sql.files.ignoreCorruptFiles`` says so.
    """
    pieces = (
        spark.read.option("lineSep", BLANK)
        .text(path)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary"))
    )
    names = [field.split(" ")[0] for field in INDEX.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("offset", "length") else pa.string()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(f"{folder}/archives")
        store.create_dir(root, recursive=True)
        source = out = cutter = None
        name, at, rows = "", 0, []

        def table() -> pa.RecordBatch:
            made = pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows], schema)
            rows.clear()
            return made

        def finish() -> None:
            if out is not None:
                out.close()
                if problem := cutter.finish():
                    rows.append((name, None, None, None, None, None, None, None, problem))

        for batch in batches:
            for now, piece in zip(batch.column("path").to_pylist(), batch.column("value")):
                if now != source:
                    finish()
                    stem = now.rsplit("/", 1)[-1].split(".", 1)[0]
                    name, at = f"{stem}-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None, buffer_size=AHEAD)
                    source, cutter = now, Cutter()
                for record in cutter.feed(piece.as_py() + b"\r\n\r\n"):
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    member = packer.compress(record) + packer.flush()
                    out.write(member)
                    f, _ = header_of(record)
                    ids = [f.get(k) for k in ("warc-record-id", "warc-type", "warc-target-uri", "warc-refers-to")]
                    rows.append((name, at, len(member), *ids, _digest(f), None))
                    at += len(member)
                    if len(rows) >= ROWS:
                        yield table()
        finish()
        if rows:
            yield table()

    pieces.mapInArrow(run, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_members(index: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Read the records an index names, each by its offset alone.

    (record_id, record_type, target_uri, refers_to, payload_bytes, payload_digest, intact, payload).
    Size and digest are those of the whole payload: measured where the record has it, and as the
    header says for a revisit. ``intact`` is false when a record's payload is not what its header
    says. Without ``payloads`` that column is null and nothing of it leaves the task. Tasks read
    neighbouring members, about ``READ_BYTES`` each, of any archive however large.
    """
    good = index.where("problem is null").select("archive", "offset", "length")
    total = good.agg(F.sum("length")).first()[0] or 0
    block = F.expr(f"offset div {READ_BYTES}")
    dealt = good.repartition(1 + total // READ_BYTES, "archive", block).sortWithinPartitions(
        "archive", "offset"
    )
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(f.split(" ")[0], kinds[f.split(" ")[1]]) for f in READ.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _opened(f"{folder}/archives")
        current = file = None
        first, ahead = 0, b""
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for start in range(0, batch.num_rows, ROWS):
                rows = []
                for name, offset, length in zip(*(c[start : start + ROWS] for c in columns)):
                    if name != current:
                        if file is not None:
                            file.close()
                        current, file, ahead = name, store.open_input_file(f"{root}/{name}"), b""
                    if not first <= offset <= offset + length <= first + len(ahead):
                        first = offset
                        ahead = file.read_at(min(max(length, AHEAD), file.size() - offset), offset)
                    member = ahead[offset - first : offset - first + length]
                    fields, content = header_of(zlib.decompress(member, 31))
                    payload, size = payload_of(fields, content)
                    digest, kind = _digest(fields), fields.get("warc-type")
                    intact = True
                    if kind != "revisit":
                        measured = hashlib.sha1(payload).hexdigest()
                        intact = size == len(payload) and digest in (None, measured)
                        size, digest = len(payload), measured
                    rows.append(
                        (
                            fields.get("warc-record-id"),
                            kind,
                            fields.get("warc-target-uri"),
                            fields.get("warc-refers-to"),
                            size,
                            digest,
                            intact,
                            payload if payloads and kind != "revisit" else None,
                        )
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(zip(*rows), schema.types)], schema=schema
                )

    return dealt.mapInArrow(run, READ)


def with_payloads(found: DataFrame) -> DataFrame:
    """The read records with the payload of its response in each revisit. Responses of one id and
    digest are one."""
    responses = (
        found.where("record_type = 'response'")
        .select(F.col("record_id").alias("refers_to"), "payload_digest", F.col("payload").alias("referred"))
        .dropDuplicates(["refers_to", "payload_digest"])
    )
    revisits_of = found.where("record_type = 'revisit'").drop("payload")
    filled = revisits_of.join(responses, ["refers_to", "payload_digest"], "left")
    filled = filled.withColumnRenamed("referred", "payload").select(*found.columns)
    return found.where("record_type is null or record_type <> 'revisit'").unionByName(filled)


def archive_pages(pages: DataFrame) -> tuple[DataFrame, str]:
    """Write all pages as monolithic WARC files, normalise these, and return the index and the
    folder, both in the shared folder of the session."""
    spark = pages.sparkSession
    folder = new_folder(spark)
    write_monolithic(records(pages), f"{folder}/monolithic")
    return normalise(spark, f"{folder}/monolithic", folder), folder


def page_records(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page, as read back
    from the archives.

    Payloads are whole at every size. Empty and null html are records with an empty payload. Rows
    that agree in page_id and html have the same result, each; a null page_id stays null and is
    the smallest in a group of equal payloads. Other columns are not read.
    """
    index, folder = archive_pages(pages)
    return read_members(index, folder, payloads=False).select(
        page_id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"),
    )
