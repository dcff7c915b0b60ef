"""Web archives as WARC records, and a Merkle audit of their replicas.

An archive is a table of records: the file and offset at which each stands, and its bytes. Hashes of records are combined over
ordered ranges of offsets, ranges over longer ranges, up to one root for each file. An audit compares the roots of two replicas
and descends only where they differ, so sound files cost one comparison.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import col
from tidemark.session import written

#: Bytes of a file in its lowest ranges, and ranges in the next longer one; both as powers of two.
RANGE_BITS, FAN_BITS = 16, 4
#: A file's size: the next record begins a new file once this many bytes are reached.
FILE_BYTES = 1 << 30

#: Fixed values of the format.
VERSION, DATE = "WARC/1.1", "1970-01-01T00:00:00Z"


def record(url: str | None, html: str | None, place: str) -> bytes:
    """One resource record. ``place`` names it; a null url or body is empty."""
    body = (html or "").encode("utf-8")
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    target = " ".join((url or "").split())
    lines = [
        VERSION,
        "WARC-Type: resource",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place + ' ' + digest)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Block-Digest: sha1:{digest}",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def _records(batches: Iterator[pa.RecordBatch], schema: pa.Schema, file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each task fills files of its own."""
    file, offset = TaskContext.get().partitionId() << 20, 0
    for batch in batches:
        files, offsets, records = [], [], []
        for url, html in zip(batch.column("url"), batch.column("html")):
            if offset >= file_bytes:
                file, offset = file + 1, 0
            made = record(url.as_py(), html.as_py(), f"{file}:{offset}")
            files.append(file)
            offsets.append(offset)
            records.append(made)
            offset += len(made)
        columns = [batch.column("page_id"), pa.array(files, pa.int64()), pa.array(offsets, pa.int64()), pa.array(records, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write pages (url, html) as records to ``folder`` and read them: page_id, file, offset, record.

    Tasks write files of their own, so nothing is shuffled. Repeated pages become a record each. Null urls and bodies are
    empty; an empty table is an archive without files.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rows = pages.select(col(id_col).alias("page_id"), "url", "html")
    made = T.StructType().add("page_id", rows.schema["page_id"].dataType)
    made.add("file", "long").add("offset", "long").add("record", "binary")
    arrow = to_arrow_schema(made)
    records = rows.mapInArrow(lambda batches: _records(batches, arrow, file_bytes), made)
    records.write.option("compression", "zstd").parquet(folder)
    return pages.sparkSession.read.schema(made).parquet(folder)


def leaves(records: DataFrame) -> DataFrame:
    """file, offset, length and hash (hex SHA-256 over place, length and bytes) of each record.

    Of several records at one place the hashes are combined in their order, so that a doubled record is a difference.
    """
    size = F.octet_length("record").cast("long")
    head = F.concat_ws(" ", "file", "offset", size).cast("binary")
    one = records.select("file", "offset", size.alias("length"), F.sha2(F.concat(head, F.lit(b"\n"), "record"), 256).alias("hash"))
    many = one.groupBy("file", "offset").agg(F.max("length").alias("length"), F.sort_array(F.collect_list("hash")).alias("all"))
    hash_ = F.when(F.size("all") == 1, F.get("all", F.lit(0))).otherwise(F.sha2(F.array_join("all", " "), 256))
    return many.select("file", "offset", "length", hash_.alias("hash"))


def _parents(nodes: DataFrame, bits: int) -> DataFrame:
    """Nodes of the next longer ranges: the hash of their children's places and hashes, in order.

    A node has as many children as the fan allows; the lowest ranges have a record for each place in them.
    """
    parent = F.shiftrightunsigned("node", bits)
    children = F.sort_array(F.collect_list(F.concat_ws(" ", F.lpad(F.col("node").cast("string"), 20, "0"), "hash")))
    grouped = nodes.groupBy("file", parent.alias("node")).agg(children.alias("children"))
    return grouped.select("file", "node", F.sha2(F.array_join("children", "\n"), 256).alias("hash"))


class Tree:
    """A replica's hashes: ``levels`` from the records up to one root for each file. Tables are written, so audits of many
    replicas read them alone."""

    def __init__(self, records: DataFrame, height: int):
        self.leaves = written(leaves(records), "leaves")
        nodes = self.leaves.select("file", F.col("offset").alias("node"), "hash")
        self.levels = [nodes]
        for level in range(height):
            nodes = written(_parents(nodes, RANGE_BITS if level == 0 else FAN_BITS), "nodes")
            self.levels.append(nodes)


def height_for(*replicas: DataFrame) -> int:
    """Levels above the records so that the largest offset of any replica lies under one root."""
    largest = max((r.agg(F.max("offset")).first()[0] or 0) for r in replicas)
    height, bits = 1, RANGE_BITS
    while largest >> bits:
        height, bits = height + 1, bits + FAN_BITS
    return height


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    a = one.select("file", "node", F.col("hash").alias("h1"))
    b = other.select("file", "node", F.col("hash").alias("h2"))
    return a.join(b, ["file", "node"], "full").where(~F.col("h1").eqNullSafe(F.col("h2")))


def audit(good: Tree, other: Tree) -> DataFrame:
    """file, offset, status of each record of which ``other`` differs from ``good``: changed, missing or extra.

    Roots are compared first. On each level below, only the children of nodes that differ are read by a join and compared.
    """
    if len(good.levels) != len(other.levels):
        raise ValueError("the trees have different heights")
    differing = written(_differing(good.levels[-1], other.levels[-1]), "differing")
    for level in reversed(range(len(good.levels) - 1)):
        parents = differing.select("file", F.col("node").alias("parent"))
        bits = RANGE_BITS if level == 0 else FAN_BITS
        below = [
            t.levels[level].withColumn("parent", F.shiftrightunsigned("node", bits)).join(parents, ["file", "parent"], "left_semi")
            for t in (good, other)
        ]
        differing = written(_differing(*below), "differing")
    status = F.when(F.col("h2").isNull(), "missing").when(F.col("h1").isNull(), "extra").otherwise("changed")
    return differing.select("file", F.col("node").alias("offset"), status.alias("status"))


def fixity(spark: SparkSession, good: DataFrame, other: DataFrame) -> DataFrame:
    """page_id, file, offset, length, sha256 and status (intact, changed, missing, or extra, then without page_id) for every
    record of two replicas."""
    height = height_for(good, other)
    first, second = Tree(good, height), Tree(other, height)
    found = audit(first, second)
    listed = good.select("page_id", "file", "offset").join(first.leaves, ["file", "offset"])
    known = listed.join(found, ["file", "offset"], "left").withColumn("status", F.coalesce("status", F.lit("intact")))
    extra = second.leaves.join(found.where("status = 'extra'"), ["file", "offset"])
    none = F.lit(None).cast(good.schema["page_id"].dataType).alias("page_id")
    columns = ["page_id", "file", "offset", "length", F.col("hash").alias("sha256"), "status"]
    return known.select(*columns).unionAll(extra.select(none, *columns[1:]))
