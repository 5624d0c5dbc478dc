"""Token-id output as byte or bit planes.

Documents are range-partitioned and sorted by id, encoded, and closed with an end id.  Each partition becomes one shard
file.  Whole documents are gathered into chunks; the ids of a chunk are cut into blocks of a fixed size, each block (32-bit
little-endian ids) is transposed into byte planes or bit planes, and every plane is compressed with zstandard.  High planes
are constant and shrink to a few bytes.

A chunk is one row of a Parquet file: ``shard, chunk, offset`` (ids before it in the shard), ``doc_ids``, ``doc_tokens``,
``n_ids``, ``plane_sizes`` (the chunk index: compressed length of every plane, block by block; 0 is a plane of zeros) and
``planes`` (the planes, one after another).  Spark's writer commits the files, so a lost executor leaves no half file, and
the files live wherever Spark can write.  A chunk is read without its neighbours.

Edge cases: null text counts as empty and still has its end id; null ids sort first and come back null; rows that repeat an
id follow each other in the order of their texts; an empty table writes no chunk and reads back empty; a very long text is a
chunk of many blocks; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitspark.llm.common import id_text, real_id, shared_dir, table
from pitspark.llm.subwords import encoded

BLOCK_IDS = 16_384  # ids in a block
CHUNK_IDS = 1 << 17  # a chunk is closed by the document that reaches it
CHUNK_SCHEMA = "shard int, chunk int, offset bigint, doc_ids array<bigint>, doc_tokens array<bigint>, n_ids bigint, plane_sizes array<int>, planes binary"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """Byte planes (4) or bit planes (32) of one block of 32-bit ids."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return [p.tobytes() for p in by_byte]
    return [np.packbits((p >> bit) & 1).tobytes() for p in by_byte for bit in range(8)]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    out = np.zeros((4, n), dtype=np.uint8)
    if kind == "byte":
        for k, p in enumerate(planes):
            out[k] = np.frombuffer(p, dtype=np.uint8)
    else:
        for k, p in enumerate(planes):
            out[k // 8] |= np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n) << (k % 8)
    return np.ascontiguousarray(out.T).view("<u4").reshape(-1)


def pack(ids: np.ndarray, kind: str, level: int = 3) -> tuple[list[int], bytes]:
    """Chunk index and compressed planes of a chunk's ids."""
    press = zstandard.ZstdCompressor(level=level)
    sizes, body = [], []
    for at in range(0, len(ids), BLOCK_IDS):
        for plane in to_planes(ids[at : at + BLOCK_IDS], kind):
            small = press.compress(plane) if plane.strip(b"\0") else b""
            sizes.append(len(small))
            body.append(small)
    return sizes, b"".join(body)


def unpack(n_ids: int, sizes: list[int], body: bytes, kind: str) -> np.ndarray:
    open_up = zstandard.ZstdDecompressor()
    per_block = 4 if kind == "byte" else 32
    out, at = [], 0
    for block in range(0, len(sizes), per_block):
        n = min(BLOCK_IDS, n_ids - block // per_block * BLOCK_IDS)
        planes = []
        for size in sizes[block : block + per_block]:
            planes.append(open_up.decompress(body[at : at + size]) if size else bytes(n if kind == "byte" else -(-n // 8)))
            at += size
        out.append(from_planes(planes, n, kind))
    return np.concatenate(out) if out else np.zeros(0, dtype="<u4")


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, planes: str = "byte", id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> None:
    """Write the ids of all documents, in ascending id order, to ``path``."""
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        chunk = offset = held = 0
        doc_ids: list[int] = []
        parts: list[bytes] = []

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            sizes, body = pack(ids, planes)
            row = [[shard], [chunk], [offset], [doc_ids], [[len(p) // 4 for p in parts]], [len(ids)], [sizes], [body]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.int32()), pa.binary()]
            names = ["shard", "chunk", "offset", "doc_ids", "doc_tokens", "n_ids", "plane_sizes", "planes"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            names = batch.column("_id").to_pylist()
            for at, to, flat, first in encoded(batch, tokenizer_path):
                ids, edge = flat.astype("<u4"), first.tolist()
                for k in range(to - at):
                    doc_ids.append(names[at + k])
                    parts.append(ids[edge[k] : edge[k + 1]].tobytes() + end)
                    held += len(parts[-1]) // 4
                    if held >= CHUNK_IDS:
                        yield close()
                        chunk, offset, held = chunk + 1, offset + held, 0
                        doc_ids, parts = [], []
        if parts:
            yield close()

    ordered = id_text(docs, id_col, text_col).repartitionByRange(shards, "_id").sortWithinPartitions("_id", "_text")
    ordered.mapInArrow(run, CHUNK_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, planes: str = "byte", with_ids: bool = False) -> DataFrame:
    """Documents of the files at ``path``: doc_id, start, n_tokens, ids_crc32, and the ids themselves if asked for."""
    chunks = spark.read.schema(CHUNK_SCHEMA).parquet(path)
    # One row for each shard, which is one partition of the writer: a bounded table.
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    base = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["n_ids"], row["plane_sizes"], row["planes"], planes)
                ends = np.cumsum(row["doc_tokens"], dtype=np.int64)
                starts = ends - np.array(row["doc_tokens"], dtype=np.int64)
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                cols = [pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["base"] + row["offset"]), pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    cols.append(pa.array([ids[a:b].astype(np.int64) for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=["_id", "start", "n_tokens", "ids_crc32", "ids"][: len(cols)])

    schema = "_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    out = chunks.join(F.broadcast(base), "shard").mapInArrow(run, schema)
    return out.select(real_id().alias("doc_id"), "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as byte planes to the shared folder and read them back."""
    import public_tokenizers

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)
