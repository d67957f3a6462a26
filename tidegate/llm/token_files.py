"""Token ids as flat unsigned files with 64-bit document offsets.

A corpus is one folder. Part ``k`` holds the documents of one range of doc_id, ascending:
``part-k.ids`` (unsigned 16- or 32-bit little-endian ids), ``part-k.off`` (64-bit offsets
of its documents and of its end, in ids) and ``part-k.doc`` (64-bit doc_ids; the smallest
64-bit integer stands for null). ``manifest`` is a table with one row per part. The
global position of a document is its offset plus the ids of all earlier parts, a prefix
sum over the manifest. Readers map the files into memory where the folder is local.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.common import doc_batches, longs, prefix
from tidegate.llm.tokens import encoder

NULL_DOC = -(1 << 63)
WIDTHS = {2: "<u2", 4: "<u4"}

MANIFEST_SCHEMA = T.StructType(
    [T.StructField("part", T.LongType()), T.StructField("docs", T.LongType()), T.StructField("ids", T.LongType())]
)
DOC_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")]
)


def _store(uri: str):
    """File system and path of a folder; any store pyarrow can reach."""
    from pyarrow import fs

    if not urlparse(uri).scheme:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return parts.path if parts.scheme in ("", "file") else None


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, kind: str = "spaced", end_id: int = 2, width: int = 4
) -> DataFrame:
    """Encodes all documents into ``folder`` and returns its manifest (part, docs, ids).

    Each part is written under a name of its own attempt and renamed when complete, so a
    repeated or speculative task leaves one whole file. Null and empty texts hold the end
    id alone; rows that share a doc_id are kept, ordered by text; a null doc_id comes first;
    an empty table leaves an empty manifest; other columns are not read.
    """
    spark = docs.sparkSession
    dtype, limit = WIDTHS[width], 1 << 8 * width

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, kind).encode
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        names = {end: f"{path}/part-{part:06d}.{end}" for end in ("ids", "off", "doc")}
        docs_seen = ids_seen = 0
        files: dict = {}
        for batch in doc_batches(batches):
            if not files:
                files = {end: store.open_output_stream(f"{n}.{attempt}") for end, n in names.items()}
            doc_ids = batch.column("doc_id").cast(pa.int64()).fill_null(NULL_DOC)
            files["doc"].write(doc_ids.to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            for ids in encode(batch.column("text").to_pylist()):
                files["off"].write(np.int64(ids_seen).astype("<i8").tobytes())
                files["ids"].write(np.append(ids, end_id).astype(dtype).tobytes())
                if len(ids) and ids.max() >= limit:
                    raise ValueError(f"ids do not fit into {width} bytes")
                ids_seen += len(ids) + 1
            docs_seen += batch.num_rows
        if files:
            files["off"].write(np.int64(ids_seen).astype("<i8").tobytes())
            for end, n in names.items():
                files[end].close()
                store.move(f"{n}.{attempt}", n)
            yield pa.RecordBatch.from_arrays(
                [longs([part]), longs([docs_seen]), longs([ids_seen])], names=MANIFEST_SCHEMA.names
            )

    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(write, MANIFEST_SCHEMA).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")


def open_part(folder: str, part: int, width: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and doc_ids of one part, mapped into memory where the folder is local."""
    base, out = _local(folder), []
    for end, dtype in (("ids", WIDTHS[width]), ("off", "<i8"), ("doc", "<i8")):
        name = f"part-{part:06d}.{end}"
        if base is not None:
            out.append(np.memmap(os.path.join(base, name), dtype=dtype, mode="r"))
        else:
            store, path = _store(folder)
            with store.open_input_file(f"{path}/{name}") as file:
                out.append(np.frombuffer(file.read(), dtype=dtype))
    return out[0], out[1], out[2]


def read_token_files(spark: SparkSession, folder: str, width: int = 4) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    parts = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest").select("part", "ids").collect()
    base = prefix({r["part"]: r["ids"] for r in parts})
    order = sorted(base)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nth in batch.column("id").to_pylist():
                ids, offsets, doc_ids = open_part(folder, order[nth], width)
                for i in range(0, len(doc_ids), 4096):
                    edge = np.asarray(offsets[i : i + 4097])
                    docs = np.asarray(doc_ids[i : i + 4096])
                    crcs = [
                        zlib.crc32(np.asarray(ids[a:b]).astype("<u4").tobytes())
                        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(docs, mask=docs == NULL_DOC),
                            longs(base[order[nth]] + edge[:-1]),
                            longs(np.diff(edge)),
                            longs(crcs),
                        ],
                        names=DOC_SCHEMA.names,
                    )

    return spark.range(0, len(order), 1, max(1, len(order))).mapInArrow(read, DOC_SCHEMA)
