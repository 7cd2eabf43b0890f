"""Token ids as flat binary files with 64-bit document offsets.

A folder holds, for each part p, ``p.bin`` (ids, little-endian unsigned 16- or 32-bit), ``p.off``
(n + 1 little-endian unsigned 64-bit offsets in ids, from 0), ``p.doc`` (n signed 64-bit
document ids; the least value stands for null), and ``bases`` (Parquet: part, docs, tokens, and
the prefix sums first_doc and first_token over the parts before). All are memory-mapped when
the folder is mounted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import discard, filesystem, local_path, publish, shared_dir, slices, table, texts, written
from .tokens import encoder, tokenizer_path

NULL_ID = -(2**63)


#: Rows, and bytes of ids, of one part's files; a task that gets more writes several parts.
PART_DOCS, PART_BYTES = 4096, 1 << 25


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    width: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    docs_per_part: int = PART_DOCS,
    bytes_per_part: int = PART_BYTES,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write in ascending order of ``id_col``; return the bases.

    Null and empty texts are the end id alone. A null id comes first. Repeated rows and ids are
    all written, side by side, by a hash of the text and then the text; so neither rows without id nor those of one id
    gather in a task. Other columns are ignored. No rows: no parts. An id that ``width`` bytes
    don't hold raises. A part closes at ``docs_per_part`` rows or ``bytes_per_part`` bytes: a task holds
    no more than that and one text.
    """
    if width not in (2, 4):
        raise ValueError("width is 2 or 4")
    tasks = max(1, -(-docs.count() // docs_per_part))
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    ranged = rows.repartitionByRange(tasks, "id", "hash").sortWithinPartitions("id", "hash", "text")
    path = tokenizer_path(tokenizer)
    kind = f"<u{width}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sizes, doc_ids, blobs = TaskContext.get().partitionId() << 24, [], [], []
        end = np.array([end_id], "<u4").tobytes()

        def close() -> pa.RecordBatch:
            nonlocal part, sizes, doc_ids, blobs
            publish(folder, f"{part}.bin", blobs)
            ends = np.concatenate([[0], np.cumsum(sizes, dtype="<u8")]).astype("<u8")
            publish(folder, f"{part}.off", ends.tobytes())
            publish(folder, f"{part}.doc", np.array(doc_ids, "<i8").tobytes())
            done = [pa.array([x], pa.int64()) for x in (part, len(sizes), int(ends[-1]))]
            part, sizes, doc_ids, blobs = part + 1, [], [], []
            return pa.RecordBatch.from_arrays(done, ["part", "docs", "tokens"])

        held, own = 0, encoder(path)
        for batch in batches:
            for piece in slices(batch, "text"):
                for doc, blob in zip(piece["id"].to_pylist(), own.encode(texts(piece, "text")), strict=True):
                    blob += end
                    sizes.append(len(blob) // 4)
                    if width == 2:
                        ids = np.frombuffer(blob, "<u4")
                        if ids.max() > 0xFFFF:
                            raise ValueError("an id needs more than 16 bits")
                        blob = ids.astype(kind).tobytes()
                    blobs.append(blob)
                    doc_ids.append(doc)
                    held += len(blob)
                    if len(sizes) >= docs_per_part or held >= bytes_per_part:
                        held = 0
                        yield close()
        if sizes:
            yield close()

    counts = written(ranged.mapInArrow(write, "part long, docs long, tokens long"), "token-counts")
    # one row a part: the window holds a number for every few thousand rows
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"first_{n}") for c, n in (("docs", "doc"), ("tokens", "token"))]
    bases = counts.select("*", *sums, F.lit(width).alias("width"))
    bases.write.parquet(f"{folder}/bases")
    discard(counts)
    return docs.sparkSession.read.schema(bases.schema).parquet(f"{folder}/bases")


def open_part(folder: str, name: str, kind: str) -> np.ndarray:
    """A file's numbers, memory-mapped where the folder is mounted."""
    if path := local_path(folder):
        return np.memmap(f"{path}/{name}", kind, "r")
    store, path = filesystem(folder)
    return np.frombuffer(store.open_input_file(f"{path}/{name}").read(), kind)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                p, kind = row["part"], f"<u{row['width']}"
                files = (("bin", kind), ("off", "<u8"), ("doc", "<i8"))
                ids, offsets, doc_ids = (open_part(folder, f"{p}.{x}", k) for x, k in files)
                for i in range(0, len(doc_ids), 4096):
                    ends = offsets[i : i + 4097].astype("i8")
                    crcs = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    docs = [None if x == NULL_ID else x for x in doc_ids[i : i + 4096].tolist()]
                    columns = [docs, ends[:-1] + row["first_token"], np.diff(ends), crcs]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])

    # the list of parts is dealt out one by one
    bases = spark.read.parquet(f"{folder}/bases")
    return bases.repartition(max(1, min(bases.count(), 1 << 16))).mapInArrow(read, schema)


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the 49k word vocabulary and end id 2; ids below 2**16 take 16 bits."""
    folder = shared_dir(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, "word_bpe_49k.json", end_id=2, width=2)
    return read_tokens(spark, folder)
