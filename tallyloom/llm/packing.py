"""Vector bin packing of token sequences: the dot-product heuristic under three limits at once.

A sequence has a limit on tokens, on segments and on tokens that bear loss. An open sequence takes,
of the examples that fit, that with the largest dot product of its demands and what remains of the limits
(both as shares of the limits). What no whole example fills is filled by a cut one. A
sequence that still isn't full is cut into powers of two, which need no padding.

Examples are packed in blocks of rows as they lie in a partition: nothing is shuffled, a task holds one
block at a time, and a lost task is done again alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_name, slices, table, texts
from .tokens import encoder, tokenizer_path


@dataclass(frozen=True)
class Limits:
    """The most that a sequence holds of each."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


#: Rows and ids of a block.
BLOCK_ROWS, BLOCK_IDS = 4096, 1 << 21


def fitting(first: int, size: int, loss_from: int, tokens: int, loss: int) -> int:
    """How many tokens from ``first`` on go into the given room; those from ``loss_from`` on bear loss."""
    most = min(size - first, tokens)
    return min(most, max(0, loss_from - first) + loss)


Piece = tuple[int, int, int]


def bins(sizes: list[int], loss_from: list[int], limits: Limits = Limits()) -> list[list[Piece]]:
    """Sequences of pieces (example, start, length), full or not. Each token lies in exactly one piece.

    An example's tokens from ``loss_from`` on bear loss. Examples without tokens are in no piece.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits are positive")
    out: list[list[Piece]] = []
    items: list[Piece] = []
    for k, (size, free) in enumerate(zip(sizes, loss_from, strict=True)):
        at = 0
        while at < size:
            n = fitting(at, size, free, limits.tokens, limits.loss)
            if n == limits.tokens:
                out.append([(k, at, n)])
            else:
                items.append((k, at, n))
            at += n
    if not items:
        return out
    items.sort(key=lambda x: -x[2])
    item, start, rest = (np.array(x) for x in zip(*items, strict=True))
    # tokens of each piece that come before those that bear loss
    free = np.clip(np.array(loss_from)[item] - start, 0, rest)
    scale = np.array([1 / limits.tokens**2, 1 / limits.segments**2, 1 / limits.loss**2])
    left = len(items)
    while left:
        if 2 * left < len(rest):
            live = rest > 0
            item, start, rest, free = item[live], start[live], rest[live], free[live]
        pieces: list[Piece] = []
        room = np.array([limits.tokens, limits.segments, limits.loss])
        while left and room[0] > 0 and room[1] > 0:
            loss = rest - free
            fits = (rest > 0) & (rest <= room[0]) & (loss <= room[2])
            if room[1] == 1 and pieces:  # the last segment: a whole example only if it fills the sequence
                fits &= rest == room[0]
            w = room * scale
            i = int(np.argmax(np.where(fits, rest * w[0] + loss * w[2] + w[1], -1.0)))
            n = int(rest[i])
            if not fits[i]:  # no whole example: the longest cut
                cut = np.minimum(np.minimum(rest, room[0]), free + room[2])
                i = int(np.argmax(cut))
                n = int(cut[i])
                if n < 1:
                    break
            pieces.append((int(item[i]), int(start[i]), n))
            room -= [n, 1, max(0, n - int(free[i]))]
            start[i] += n
            rest[i] -= n
            free[i] = max(0, int(free[i]) - n)
            left -= int(rest[i] == 0)
        out.append(pieces)
    return out


def pack(sizes: list[int], loss_from: list[int], limits: Limits = Limits()) -> list[list[Piece]]:
    """``bins``, and what isn't full cut into powers of two."""
    return [s for b in bins(sizes, loss_from, limits) for s in shares(b, sum(n for _, _, n in b), limits.tokens)]


def shares(pieces: list[tuple[int, int, int]], total: int, tokens: int) -> list[list[tuple[int, int, int]]]:
    """A sequence, or if it is neither full nor a power of two, sequences of powers of two, largest first."""
    if total == tokens or total & (total - 1) == 0:
        return [pieces] if total else []
    out, left = [], list(reversed(pieces))
    while total:
        room = 1 << total.bit_length() - 1
        total -= room
        out.append([])
        while room:
            k, a, n = left.pop()
            out[-1].append((k, a, min(n, room)))
            if n > room:
                left.append((k, a + room, n - room))
            room -= min(n, room)
    return out


def pack_texts(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
    lead: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, pack; a row for each piece.

    id, start, length, ids_crc32, doc_tokens, sequence_id, offset, loss_tokens, bin_tokens (tokens of the piece's sequence
    before unfilled ones are cut into powers of two), and ids on demand.

    With ``prompt_col`` (a text before the text, for instruction data) its tokens come first and bear no loss.
    Without, the first ``lead`` tokens of a text are its prompt, but half of its tokens at most; the rest bear loss.

    Null and empty texts are the end id alone. Repeated rows and null ids are packed like others, each row for
    itself. Texts of any length are cut. Sequences don't cross partitions; ``sequence_id`` is the partition's number
    times 2**32 plus a count. No rows: no pieces. Other columns are ignored; an id named like an output has
    ``_input`` behind its name.
    """
    path = tokenizer_path(tokenizer)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        (F.col(prompt_col) if prompt_col else F.lit(None)).cast("string").alias("prompt"),
    )
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens", "bin_tokens"]
    names = [id_name(id_col, [*numbers, "ids"]), *numbers] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, blobs, free, held = [], [], [], 0

        def block() -> pa.RecordBatch:
            nonlocal number, ids, blobs, free, held
            columns: list[list] = [[] for _ in range(10)]
            for b in bins([len(b) // 4 for b in blobs], free, limits):
                total = sum(n for _, _, n in b)
                for pieces in shares(b, total, limits.tokens):
                    offset = 0
                    for k, a, n in pieces:
                        part = blobs[k][4 * a : 4 * (a + n)]
                        loss = a + n - max(a, min(free[k], a + n))
                        own = np.frombuffer(part, "<u4").astype("i4") if with_ids else None
                        row = (ids[k], a, n, zlib.crc32(part), len(blobs[k]) // 4, number, offset, loss, total, own)
                        for column, value in zip(columns, row, strict=True):
                            column.append(value)
                        offset += n
                    number += 1
            arrays = [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:9])]
            arrays += [pa.array(columns[9], pa.list_(pa.int32()))] * with_ids
            ids, blobs, free, held = [], [], [], 0
            return pa.RecordBatch.from_arrays(arrays, names)

        end = np.array([end_id], "<u4").tobytes()
        own = encoder(path)
        for batch in batches:
            id_type = batch.column("id").type
            for piece in slices(batch, "text"):
                found = own.encode(texts(piece, "text"))
                before = own.encode(texts(piece, "prompt")) if prompt_col else [b""] * len(found)
                for doc, p, b in zip(piece.column("id").to_pylist(), before, found, strict=True):
                    ids.append(doc)
                    blobs.append(p + b + end)
                    free.append(len(p) // 4 if prompt_col else min(lead, len(blobs[-1]) // 8))
                    held += len(blobs[-1]) // 4
                    if len(ids) >= BLOCK_ROWS or held >= BLOCK_IDS:
                        yield block()
        if ids:
            yield block()

    schema = ", ".join([f"`{names[0]}` {kind}", *(f"{n} long" for n in numbers)] + ["ids array<int>"] * with_ids)
    return rows.mapInArrow(run, schema)


#: Of the query below and of the pipeline: a document's first tokens are its prompt, and the limit on loss leaves room
#: for one prompt in each sequence.
LEAD = 64
LIMITS = Limits(tokens=2048, segments=64, loss=2048 - LEAD)


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the 50k byte vocabulary and end id 1, under ``LIMITS``."""
    return pack_texts(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", 1, LIMITS, lead=LEAD)
