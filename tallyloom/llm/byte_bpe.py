"""Exact byte-level BPE from a rank file: longest matches of an Aho-Corasick automaton, with backtracking.

Bytes stand as Latin-1 characters in the automaton. A tokenisation is the one that the merges
give if and only if each adjacent pair of its tokens is one that the merges give for the two
tokens' bytes alone. So the encoder walks left to right, tries the longest token and then its
shorter prefixes, and steps back from positions that it has found to be dead ends; each
position dies at most once, so the time is linear. Compatibility of pairs is memoised.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_name, map_slices, table, texts, worker_state
from .tokens import has_joined_space, has_rare_space, tokenizer_path

#: Unicode White_Space, as \s is in the tiktoken library.
SPACE = r"\t-\r\x20\x85\xa0  -     　"
PATTERN = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", rf"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]"))


#: Above all ranks.
_NEVER = 1 << 62


class BytePairs:
    """limit: entries of each memo, emptied when full."""

    def __init__(self, path: str, limit: int = 400_000):
        with open(path, "rb") as lines:
            self.token = {int(rank): base64.b64decode(text) for text, rank in map(bytes.split, lines)}
        self.rank = {t: r for r, t in self.token.items()}
        self.size = {r: len(t) for r, t in self.token.items()}
        self.automaton = ahocorasick.Automaton()
        for t, r in self.rank.items():
            self.automaton.add_word(t.decode("latin-1"), (len(t), r))
        self.automaton.make_automaton()
        self.limit, self.pieces, self.words, self.valid = limit, {}, {}, {}
        self.shorter = {r: self.prefix(t) for t, r in self.rank.items()}
        self.last_merge = {r: self.halves(t) for t, r in self.rank.items()}
        self.left_ends: dict[int, list] = {}
        self.right_ends: dict[int, list] = {}

    def prefix(self, token: bytes) -> int | None:
        """The longest token that this one starts with, itself excepted."""
        for n in range(len(token) - 1, 0, -1):
            if (r := self.rank.get(token[:n])) is not None:
                return r
        return None

    def halves(self, token: bytes) -> tuple[int, int] | None:
        """The two tokens that the merges join last to make this one; none for a byte, or for what merges don't make."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            ranks = [self.rank.get(a + b, _NEVER) for a, b in zip(parts, parts[1:], strict=False)]
            k = ranks.index(min(ranks))
            if ranks[k] == _NEVER:
                return None
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return (self.rank[parts[0]], self.rank[parts[1]]) if len(parts) == 2 else None

    def ends(self, token: int, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at the token's left (0) or right (1) end while it is made: (bytes, from which rank on, up to which)."""
        known = self.right_ends if side else self.left_ends
        if token not in known:
            out, at, until = [], token, _NEVER
            while True:
                made = self.last_merge[at]
                out.append((self.token[at], at if made else -1, until))
                if made is None:
                    break
                until, at = at, made[side]
            known[token] = out
        return known[token]

    def compatible(self, a: int, b: int) -> bool:
        """Whether the merges of the bytes of a and b end in just a, b.

        They don't if some merge across the border comes while both of its sides stand there. Of two merges of one rank
        the left one comes first: it spoils a left side that it takes away, and finds a right side still there.
        """
        for right, born, gone in self.ends(a, 1):
            for left, begun, taken in self.ends(b, 0):
                rank = self.rank.get(right + left)
                if rank is not None and (at := max(rank, born, begun)) < gone and at <= taken:
                    return False
        return True

    def fits(self, a: int, b: int) -> bool:
        known = self.valid.get((a, b))
        if known is None:
            if len(self.valid) > self.limit:
                self.valid.clear()
            known = self.valid[a, b] = self.compatible(a, b)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        if (whole := self.rank.get(piece)) is not None:
            return [whole]
        end, longest = len(piece), [None] * len(piece)
        # matches that end later are longer for their start: the last one stays
        for stop, (n, r) in self.automaton.iter(piece.decode("latin-1")):
            longest[stop + 1 - n] = r
        path: list[int] = []
        dead, at, size, shorter, fits = set(), 0, self.size, self.shorter, self.fits
        token = longest[0]
        while at < end:
            while token is not None and (at + size[token] in dead or path and not fits(path[-1], token)):
                token = shorter[token]
            if token is not None:
                path.append(token)
                at += size[token]
                token = longest[at] if at < end else None
            elif path:  # nothing goes on from here: try less before it
                dead.add(at)
                last = path.pop()
                at -= size[last]
                token = shorter[last]
            else:
                raise ValueError("a byte is missing from the vocabulary")
        return path

    def ids(self, part: str) -> bytes:
        """Ids of a text's part that the pattern splits as it would in the text."""
        found = []
        for m in PATTERN.findall(part):
            known = self.pieces.get(m)
            if known is None:
                known = np.array(self.encode_piece(m.encode()), "<u4").tobytes()
                if len(m) <= 64:
                    self.pieces[m] = known
            found.append(known)
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if len(self.pieces) > self.limit:
            self.pieces.clear()
        if len(self.words) > self.limit:
            self.words.clear()
        if has_rare_space(text) or has_joined_space(text):
            return self.ids(text)
        # the pattern has a border before each of these spaces, so words with the space before them stand alone
        head, *rest = text.split(" ")
        words = self.words
        for w in set(rest).difference(words):
            words[w] = self.ids(" " + w)
        return self.ids(head) + b"".join(map(words.__getitem__, rest))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def byte_pairs(path: str) -> BytePairs:
    """This Python worker's tables, kept from task to task."""
    return worker_state(("byte pairs", path), lambda: BytePairs(path))


def encode_column(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", ids_as: str = "ids") -> DataFrame:
    """id and ids (array of int) of every whole text; null and empty texts have no ids. Rows and other ids are kept as they are.

    Texts go through a worker by slices bounded in bytes. Other columns are ignored; an id named like the
    output has ``_input`` behind its name. No rows: no rows.
    """
    path = tokenizer_path(vocabulary)
    own_id = id_name(id_col, [ids_as])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [np.frombuffer(byte_pairs(path).encode(t), "<u4").astype("i4") for t in texts(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.list_(pa.int32()))], [own_id, ids_as])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_slices(rows, "text", run, f"`{own_id}` {docs.schema[id_col].dataType.simpleString()}, `{ids_as}` array<int>")


def decode_column(rows: DataFrame, vocabulary: str, id_col: str = "doc_id", ids_col: str = "ids", bytes_as: str = "bytes") -> DataFrame:
    """id and the bytes that the ids stand for; null ids give empty bytes, an unknown id raises KeyError."""
    path = tokenizer_path(vocabulary)
    own_id = id_name(id_col, [bytes_as])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found = [byte_pairs(path).decode(np.array(x or [], "<u4").tobytes()) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, pa.binary())], [own_id, bytes_as])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(run, f"`{own_id}` {kind}, `{bytes_as}` binary")


def round_trip_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of ids and of the bytes decoded from them; ids don't leave the worker.

    doc_id, n_tokens, ids_sha256, decoded_sha256. Null and empty texts: 0 ids and the digests of no bytes. Otherwise as
    ``encode_column``.
    """
    path = tokenizer_path(vocabulary)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    own_id = id_name(id_col, names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe, n, ids_sha, text_sha = byte_pairs(path), [], [], []
        for t in texts(batch, "text"):
            ids = bpe.encode(t)
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        arrays = [batch.column("id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
        return pa.RecordBatch.from_arrays(arrays, [own_id, *names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(rows, "text", run, f"`{own_id}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` with the multilingual 50k ranks."""
    return round_trip_digests(table(spark, sf_dir, "documents"), "byte_bpe_multi_50k.tiktoken")
