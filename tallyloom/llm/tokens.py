"""Byte- and word-level encoding of whole texts with the tokenizers library, through a bounded cache.

Text is cut only where the tokenizer's own splitting has a boundary anyway, and each distinct
piece is encoded once by the library; a text where such a cut isn't certain is encoded whole. Results
equal those for whole texts, as the tests check.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import chain

import numpy as np
import public_tokenizers

from .common import worker_state

#: White space besides the six ASCII ones, and characters on which definitions of white space differ.
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0 ᠎ -​    　﻿]")
#: A space after white space and not before a word: "\\s+(?!\\S)" may join it with what stands before.
JOINED_SPACE = re.compile(r"\s\x20(?=\s|\Z)")
#: White space besides spaces and line ends.
ODD_SPACE = "\t\r\x0b\x0c"


def has_rare_space(text: str) -> bool:
    """Whether ``RARE_SPACE`` is found; plain searches spare most texts the pattern."""
    if text.isascii():
        return any(c in text for c in "\x1c\x1d\x1e\x1f")
    if is_latin(text):
        return any(c in text for c in "\x1c\x1d\x1e\x1f\x85\xa0")
    return RARE_SPACE.search(text) is not None


def has_joined_space(text: str) -> bool:
    """Whether ``JOINED_SPACE`` is found in a text without rare spaces."""
    return text[-2:].isspace() or ("  " in text or "\n " in text or has_odd_space(text)) and JOINED_SPACE.search(text) is not None


def has_odd_space(text: str) -> bool:
    return any(c in text for c in ODD_SPACE)


def has_awkward_lines(text: str) -> bool:
    """Whether a line end doesn't stand between two words, or more than two stand together; other white space counts beside any."""
    return "\n" in text and (text[0] == "\n" or text[-1] == "\n" or "\n\n\n" in text or " \n" in text or "\n " in text or has_odd_space(text))


def is_latin(text: str) -> bool:
    """Whether no character is above U+00FF."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def tokenizer_path(name_or_path: str) -> str:
    """A vocabulary's place: a path, or the name of one of the public files."""
    return name_or_path if os.sep in name_or_path else public_tokenizers.path(name_or_path)


#: Letters, all of \\p{L}, that stay as they are under NFC beside each other, and that Python and the library lower alike.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: A piece whose characters are those and printable ASCII: the patterns below split it as the library does.
PLAIN = re.compile(f"\\n?[!-~{LETTERS}]+")
LETTERS_ALONE = re.compile(f" ([{LETTERS}]+)(?= )")
LETTERS_AND_MARKS = re.compile(f" ([{LETTERS}]+)([!-/:-@[-`{{-~]+)(?= )")
PLAIN_PARTS = {
    "words": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^{LETTERS}0-9]+"),
    "spaced": re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[0-9]+| ?[^\\s{LETTERS}0-9]+|\\s+"),
}
#: Bytes as byte-level vocabularies write them: those that are no visible character of Latin-1 follow U+0100 in order.
VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = {b: chr(0x100 + k) for k, b in enumerate(x for x in range(256) if x not in VISIBLE)}
#: The same for the characters of plain parts.
PART_CHARS = {ord(c): "".join(BYTE_CHARS.get(b, chr(b)) for b in c.encode()) for c in ["\n", " ", *map(chr, range(0xC0, 0x100))]}
#: Pieces that the library encodes in one call's text, with a border word between them.
GROUP = 64
#: The two ways of splitting for which the cuts below are certain, as tokenizer files state them. Fixed values.
WORDS = (
    {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
)
SPACED = (None, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True})


def splitting(path: str) -> str | None:
    """How a tokenizer file splits: "words" (white space is dropped), "spaced" (words take the space before them), or
    None, an unknown way, for which texts are encoded whole."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    if found["model"]["type"] != "BPE" or found["model"].get("dropout") or any(not t["special"] for t in found.get("added_tokens", [])):
        return None
    form = (found.get("normalizer"), found.get("pre_tokenizer"))
    return "words" if form == WORDS else "spaced" if form == SPACED else None


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    limit: entries of the cache, which is emptied when full. A tokenizer file that splits in an unknown way, or has no border
    word, gets whole texts.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.limit, self.cache = splitting(path), limit, {}
        self.words = self.kind == "words"
        #: A word of one id that stands between pieces.
        ids = ((w, self.tokenizer.encode(w, add_special_tokens=False).ids) for w in (" zurich", " Zurich", " January"))
        self.border = next(((w, i[0]) for w, i in ids if len(i) == 1), None)
        if self.border is None:
            self.kind = None
        self.tokenize = self.tokenizer.model.tokenize

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def led(self, pieces: list[str]) -> list[str]:
        """Pieces as they stand in a text: a space goes before each, unless words are cut or a line end leads it."""
        return pieces if self.words else [p if p[0] == "\n" else " " + p for p in pieces]

    def pieces(self, cold: list[str]) -> list[bytes]:
        """Ids of each piece; many at a time, which costs the library less.

        Border words split off what they stand between. A group whose pieces hold the border's id
        themselves shows too many of it and is encoded piece by piece.
        """
        word, mark = self.border
        joiner = word + " " if self.words else word
        groups = [self.led(cold[i : i + GROUP]) for i in range(0, len(cold), GROUP)]
        found = self.tokenizer.encode_batch_fast([joiner.join(g) for g in groups], add_special_tokens=False)
        out = []
        for group, e in zip(groups, found, strict=True):
            ids = np.array(e.ids, "<u4")
            at = np.flatnonzero(ids == mark)
            if len(at) != len(group) - 1:
                out += self.whole(group)
                continue
            data, ends = ids.tobytes(), (at * 4).tolist()
            out += [data[a:b] for a, b in zip([0, *(x + 4 for x in ends)], [*ends, len(data)], strict=True)]
        return out

    def plain_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that the splitting leaves whole: the library's model merges each, written as byte-level characters."""
        tokenize, out = self.tokenize, []
        for p in parts:
            if not p.isascii():
                p = p.translate(PART_CHARS)
            elif p[0] <= " ":
                p = PART_CHARS[ord(p[0])] + p[1:]
            out.append(array("I", [t.id for t in tokenize(p)]).tobytes())
        return out

    def warm(self, cold: list[str]) -> None:
        """Put pieces into the cache. Plain ones are split into parts here, and each distinct part is encoded once.

        A part's key is the piece that it is, or has a space, which no piece has, before it.
        """
        cache, inner = self.cache, "" if self.words else " "
        # most pieces are letters, or those and one run of marks after them
        line = f" {' '.join(cold)} "
        single, ended = LETTERS_ALONE.findall(line), LETTERS_AND_MARKS.findall(line)
        wanted = set(single)
        wanted.update(a for a, _ in ended)
        marks = {b for _, b in ended}
        other = list(set(cold).difference(single, map("".join, ended))) if len(single) + len(ended) < len(cold) else []
        plain = [p for p in other if PLAIN.fullmatch(p)]
        rest = list(set(other).difference(plain))
        for i in range(0, len(rest), 100 * GROUP):
            cache.update(zip(rest[i : i + 100 * GROUP], self.pieces(rest[i : i + 100 * GROUP]), strict=True))
        find = PLAIN_PARTS[self.kind].findall
        split = [find(p) for p in ([p.lower() for p in plain] if self.words else self.led(plain))]
        keys = split if self.words else [[x[1:] if x[0] == " " else " " + x for x in s] for s in split]
        names = list(wanted.difference(cache))
        parts = [p.lower() for p in names] if self.words else [" " + p for p in names]
        more = {inner + b: b for b in marks} | {k: x for ks, xs in zip(keys, split, strict=True) for k, x in zip(ks, xs, strict=True)}
        for k in set(more).difference(cache, wanted):
            names.append(k)
            parts.append(more[k])
        cache.update(zip(names, self.plain_parts(parts), strict=True))
        for a, b in ended:
            cache[a + b] = cache[a] + cache[inner + b]
        for p, ks in zip(plain, keys, strict=True):
            if len(ks) > 1 or p != ks[0]:
                cache[p] = b"".join(map(cache.__getitem__, ks))

    def cut(self, text: str) -> list[str] | None:
        """Pieces whose ids, one after the other, are the text's; None where no cut is certain."""
        if self.kind is None or has_rare_space(text):
            return None
        if self.words:
            # up to U+00FF NFC changes nothing and cases are one to one: the library's own lowering can come first
            return (text.lower() if text.isascii() or is_latin(text) else text).split()
        if " \n" in text or has_joined_space(text):
            return None
        # a line end between words is split off before and behind it: it leads the piece after it
        return (text if has_awkward_lines(text) else text.replace("\n", " \n")).split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """texts: a bounded batch."""
        if len(self.cache) > self.limit:
            self.cache.clear()
        cache = self.cache
        cut = [self.cut(t) for t in texts]
        first = 0 if self.words else 1
        cold = list(set(chain.from_iterable(c[first:] for c in cut if c)).difference(cache))
        if "" in cold:  # white space alone: nothing, or the space that it is
            cold.remove("")
            cache[""] = b"" if self.words else self.whole([" "])[0]
        if cold:
            self.warm(cold)
        rest = iter(self.whole([t for t, c in zip(texts, cut, strict=True) if c is None]))
        if self.words:
            return [next(rest) if c is None else b"".join(map(cache.__getitem__, c)) for c in cut]
        heads = iter(self.whole([c[0] for c in cut if c]))
        return [next(rest) if c is None else next(heads) + b"".join(map(cache.__getitem__, c[1:])) for c in cut]


def encoder(path: str) -> Encoder:
    """This Python worker's encoder, kept from task to task."""
    return worker_state(("encoder", path), lambda: Encoder(path))
