"""Exact token ids of a text from cached chunks of it.

A byte-pair tokenizer of the byte-level kind never merges across its
pre-tokens, and a single space between two non-space characters always
starts a pre-token, while a line break between two is one. So a text cut at
such places gives the same ids chunk by chunk, and most chunks (words)
repeat. A chunk that is not in the worker's cache goes to the tokenizers
library, which also handles special strings inside it; these hold no white
space. The caches are bounded and only a matter of speed.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from prodsearch.llm.common import KEPT

MAX_CACHED = 500_000        # chunks kept per worker
SLICE_BYTES = 1 << 20       # of texts whose chunks are told apart together
KEPT_BYTES = 24 << 20       # of chunks and their ids in each of two generations
ENTRY_BYTES = 130           # of one of them beside its characters and ids
# white space in Python's sense but for the space and the line break
_OTHER_SPACE = "\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNEVEN = f"^$|^[ \n]|[ \n]$|[ \n][ \n]|[{_OTHER_SPACE}]"

_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# Latin letters with an optional mark run behind: two pre-tokens at most.
# marks behind a letter and before white space are a pre-token of their own
_MARKS = r"([A-Za-zÀ-ÖØ-öø-ɏ])([.,;:!?]+)([ \n]|$)"
_LATIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]+")
_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")


def lines_of_chunks(text: str) -> list[list[str]]:
    """The text without the line breaks between the lists and without the
    single spaces between the chunks of a list. Lines are told apart only
    where all white space (Python's class holds every character that the
    library treats as such, and more) is one space or line break between words."""
    if not text:
        return []
    words = text.split()
    breaks = len(words) - 1
    even = (len(text) - len("".join(words)) == breaks
            and text.count(" ") + text.count("\n") == breaks)
    return [line.split(" ") for line in text.split("\n")] if even else [_SINGLE_SPACE.split(text)]


class _Cache(dict):
    """What chunks (after ``lead``) give: bytes of ids, or a number of ids."""

    def __init__(self, lead: str, encode, marks: "_Cache | None", seed=None):
        super().__init__(seed or {})
        self.lead, self.encode, self.seed = lead, encode, seed or {}
        self.marks = self if marks is None else marks

    def __missing__(self, chunk):
        m = _WORD.fullmatch(chunk)
        if m and m[2]:
            return self[m[1]] + self.marks[m[2]]        # kept by its parts
        if len(self) >= MAX_CACHED + len(self.seed):
            self.clear()
            self.update(self.seed)
        out = self[chunk] = self.encode(self.lead, chunk, m is not None)
        return out


class TextEncoder:
    """Ids (little-endian unsigned 32-bit) or number of ids of whole texts."""

    def __init__(self, path: str, counts_seed: dict[str, int] | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        byte_chars = _byte_chars()
        self.space = chr(byte_chars[0x20])
        #: a word's letters as the byte-level alphabet writes their UTF-8 bytes
        self.letters = {c: chr(c).encode().decode("latin-1").translate(byte_chars) for c in range(0x250)}
        self.first = _Cache("", self._bytes, None)
        self.spaced = _Cache(" ", self._bytes, self.first)
        self.first_len = _Cache("", self._number, None)
        self.spaced_len = _Cache(" ", self._number, self.first_len, counts_seed)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes = 0
        self.line = self.first["\n"]

    def _ids(self, lead: str, chunk: str, word: bool) -> list[int]:
        if not word:
            return self.lib.encode(lead + chunk, add_special_tokens=False).ids
        mapped = chunk if chunk.isascii() else chunk.translate(self.letters)
        return [t.id for t in self.lib.model.tokenize(self.space + mapped if lead else mapped)]

    def _bytes(self, lead: str, chunk: str, word: bool) -> bytes:
        ids = array("I", self._ids(lead, chunk, word))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _number(self, lead: str, chunk: str, word: bool) -> int:
        return len(self._ids(lead, chunk, word))

    def ids(self, text: str | None) -> bytes:
        return self.first["\n"].join([
            self.first[parts[0]] + b"".join(map(self.spaced.__getitem__, parts[1:]))
            for parts in lines_of_chunks(text or "")])

    def column_ids(self, texts: pa.Array) -> Iterator[bytes]:
        """``ids`` of each text of an Arrow column. Texts whose white space is
        single spaces and line breaks are cut into chunks by Arrow, a slice of
        them at a time, and each different chunk of the slice is looked up once."""
        texts = pc.fill_null(texts, "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
            yield from self._slice_ids(texts.slice(at, to - at))
            at = to

    def _slice_ids(self, texts: pa.Array) -> Iterator[bytes]:
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        even = texts.filter(pc.invert(uneven))
        # a chunk that starts a text or a line, or follows a word at once, is told
        # by its first character (even texts hold no \r and no tab)
        parted = pc.replace_substring(pc.replace_substring_regex(even, _MARKS, "\\1 \t\\2\\3"), "\n", " \n")
        lists = pc.split_pattern(pc.binary_join_element_wise("\r", parted, ""), " ")
        chunks = lists.flatten().dictionary_encode()
        known = self._chunk_ids(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        size = np.fromiter(map(len, known), np.int32, len(known)) // 4
        ids = np.frombuffer(b"".join(known), "<u4")
        del known
        codes = chunks.indices.to_numpy()
        sizes = size[codes]
        ends = np.cumsum(sizes, dtype=np.int64)
        kind = np.int32 if len(ids) < 1 << 31 and (not len(ends) or ends[-1] < 1 << 31) else np.int64
        starts = np.cumsum(size, dtype=np.int64) - size
        places = np.repeat((starts[codes] - (ends - sizes)).astype(kind), sizes)
        places += np.arange(len(places), dtype=kind)
        found = ids[places]
        last = np.r_[0, ends][np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))].tolist()
        at, k = 0, 0
        for i, odd in enumerate(uneven.to_pylist()):
            if odd:
                yield self.ids(texts[i].as_py())
            else:
                yield found[at:last[k]].tobytes()
                at, k = last[k], k + 1

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        """The ids of each marked chunk. Known ones are kept in two generations
        of about KEPT_BYTES: a full young one becomes the old one, and what is
        asked for again returns from there."""
        out = list(map(self.young.get, chunks))
        at = [i for i, x in enumerate(out) if x is None]
        missing = [chunks[i] for i in at]
        found = list(map(self.old.get, missing))
        new = [c for c, x in zip(missing, found) if x is None]
        made = iter(self._encode(new))
        found = [next(made) if x is None else x for x in found]
        for i, x in zip(at, found):
            out[i] = x
        self.young.update(zip(missing, found))
        self.young_bytes += ENTRY_BYTES * len(missing) + sum(map(len, missing)) + sum(map(len, found))
        if self.young_bytes > KEPT_BYTES:
            self.old, self.young, self.young_bytes = self.young, {}, 0
        return out

    def _encode(self, chunks: list[str]) -> list[bytes]:
        """The ids of marked chunks, from the library."""
        tokenize, space, letters, out = self.lib.model.tokenize, self.space, self.letters, []
        swap = sys.byteorder == "big"
        for chunk in chunks:
            mark = chunk[0]
            lead, body = ("", chunk[1:]) if mark in "\r\n\t" else (space, chunk)
            plain = body.isascii()
            if body.isalpha() and (plain or _LATIN.fullmatch(body)):
                ids = array("I", [t.id for t in tokenize(lead + (body if plain else body.translate(letters)))])
            else:
                ids = array("I", self.lib.encode((" " if lead else "") + body, add_special_tokens=False).ids)
            if swap:
                ids.byteswap()
            out.append(self.line + ids.tobytes() if mark == "\n" else ids.tobytes())
        return out

    def count(self, text: str | None) -> int:
        lines = lines_of_chunks(text or "")
        breaks = max(0, len(lines) - 1) * self.first_len["\n"]
        return breaks + sum(self.first_len[parts[0]] + sum(map(self.spaced_len.__getitem__, parts[1:]))
                            for parts in lines)


def _byte_chars() -> dict[int, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: 0x100 + k for k, b in enumerate(rest)}


def encoder(path: str, key: str = "", counts_seed=None) -> TextEncoder:
    """The worker's encoder for a vocabulary file; the last one is kept between
    tasks. ``counts_seed`` is a function that gives the seed of a new one."""
    if KEPT.get("encoder", (None,))[0] != (path, key):
        KEPT.clear()
        KEPT["encoder"] = (path, key), TextEncoder(path, counts_seed() if counts_seed else None)
    return KEPT["encoder"][1]
