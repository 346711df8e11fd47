"""Byte-level BPE over Arrow batches with the tokenizers library, and its inverse.

Each match of the split pattern is encoded by itself and without special tokens. The model is built from the ranks
file: bytes are mapped to printable characters, and any two adjacent parts whose join is in the vocabulary may merge,
lowest rank first. Distinct parts of a batch are encoded once; a task remembers a bounded number of them. Decoding takes
the vocabulary's strings back to bytes by the reversed table; a character whose bytes lie in several tokens is whole
again once they are joined.

Null text is empty text: no ids, empty bytes. Row order, ties, repeated rows, null ids and extra columns do not matter:
every row is encoded by itself and kept as it is in the struct column `row`. A very long text is one row of ids, held by
one task; an empty table gives an empty result.
"""

from __future__ import annotations

import array
import base64
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from augury.llm.common import with_results

#: Parts and pieces of parts that a task remembers, of late and from before, each, and the longest in characters.
_KEEP, _LONG = 150_000, 60
#: A single blank between two characters that are none. No match of a split pattern goes on from other characters into
#: white space, so every match lies between two such places. White space is taken widely here, which only splits less.
_BLANK = re.compile(r" (?<!\s )(?!\s)")
_FIRST = "\n"  # marks the first part of a text, before which there is no blank; other parts never begin with it
#: Unicode's White_Space, which regex engines disagree on: fixed values.
_SPACE = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"


def byte_characters() -> list[str]:
    """Character of each byte: printable Latin-1 ones stand for themselves, the others follow from U+0100."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def splitter(pattern: str) -> regex.Pattern:
    """The split pattern with white space spelled out."""
    pattern = pattern.replace(r"[^\s", f"[^{_SPACE}").replace(r"\s", f"[{_SPACE}]").replace(r"\S", f"[^{_SPACE}]")
    return regex.compile(pattern)


@lru_cache(1)
def token_bytes(path: str) -> tuple[bytes, ...]:
    """Bytes of each id, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    return tuple(ranks.get(i, b"") for i in range(max(ranks) + 1))


class Recent:
    """Values of keys that were met of late, and of those before; the latter go when the former are too many."""

    def __init__(self):
        self.late: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}

    def unknown(self, keys: set[str]) -> list[str]:
        """The keys without a value; late has those of all others."""
        new = keys.difference(self.late)
        again = new.intersection(self._before)
        self.late.update((k, self._before[k]) for k in again)
        return list(new - again)

    def settle(self, new: list[str]) -> None:
        for k in new:
            if len(k) > _LONG:
                del self.late[k]
        if len(self.late) > _KEEP:
            self.late, self._before = {}, self.late


class Encoder:
    """Ids of pieces of text."""

    def __init__(self, path: str, pattern: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        table = byte_characters()
        self._mapped = dict(enumerate(table))
        word = lambda t: "".join(table[b] for b in t)
        tokens = token_bytes(path)
        ids = {t: i for i, t in enumerate(tokens) if t}
        merges = [(word(t[:k]), word(t[k:])) for t in tokens for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids]
        self._model = Tokenizer(BPE(vocab={word(t): i for t, i in ids.items()}, merges=merges))
        self._split = splitter(pattern).findall

    def _ids(self, parts: list[str], pieces: Recent) -> list[bytes]:
        """Ids of each part, given as it stands in the text."""
        split = list(map(self._split, parts))
        new = pieces.unknown(set(chain.from_iterable(split)))
        mapped = [p.encode("utf-8", "surrogatepass").decode("latin-1").translate(self._mapped) for p in new]
        for at in range(0, len(new), 10_000):
            found = self._model.encode_batch_fast(mapped[at : at + 10_000], add_special_tokens=False)
            pieces.late.update((p, array.array("i", e.ids).tobytes()) for p, e in zip(new[at : at + 10_000], found))
        out = [b"".join(map(pieces.late.__getitem__, s)) for s in split]
        pieces.settle(new)
        return out

    def encode(self, texts: list[str], known: tuple[Recent, Recent]) -> list[np.ndarray]:
        """Ids of each text; known keeps the ids of parts and of pieces between calls."""
        split = [_BLANK.split(t) for t in texts]
        for parts in split:
            parts[0] = _FIRST + parts[0]
        whole, pieces = known
        new = whole.unknown(set(chain.from_iterable(split)))
        whole.late.update(zip(new, self._ids([p[1:] if p.startswith(_FIRST) else " " + p for p in new], pieces)))
        out = [np.frombuffer(b"".join(map(whole.late.__getitem__, parts)), np.int32) for parts in split]
        whole.settle(new)
        return out

    def token_bytes(self) -> list[bytes]:
        """Bytes of each id: the characters of the vocabulary's string, each taken back to its byte."""
        back = {c: b for b, c in self._mapped.items()}
        strings = {i: t for t, i in self._model.get_vocab(with_added_tokens=False).items()}
        return [bytes(map(back.__getitem__, strings.get(i, ""))) for i in range(max(strings, default=-1) + 1)]


@lru_cache(1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(1)
def _decoder(path: str, pattern: str) -> list[bytes]:
    return _encoder(path, pattern).token_bytes()


def offsets(text: str, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters that each token covers, end exclusive; tokens that share a split character all cover it."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(lengths[ids])
    return char[ends - lengths[ids]], char[ends - 1] + 1


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    at = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(values) if values else np.empty(0, np.int32)))


def _chunks(n: int, size: int = 512):
    return (slice(at, at + size) for at in range(0, n, size))


def _place(path: str) -> str:
    """The file itself, or the copy that Spark sent to this executor (SparkContext.addFile)."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def _bytes_table(path: str, pattern: str) -> pa.Array:
    """Bytes of each id; the last entry is for what has no bytes."""
    return pa.array([*_decoder(_place(path), pattern), b""], pa.large_binary())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", with_offsets: bool = False, with_split: bool = False, keep: list[str] | None = None, with_bytes: bool = False) -> DataFrame:
    """Columns row, ids array<int> and, if asked for, starts and ends array<int> (characters), n_split long: tokens
    that end within a character, by their offsets, and bytes binary: what the ids decode to. row has the columns named in
    keep, all if that is not given.

    Bytes that are asked for here are decoded by the worker that encoded; decode() after encode() in one stage needs two
    workers for each core, both with the model.
    """
    fields = pa.schema([("ids", pa.list_(pa.int32())), *[(c, pa.list_(pa.int32())) for c in ("starts", "ends") if with_offsets], *[("n_split", pa.int64())] * with_split, *[("bytes", pa.binary())] * with_bytes])

    def start():
        known = Recent(), Recent()  # of this task: a worker that is idle holds the model only
        encoder, lengths = _encoder(_place(path), pattern), np.array([len(t) for t in token_bytes(_place(path))], np.int64)
        table = _bytes_table(path, pattern) if with_bytes else None

        def run(row: pa.StructArray) -> list:
            texts = [t or "" for t in row.field(text).to_pylist()]
            ids = [x for s in _chunks(len(texts)) for x in encoder.encode(texts[s], known)]
            spans = [offsets(t, i, lengths) for t, i in zip(texts, ids)] if with_offsets or with_split else []
            lists = [_lists([s[k].astype(np.int32) for s in spans]) for k in (0, 1)] if with_offsets else []
            found = _lists(ids)
            raw = [joined(found, table).cast(pa.binary())] if with_bytes else []
            return [found, *lists, *[[int((a[1:] < z[:-1]).sum()) for a, z in spans]] * with_split, *raw]

        return run

    return with_results(docs, start, fields, keep)


def joined(lists: pa.ListArray, table: pa.Array) -> pa.LargeBinaryArray:
    """Bytes of each list of ids; the table's last entry stands for ids that it lacks."""
    at = pc.fill_null(lists.flatten(), -1).to_numpy(zero_copy_only=False)
    at = np.where((at < 0) | (at >= len(table)), len(table) - 1, at)
    found = table.take(pa.array(at))
    ends = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] if len(found) else np.zeros(1, np.int64)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    edges = ends[np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(edges.tobytes()), found.buffers()[2]])


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids", with_text: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Columns row, bytes binary and, if asked for, decoded string, in which bytes that are no whole character show as
    U+FFFD.

    A null list is empty; an id that the vocabulary lacks, or null, has no bytes.
    """

    def start():
        table = _bytes_table(path, pattern)

        def run(row: pa.StructArray) -> list:
            raw = joined(row.field(ids), table)
            return [raw.cast(pa.binary()), *([[r.decode("utf-8", "replace") for r in raw.to_pylist()]] if with_text else [])]

        return run

    return with_results(encoded, start, pa.schema([("bytes", pa.binary()), ("decoded", pa.string())][: 2 if with_text else 1]), keep)
