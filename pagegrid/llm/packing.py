"""Packing by minimum bin slack: windows of a fixed size filled by subset-sum over piece lengths."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

#: Ranges in which normalising and splitting are done here, as the library does them.
_PLAIN = re.compile("[\\t-\\r\\x20-\\x7e\\u00a1-\\u012f\\u2010-\\u2027]*")
#: The vocabulary's own pattern for pieces, for those ranges: contractions, letters, a digit, others.
_LETTER, _DIGIT = "a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f", "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_LETTER}{_DIGIT}]+")
_END = b"\xff"  # stands for a word's end; no byte of UTF-8
_tokenizers: dict[str, WordBpe] = {}


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(hidden)}


class WordBpe:
    """Ids of a word-level BPE file, those of words seen before remembered.

    Texts of plain characters are split here, and the file's merges are applied to new
    words by the ranks of what they make; any other text goes to the tokenizers library
    as a whole. The ids are the library's either way.
    """

    CACHE = 300_000

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.words: dict[str, bytes] = {}
        model = json.loads(Path(path).read_text())["model"]
        letters = _byte_letters()
        suffix = model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            end = token.endswith(suffix)
            return bytes(letters[c] for c in (token.removesuffix(suffix) if end else token)) + _END * end

        # Ranks: bytes, bytes that end a word, then what each merge makes, in order.
        made = [raw(a + b) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        order = [bytes([x]) for x in range(256)] + [bytes([x]) + _END for x in range(256)] + made
        ranks = {token: i for i, token in enumerate(order)}
        if len(ranks) != len(order):
            raise ValueError("two merges make the same token")
        self.core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
        ids = {raw(t): i for t, i in model["vocab"].items() if set(t.removesuffix(suffix)) <= letters.keys()}
        missing = [t for t in order if t not in ids]
        if missing:
            raise ValueError(f"{len(missing)} tokens of the merges have no id, first {missing[0]!r}")
        self.ids = np.array([ids[t] for t in order], np.int64)

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        piece = self.core.encode_single_piece
        ranks = [r for p in _PIECE.findall(word) for r in piece(p.encode() + _END)]
        found = self.words[word] = self.ids[ranks].astype("<u4").tobytes()
        return found

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit numbers."""
        if not _PLAIN.fullmatch(text) or "<|" in text:
            return self._whole(text)
        if len(self.words) > self.CACHE:
            self.words.clear()
        split = text.lower().split()
        found = list(map(self.words.get, split))
        if None in found:
            found = [self.words.get(w) or self._word(w) if x is None else x for w, x in zip(split, found)]
        return b"".join(found)


def tokenizer(path: str) -> WordBpe:
    if path not in _tokenizers:
        _tokenizers[path] = WordBpe(path)
    return _tokenizers[path]


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as close below capacity as can be.

    A bitset holds the sums that the lengths so far can make. A length's count is split
    into 1, 2, 4 ... copies; each step's bitset is kept, and walking back over the steps
    tells which were used. Lengths come in descending order; the first set that fills the
    capacity ends the search.
    """
    goal = (1 << (capacity + 1)) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length], capacity // length)
        part = 1
        while left:
            part = min(part, left)
            left -= part
            steps.append((length, part, sums))
            sums |= (sums << (length * part)) & goal
            part *= 2
        if sums >> capacity & 1:
            break
    at = sums.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, part, old in reversed(steps):
        if not old >> at & 1:
            taken[length] += part
            at -= length * part
    return dict(taken)


class Packer:
    """Packs pieces as they come. pool: pieces shorter than a window, by length."""

    #: Pieces that wait for partners, and those that stay when windows are filled.
    HIGH, LOW = 1536, 768

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.pool: dict[int, list] = defaultdict(list)
        self.waiting = 0
        self.out: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        """A sequence: pieces are (row key, start, ids, document's tokens)."""
        offset = 0
        for key, start, ids, total in pieces:
            n = len(ids) // 4
            self.out.append((key, start, n, zlib.crc32(ids), total, self.next_id, offset))
            offset += n
        self.next_id += 1

    def add(self, key, ids: bytes) -> None:
        size, total = 4 * self.capacity, len(ids) // 4
        whole = len(ids) // size * size
        for i in range(0, whole, size):
            self._emit([(key, i // 4, ids[i : i + size], total)])
        if whole < len(ids):
            self.pool[(len(ids) - whole) // 4].append((key, whole // 4, ids[whole:], total))
            self.waiting += 1
        if self.waiting >= self.HIGH:
            self.settle(self.LOW)

    def settle(self, keep: int) -> None:
        """Fill windows until few pieces wait. The longest piece that waits is always used."""
        while self.waiting > keep:
            counts = {n: len(x) for n, x in self.pool.items()}
            longest = max(counts)
            counts[longest] -= 1
            taken = fill({n: c for n, c in counts.items() if c}, self.capacity - longest)
            taken[longest] = taken.get(longest, 0) + 1
            if sum(n * c for n, c in taken.items()) < self.capacity:
                self._cut(taken)
                if not self.waiting:
                    return
                continue
            self._emit([self._take(n) for n, c in taken.items() for _ in range(c)])

    def _take(self, n: int):
        piece = self.pool[n].pop()
        if not self.pool[n]:
            del self.pool[n]
        self.waiting -= 1
        return piece

    def _cut(self, taken: dict[int, int]) -> None:
        """No set fills the window: cut a waiting piece to fill it, or pack the rest in powers of two."""
        pieces = [self._take(n) for n, c in taken.items() for _ in range(c)]
        room = self.capacity - sum(len(p[2]) // 4 for p in pieces)
        longer = [n for n in self.pool if n > room]
        if longer:
            head, tail = self._split(self._take(max(longer)), room)
            self._emit([*pieces, head])
            self.pool[len(tail[2]) // 4].append(tail)
            self.waiting += 1
            return
        pieces += [self._take(n) for n in list(self.pool) for _ in range(len(self.pool[n]))]
        while pieces:
            total = sum(len(p[2]) // 4 for p in pieces)
            size, now = min(self.capacity, 1 << (total.bit_length() - 1)), []
            while size:
                p = pieces.pop()
                n = len(p[2]) // 4
                if n > size:
                    p, rest = self._split(p, size)
                    pieces.append(rest)
                    n = size
                now.append(p)
                size -= n
            self._emit(now)

    @staticmethod
    def _split(piece, n: int):
        key, start, ids, total = piece
        return (key, start, ids[: 4 * n], total), (key, start + n, ids[4 * n :], total)

    def finish(self) -> None:
        self.settle(0)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """One row per piece of a document: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are the tokenizer's, without special tokens added, then end_id; a null
    or empty text is the end id alone. Documents are cut into whole windows; what remains
    waits with others until sets of them fill a window exactly. Each task packs its own
    rows with a bounded number of waiting pieces. Where no set fills a window a piece is
    cut; the last pieces of a task make sequences of powers of two, which need no padding.
    Rows are packed one by one, repeated ones too; an empty table gives no rows. Memory
    follows the longest document.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    end = struct.pack("<I", end_id)
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def ready(packer: Packer, kind) -> pa.RecordBatch:
        cols = list(zip(*packer.out))
        packer.out = []
        return pa.RecordBatch.from_arrays([pa.array(cols[0], kind), *(pa.array(c, pa.int64()) for c in cols[1:])], names)

    def run(batches: Iterator[pa.RecordBatch]):
        own = tokenizer(tokenizer_path)
        packer = Packer(capacity, TaskContext.get().partitionId() << 33)
        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for key, text in zip(*batch.columns):
                packer.add(key.as_py(), own.encode(text.as_py()) + end)
                if len(packer.out) >= 4096:
                    yield ready(packer, kind)
        packer.finish()
        if packer.out:
            yield ready(packer, kind)

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long")
    return found.withColumnRenamed("id", id_col)
