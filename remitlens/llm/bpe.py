"""Byte-level BPE as arrays of ranks.

A word is held as its parts and, beside them, the rank of each pair of neighbours. The smallest rank is looked up by a
scan, its pair becomes one part, and only the two ranks beside it are looked up anew. For the short words that text
consists of this beats a heap. Words beyond ``SCANNED`` bytes, where repeated scans would take quadratic time, use a
heap of the same ranks with the same order of merges.
"""

from __future__ import annotations

import heapq
import json
import struct
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from remitlens.llm.common import slices, texts, tokenizer_file

#: Longest word whose ranks are scanned, in bytes; words that a worker remembers before it drops half of them.
SCANNED, REMEMBERED = 256, 600_000
NEVER = 1 << 40

# The pattern that cuts text into words before any merge.
WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves; the other bytes take the letters from 256 on, in order.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBPE(dict):
    """Encoder and decoder of a byte-level tokenizer file with merges: a dictionary of words that fills itself."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        vocabulary = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: raw(t) for t, i in vocabulary.items() if t not in self.special}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.byte_id = [0] * 256
        for i, b in self.bytes_of.items():
            if len(b) == 1:
                self.byte_id[b[0]] = i
        # A pair of ids to its rank, and a rank to the id that the pair becomes.
        self.ranks: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left], vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])
        # The same by left id, so that a lookup makes no pair.
        self.follow: list[dict[int, int]] = [{} for _ in range(max(self.bytes_of) + 1)]
        for (left, right), rank in self.ranks.items():
            self.follow[left][right] = rank
        self.words = regex.compile(WORDS)
        self.cuts = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.table = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]

    # -- words -------------------------------------------------------------------------------------

    def __missing__(self, text: str) -> bytes:
        if "<" in text and self.cuts is not None and self.cuts.search(text):
            return self.encode(text)
        words = self.words.findall(text)
        if len(words) != 1:
            return b"".join(map(self.__getitem__, words))
        parts = self.merge(text.encode())
        ids = struct.pack(f"<{len(parts)}I", *parts)
        if len(text) <= SCANNED:
            self[text] = ids
        return ids

    def merge(self, word: bytes) -> list[int]:
        parts = [self.byte_id[b] for b in word]
        return self._scan(parts) if len(parts) <= SCANNED else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        follow, merged = self.follow, self.merged
        ranks = [follow[a].get(b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            parts[i] = new = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = follow[parts[i - 1]].get(new, NEVER)
            if i < len(ranks):
                ranks[i] = follow[new].get(parts[i + 1], NEVER)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        count, rank_of = len(parts), self.ranks.get
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = [(r, i) for i in range(count - 1) if (r := rank_of((parts[i], parts[i + 1]), NEVER)) != NEVER]
        heapq.heapify(heap)
        gone = bytearray(count + 1)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if not gone[i] else count
            if j >= count or rank_of((parts[i], parts[j]), NEVER) != rank:
                continue  # one of the two has been merged since
            parts[i], gone[j], after[i] = self.merged[rank], 1, after[j]
            if after[i] < count:
                before[after[i]] = i
                if (r := rank_of((parts[i], parts[after[i]]), NEVER)) != NEVER:
                    heapq.heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := rank_of((parts[h], parts[i]), NEVER)) != NEVER:
                heapq.heappush(heap, (r, h))
        return [p for i, p in enumerate(parts) if not gone[i]]

    # -- texts -------------------------------------------------------------------------------------

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.words.findall(text)))

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids; special tokens in the text become their ids."""
        if self.cuts is None or not self.cuts.search(text):
            return self._plain(text)
        found, start = [], 0
        for special in self.cuts.finditer(text):
            found += [self._plain(text[start : special.start()]), np.array([self.special[special[0]]], "<u4").tobytes()]
            start = special.end()
        return b"".join([*found, self._plain(text[start:])])

    def encode_all(self, column: pa.Array) -> list[bytes]:
        """Ids of a column of texts, null as empty. What stands between blanks is looked up once for all texts.

        A blank between two other characters always begins a word, so a text is encoded piece by piece, each with the
        blank before it. Texts where white space meets a blank are encoded as a whole.
        """
        column = column.fill_null("")
        pieces = pc.split_pattern(column, " ")
        coded = pieces.flatten().dictionary_encode()
        unique, bounds = coded.dictionary.to_pylist(), pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        odd = np.fromiter((not p or p[0].isspace() or p[-1].isspace() for p in unique), bool, len(unique))
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        whole = np.add.reduceat(odd[index], bounds[:-1]) > 0 if len(column) else np.zeros(0, bool)
        # Texts' first pieces have no blank before them, so they get entries of their own.
        firsts = [unique[i] for i in index[bounds[:-1]]]
        found = [b"" if o else self[" " + p] for p, o in zip(unique, odd, strict=True)] + [self[p] if p else b"" for p in firsts]
        index[bounds[:-1]] = len(unique) + np.arange(len(firsts))
        order = index.tolist()
        out = []
        for number, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if whole[number]:
                out.append(self.encode(column[number].as_py()))
            else:
                out.append(b"".join([found[i] for i in order[start:end]]))
        if len(self) > REMEMBERED:
            # Words that came first are the frequent ones.
            for word in [*islice(self, REMEMBERED // 2, None)]:
                del self[word]
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids, with a replacement character for bytes that are no UTF-8; unknown ids say nothing."""
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and numbers.max() >= len(self.table):
            numbers = numbers[numbers < len(self.table)]
        return b"".join(map(self.table.__getitem__, numbers.tolist())).decode("utf-8", "replace")


_loaded: dict[str, ByteBPE] = {}


def byte_bpe(name: str) -> ByteBPE:
    """The tokenizer of a file, loaded once per process."""
    if name not in _loaded:
        _loaded[name] = ByteBPE(tokenizer_file(name))
    return _loaded[name]


def encode(text: Column, tokenizer: str) -> Column:
    """Token ids of a text column as little-endian unsigned 32-bit integers; null counts as empty.

    A function of one row's text alone, so repeated rows and other columns make no difference.
    """

    @F.arrow_udf("binary")
    def of(column: pa.Array) -> pa.Array:
        bpe = byte_bpe(tokenizer)
        return pa.array([ids for _, part in slices(column) for ids in bpe.encode_all(part)], pa.binary())

    return of(text)


def decode(ids: Column, tokenizer: str) -> Column:
    """The text of a column of ids as ``encode`` gives them; null counts as no ids."""

    @F.arrow_udf("string")
    def of(column: pa.Array) -> pa.Array:
        bpe = byte_bpe(tokenizer)
        return pa.array([bpe.decode(t) for t in texts(column)], pa.string())

    return of(ids)


def round_trip(text: Column, tokenizer: str) -> Column:
    """A struct of ``ids`` as ``encode`` gives them and of ``decoded``, the text that ``decode`` makes of them.

    Spark evaluates nested Python functions of one column side by side, the inner one twice; this encodes once.
    """

    @F.arrow_udf("ids binary, decoded string")
    def of(column: pa.Array) -> pa.Array:
        bpe = byte_bpe(tokenizer)
        ids = [x for _, part in slices(column) for x in bpe.encode_all(part)]
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())], ["ids", "decoded"]
        )

    return of(text)
