"""Documents as token pieces, packed into sequences by cutting-stock patterns.

1. Each document becomes pieces: whole sequences, then the rest of at most one sequence.
2. Piece lengths are counted in classes of a few tokens. This histogram, bounded by its number of classes, is all that
   the driver sees; column generation turns it into patterns such as "one of class 200 and two of class 28".
3. Pieces are ranked within their class: by partition, then within it. The rank says which pattern, which of its
   sequences and which place a piece gets. The ranks come from counts, so no class is gathered in one task.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.bpe import byte_letters
from remitlens.llm.common import LOWER, slices, tokenizer_file
from remitlens.llm.cutting_stock import cutting_stock
from remitlens.session import written

#: Tokens of a sequence, id after each document, tokens of a length class.
LENGTH, END, STEP = 4096, 2, 16
#: Words whose ids a worker remembers before it drops half of them.
REMEMBERED = 500_000
#: Marks that no letter in front of them joins.
MARKS = b'.,;:!?#$%&*"()|'

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary, part int, size int, number long"

_encoders: dict[str, WordEncoder] = {}


class WordEncoder(dict):
    """Token ids of texts through their words, each encoded once: a dictionary that fills itself.

    For tokenizers that lower-case, normalise to NFC, drop white space and cut between letters and other characters:
    the ids of a text are then those of its words, and those of a word that of its letters and of the marks behind
    them. Whole words of letters go straight to the library's merges, all others through the whole library.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merges = self.tokenizer.model.tokenize
        self.letters = {byte: letter for letter, byte in byte_letters().items()}

    def __missing__(self, word: bytes) -> bytes:
        stem = word.rstrip(MARKS)
        if stem != word and stem[-1:].isalpha() and b"<" not in stem:
            found = self[stem] + self[word[len(stem) :]]
        else:
            text = word.decode()
            if text.isalpha() and text.lower() == text and unicodedata.is_normalized("NFC", text):
                ids = [t.id for t in self.merges(text if text.isascii() else "".join(map(self.letters.get, word)))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = np.array(ids, "<u4").tobytes()
        self[word] = found
        return found

    def _exact(self, text: bytes) -> bytes:
        """Ids of a text that may name special tokens: words with a control character's bracket keep their case."""
        return b"".join([self[w if b"<" in w else w.translate(LOWER)] for w in text.split()])

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of every text, null as empty. The words of all texts are looked up once each."""
        column = column.fill_null("")
        words = pc.ascii_split_whitespace(pc.ascii_lower(column))
        coded = words.flatten().dictionary_encode()
        found = [self[w] for w in coded.dictionary.cast(pa.binary()).to_pylist()]
        ids, sizes = np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4
        index = coded.indices.to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes[index])
        # Position in ``ids`` of each token: its place among all tokens, shifted by its word's.
        shift = (np.cumsum(sizes) - sizes)[index] - (ends - sizes[index])
        tokens = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, sizes[index])]
        bounds = np.r_[0, ends][words.offsets.to_numpy() - words.offsets[0].as_py()]
        special = pc.match_substring(column, "<|").to_numpy(zero_copy_only=False)
        for number, (start, end) in enumerate(zip(bounds, bounds[1:], strict=False)):
            yield np.frombuffer(self._exact(column[number].as_py().encode()), "<u4") if special[number] else tokens[start:end]
        if len(self) > REMEMBERED:
            # Words that came first are the frequent ones.
            for word in [*islice(self, REMEMBERED // 2, None)]:
                del self[word]


def word_encoder(name: str) -> WordEncoder:
    if name not in _encoders:
        _encoders[name] = WordEncoder(name)
    return _encoders[name]


def pieces(docs: DataFrame, tokenizer: str, end: int = END, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """Pieces of every document (``doc_id``, ``text``), as a written table with columns ``PIECES``.

    ``ids`` are little-endian unsigned 32-bit; ``size`` is the length in steps, rounded up; ``part`` and ``number`` say
    where a piece stands among those of its size. A null or empty text is one piece with the end id alone. Rows are cut
    one by one, those that repeat others and those without an id too; columns beside these two are left out.
    """
    names = [c.split()[0] for c in PIECES.split(", ")]
    last = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = word_encoder(tokenizer).encode, TaskContext.get().partitionId(), {}
        for batch in batches:
            for first, column in slices(batch.column(1)):
                rows, whose = [], []
                for number, found in enumerate(encode(column), first):
                    ids = found.tobytes() + last
                    tokens = len(ids) // 4
                    for start in range(0, tokens, length):
                        piece = ids[4 * start : 4 * (start + length)]
                        size = -(-len(piece) // (4 * step))
                        rank = seen[size] = seen.get(size, -1) + 1
                        whose.append(number)
                        rows.append((start, len(piece) // 4, tokens, piece, part, size, rank))
                yield emit(batch, whose, rows)

    def emit(batch, whose, rows):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(whose, pa.int64())), *arrays], names)

    return written(docs.select("doc_id", "text").mapInArrow(run, PIECES), "pieces")


class Layout:
    """Which sequence and place the pieces of each size get, by their rank within it."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]]):
        rows, sequence = [], 0
        taken: dict[int, int] = {}
        for pattern, times in patterns:
            slot = 0
            for size in sorted(pattern, reverse=True):
                # From this rank on, pieces of the size come by so many to a sequence.
                rows.append((size, taken.get(size, 0), sequence, pattern[size], slot))
                taken[size] = taken.get(size, 0) + times * pattern[size]
                slot += pattern[size]
            sequence += times
        self.sequences = sequence
        rows = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.keys, self.first, self.sequence, self.each, self.slot = (rows[:, 0] << 48) + rows[:, 1], *rows.T[1:]

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = np.searchsorted(self.keys, (size.astype(np.int64) << 48) + rank, "right") - 1
        above = rank - self.first[row]
        return self.sequence[row] + above // self.each[row], self.slot[row] + above % self.each[row]


def _placed(layout: Layout, size: Column, rank: Column) -> Column:
    @F.arrow_udf("sequence_id long, slot long")
    def of(sizes: pa.Array, ranks: pa.Array) -> pa.Array:
        found = layout.place(np.asarray(sizes), np.asarray(ranks))
        return pa.StructArray.from_arrays([pa.array(a) for a in found], ["sequence_id", "slot"])

    return of(size, rank)


def place(found: DataFrame, length: int = LENGTH, step: int = STEP) -> DataFrame:
    """Pieces (any columns beside ``part``, ``size``, ``number``, ``length``) with ``sequence_id`` and ``offset``.

    ``found`` is read twice, so it should be a written table or a projection of one.
    """
    counts = written(found.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    demand = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    layout = Layout(cutting_stock(demand, length // step))
    before = Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "size", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(bases, ["part", "size"]).withColumn("at", _placed(layout, F.col("size"), F.col("base") + F.col("number")))
    inside = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranked.select(*found.columns, "at.sequence_id", "at.slot")
        .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
        .drop("part", "size", "number", "slot")
    )


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences of placed pieces: ``sequence_id``, ``ids`` without padding, and the ``offsets`` where pieces begin."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.col("parts.ids"), F.expr("X''"), lambda a, b: F.concat(a, b))
    return placed.groupBy("sequence_id").agg(ordered.alias("parts")).select(
        "sequence_id", joined.alias("ids"), F.col("parts.offset").alias("offsets")
    )
