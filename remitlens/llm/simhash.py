"""Near-duplicate documents by SimHash, compared exactly in tiles.

Every document becomes a 64-bit fingerprint. Distinct fingerprints are dealt into tiles by their population count
(number of one bits) and, where many share a count, by hash. Two fingerprints at d differing bits have population
counts at most d apart, so only tiles whose counts are within the radius meet. Each pair of tiles is one row of
two arrays, compared by numpy in blocks; it yields a spanning forest of the links that it finds instead of all
pairs, so a large group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import LOWER, texts
from remitlens.llm.components import connected_components
from remitlens.session import written

SEED = 42
#: Words of a shingle and most differing bits between linked documents.
SHINGLE, RADIUS = 4, 4
#: Fingerprints of a tile on average. A pair of tiles is two arrays of this length; the number of pairs of tiles
#: grows with the square of documents / TILE.
TILE = 16_384

_ROWS, _COLUMNS = 32, 4096


# -- fingerprints ------------------------------------------------------------------------------------


def simhash(text: bytes, width: int = SHINGLE) -> int:
    """The fingerprint of UTF-8 text, as an unsigned integer; 0 without any word."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = list(accumulate([len(w) + 1 for w in words]))
    hash_of = xxhash.xxh64_intdigest
    count = len(words) - width + 1
    hashes = np.fromiter(
        (hash_of(joined[s : e - 1], SEED) for s, e in zip([0, *ends], ends[width - 1 :], strict=False)), np.uint64, count
    )
    votes = np.zeros(64, np.int64)
    for start in range(0, count, 255 * 64):  # sums of 255 bits fit a byte
        bits = np.unpackbits(hashes[start : start + 255 * 64].view(np.uint8), bitorder="little").reshape(-1, 64)
        whole = len(bits) // 255 * 255
        if whole:
            votes += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        if whole < len(bits):
            votes += bits[whole:].sum(0, dtype=np.uint8)
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, width: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long; null counts as empty."""

    @F.arrow_udf("long")
    def of(column: pa.Array) -> pa.Array:
        found = np.fromiter((simhash(t, width) for t in texts(column)), np.uint64, len(column))
        return pa.array(found.view(np.int64))

    return of(text)


def as_hex(value: Column) -> Column:
    """Sixteen lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# -- tiles -------------------------------------------------------------------------------------------


def _halves(tile: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tile sorted by the one bits of the low half, and these counts."""
    low = np.bitwise_count(tile & np.uint64(0xFFFFFFFF))
    order = np.argsort(low, kind="stable")
    return tile[order], low[order].astype(np.int64)


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into a, into b) at ``radius`` differing bits or fewer, block by block.

    Both arrays are sorted by the one bits of their low halves. A block of rows meets only the columns whose low
    halves are within the radius too, which form one slice.
    """
    low_a = np.bitwise_count(a & np.uint64(0xFFFFFFFF)).astype(np.int64)
    low_b = np.bitwise_count(b & np.uint64(0xFFFFFFFF)).astype(np.int64)
    xor, bits = np.empty((_ROWS, _COLUMNS), np.uint64), np.empty((_ROWS, _COLUMNS), np.uint8)
    for i in range(0, len(a), _ROWS):
        rows = a[i : i + _ROWS, None]
        first = np.searchsorted(low_b, low_a[i] - radius, "left")
        last = np.searchsorted(low_b, low_a[min(i + _ROWS, len(a)) - 1] + radius, "right")
        for j in range(first, last, _COLUMNS):
            columns = b[None, j : min(j + _COLUMNS, last)]
            x, d = xor[: len(rows), : columns.shape[1]], bits[: len(rows), : columns.shape[1]]
            np.bitwise_xor(rows, columns, out=x)
            np.bitwise_count(x, out=d)
            if d.min() <= radius:
                u, v = np.nonzero(d <= radius)
                yield u + i, v + j


def _roots(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    found = parent[nodes]
    while True:
        above = parent[found]
        if np.array_equal(above, found):
            return found
        found = above


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, or within one: nodes and their roots."""
    a, _ = _halves(a)
    if b is None:
        nodes, shift, other = a, 0, a
    else:
        other, _ = _halves(b)
        nodes, shift = np.concatenate([a, other]), len(a)
    parent = np.arange(len(nodes))
    for u, v in close_pairs(a, other, radius):
        v = v + shift
        while len(u):
            u, v = _roots(parent, u), _roots(parent, v)
            apart = u != v
            u, v = u[apart], v[apart]
            np.minimum.at(parent, np.maximum(u, v), np.minimum(u, v))
    linked = np.flatnonzero(parent != np.arange(len(nodes)))
    return nodes[linked], nodes[_roots(parent, linked)]


def _compare(radius: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tiles in batch.column("tiles"):
                found = [np.asarray(t["prints"].values).view(np.uint64) for t in tiles]
                nodes, roots = forest(found[0], found[1] if len(found) > 1 else None, radius)
                if len(nodes):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(nodes.view(np.int64)), pa.array(roots.view(np.int64))], schema=schema
                    )

    return run


def links(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links a, b that span every group of distinct fingerprints (column ``fingerprint``) within the radius.

    The driver learns only how many fingerprints have 0, 1, ... 64 one bits.
    """
    ones = F.expr("bit_count(fingerprint)")
    sizes = {r["ones"]: r["n"] for r in prints.groupBy(ones.alias("ones")).agg(F.count(F.lit(1)).alias("n")).collect()}
    shares = [-(-sizes.get(p, 0) // tile) for p in range(65)]
    starts = [0, *accumulate(shares)]
    # For each count, the numbers of all tiles that a tile of that count has to meet.
    near = [[starts[max(0, p - radius)], starts[min(65, p + radius + 1)]] for p in range(65)]
    at = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("ones") + 1)
    tiles = (
        prints.select("fingerprint", ones.alias("ones"))
        .withColumn("tile", at(starts[:65]) + F.pmod(F.xxhash64("fingerprint"), F.greatest(at(shares), F.lit(1))).cast("int"))
        .groupBy("tile", "ones")
        .agg(F.collect_list("fingerprint").alias("prints"))
    )
    partners = F.sequence(at([n[0] for n in near]), at([n[1] for n in near]) - 1)
    pairs = (
        tiles.select("tile", "prints", F.explode(partners).alias("partner"))
        .groupBy(F.least("tile", "partner").alias("left"), F.greatest("tile", "partner").alias("right"))
        .agg(F.collect_list(F.struct("tile", "prints")).alias("tiles"))
    )
    return pairs.select("tiles").mapInArrow(_compare(radius), "a long, b long")


# -- operator ----------------------------------------------------------------------------------------


def near_duplicates(prints: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Each row of ``prints`` (columns ``doc_id`` and ``fingerprint``, read more than once, so a table) with its group.

    Adds ``root`` (a fingerprint that names the group) and ``component_id`` (the group's smallest doc_id), which replace
    columns of these names. Rows
    without a doc_id are linked like any other, but name a group only if none of its rows has one: then
    ``component_id`` is null. Repeated rows come back as often as they are given. Documents without a word share
    the fingerprint zero and so form a group.
    """
    nodes = written(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")), "prints")
    linked = written(connected_components(links(nodes.select("fingerprint"), radius, tile)), "linked")
    members = written(
        nodes.join(linked, nodes.fingerprint == linked.node, "left").select(
            "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "least_id"
        ),
        "members",
    )
    # A group's rows may all share one root, so its smallest id is folded first and joined between written tables.
    least = written(members.groupBy("root").agg(F.min("least_id").alias("component_id")), "least-ids")
    named = written(members.join(least, "root").select("fingerprint", "root", "component_id"), "named")
    return prints.drop("root", "component_id").join(named, "fingerprint", "left")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE) -> DataFrame:
    """The documents (columns ``doc_id``, ``text``, any others) without near copies: one row of each group stays.

    That is the row with the group's smallest doc_id (null only if no row has one); of rows that repeat it, those
    with the smallest fingerprint, and of these the least by all columns in order.
    """
    columns = docs.columns
    marked = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), fingerprint(F.col("text"), width).alias("fingerprint")), "marked")
    prints = marked.select(F.col("row.doc_id").alias("doc_id"), "fingerprint")
    keep = (
        near_duplicates(prints, radius)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("doc_id").alias("keep_id"), F.min("fingerprint").alias("keep_print"))
        .drop("root")
    )
    kept = marked.withColumn("doc_id", F.col("row.doc_id")).join(
        keep, F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("fingerprint") == F.col("keep_print")), "left_semi"
    )
    return kept.groupBy("doc_id", "fingerprint").agg(F.min("row").alias("row")).select("row.*")
