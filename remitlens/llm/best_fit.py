"""Documents as token pieces, packed by best-fit decreasing with certified bin counts.

1. Pieces stay in the partition that cut them. All that is known of a partition is how many pieces it has of each length,
   a table of at most as many rows as a sequence has tokens, and best-fit decreasing works on that: equal pieces are placed
   in as many equal sequences at once as there are.
2. Dual feasible functions bound from below how many sequences a partition's pieces need. A partition that needs no more
   is certified and done. Partitions with a gap exchange their documents: four neighbours become one pool, which is packed
   anew, and so on until none has a gap or all are one pool.
3. At the end all partitions exchange the documents of sequences that are not full, if that saves any.
4. A piece finds its place by its rank among the pieces of its length: ranks come from counts, so no pool's pieces are ever
   gathered, and a length that very many pieces share is no task's alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlens.llm.packing import pieces
from remitlens.session import written

#: Tokens of a sequence, id after each document, pools that exchange their documents at a time.
LENGTH, END, FANOUT = 2048, 0, 4
#: Dual feasible functions of rounding that are tried.
ROUNDINGS = 40
#: Bits of a pool's number within its round, and of a sequence's within its pool.
POOL_BITS, SEQUENCE_BITS = 24, 32
#: The round of what is exchanged at the end.
LAST = 127


class Row(NamedTuple):
    """Pieces of one size from some rank on: so many to each of some sequences in a row, from an offset on."""

    size: int
    first: int
    items: int
    sequence: int
    each: int
    offset: int
    loose: bool


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by dual feasible functions: a size's value is such that no bin's values exceed one.

    Tried are the plain share of the capacity; for each size up to half, counting larger ones than what it leaves as
    whole and smaller ones as nothing; and rounding shares down to a k-th after a (k+1)-fold.
    """
    if not len(sizes):
        return 0
    held = np.zeros(capacity + 1, np.int64)
    held[sizes] = counts
    number, tokens = np.cumsum(held), np.cumsum(held * np.arange(capacity + 1))
    cut = np.arange(capacity // 2 + 1)
    below = np.maximum(cut - 1, 0)
    shares = (number[-1] - number[capacity - cut]) * capacity + tokens[capacity - cut] - tokens[below]
    best = -(-int(shares.max()) // capacity)
    for k in range(1, ROUNDINGS + 1):
        whole = (k + 1) * sizes
        value = np.where(whole % capacity == 0, k * sizes, whole // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit(sizes: list[int], counts: list[int], capacity: int) -> tuple[list[Row], int]:
    """Best-fit decreasing over counts of sizes; returns the layout and the number of bins.

    Of each size, ranks in full bins come before those in bins that are not.
    """
    rows: list[list[int]] = []
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by room: first bin and number of bins
    rooms: list[int] = []
    bins = 0
    for size, left in sorted(zip(sizes, counts, strict=True), reverse=True):
        while left:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                start, number = free[room].pop()
                each = room // size
                take = min(number, left // each)
                if not take:
                    take, each = 1, left
                if take < number:
                    free[room].append((start + take, number - take))
            else:
                room, start, each = capacity, bins, capacity // size
                take = left // each
                if not take:
                    take, each = 1, left
                bins += take
            if room < capacity and not free[room]:
                rooms.remove(room)
            rest = room - each * size
            if rest:
                if not free[rest]:
                    insort(rooms, rest)
                free[rest].append((start, take))
            rows.append([size, start, take, each, capacity - room])
            left -= take * each
    return _ranked(rows, sorted(group for groups in free.values() for group in groups)), bins


def _ranked(rows: list[list[int]], loose: list[tuple[int, int]]) -> list[Row]:
    """Cut the rows where full bins and others meet, and number the pieces of each size, those of full bins first."""
    starts = [start for start, _ in loose]
    cut = []
    for size, start, take, each, offset in rows:
        end, at = start + take, start
        i = max(bisect_left(starts, start + 1) - 1, 0)
        while at < end:
            while i < len(loose) and sum(loose[i]) <= at:
                i += 1
            inside = i < len(loose) and loose[i][0] <= at
            upto = min(end, (sum(loose[i]) if inside else loose[i][0]) if i < len(loose) else end)
            cut.append((size, inside, at, upto - at, each, offset))
            at = upto
    found, seen = [], defaultdict(int)
    for size, inside, at, take, each, offset in sorted(cut):
        found.append(Row(size, seen[size], take * each, at, each, offset, inside))
        seen[size] += take * each
    return found


LAYOUT = "pool long, size int, first long, items long, sequence long, each long, offset long, loose boolean, bins long, bound long"


def _packed(counts: DataFrame, capacity: int) -> DataFrame:
    """The layout of every pool (``pool``, ``size``, ``n``; a row per pool and size) with its bins and their bound."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        sizes, n = np.asarray(table["size"]).astype(np.int64), np.asarray(table["n"])
        rows, bins = best_fit(sizes.tolist(), n.tolist(), capacity)
        bound = lower_bound(sizes, n, capacity)
        whole = [(key[0].as_py(), *row, bins, bound) for row in rows]
        names = [c.split()[0] for c in LAYOUT.split(", ")]
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*whole, strict=True), kinds, strict=True)], names=names)

    return counts.groupBy("pool").applyInArrow(run, LAYOUT)


class Plan(NamedTuple):
    """Where pieces go: ``held``, the numbers of pieces by ``part``, ``size`` and ``pool``; the pools' ``layout``; and the
    layout of the sequences that all pools fill together, or None. Pools are numbered over all rounds."""

    held: DataFrame
    layout: DataFrame
    shared: DataFrame | None


def plan(counts: DataFrame, capacity: int = LENGTH, fanout: int = FANOUT) -> Plan:
    """Pack numbers of pieces (``part``, ``size``, ``n``; a written table), in rounds of exchange.

    The rounds are as many as it takes to make all partitions one pool; only pools with a gap take part in the next.
    """
    parts = (counts.agg(F.max("part").alias("m")).first()["m"] or 0) + 1
    open_counts, held, layout, step = counts.withColumn("pool", F.col("part").cast("long")), None, None, 0
    while True:
        pooled = open_counts.groupBy("pool", "size").agg(F.sum("n").alias("n"))
        found = written(_packed(pooled, capacity), f"layout-{step}")
        gaps = found.where("bins > bound").select("pool").distinct()
        # All partitions are one pool already, or no pool has a gap.
        last = fanout**step >= parts or gaps.isEmpty()
        done = found if last else found.where("bins <= bound")
        here = open_counts if last else open_counts.join(gaps, "pool", "left_anti")
        number = (F.lit(step << POOL_BITS) + F.col("pool")).alias("pool")
        here = here.select("part", "size", "n", number)
        done = done.select(number, *[c for c in found.columns if c != "pool"])
        held = here if held is None else held.unionAll(here)
        layout = done if layout is None else layout.unionAll(done)
        if last:
            break
        again = open_counts.join(gaps, "pool", "left_semi").withColumn("pool", F.expr(f"pool div {fanout}"))
        open_counts, step = written(again.select("part", "size", "n", "pool"), f"exchanged-{step}"), step + 1
    held, layout = written(held, "held"), written(layout, "layout")
    return Plan(held, layout, _shared(layout, capacity))


def _shared(layout: DataFrame, capacity: int) -> DataFrame | None:
    """A layout for the pieces of all sequences that are not full, if it has fewer sequences."""
    loose = layout.where("loose")
    before = loose.where("offset = 0").agg(F.sum(F.expr("items div each")).alias("n")).first()["n"] or 0
    pooled = loose.groupBy("size").agg(F.sum("items").alias("n")).withColumn("pool", F.lit(LAST << POOL_BITS).cast("long"))
    found = written(_packed(pooled, capacity), "shared-layout")
    row = found.select("bins").first()
    return found if row and row["bins"] < before else None


def certificates(layout: DataFrame) -> DataFrame:
    """``pool``, its ``bins`` before what is exchanged at the end, and the ``bound`` that no packing of its pieces beats."""
    return layout.select("pool", "bins", "bound").distinct()


def _rows_of(layout: DataFrame, *keys: str) -> DataFrame:
    """The layout as one array per size, by rank."""
    row = F.struct("first", "sequence", "each", "offset")
    return layout.groupBy(*keys).agg(F.sort_array(F.collect_list(row)).alias("rows"))


def place(found: DataFrame, planned: Plan) -> DataFrame:
    """Pieces (any columns beside ``part``, ``size``, ``number``) with ``sequence_id`` and ``offset``.

    ``part`` and ``number`` must be those that were counted, so ``found`` has to be a written table or come from one: a task
    that runs again then yields the same ranks.
    """
    shared = planned.shared
    before = Window.partitionBy("pool", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = planned.held.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = planned.layout if shared is None else planned.layout.where("not loose")
    tables = planned.layout.groupBy("pool", "size").agg(
        F.sum(F.when(F.col("loose"), 0).otherwise(F.col("items"))).alias("full"), F.sum("items").alias("items")
    )
    if shared is None:
        tables = tables.select("pool", "size", F.col("items").alias("full"), F.lit(0).cast("long").alias("loose_base"))
    else:
        pools = Window.partitionBy("size").orderBy("pool").rowsBetween(Window.unboundedPreceding, -1)
        tables = tables.withColumn("loose_base", F.coalesce(F.sum(F.col("items") - F.col("full")).over(pools), F.lit(0))).drop("items")
    tables = tables.join(_rows_of(own, "pool", "size"), ["pool", "size"], "left")
    ranked = found.join(bases.join(tables, ["pool", "size"]), ["part", "size"])
    rank = F.col("base") + F.col("number")
    if shared is not None:
        # At most a row per size, so it can be sent whole.
        ranked = ranked.join(F.broadcast(_rows_of(shared, "size").withColumnRenamed("rows", "shared_rows")), "size", "left")
        loose = rank >= F.col("full")
        number = F.lit(LAST << POOL_BITS)
        rank, pool = F.when(loose, rank - F.col("full") + F.col("loose_base")).otherwise(rank), F.when(loose, number).otherwise(F.col("pool"))
        rows = F.when(loose, F.col("shared_rows")).otherwise(F.col("rows"))
    else:
        pool, rows = F.col("pool"), F.col("rows")
    at = ranked.withColumns({"rank": rank, "pool": pool}).withColumn("row", _row(rows, F.col("rank")))
    above = F.col("rank") - F.col("row.first")
    sequence = F.shiftleft("pool", SEQUENCE_BITS) + F.col("row.sequence") + F.floor(above / F.col("row.each"))
    offset = F.col("row.offset") + above % F.col("row.each") * F.col("size")
    kept = [c for c in found.columns if c not in ("part", "size", "number")]
    return at.select(*kept, sequence.alias("sequence_id"), offset.cast("long").alias("offset"))


def _row(rows: Column, rank: Column) -> Column:
    return F.get(rows, F.size(F.filter(rows, lambda r: r["first"] <= rank)) - 1)


def pack(docs: DataFrame, tokenizer: str, end: int = END, length: int = LENGTH) -> DataFrame:
    """Pieces of every document (``doc_id``, ``text``) with their place: ``doc_id``, ``piece``, ``start``, ``length``,
    ``doc_tokens``, ``ids`` (little-endian unsigned 32-bit), ``sequence_id``, ``offset``.

    A document of more than ``length`` tokens is cut into pieces of that many and a last one that may be shorter; others
    stay whole. A null or empty text is the end id alone. Rows that repeat others, and those without an id, are packed like
    any other; columns beside ``doc_id`` and ``text`` are left out. No documents make no sequences.
    """
    found = pieces(docs, tokenizer, end, length, 1)
    return place(_numbered(found, length), plan(_counted(found), length))


def _numbered(found: DataFrame, length: int) -> DataFrame:
    return found.withColumn("piece", F.expr(f"start div {length}").cast("int"))


def _counted(found: DataFrame) -> DataFrame:
    return written(found.groupBy("part", "size").agg(F.count(F.lit(1)).alias("n")), "piece-counts")


def digests(docs: DataFrame, tokenizer: str, end: int = END, length: int = LENGTH) -> DataFrame:
    """As :func:`pack`, with the CRC-32 of each piece's ids (``ids_crc32``) in their place."""
    found = pieces(docs, tokenizer, end, length, 1)
    short = _numbered(found, length).withColumn("ids_crc32", F.crc32("ids")).drop("ids", "doc_tokens")
    return place(short, plan(_counted(found), length))
