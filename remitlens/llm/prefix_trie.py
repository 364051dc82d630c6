"""Conversations as a trie of their shared first turns, from weighted sequences.

1. A turn becomes a hash of its role and text and the text's code points, so a conversation of any texts is a short string
   of 24 bytes a turn; sorting is Spark's, and no text is held longer than its row.
2. Equal conversations collapse into one sequence with its weight and the ids that end there. Ids are joined in ranges of
   numbers first, so a sequence that very many conversations share reaches its task as few rows, which are read one by one.
3. A node is a prefix of sequences, named by a chained hash. Every number of a node is a sum or an extreme over the
   sequences through it, so no node's members or descendants are ever gathered, and hot nodes fold before the shuffle.
   What counts each node once, such as the children, is added by its owner alone: the sequence with the smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.session import written

#: Bytes of a hash, and of a turn: its hash and the code points of its text.
HASH, TURN = 16, 24
#: The node of no turns.
ROOT = bytes(HASH)
#: Ids that are joined into one text before they meet those of the same sequence.
RANGE = 4096

SEQUENCES = "first long, n long, e0 long, e1 long, e2 long, e3 long, key binary, keys array<binary>, upto array<long>"


def _digest(*parts: bytes) -> bytes:
    found = hashlib.blake2b(digest_size=HASH)
    for part in parts:
        found.update(part)
    return found.digest()


def packed(rows: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns`` of every conversation from its rows (``conv_id``, ``turn``, ``role``, ``text``).

    Turns stand in the order of ``turn``, null first, then of role and text; repeated rows are turns of their own. A null
    role or text is empty. Rows without a conv_id belong to no conversation and are left out, as are other columns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            ids, roles, texts = batch.columns
            sizes = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
            done = []
            for conv, role, text, size in zip(ids.to_pylist(), roles, texts, sizes, strict=True):
                if conv != last:
                    if held:
                        done.append((last, b"".join(held)))
                    last, held = conv, []
                role = role.as_buffer().to_pybytes()
                held.append(_digest(len(role).to_bytes(8), role, text.as_buffer()) + int(size).to_bytes(8))
            yield emit(done)
        yield emit([(last, b"".join(held))] if held else [])

    def emit(done: list[tuple[int, bytes]]) -> pa.RecordBatch:
        arrays = [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "turns"])

    text = lambda name: F.coalesce(F.col(name), F.lit("")).alias(name)
    rows = rows.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", text("role"), text("text"))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, turns binary")


def with_shared_heads(convs: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations whose first turns are those of their group's first one, as after many continuations of one start.

    The first ``crc32(conv_id) % heads`` turns come from the conversation whose id is the multiple of ``group`` at or below
    (toward zero, for negative ids), as many as it has, none if it is not there; a conversation's own turns after as many
    follow. ``convs`` is read twice, so it should be a written table.
    """
    own = F.col("conv_id") - F.col("conv_id") % group
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads * TURN).cast("int")
    head = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), n)
    tail = F.substring(F.col("turns"), n + 1, F.octet_length("turns"))
    starts = convs.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.substring("turns", 1, (heads - 1) * TURN).alias("head")
    )
    return convs.join(starts, own == F.col("base"), "left").select("conv_id", F.concat(head, tail).alias("turns"))


def sequences(convs: DataFrame) -> DataFrame:
    """Distinct ``turns`` with their smallest conv_id (``first``), their number ``n``, the SHA-256 of their ids as four
    longs, and the ``keys`` and code points ``upto`` of every prefix, the root's first and the sequence's own last."""
    ids = F.array_join(F.array_sort(F.collect_list("conv_id")), ",")
    ranges = convs.groupBy("turns", F.expr(f"conv_id div {RANGE}").alias("range")).agg(
        ids.alias("ids"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        found = []
        for turns, same in groupby(rows, key=lambda row: row[0]):
            digest, n, first = hashlib.sha256(), 0, None
            for _, ids, count, least in same:
                digest.update(ids.encode() if n == 0 else b"," + ids.encode())
                n, first = n + count, least if first is None else first
            keys, upto = [ROOT], [0]
            for at in range(0, len(turns), TURN):
                keys.append(_digest(keys[-1], turns[at : at + HASH]))
                upto.append(upto[-1] + int.from_bytes(turns[at + HASH : at + TURN]))
            found.append((first, n, *np.frombuffer(digest.digest(), ">i8").tolist(), keys[-1], keys, upto))
            if len(found) == 1000:
                yield emit(found)
                found = []
        yield emit(found)

    def emit(found: list[tuple]) -> pa.RecordBatch:
        names = [c.split()[0] for c in SEQUENCES.split(", ")]
        kinds = [*[pa.int64()] * 6, pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())]
        columns = zip(*found, strict=True) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    ordered = ranges.repartition("turns").sortWithinPartitions("turns", "range")
    return ordered.select("turns", "ids", "n", "first").mapInArrow(run, SEQUENCES)


def nodes(convs: DataFrame) -> DataFrame:
    """The trie of conversations (``conv_id``, ``turns``; one row each), one row per node.

    ``conv_id``: the smallest member; ``depth``; ``parent_conv_id``: the parent's smallest member, null for the root;
    ``n_convs``: members; ``n_children``; ``n_leaves``: childless nodes of its subtree; ``saved_tokens``: over the subtree,
    each node's members but one times the code points of its last text; ``ends_sha256``: SHA-256 of the ids of members that
    end there, by number and joined by commas. Without conversations there are no nodes.
    """
    seqs = written(sequences(convs), "sequences")
    whole = F.size("keys") - 1
    prefixes = seqs.select("first", whole.alias("length"), F.posexplode("keys").alias("depth", "key"))
    known = written(
        prefixes.groupBy("key").agg(
            F.min("first").alias("owner"), F.max("depth").alias("depth"), F.max(F.col("depth") < F.col("length")).alias("goes_on")
        ),
        "prefixes",
    )
    # A sequence is a leaf unless it is a proper prefix of another.
    leaves = seqs.select("first", "key").join(known.where("goes_on").select("key"), "key", "left_anti")
    leaves = leaves.select("first", F.lit(1).alias("leaf"))
    # A sequence owns its nodes from some depth on; the node above that depth has another owner.
    owned = known.groupBy(F.col("owner").alias("first")).agg(F.min("depth").alias("own"))
    marked = written(seqs.join(leaves, "first", "left").join(owned, "first", "left"), "owned-sequences")
    above = marked.where("own > 0").select("first", F.col("keys")[F.col("own") - 1].alias("key"))
    above = above.join(known.select("key", F.col("owner").alias("above")), "key").select("first", "above")
    return _folded(marked.join(above, "first", "left"))


def _folded(marked: DataFrame) -> DataFrame:
    depth, length, own = F.col("depth"), F.size("keys") - 1, F.col("own")
    is_owner = F.coalesce(depth >= own, F.lit(False))

    def texts_from(place: Column) -> Column:
        """Code points of the sequence's turns from this one on."""
        return F.element_at("upto", -1) - F.when(place > 0, F.col("upto")[place - 1]).otherwise(0)

    # Members of all nodes below times their texts, less each of these texts once: from the owner of its node.
    once = F.when(own.isNull(), 0).otherwise(texts_from(F.greatest(depth, own)))
    rows = marked.select("*", F.posexplode("keys").alias("depth", "node")).select(
        "node", "depth", "first", "n",
        (F.col("n") * texts_from(depth) - once).alias("saved"),
        (F.coalesce(depth + 1 >= own, F.lit(False)) & (depth < length)).cast("long").alias("children"),
        F.coalesce("leaf", F.lit(0)).cast("long").alias("leaves"),
        F.when(is_owner & (depth > own), F.col("first")).when(is_owner, F.col("above")).alias("parent"),
        *[F.when(depth == length, F.col(f"e{i}")).alias(f"e{i}") for i in range(4)],
    )
    found = rows.groupBy("node").agg(
        F.min("first").alias("conv_id"), F.max("depth").cast("long").alias("depth"), F.max("parent").alias("parent_conv_id"),
        F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"), *[F.max(f"e{i}").alias(f"e{i}") for i in range(4)],
    )
    digest = F.concat(*[F.lpad(F.lower(F.hex(f"e{i}")), 16, "0") for i in range(4)])
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce(digest, F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
