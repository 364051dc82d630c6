"""Secrets in texts, by a ledger of content addresses.

Each version of a text is a blob, named by the SHA-256 of its content. The ledger holds, for every blob and version of
the rules, the spans that were found, also if there were none. A scan reads only the blobs that the ledger has not seen
under the present rules, one copy of each, and adds them in one append; then the ledger is joined back to all rows that
hold the blobs. A repeated scan, or one of a corpus that shares most of its texts with an earlier one, scans the rest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from remitlens.llm.common import let
from remitlens.session import new_folder

LEDGER = "blob string, rules string, spans array<struct<start:int,rank:int,kind:string,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and without overlap, whose group ``value`` (0: all) has ``least`` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 0


@dataclass(frozen=True)
class Block:
    """From a first mark to the next mark if that is a last one, or else the first mark and what belongs to it behind.

    ``pattern`` finds marks of all kinds; those that begin with ``first`` or ``last`` and end with ``ends`` are first or
    last ones. Without a last one, runs of ``part`` follow the first, and one ``short`` (its group 1) behind a part that
    is no ``field``.
    """

    kind: str
    pattern: str
    first: str
    last: str
    ends: str
    part: str
    field: str
    short: str

    def parts(self) -> str:
        """Cuts a text into parts and, from the first place on that is none, the rest."""
        return f"{self.part}|(?s:.+)"


# Formats of secrets. Runs of at least so many characters are matched as such, which finds the same spans
# as matching any run and dropping the short ones; an assignment is matched whole and then measured, since a short
# value may hide the start of the next one.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
# A private key is all from its first line to its last, without another key's between. Where the last is missing, it is the
# known fields and the base64 lines that follow, and a shorter line that ends these. Lines may be quoted, or broken by the
# two characters of an escaped line feed.
_BREAK = r"""[\x20\t\r\n>"'\\nr]*"""
_FIELD = rf"{_BREAK}(?:Proc-Type|DEK-Info):"
MORE = (
    Rule("forge", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Block(
        "private",
        "-----(?:BEGIN|END) (?:[A-Z ]{0,20}PRIVATE KEY-----)?",
        "-----BEGIN ",
        "-----END ",
        "PRIVATE KEY-----",
        rf"(?:{_FIELD}[^\r\n\\]*|{_BREAK}[A-Za-z0-9+/]{{20,}}={{0,2}})",
        rf"^{_FIELD}",
        rf"""^((?:[\r\n]|\\[nr]){_BREAK}[A-Za-z0-9+/]+={{0,2}}[\x20\t]*)(?:\z|[\r\n\\"'])""",
    ),
)


def version(rules: tuple[Rule | Block, ...]) -> str:
    """A name of these rules that changes with any of them."""
    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


SPAN = "struct<start:int,rank:int,kind:string,end:int>"
#: Entries that a running sum or maximum of an array looks back over at most, on each of its levels.
BLOCK = 128


def _running(values: Column, fold: Callable[[Column], Column], join: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """The array of ``fold`` over each entry and all before it.

    An entry folds those of its own block, and adds what is known of the blocks before, so work grows with the array;
    ``aggregate`` would copy a growing array at every entry.
    """

    def of(array: Column, level: int) -> Column:
        if level == 0:
            return F.transform(array, lambda _, i: fold(F.slice(array, 1, i + 1)))
        blocks = F.transform(F.filter(array, lambda _, i: i % BLOCK == 0), lambda _, b: fold(F.slice(array, b * BLOCK + 1, BLOCK)))

        def joined(before: Column) -> Column:
            own = lambda i: fold(F.slice(array, i - i % BLOCK + 1, i % BLOCK + 1))
            block = lambda i: F.floor(i / BLOCK).cast("int")
            return F.transform(array, lambda _, i: F.when(i < BLOCK, own(i)).otherwise(join(F.get(before, block(i) - 1), own(i))))

        return let(let(blocks, lambda found: of(found, level - 1)), joined)

    return let(values, lambda array: of(array, levels))


def _running_sum(values: Column) -> Column:
    return _running(values, lambda part: F.aggregate(part, F.lit(0), lambda a, b: a + b), lambda a, b: a + b)


def _running_max(values: Column) -> Column:
    return _running(values, F.array_max, F.greatest)


def _hit(gap: Column, hit: Column, counts: Column, more: Column) -> Column:
    return F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit"), counts.alias("counts"), more.alias("more"))


def _matches(text: Column, rule: Rule) -> Column:
    """Every match with the length of the gap before it; the pattern reads the text once for gaps and once for matches."""
    gaps, hits = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, F.lit(rule.pattern), 0)
    long = lambda hit: F.length(F.regexp_extract(hit, rule.pattern, rule.value)) >= rule.least
    counts = long if rule.least else (lambda hit: F.lit(True))
    # The last gap has no match behind it.
    return F.zip_with(gaps, hits, lambda gap, hit: _hit(gap, F.coalesce(hit, F.lit("")), hit.isNotNull() & counts(hit), F.lit(0)))


def _blocks(text: Column, rule: Block) -> Column:
    """Every mark with the length of the gap before it, and how far a block that it begins goes on behind it."""

    def behind(gap: Column, mark: Column) -> Column:
        begins = lambda m, head: m.startswith(head) & m.endswith(rule.ends)

        def tail(cut: Column) -> Column:
            own = F.filter(cut, lambda p: p.rlike("^" + rule.part))
            last = F.get(own, F.size(own) - 1)
            rest = F.when(F.size(own) < F.size(cut), F.element_at(cut, -1)).otherwise("")
            short = F.when(last.rlike(rule.field), 0).otherwise(F.length(F.regexp_extract(rest, rule.short, 1)))
            return F.aggregate(own, F.lit(0), lambda n, p: n + F.length(p)) + F.when(F.size(own) > 0, short).otherwise(0)

        whole = F.length(gap) + F.length(mark)
        unended = let(F.regexp_extract_all(gap, F.lit(rule.parts()), 0), tail)
        return F.when(begins(mark, rule.last), whole).otherwise(unended)

    def paired(found: Column) -> Column:
        gaps, marks = found["gaps"], found["marks"]
        after = lambda items: F.slice(items, 2, F.size(items))
        here = F.zip_with(gaps, marks, lambda gap, mark: F.struct(gap.alias("gap"), mark.alias("mark")))
        nexts = F.zip_with(after(gaps), after(marks), lambda gap, mark: F.struct(gap.alias("gap"), F.coalesce(mark, F.lit("")).alias("mark")))

        def joined(h: Column, n: Column) -> Column:
            mark = F.coalesce(h["mark"], F.lit(""))
            first = mark.startswith(rule.first) & mark.endswith(rule.ends)
            return _hit(h["gap"], mark, first, F.when(first, behind(n["gap"], n["mark"])).otherwise(0))

        return F.zip_with(here, nexts, joined)

    split = F.struct(F.split(text, rule.pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(rule.pattern), 0).alias("marks"))
    return let(split, paired)


def _spans(text: Column, rule: Rule | Block, rank: int) -> Column:
    def placed(hits: Column) -> Column:
        ends = _running_sum(F.transform(hits, lambda h: h["gap"] + h["hit"]))

        def span(h: Column, end: Column) -> Column:
            found = F.struct((end - h["hit"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (end + h["more"]).alias("end"))
            return F.when(h["counts"], found.cast(SPAN))

        return F.array_compact(F.zip_with(hits, ends, span))

    hits = _blocks(text, rule) if isinstance(rule, Block) else _matches(text, rule)
    return F.when(text.rlike(rule.pattern), let(hits, placed)).otherwise(F.array().cast(f"array<{SPAN}>"))


def spans(text: Column, rules: tuple[Rule | Block, ...]) -> Column:
    """All spans in code points (end exclusive) by start, then by the order of the rules."""
    return F.array_sort(F.concat(*[_spans(text, rule, rank) for rank, rule in enumerate(rules)]))


def listed(found: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


#: Code points of the pieces that a text is cut into to reach places in it.
PIECE = 512


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of spans that overlap, replaced by a mark.

    What stays is joined by the mark. A stretch is taken from the pieces that it touches, so a text is not walked from
    its start for every span.
    """

    def joined(cut: Column) -> Column:
        def stretch(start: Column, end: Column) -> Column:
            first = F.floor(start / PIECE).cast("int")
            pieces = F.slice(cut["pieces"], first + 1, F.ceil(end / PIECE).cast("int") - first)
            return F.when(end <= start, "").otherwise(F.substring(F.array_join(pieces, ""), start - first * PIECE + 1, end - start))

        # Up to where spans before each one reach; a span that starts inside of one of these leaves nothing in front.
        reach = F.concat(F.array(F.lit(0)), cut["reach"])
        kept = F.zip_with(cut["starts"], F.slice(reach, 1, F.size(cut["starts"])), lambda s, r: F.when(s >= r, stretch(r, s)))
        return F.array_join(F.concat(F.array_compact(kept), F.array(stretch(F.element_at(reach, -1), cut["length"]))), mark)

    cut = F.struct(
        F.transform(found, lambda s: s["start"]).alias("starts"),
        _running_max(F.transform(found, lambda s: s["end"])).alias("reach"),
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), 0).alias("pieces"),
        F.length(text).alias("length"),
    )
    return F.when(F.size(found) == 0, text).otherwise(let(cut, joined))


class BlobLedger:
    """Spans by blob and rules, as a table in the shared folder that scans add to."""

    def __init__(self, spark: SparkSession, path: str | None = None, rules: tuple[Rule | Block, ...] = BASE + MORE):
        self.spark, self.rules, self.rules_version = spark, rules, version(rules)
        self.path = path or new_folder(spark, "secret-ledger")
        # Makes the table, so that it can be read before the first scan.
        empty = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(LEDGER)])
        empty.write.mode("append").parquet(self.path)

    def read(self) -> DataFrame:
        """Blobs and spans under the present rules."""
        held = self.spark.read.schema(LEDGER).parquet(self.path)
        return held.filter(F.col("rules") == self.rules_version).select("blob", "spans")

    def scan(self, texts: DataFrame) -> int:
        """Scan the unseen blobs of ``texts`` (``blob``, ``text``); returns how many these were."""
        # Copies fold before the shuffle; all texts of a blob are equal.
        unseen = texts.groupBy("blob").agg(F.first("text").alias("text")).join(self.read().select("blob"), "blob", "left_anti")
        before = self.read().count()
        unseen.select(
            "blob", F.lit(self.rules_version).alias("rules"), spans(F.col("text"), self.rules).alias("spans")
        ).write.mode("append").parquet(self.path)
        return self.read().count() - before


def blob(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find_secrets(docs: DataFrame, ledger: BlobLedger) -> DataFrame:
    """``doc_id`` and ``spans`` of every row of ``docs``; rows that share a doc_id are versions of one document.

    A null text counts as empty and has no spans. The copies of a blob may be a large part of all rows: they are joined
    with the ledger by a plain join of two tables, whose large partitions Spark splits.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ledger.scan(rows.select(blob(F.col("text")).alias("blob"), "text"))
    held = ledger.read().withColumnRenamed("blob", "held")
    return rows.select("doc_id", blob(F.col("text")).alias("blob")).join(held, F.col("blob") == F.col("held")).select("doc_id", "spans")


def redact(docs: DataFrame, ledger: BlobLedger) -> DataFrame:
    """The documents (``text``, any others) with secrets replaced; ``n_chars``, if given, follows the new text.

    Rows without secrets come back as they are, a null text as null. Only blobs with spans take part in the join.
    """
    ledger.scan(docs.select(blob(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("text")))
    held = ledger.read().filter("size(spans) > 0").withColumnRenamed("blob", "held")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, blob(F.col("text")).alias("blob")).join(held, F.col("blob") == F.col("held"), "left")
    changed = F.col("spans").isNotNull()
    text = F.when(changed, redacted(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text"))
    rows = rows.withColumn("new", text)
    out = []
    for field in docs.schema.fields:
        value = F.col("row").getField(field.name)
        if field.name == "text":
            value = F.col("new")
        elif field.name == "n_chars":
            value = F.when(changed, F.length("new").cast(field.dataType)).otherwise(value)
        out.append(value.alias(field.name))
    return rows.select(*out)
