"""Quality rules over whole texts: word, line and repetition counts, and divergence from the language's usual text.

Every document's characters fall into a few classes, and its words onto the language's common words or none of them.
Both histograms are compared with those of the language, summed over all documents of the table that pass the counting
rules, by Jensen-Shannon distance. Short documents, whose histograms say less, may be further off, and their words are not
compared. All of this is expressions over one row, a sum per language and a broadcast of these few sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm.common import SPACE, let
from remitlens.session import written

#: Fewest words, largest share in percent of words in repeated windows, words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Fewest words, and largest distances of characters, of words and of both together, for the divergence rules.
GUARD_WORDS, MOST_CHARS, MOST_WORDS, MOST_TOGETHER = 60, 0.30, 0.45, 0.44
#: Texts of fewer words than that are judged by their characters alone, and the fewer they are the further these may be off:
#: the largest distance just below the guard, and how much more a text of ``LEAST_WORDS`` may have.
SHORT_CHARS, WIDER = 0.34, 0.10

# Common words by language.
COMMON = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "be", "with", "as", "by"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "ein", "nicht"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}
#: Character classes that are counted one by one; the rest, white space apart, is one class more.
CLASSES = {"upper": r"\p{Lu}", "digits": "[0-9]", "stops": r"""[.,;:!?'"()\-]"""}
SYMBOLS = "[#*$%&|<>]"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _occurrences(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _repeat_words(words: Column, window: int) -> Column:
    """Words inside windows (a power of two long) that occur twice or more in the text, each counted once."""

    def joined(hashes: Column, shift: int) -> Column:
        """Hashes of neighbours at a distance: of 2 words from 1, of 4 from 2, of 8 from 4."""

        def pairs(h: Column) -> Column:
            count = F.size(h) - shift
            return F.zip_with(F.slice(h, 1, count), F.slice(h, 1 + shift, count), lambda x, y: F.xxhash64(x, y))

        return let(hashes, pairs)

    def hashes(w: Column) -> Column:
        found, width = F.transform(w, lambda x: F.xxhash64(x)), 1
        while width < window:
            found, width = joined(found, width), 2 * width
        return found

    def covered(h: Column) -> Column:
        # Sorted by hash, a window that occurs again stands beside one that is equal.
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        alike = lambda s, e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        again = let(pairs, lambda s: F.filter(s, lambda e, k: alike(s, e, k - 1) | alike(s, e, k + 1)))
        starts = F.array_sort(F.transform(again, lambda e: e["i"]))
        # A window covers its words up to the next window's start.
        widths = let(starts, lambda s: F.transform(s, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(s, k + 1) - p, F.lit(window)))))
        return F.aggregate(widths, F.lit(0), lambda a, b: a + b)

    repeated = let(hashes(words), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(F.size(words) <= window, 0).otherwise(repeated)


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def _language(lang: Column) -> Column:
    return F.when(lang.isin(*COMMON), lang).otherwise("other")


def _common(words: Column, language: Column) -> Column:
    """How often each common word of the language occurs; an empty array for other languages."""
    listed = sorted({w for of in COMMON.values() for w in of})
    usual = F.filter(words, lambda w: w.isin(*listed))

    def counts(of: tuple[str, ...]) -> Column:
        return let(usual, lambda u: F.transform(F.array(*map(F.lit, of)), lambda c: F.size(u) - F.size(F.array_remove(u, c))))

    chosen = F.lit(None).cast("array<int>")
    for name, of in COMMON.items():
        chosen = F.when(language == name, counts(of)).otherwise(chosen)
    return F.coalesce(chosen, F.array().cast("array<int>"))


def measured(docs: DataFrame, text: Column, lang: Column, window: int = WINDOW) -> DataFrame:
    """``docs`` with a struct ``found``: the counts, both histograms, the language and the counting rules' verdict.

    It replaces a column of this name; other columns stay, whatever their names.
    """
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+", -1), "")
    kept = [c for c in docs.columns if c != "found"]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_own")
    rows = docs.select(own, F.coalesce(text, F.lit("")).alias("_text"), words.alias("_words"), _language(lang).alias("_language"))
    w, n = F.col("_words"), F.size("_words")
    # What is neither lower case nor white space is a small part of most texts, and all that the classes count.
    rows = rows.withColumn("_marks", F.regexp_replace("_text", r"[\p{Ll}\x20\x09-\x0D]+", ""))
    t = F.col("_marks")
    rows = rows.withColumns(
        {
            "_n_words": n.cast("long"),
            "_word_chars": F.length(F.array_join(w, "")).cast("long"),
            "_n_symbols": _occurrences(t, SYMBOLS).cast("long"),
            "_n_dup_lines": _dup_lines(F.col("_text")).cast("long"),
            "_n_repeat_words": _repeat_words(w, window).cast("long"),
            "_common": _common(w, F.col("_language")),
            "_classes": F.array(*[_occurrences(t, p) for p in CLASSES.values()]),
        }
    )
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    rest = lambda whole, a: F.concat(a, F.array((whole - total(a)).cast("int")))
    failed = (F.col("_n_words") < LEAST_WORDS) | (100 * F.col("_n_repeat_words") > MOST_REPEATED * F.col("_n_words"))
    chars = rest(F.col("_word_chars"), F.concat("_classes", F.array(F.col("_n_symbols").cast("int"))))
    found = F.struct(
        *[F.col(f"_{c}").alias(c) for c in COUNTS],
        failed.alias("base_failed"),
        F.col("_language").alias("language"),
        chars.alias("chars"),
        rest(F.col("_n_words"), F.col("_common")).alias("words"),
    )
    return rows.select(*[F.col("_own").getField(c).alias(c) for c in kept], found.alias("found"))


def _share(counts: Column) -> Column:
    whole = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return let(whole, lambda s: F.transform(counts, lambda x: x / s))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (0 to 1) of two histograms of the same length, of any sums above 0."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    both = F.zip_with(_share(p), _share(q), lambda x, y: let((x + y) / 2, lambda m: (part(x, m) + part(y, m)) / 2))
    root = F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))
    return F.round(root, 9)  # the last digits depend on the order of the sums


def _usual(found: DataFrame, fits: Column) -> DataFrame:
    """Sums of both histograms by language over the rows that fit: a row per known language and one for the others."""
    sums = {"chars": len(CLASSES) + 2, "words": max(map(len, COMMON.values())) + 1}
    parts = [
        F.coalesce(F.sum(F.get(F.col(f"found.{name}"), F.lit(i))), F.lit(0)).alias(f"{name}{i}")
        for name, size in sums.items() for i in range(size)
    ]
    summed = found.filter(fits).groupBy(F.col("found.language").alias("usual_language")).agg(*parts)
    return summed.select(
        "usual_language",
        *[F.array(*[f"{name}{i}" for i in range(size)]).alias(f"usual_{name}") for name, size in sums.items()],
    )


def _compared(found: DataFrame, usual: DataFrame) -> DataFrame:
    """Rows with ``chars_distance``, ``words_distance`` and ``usual``, whether both are small enough or unknown."""
    rows = found.join(F.broadcast(usual), F.col("found.language") == F.col("usual_language"), "left")
    n = F.col("found.n_words")
    apart = lambda name, q: F.when(q.isNotNull(), distance(F.col(f"found.{name}"), q))
    chars = F.when(n >= LEAST_WORDS, apart("chars", F.col("usual_chars")))
    listed = F.slice("usual_words", 1, F.greatest(F.size("found.words"), F.lit(1)))
    words = F.when((n >= GUARD_WORDS) & (F.col("found.language") != "other"), apart("words", listed))
    rows = rows.withColumns({"chars_distance": chars, "words_distance": words})
    known = [F.coalesce(F.col(name), F.lit(0.0)) for name in ("chars_distance", "words_distance")]
    short = F.lit(SHORT_CHARS) + F.lit(WIDER) * (GUARD_WORDS - n) / F.lit(float(GUARD_WORDS - LEAST_WORDS))
    most = F.when(n >= GUARD_WORDS, F.lit(MOST_CHARS)).otherwise(short)
    small = (known[0] <= most) & (known[1] <= MOST_WORDS) & (known[0] + known[1] <= MOST_TOGETHER)
    return rows.withColumn("usual", small).drop("usual_language", "usual_chars", "usual_words")


def judged(found: DataFrame) -> DataFrame:
    """Measured rows (a written table: it is read three times) with a struct ``verdict`` of both distances and ``kept``.

    The reference of a language is summed twice: over all rows that pass the counting rules, and then over those of
    them that are near the first sum, so that junk does not shift what is usual.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in found.columns if c != "found"]).alias("row")
    passed = ~F.col("found.base_failed")
    near = _compared(found.select("found"), _usual(found, passed)).filter("usual").select("found")
    rows = _compared(found.select(row, "found"), _usual(near, passed))
    verdict = F.struct("chars_distance", "words_distance", (passed & F.col("usual")).alias("kept"))
    return rows.select("row.*", "found", verdict.alias("verdict"))


def quality(docs: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``chars_distance``, ``words_distance`` and ``kept`` of every document.

    Takes ``doc_id``, ``text`` and ``lang``. A null or empty text has no words and fails. The distance of words is null
    for texts of fewer than ``GUARD_WORDS`` and for languages without a list, both are for fewer than ``LEAST_WORDS``; null
    passes. Repeated rows are judged each.
    """
    found = written(measured(docs.select("doc_id", "text", "lang"), F.col("text"), F.col("lang")).drop("text", "lang"), "measures")
    return judged(found).select(
        "doc_id", *[f"found.{c}" for c in COUNTS], "found.base_failed", "verdict.chars_distance", "verdict.words_distance", "verdict.kept"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents (``doc_id``, ``text``, ``lang``, any others) that pass every rule, each row judged by itself."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = written(measured(docs.select(row), F.col("row.text"), F.col("row.lang")), "measured")
    return judged(found).filter("verdict.kept").select("row.*")
