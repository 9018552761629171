"""Removal of repeated line runs by winnowing over line hashes (operator 8),
DataFrame functions only.

A line is what stands between line feeds, compared without the white space
around it; lines without a word take no part and stay.  A window is a shortest run of
consecutive lines with at least ``RUN_WORDS`` words.  Where a window's lines
occur again later (in a later document, or further down the same one) the
later copy goes; documents are ordered by id, then by a hash of the text.

1. Fingerprint: every window selects the position of its smallest line hash (the
   first of equal ones).  A repeated run of ``RUN_WORDS`` words holds a whole
   window, so a position of it is selected wherever the run occurs.
2. Join: selected positions, one row each, meet by their line hash; those whose
   hash is selected at one place only are done.
3. Extend: from each matched position the windows to both sides that selected
   it are compared as whole line sequences; the first place of each is
   its source, and the lines of all later ones are deleted.  Together these
   windows reach exactly as far as the run agrees with earlier text.

First and last places are minima and maxima, combined in each task before
anything moves, so a line that a third of all documents share is one row per
task, and they go back to the rows of frequent lines by a broadcast (see
``attach_totals``).  Nothing is paired within a group.

Defined results: null text stays null; empty text stays; rows of equal id and
text are one document and keep the same lines; overlapping repeats (one line
many times) shrink to their first lines; ids that are null come first; a text of any
length is read whole; an empty table gives no rows; other columns pass through under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.llm.common import attach_totals, let, written

#: words of a run that is long enough to go
RUN_WORDS = 50
#: rows of deleted lines that may be broadcast with the documents; more are shuffled
BROADCAST_ROWS = 500_000

_WORD = r"[^\x20\x09-\x0D]+"
_SPACE = " \t\x0b\x0c\r"


def _reach(words: Column, width: int) -> Column:
    """How many of the first values of an array make up ``width`` (0: too few)."""
    start = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("n"))
    return F.aggregate(
        words, start,
        lambda a, x: F.when(a["sum"] >= width, a).otherwise(
            F.struct((a["sum"] + x).cast("bigint").alias("sum"), (a["n"] + 1).alias("n"))),
        lambda a: F.when(a["sum"] >= width, a["n"]).otherwise(0))


def _units(text: Column) -> Column:
    """Lines with a word: (line number, hash, words)."""
    lines = F.transform(F.split(text, "\n"), lambda line, i: F.struct(
        i.alias("line"), F.xxhash64(F.trim(line, F.lit(_SPACE))).alias("hash"), F.regexp_count(line, F.lit(_WORD)).alias("words")))
    return F.filter(lines, lambda u: u["words"] > 0)


def _spans(words: Column, run_words: int) -> Column:
    """(first, n) of all shortest windows of one document, from the bound words of its lines."""
    def span(first: Column, n: Column, wanted: Column) -> Column:
        return F.when(wanted & (n > 0), F.struct(first.cast("int").alias("first"), n.cast("int").alias("n")))

    # a window has run_words lines at most, since every line has a word
    def ending(j: Column) -> Column:
        low = F.greatest(F.lit(0), j - run_words + 1)
        reach = _reach(F.reverse(F.slice(words, low + 1, j - low + 1)), run_words)
        return let(reach, lambda n: span(j - n + 1, n, F.lit(True)))

    def starting(i: Column) -> Column:
        ahead = F.slice(words, i + 1, F.lit(run_words))

        def of(n: Column) -> Column:
            # one that is too short without its first line is also the shortest that ends where it ends
            rest = F.aggregate(F.slice(ahead, F.lit(2), F.greatest(n - 1, F.lit(0))), F.lit(0).cast("bigint"),
                               lambda a, x: (a + x).cast("bigint"))
            return span(i, n, rest >= run_words)

        return let(_reach(ahead, run_words), of)

    places = F.sequence(F.lit(0), F.size(words) - 1)
    found = F.when(F.size(words) > 0, F.concat(F.transform(places, ending), F.transform(places, starting)))
    return F.filter(found, lambda w: w.isNotNull())


def _selected(u: Column, run_words: int) -> Column:
    """(at, first, n) of every window of one document: the place that it selects, its lines."""
    def of(w: Column) -> Column:
        run = F.slice(u["hashes"], w["first"] + 1, w["n"])
        return F.struct((w["first"] + F.array_position(run, F.array_min(run)) - 1).cast("int").alias("at"),
                        w["first"].alias("first"), w["n"].alias("n"))

    return F.transform(_spans(u["words"], run_words), of)


def line_table(docs: DataFrame, run_words: int, id_col: str, text_col: str) -> DataFrame:
    """Per document with a window: ``lines`` (numbers), ``hashes`` of the lines with a word, ``spans`` (at, first, n)."""
    text = F.col(text_col).cast("string")
    row = let(_units(text), lambda units: let(
        F.struct(units["line"].alias("lines"), units["hash"].alias("hashes"), units["words"].alias("words")),
        lambda u: F.struct(u["lines"].alias("lines"), u["hashes"].alias("hashes"),
                           _selected(u, run_words).alias("spans"))))
    return (docs.where(F.col(text_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), row.alias("u"))
            .select("id", "text_hash", "u.*").where(F.size("spans") > 0))


def matched_positions(table: DataFrame) -> DataFrame:
    """``id``, ``text_hash``, ``matched``: a document's selected places whose line is selected at another place too."""
    selected = F.array_distinct(F.transform("spans", lambda w: w["at"]))
    places = (table.select("id", "text_hash", "hashes", F.explode(selected).alias("at"))
              .select("id", "text_hash", "at", F.get("hashes", F.col("at")).alias("fingerprint")))
    place = F.struct("id", "text_hash", "at")
    repeated = (places.groupBy("fingerprint")
                .agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("n"))
                .where(~F.col("low").eqNullSafe(F.col("high"))).select("fingerprint", "n"))
    found = attach_totals(places, written(repeated, "line_fingerprints"), "fingerprint", "n")
    return found.groupBy("id", "text_hash").agg(F.collect_set("at").alias("matched"))  # places of one document


def extended(table: DataFrame, matched: DataFrame) -> DataFrame:
    """The windows that selected a matched position: ``id``, ``text_hash``, ``first``, ``identity`` (of their
    line sequence), ``lines``."""
    t, m = table.alias("t"), matched.alias("m")
    same = F.col("t.id").eqNullSafe(F.col("m.id")) & (F.col("t.text_hash") == F.col("m.text_hash"))
    spans = F.filter("spans", lambda w: F.array_contains("matched", w["at"]))
    return (t.join(m, same).select("t.id", "t.text_hash", "lines", "hashes", F.explode(spans).alias("w"))
            .select("id", "text_hash", F.col("w.first").alias("first"),
                    F.xxhash64(F.slice("hashes", F.col("w.first") + 1, F.col("w.n")), "w.n").alias("identity"),
                    F.slice("lines", F.col("w.first") + 1, F.col("w.n")).alias("lines")))


def repeated_lines(docs: DataFrame, run_words: int = RUN_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id``, ``text_hash``, ``line`` (number from 0) of every line to delete."""
    table = written(line_table(docs, run_words, id_col, text_col), "lines", codec="lz4")
    near = written(extended(table, matched_positions(table)), "line_windows", codec="lz4")
    start = F.struct("id", "text_hash", "first")
    sources = (near.groupBy("identity")
               .agg(F.min(start).alias("source"), F.max(start).alias("end"), F.count(F.lit(1)).alias("n"))
               .where(~F.col("source").eqNullSafe(F.col("end"))).select("identity", "source", "n"))
    return (attach_totals(near, written(sources, "line_sources"), "identity", "n")
            .where(~start.eqNullSafe(F.col("source")))
            .select("id", "text_hash", F.explode("lines").alias("line")).distinct())


def dedup_lines(docs: DataFrame, run_words: int = RUN_WORDS, id_col: str = "doc_id",
                text_col: str = "text", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with later repeated runs deleted from the text.

    ``counts`` names two further columns: the lines of the text before, and
    the lines deleted.
    """
    deleted = written(repeated_lines(docs, run_words, id_col, text_col), "deleted_lines")
    small = deleted.count() <= BROADCAST_ROWS
    per_doc = deleted.groupBy("id", "text_hash").agg(F.collect_set("line").alias("gone"))
    joined = docs.alias("d").join(
        (F.broadcast(per_doc) if small else per_doc).alias("x"),
        F.col(f"d.`{id_col}`").eqNullSafe(F.col("x.id"))
        & (F.xxhash64(F.col(f"d.`{text_col}`").cast("string")) == F.col("x.text_hash"))
        & F.col(f"d.`{text_col}`").isNotNull(), "left")
    whole, gone = F.col(f"d.`{text_col}`").cast("string"), F.col("x.gone")

    def rebuilt(lines: Column) -> Column:
        kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    shorter = F.when(gone.isNull(), whole).otherwise(let(F.split(whole, "\n"), rebuilt))
    out = [shorter.alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns]
    if counts:
        n = F.when(whole.isNull(), 0).otherwise(F.regexp_count(whole, F.lit("\n")) + 1)
        out += [n.cast("bigint").alias(counts[0]),
                F.coalesce(F.size(gone), F.lit(0)).cast("bigint").alias(counts[1])]
    return joined.select(*out)
