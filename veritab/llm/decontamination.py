"""Benchmark decontamination by winnowing (operator 4), DataFrame functions only.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words is
one window.  A document word inside any occurrence of a window is hit.

1. Fingerprint: of every ``WINDOW - GRAM + 1`` consecutive word-grams the
   smallest hash is kept, in documents and items alike.  Any shared span of
   ``WINDOW`` words contains the same minimum on both sides, so joining the
   fingerprints finds every document that shares a window.  Items shorter than
   a window have no full span to choose from: for each such length that
   occurs, the word-grams of that length are kept whole.
2. Extend: the documents found are read again; their windows are compared as
   text with the items' windows, which extends a hit to every shared window.
3. The hit words are the union of the matching spans.

The join of fingerprints moves 64-bit hashes; the items' side is broadcast
only if it was counted to be small, and shuffled else.

Defined results: null or empty text has no words; a null item id counts as an
empty string; items of equal id are one item; rows of equal id and text get
equal results; without items nothing is hit; a text of any length is read whole;
an empty table of documents gives no rows; other columns are not read, and pass
through ``drop_contaminated`` under any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritab.llm.common import let, written

#: consecutive words of a window, and words of a fingerprinted gram
WINDOW, GRAM = 10, 5
#: everything but lower-case letters, digits and characters beyond ASCII separates words
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: rows of at most 32 bytes that may be broadcast; more are shuffled
BROADCAST_ROWS = 500_000
#: bytes of text that may be broadcast
BROADCAST_BYTES = 32 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def gram_hashes(hashes: Column, n: int) -> Column:
    """Hash of every ``n`` consecutive word hashes (a bound array)."""
    starts = F.sequence(F.lit(0), F.size(hashes) - n)
    return F.when(F.size(hashes) >= n, F.transform(
        starts, lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(n)]))).otherwise(_no_hashes())


def minima(hashes: Column, width: int) -> Column:
    """Smallest of every ``width`` consecutive gram hashes of a bound array."""
    def of(grams: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(grams) - width + 1)
        return F.when(F.size(grams) >= width, F.transform(
            starts, lambda i: F.array_min(F.slice(grams, i, F.lit(width))))).otherwise(_no_hashes())

    return let(gram_hashes(hashes, GRAM), of)


def fingerprints(hashes: Column, short: list[int]) -> Column:
    """Distinct fingerprints of a bound array of word hashes."""
    kept = [minima(hashes, WINDOW - GRAM + 1)] + [gram_hashes(hashes, n) for n in short]
    return F.array_distinct(F.concat(*kept) if len(kept) > 1 else kept[0])


def _no_hashes() -> Column:
    return F.array().cast("array<bigint>")


def _hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _windows(words: Column, lengths: list[int]) -> Column:
    """(start, length, text) of every run of one of ``lengths`` words."""
    def runs(words: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - n)
        return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.struct(
            i.alias("start"), F.lit(n).alias("length"),
            F.array_join(F.slice(words, i + 1, F.lit(n)), " ").alias("words")))).otherwise(
            F.array().cast("array<struct<start:int,length:int,words:string>>"))

    return let(words, lambda bound: reduce(F.concat, [runs(bound, n) for n in lengths]))


def _bounded(df: DataFrame, text: str | None = None) -> DataFrame:
    """A written table, marked for broadcast if its rows (and the bytes of a text column) are few."""
    size = df.agg(F.count(F.lit(1)).alias("rows"),
                  (F.sum(F.octet_length(text)) if text else F.lit(0)).alias("bytes")).first()
    return F.broadcast(df) if size["rows"] <= BROADCAST_ROWS and (size["bytes"] or 0) <= BROADCAST_BYTES else df


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_words``, ``n_hit``, ``items`` (sorted ids
    as strings) of every row of ``docs``."""
    item_words = written(items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text_col)).alias("words"))
        .where(F.size("words") > 0), "items")
    short = sorted(r[0] for r in item_words.where(F.size("words") < WINDOW)
                   .select(F.size("words")).distinct().collect())  # at most WINDOW - 1 lengths
    lengths = [WINDOW, *short]

    wanted = _bounded(written(
        item_words.select(F.explode(let(_hashes_of(F.col("words")), lambda hashes: F.when(
            F.size(hashes) >= WINDOW, fingerprints(hashes, [])).otherwise(_whole(hashes, short)))).alias("fingerprint"))
        .distinct(), "item_prints"))
    item_windows = written(
        item_words.select("item", F.explode(_windows(F.col("words"), lengths)).alias("w"), F.size("words").alias("n"))
        .where(F.col("w.length") == F.least(F.col("n"), F.lit(WINDOW)))
        .select("item", F.col("w.words").alias("words")).distinct(), "item_windows")

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    text_hash = F.xxhash64(F.coalesce(F.col("_text").cast("string"), F.lit("")))
    summary = let(_hashes_of(words_of(F.col("_text"))), lambda hashes: F.struct(
        F.size(hashes).cast("bigint").alias("n_words"), fingerprints(hashes, short).alias("prints")))
    base = written(rows.select("doc_id", text_hash.alias("text_hash"), summary.alias("s"))
                   .select("doc_id", "text_hash", "s.n_words", "s.prints"), "doc_prints", codec="lz4")

    found = _bounded(written(
        base.select("doc_id", "text_hash", F.explode("prints").alias("fingerprint"))
        .join(wanted, "fingerprint").select("doc_id", "text_hash").distinct(), "candidates"))
    again = rows.withColumn("text_hash", text_hash).alias("d").join(
        found.alias("f"), F.col("d.doc_id").eqNullSafe(F.col("f.doc_id"))
        & (F.col("d.text_hash") == F.col("f.text_hash"))).select("d.doc_id", "d.text_hash", "_text")
    spans = (again.select("doc_id", "text_hash", F.explode(_windows(words_of(F.col("_text")), lengths)).alias("w"))
             .select("doc_id", "text_hash", "w.start", "w.length", "w.words"))
    known = item_windows.select("words").distinct()
    hits = written(spans.join(_bounded(known, "words"), "words").distinct(), "hits")

    row = Window.partitionBy("doc_id", "text_hash").orderBy("start", "length")
    end = F.col("start") + F.col("length")
    reached = F.coalesce(F.max(end).over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = (hits.select("doc_id", "text_hash", F.greatest(F.lit(0), end - F.greatest(reached, "start")).alias("new"))
               .groupBy("doc_id", "text_hash").agg(F.sum("new").cast("bigint").alias("n_hit")))
    named = (hits.select("doc_id", "text_hash", "words").distinct().join(item_windows, "words")
             .select("doc_id", "text_hash", "item").distinct()
             .groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list("item")).alias("items")))
    marks = written(covered.alias("c").join(named.alias("n"), F.col("c.doc_id").eqNullSafe(F.col("n.doc_id"))
                                            & (F.col("c.text_hash") == F.col("n.text_hash")))
                    .select("c.doc_id", "c.text_hash", "n_hit", "items"), "marks")
    return base.alias("b").join(marks.alias("m"), F.col("b.doc_id").eqNullSafe(F.col("m.doc_id"))
                                & (F.col("b.text_hash") == F.col("m.text_hash")), "left").select(
        "b.doc_id", "b.text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _whole(hashes: Column, short: list[int]) -> Column:
    """The one gram of an item of fewer words than a window."""
    none = F.array().cast("array<bigint>")
    return reduce(lambda rest, n: F.when(F.size(hashes) == n, gram_hashes(hashes, n)).otherwise(rest), short, none)


def report(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """One digest row per document."""
    found = contamination(docs, items, **columns)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **columns: str) -> DataFrame:
    """The rows of ``docs`` without a hit word, with all their columns."""
    hit = written(contamination(docs, items, id_col, text_col, **columns).where(F.col("n_hit") > 0)
                  .select("doc_id", "text_hash").distinct(), "contaminated")
    hashed = F.xxhash64(F.coalesce(F.col(f"d.`{text_col}`").cast("string"), F.lit("")))
    return docs.alias("d").join(_bounded(hit).alias("x"), F.col(f"d.`{id_col}`").eqNullSafe(F.col("x.doc_id"))
                                & (hashed == F.col("x.text_hash")), "left_anti")
