"""Benchmark decontamination with built-in functions only.

The items of a benchmark become windows of ``width`` words (a shorter item is one window). A window of
m words holds, wherever it lies in a document, a whole block of b = (m + 1) // 2 words that begins at a
multiple of b. So a document is scanned block by block: one hash for each block, looked up in the
broadcast set of the benchmark's b-word runs. Only around the blocks found are windows formed, and they
are verified word for word against the benchmark's windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgauge.llm.common import row_id

BROADCAST_WINDOWS = 500_000
"""Up to so many benchmark windows (about 150 bytes each) are broadcast; more are joined by shuffle."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normal_words(text: Column) -> Column:
    """A-Z in lower case, then runs of ASCII letters, digits and all other non-ASCII characters."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))
    plain = F.trim(F.regexp_replace(low, _GAP, " "))
    none = F.array().cast("array<string>")
    return let(plain, lambda p: F.when(F.length(p) > 0, F.split(p, " ")).otherwise(none))


def benchmark_windows(benchmark: DataFrame, width: int) -> DataFrame:
    """(m, window, items): the distinct windows, their words joined by spaces, and their items."""
    items = benchmark.select(F.col("item_id"), normal_words(F.col("text")).alias("w"))
    # one window of the whole item where it is short
    m = F.least(F.size("w"), F.lit(width))
    made = items.where(F.size("w") > 0).select(
        "item_id", m.alias("m"),
        F.explode(let(F.col("w"), lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w) - F.least(F.size(w), F.lit(width)) + 1),
            lambda s: F.array_join(F.slice(w, s, F.least(F.size(w), F.lit(width))), " "),
        ))).alias("window"),
    )
    return made.groupBy("m", "window").agg(F.collect_set("item_id").alias("items"))


def _judged(docs: DataFrame, benchmark: DataFrame, width: int) -> DataFrame:
    """A row for each distinct (``_id``, ``_tag``), the id and the hash of the text: ``doc_id``, ``copies``
    (rows of this kind), ``n_words``, ``items`` and ``spans`` (NULL without hits)."""
    windows = benchmark_windows(benchmark, width)
    sizes = {r["m"]: r["n"] for r in windows.groupBy("m").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= width rows
    sent = F.broadcast if sum(sizes.values()) <= BROADCAST_WINDOWS else (lambda df: df)
    rows = docs.select("doc_id", row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.col("text").cast("string").alias("text"))
    mark = "struct<m:int,p:int,h:bigint>"

    def hashed(w: Column, m: int) -> Column:
        b = (m + 1) // 2
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - b + 1, F.lit(1)), F.lit(b))
        return F.transform(starts, lambda s: F.struct(F.lit(m), s, F.xxhash64(F.slice(w, s, b))).cast(mark))

    def marks(w: Column) -> Column:
        runs = [F.array(F.struct(F.lit(0), F.lit(0), F.size(w).cast("long")).cast(mark))]
        for m in sizes:
            runs.append(F.when(F.size(w) >= m, hashed(w, m)).otherwise(F.array().cast(f"array<{mark}>")))
        return F.concat(*runs)

    scanned = rows.select("doc_id", "_id", "_tag", F.inline(let(normal_words(F.coalesce("text", F.lit(""))), marks)))
    known = windows.select("m", F.expr(
        "explode(transform(sequence(1, m - int((m + 1) / 2) + 1),"
        " s -> xxhash64(slice(split(window, ' '), s, int((m + 1) / 2)))))"
    ).alias("h")).distinct().withColumn("found", F.lit(True))
    near = scanned.join(sent(known), ["m", "h"], "left").where("p = 0 or found")
    seen = near.groupBy("doc_id", "_id", "_tag").agg(
        F.max(F.when(F.col("p") == 0, F.col("h"))).alias("n_words"),
        F.count(F.when(F.col("p") == 0, True)).alias("copies"),
        F.collect_set(F.when(F.col("p") > 0, F.struct("m", "p"))).alias("blocks"),
    )

    def around(w: Column, k: Column) -> Column:
        b = F.floor((k["m"] + 1) / 2).cast("int")
        low, high = F.greatest(F.lit(1), k["p"] - b + 1), F.least(k["p"], F.size(w) - k["m"] + 1)
        made = F.transform(F.sequence(F.least(low, high), high), lambda s: F.struct(
            k["m"].alias("m"), s.alias("s"), F.array_join(F.slice(w, s, k["m"]), " ").alias("window")
        ))
        return F.when(high >= low, made).otherwise(F.array().cast("array<struct<m:int,s:int,window:string>>"))

    near_docs = seen.where(F.size("blocks") > 0).select("_id", "_tag", "blocks")
    tried = rows.join(near_docs, ["_id", "_tag"]).select("_id", "_tag", F.inline(
        let(normal_words(F.col("text")), lambda w: F.flatten(F.transform("blocks", lambda k: around(w, k))))
    ))
    merged = F.expr(
        "aggregate(array_sort(spans), cast(array() as array<struct<first:int,last:int>>), (done, x) ->"
        " if(size(done) > 0 and element_at(done, -1).last >= x.first - 1,"
        "  concat(slice(done, 1, size(done) - 1), array(named_struct('first', element_at(done, -1).first,"
        "   'last', greatest(element_at(done, -1).last, x.last)))),"
        "  concat(done, array(x))))"
    )
    marked = tried.join(sent(windows), ["m", "window"]).groupBy("_id", "_tag").agg(
        F.collect_set(F.struct(F.col("s").alias("first"), (F.col("s") + F.col("m") - 1).alias("last"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    return seen.drop("blocks").join(marked.select("_id", "_tag", "items", merged.alias("spans")), ["_id", "_tag"], "left")


def hits(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids of the items with a
    window in the text), ``spans`` (hit words as merged ranges: first, last, counted from 1).

    Only ``doc_id`` and ``text`` of ``docs`` and ``item_id`` and ``text`` of ``benchmark`` are read, so
    other columns cannot clash. NULL or empty text, or no words: 0 words, no hits. NULL id: the row is
    judged like any other. Rows of one id are judged by their own texts, equal rows alike. An item
    without an id marks words but is not listed; an item without words is no item. Empty tables: no
    rows, or no hits. Texts of any length are scanned whole.
    """
    judged = _judged(docs, benchmark, width)
    total = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return judged.select(
        "doc_id", "n_words", F.coalesce(total, F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast(judged.schema["items"].dataType)).alias("items"),
        F.coalesce("spans", F.array().cast(judged.schema["spans"].dataType)).alias("spans"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")


def clean(docs: DataFrame, benchmark: DataFrame, width: int = 10, spans: bool = False) -> DataFrame:
    """``docs`` with all its columns, without what the benchmark holds: rows with a hit go, or with
    ``spans`` only their hit words, each with the gap before it, while the text after the last word
    goes too. Rows without hits stay as they are, NULL and empty texts among them."""
    bad = _judged(docs, benchmark, width).where("spans is not null").select("_id", "_tag", F.col("spans").alias("_spans"))
    keyed = docs.select(row_id().alias("_id"), F.xxhash64("text").alias("_tag"), F.struct("*").alias("_row"))
    if not spans:
        return keyed.join(bad, ["_id", "_tag"], "left_anti").select("_row.*")
    joined = keyed.join(bad, ["_id", "_tag"], "left")
    pieces = F.regexp_extract_all(F.col("_row.text"), F.lit(_PIECE), F.lit(0))
    kept = F.filter(pieces, lambda piece, i: ~F.exists("_spans", lambda x: (x["first"] <= i + 1) & (i + 1 <= x["last"])))
    text = F.when(F.col("_spans").isNull(), F.col("_row.text")).otherwise(F.array_join(kept, ""))
    return joined.select(*[(text if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
