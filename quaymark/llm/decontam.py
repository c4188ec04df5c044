"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: After lower-casing A-Z only: digits, a-z and everything beyond ASCII.
TOKEN = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; ``lower`` does just that where all is ASCII, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TOKEN), F.lit(0))


def _shingles(words: Column, n: Column, size: int) -> Column:
    """Hashes of the ``size`` words from each position on; empty if there are fewer."""
    made = F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(n >= size, made).otherwise(F.array().cast("array<bigint>"))


def windows(items: DataFrame, width: int = 13, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(win array, items array)``: each different window with the items that have it."""
    w = items.select(F.col(item_col).alias("item"), tokens(F.col(text_col)).alias("words")).where("size(words) > 0")
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - width, F.lit(0)) + 1)
    return (
        w.select("item", F.explode(F.transform(starts, lambda s: F.slice("words", s, width))).alias("win"))
        .groupBy("win").agg(F.collect_set("item").alias("items"))
    )


def prefixes(wins: DataFrame, shingle: int = 5) -> DataFrame:
    """Each window under its rarest shingle: ``(size, h, at, win, items)``.

    A document that holds a window holds all of the window's shingles, so that the prefix
    that an exact-containment join needs is one shingle long: the rarest in the order by
    frequency among windows (ties by hash). ``at`` is its place in the window, which bounds
    where the window can start in a document.
    """
    n = F.size("win")
    size = F.least(n, F.lit(shingle))
    listed = wins.select(F.lit(0).alias("size"), "win", "items", F.lit(0).alias("at"), F.lit(0).cast("long").alias("h")).limit(0)
    for k in [r[0] for r in wins.select(size).distinct().collect()]:  # at most ``shingle`` sizes
        part = wins.where(size == k).select(
            F.lit(k).alias("size"), "win", "items", F.posexplode(_shingles(F.col("win"), n, k)).alias("at", "h"))
        listed = listed.unionByName(part)
    often = listed.groupBy("size", "h").agg(F.count("*").alias("often"))
    best = listed.join(often, ["size", "h"]).groupBy("win").agg(
        F.min(F.struct("often", "h", "at", "size", "items")).alias("b"))
    return best.select("b.size", "b.h", "b.at", "win", "b.items")


def matches(docs: DataFrame, probes: DataFrame, broadcast_rows: int = 200_000) -> DataFrame:
    """``(doc_id, th, n_words, start, stop, items)``: a row for each row of docs(doc_id, th, text), its last three
    columns null, and one for each occurrence of a window.

    Candidates come from the prefix shingles; length and place bound the start; then all
    words of the window are compared. The window table is broadcast up to ``broadcast_rows``
    rows (of at most a window's words each); a larger one is joined by shuffling, and its
    candidates meet their documents by key. With the broadcast a text is cut into words once: the
    shingles of all sizes are in one array, whose last element meets a row without a window, so
    that each document leaves the join with its number of words.
    """
    sizes = sorted(r["size"] for r in probes.groupBy("size").agg(F.count("*").alias("n")).collect())
    small = probes.limit(broadcast_rows + 1).count() <= broadcast_rows
    worded = docs.select("doc_id", "th", tokens(F.col("text")).alias("words"))
    n = F.size("words")
    start = F.col("pos") - F.col("at")
    inside = (start >= 0) & (start + F.size("win") <= n)
    same = F.slice("words", F.when(inside, start + 1).otherwise(F.lit(1)), F.size("win")) == F.col("win")
    hit = ["doc_id", "th", n.cast("long").alias("n_words"), start.alias("start"), (start + F.size("win")).alias("stop"), "items"]
    # the outer form of explode: for the inner one the optimizer derives a filter on the
    # size of the array, and computes the array, words and all, a second time for it
    if small:
        # a hash that two sizes share costs a comparison and no more, as all words are compared
        probe = probes.drop("size").unionByName(
            probes.sparkSession.range(1).select(F.lit(0).cast("long").alias("h")), allowMissingColumns=True)
        hs = F.concat(*[_shingles(F.col("words"), n, k) for k in sizes], F.array(F.lit(0).cast("long")))
        cand = worded.select("doc_id", "th", "words", hs.alias("hs")).select(
            "doc_id", "th", "words", F.posexplode_outer("hs").alias("i", "h")).join(F.broadcast(probe), "h")
        pos, before = F.col("i"), F.lit(0)
        for k in sizes:  # the places of a size follow those of the sizes before
            pos = F.when(F.col("i") >= before, F.col("i") - before).otherwise(pos)
            before = before + F.greatest(n - k + 1, F.lit(0))
        last = F.col("i") == before
        cand = cand.withColumn("pos", pos)
        return cand.where(F.when(F.col("win").isNull(), last).otherwise(~last & inside & same)).select(*hit)
    found = worded.select("doc_id", "th", n.cast("long").alias("n_words"), F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("int").alias("stop"), F.lit(None).cast(probes.schema["items"].dataType).alias("items"))
    for k in sizes:
        hashed = worded.select("doc_id", "th", _shingles(F.col("words"), n, k).alias("hs"))
        keys = hashed.select("doc_id", "th", F.posexplode_outer("hs").alias("pos", "h")).join(
            probes.where(F.col("size") == k).drop("size"), "h").drop("h")
        cand = keys.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t").join(
            worded, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th")))
        found = found.unionByName(cand.where(inside & same).select(*hit))
    return found


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", width: int = 13, shingle: int = 5, share: int = 20, broadcast_rows: int = 200_000,
) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``.

    A word is hit if it lies inside any occurrence of a window of ``width`` item words (items
    with fewer are one window); a document is contaminated if at least one in ``share`` of its
    words is hit. Null or empty texts have no words and are clean; items without words match
    nothing; repeated rows each get their row; a null doc_id is a document of its own; items
    with a null id hit words but are not listed. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    probes = written(prefixes(written(windows(items, width, item_col, item_text_col), "windows"), shingle), "prefixes")
    found = matches(rows, probes, broadcast_rows)
    reach = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0).cast("long"), s["stop"] - F.greatest(a["to"], s["start"].cast("long")))).alias("n"),
            F.greatest(a["to"], s["stop"].cast("long")).alias("to")))
    # equal texts with one doc_id (or none) are one group until each has its row again
    grouped = found.groupBy("doc_id", "th", "n_words").agg(
        F.count(F.when(F.col("start").isNull(), 1)).alias("copies"),
        F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "stop"))).alias("spans"), F.collect_set("items").alias("items"),
    ).select("doc_id", "n_words", "copies", reach["n"].alias("n_hit"),
             F.array_sort(F.transform(F.array_distinct(F.flatten("items")), lambda x: x.cast("string"))).alias("ids"))
    n_hit, ids = F.col("n_hit"), F.col("ids")
    made = grouped.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * share >= F.col("n_words"))).alias("contaminated"), "copies")
    return made.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies", "copy")
