"""Benchmark decontamination by winnowing, in DataFrame operations only.

Both sides keep, for every window of `WINDOW` words, the smallest hash of its `K`-word grams. A span of
`WINDOW` words that a text shares with an item gives the same smallest hash, so joining documents and
items on it misses no such span. Each joined window is then compared word by word, and the hits extend
over all windows that match.

Up to `most_windows` windows of items are broadcast: the join, the comparison and the document's word count then
need one pass over the texts, in which every document carries one extra fingerprint that always joins. Beyond it
both sides shuffle by fingerprint, and a document sends each smallest gram once for a run of windows that share
it, with its place and the document's id and hash, not its words. The windows that the joined grams point at go
back to their documents, where they are compared: to all by a broadcast of at most `most_windows` of them, else
by a join on the ids. Both ways give the same rows.

Null and empty texts have no words; items without words match nothing; texts of any length are compared whole; of
equal smallest hashes in a window the first counts; repeated documents give repeated rows, repeated items count
once per item_id (a null item_id matches words but is not listed); empty tables give no rows or no hits; other
columns, whatever their names, are ignored (`find_hits`) or passed through (`remove_hits`).
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termtide.llm.common import cut

WINDOW, K = 10, 5
MOST_IDS = 1_000_000
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered; other letters stay as they are."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.array_remove(F.split(low, PARTS), "")


def _positions(n: Column, span: int) -> Column:
    return F.when(n >= span, F.sequence(F.lit(0), n - span)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, n: Column, k: int) -> Column:
    return F.transform(_positions(n, k), lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k))))


def fingerprints(n: Column, hashes: Column, grams: Column, span: int) -> Column:
    """The fingerprint of every window of `span` words: the smallest hash of its K-grams, or its own hash if shorter."""
    if span <= K:
        return grams if span == K else _grams(hashes, n, span)
    return F.transform(_positions(n, span), lambda i: F.least(*(F.get(grams, i + j) for j in range(span - K + 1))))


def _windows(df: DataFrame, spans: list[int]) -> DataFrame:
    """df (with `words`) with a row for each window: span, at, fp; and one of span 0 that marks the text itself."""
    n = F.col("n_words")
    df = df.withColumn("n_words", F.size("words")).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("grams", _grams(F.col("hashes"), n, K))
    each = [F.struct(F.lit(0).alias("span"), F.array(F.lit(0).cast("long")).alias("fps"))]
    each += [F.struct(F.lit(s).alias("span"), fingerprints(n, F.col("hashes"), F.col("grams"), s).alias("fps")) for s in spans]
    df = df.withColumn("each", F.array(*each)).drop("hashes", "grams")
    df = df.select("*", F.explode_outer("each").alias("one")).drop("each")  # outer: no filter on `each` is pushed below its parts
    return df.select("*", F.posexplode("one.fps").alias("at", "fp")).withColumn("span", F.col("one.span")).drop("one")


def _text(words: Column, at: Column, span: Column) -> Column:
    return F.array_join(F.slice(words, at + 1, span), " ")


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(span, fp, window, item): the distinct windows of the items; an item shorter than a window is one."""
    items = items.select(F.col(id_col).alias("item"), words(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    own = F.least(F.size("words"), F.lit(WINDOW))
    return _windows(items, list(range(1, WINDOW + 1))).where((F.col("span") == own) & (F.col("span") > 0)).select(
        "span", "fp", _text(F.col("words"), F.col("at"), F.col("span")).alias("window"), "item").distinct()


def minima(n: Column, hashes: Column, grams: Column, span: int) -> Column:
    """(fp, at): the first smallest gram of every window of `span` words and where it starts, once for all windows that share it."""
    if span <= K:
        return F.transform(fingerprints(n, hashes, grams, span), lambda h, i: F.struct(h.alias("fp"), i.alias("at")))
    first = F.transform(_positions(n, span), lambda i: F.least(*(F.struct(F.get(grams, i + j).alias("fp"), (i + j).alias("at")) for j in range(span - K + 1)))["at"])
    return F.transform(F.array_distinct(first), lambda at: F.struct(F.get(grams, at).alias("fp"), at.alias("at")))


def _minima_rows(df: DataFrame, spans: list[int]) -> DataFrame:
    """df (with `words`) with a row for each smallest gram: span, fp, at; the words go."""
    n = F.size("words")
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("grams", _grams(F.col("hashes"), n, K))
    each = F.array(*(F.struct(F.lit(s).alias("span"), minima(n, F.col("hashes"), F.col("grams"), s).alias("found")) for s in spans))
    df = df.withColumn("each", each).drop("words", "hashes", "grams")
    df = df.select("*", F.explode_outer("each").alias("one")).drop("each")  # outer, as in `_windows`
    df = df.select("*", F.explode_outer("one.found").alias("gram")).select("*", F.col("one.span").alias("span"), "gram.fp", "gram.at").drop("one", "gram")
    return df.where("fp is not null")


def _figures(ids: list[Column], n_words: Column, places: Column, items: Column) -> list[Column]:
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(F.greatest(a["end"], p["to"]).alias("end"), (a["n"] + F.greatest(F.lit(0), p["to"] - F.greatest(a["end"], p["at"]))).alias("n")),
        lambda a: a["n"],
    )
    return [
        *ids, n_words.cast("long").alias("n_words"), covered.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (F.size(places) > 0).alias("contaminated"),
    ]


def _by_broadcast(texts: DataFrame, windows: DataFrame, spans: list[int]) -> DataFrame:
    """Figures of each text in one pass; the windows go to every task."""
    mark = texts.sparkSession.range(1).select(
        F.lit(0).alias("span"), F.lit(0).cast("long").alias("fp"), F.lit(None).cast("string").alias("window"), F.lit(None).cast(windows.schema["item"].dataType).alias("item"))
    known = F.broadcast(windows.unionByName(mark))
    rows = _windows(texts, spans)
    same = (rows["fp"] == known["fp"]) & (rows["span"] == known["span"]) & ((rows["span"] == 0) | (known["window"] == _text(rows["words"], rows["at"], rows["span"])))
    hits = rows.join(known, same).select("id", "mark", "n_words", rows["span"], "at", "item")
    place = F.when(F.col("span") > 0, F.struct("at", (F.col("at") + F.col("span")).alias("to")))
    found = hits.groupBy("id", "mark", "n_words").agg(
        F.count(F.when(F.col("span") == 0, 1)).alias("copies"), F.array_sort(F.collect_set(place)).alias("places"),
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"),
    )
    out = found.select(*_figures([F.col("id"), F.col("mark"), F.col("copies")], F.col("n_words"), F.col("places"), F.col("items")))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("_copy", "copies")


def _by_shuffle(texts: DataFrame, windows: DataFrame, spans: list[int], most_windows: int) -> DataFrame:
    """Figures of each text; fingerprints meet in a shuffle, and what they point at is compared where the texts are."""
    listed = windows.select("window", "item", F.split("window", " ").alias("words")).withColumn("size", F.size("words"))
    pointed = _minima_rows(listed, spans).where(F.col("span") == F.col("size")).select("span", "fp", F.col("at").alias("offset"), "window", "item")
    grams = _minima_rows(texts, spans)
    met = grams.join(pointed, ["span", "fp"]).select("id", "mark", F.struct((F.col("at") - F.col("offset")).alias("at"), "span", "window", "item").alias("near"))
    near = cut(met.groupBy("id", "mark").agg(F.collect_set("near").alias("near")))
    held = near.agg(F.coalesce(F.sum(F.size("near")), F.lit(0))).first()[0]
    near = (F.broadcast(near) if held <= most_windows else near).withColumnsRenamed({"id": "near_id", "mark": "near_mark"})
    joined = texts.join(near, F.col("id").eqNullSafe(F.col("near_id")) & (F.col("mark") == F.col("near_mark")), "left")
    true = F.filter(F.coalesce("near", F.array()), lambda w: (w["at"] >= 0) & (_text(F.col("words"), F.greatest(w["at"], F.lit(0)), w["span"]) == w["window"]))
    joined = joined.select("id", "mark", F.size("words").alias("n_words"), true.alias("true"))
    places = F.array_sort(F.transform("true", lambda w: F.struct(w["at"], (w["at"] + w["span"]).alias("to"))))
    items = F.array_sort(F.array_distinct(F.filter(F.transform("true", lambda w: w["item"].cast("string")), lambda i: i.isNotNull())))
    return joined.select(*_figures([F.col("id"), F.col("mark")], F.col("n_words"), places, items))


def _figures_of(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, most_windows: int) -> DataFrame:
    windows = item_windows(items, item_id_col, item_text_col)
    sizes = {r["span"]: r["count"] for r in windows.groupBy("span").count().collect()}
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("mark"), words(F.col(text_col)).alias("words"))
    if sum(sizes.values()) <= most_windows:
        return _by_broadcast(texts, windows, sorted(sizes))
    return _by_shuffle(texts, windows, sorted(sizes), most_windows)


def find_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", most_windows: int = 200_000,
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of each row."""
    return _figures_of(docs, items, id_col, text_col, item_id_col, item_text_col, most_windows).withColumnRenamed("id", id_col).drop("mark")


def remove_hits(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", most_windows: int = 200_000,
) -> DataFrame:
    """The rows of texts that share no window with an item, all columns."""
    found = _figures_of(docs, items, id_col, text_col, item_id_col, item_text_col, most_windows)
    bad = cut(found.where("contaminated").select(F.col("mark").alias("_mark")).distinct())
    bad = F.broadcast(bad) if bad.count() <= MOST_IDS else bad
    return docs.join(bad, F.xxhash64(text_col) == F.col("_mark"), "left_anti")
