"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` words (the whole item if it is shorter). A window
can only occur in a document that has every one of its shingles, so one shingle is a sufficient
prefix: the rarest in the corpus. Places are joined to windows on that shingle alone; where it
stands in the window says where the window must start (positional bound), the window must end
inside the document (length bound), and what is left is compared word by word.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.columns import lower_ascii, written

# Words are lowered after they are cut, so here capitals are no breaks.
_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# So many shingle keys (8 bytes each) go to the executors at once; more take further passes.
KEYS_PER_PASS = 2_000_000


def words(text: str | Column) -> Column:
    """Runs of letters, digits and non-ASCII characters, as written; none for NULL."""
    found = F.array_remove(F.split(text, _BREAKS), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def _lowered(array: Column) -> Column:
    return F.transform(array, lower_ascii)


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows with the ids of the items they come from; items without words have none."""
    w = items.select(F.col("item_id").cast("string").alias("item_id"), _lowered(words("text")).alias("w"))
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("w") - size)
    return (
        w.filter(F.size("w") > 0)
        .select("item_id", "w", size.alias("size"), F.explode(starts).alias("start"))
        .select("item_id", F.slice("w", F.col("start") + 1, F.col("size")).alias("window_words"))
        .groupBy("window_words").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
        .withColumn("window_id", F.xxhash64("window_words"))
    )


def _hashes(array: Column) -> Column:
    """A hash per word. All letters are lowered first: more words may agree, none less."""
    return F.transform(array, lambda w: F.xxhash64(F.lower(w)))


def _key(hashes: Column, at: Column, length: int) -> Column:
    return F.xxhash64(F.lit(length), *[F.get(hashes, at + i) for i in range(length)])


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """Every shingle of every window: (window_id, window_words, key, offset)."""
    parts = []
    size = F.size("window_words")
    for length in range(1, shingle + 1):
        parts.append(
            windows.filter((size == length) if length < shingle else (size >= length))
            .select("*", _hashes(F.col("window_words")).alias("h"),
                    F.explode(F.sequence(F.lit(0), size - length)).alias("offset"))
            .select("window_id", "window_words", _key(F.col("h"), F.col("offset"), length).alias("key"), "offset"))
    return reduce(DataFrame.unionByName, parts)


def _matches(docs: DataFrame, keys: DataFrame, lengths: list[int], window: int, shingle: int, ids: bool) -> DataFrame:
    """One pass over the texts: places where a shingle of ``keys`` starts, with the words around.

    With ``ids`` there is also a row per document (``key`` NULL), so that nothing is read twice.
    """
    w = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), words("text").alias("w"))
    at = w.select("*", _hashes(F.col("w")).alias("h")).select("*", F.posexplode_outer("h").alias("at", "one"))
    each = [F.when(F.col("at") + n <= F.size("w"), _key(F.col("h"), F.col("at"), n)) for n in lengths]
    spread = at.withColumn("key", each[0] if len(each) == 1 else F.explode(F.array(*each)))
    first = (F.coalesce("at", F.lit(0)) == 0) if ids else F.lit(False)
    found = spread.join(F.broadcast(keys.withColumn("known", F.lit(True))), "key", "left")
    begin = F.greatest(F.col("at") - (window - 1), F.lit(0))
    return found.filter(F.col("known") | first).select(
        "doc_id", "row", F.size("w").alias("n"), "at", F.when(F.col("known"), F.col("key")).alias("key"),
        begin.alias("begin"),
        F.when(F.col("known"), F.slice("w", begin + 1, F.col("at") - begin + window)).alias("around"))


def occurrences(
    docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 5, keys_per_pass: int = KEYS_PER_PASS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (doc_id, row, n), windows in them (row, window_id, start, size), and the windows.

    A shingle has ``shingle`` words; a shorter item is one shingle. The keys of all shingles are
    sent to the executors, ``keys_per_pass`` at a time, and the texts are read once for each
    such part: usually once. What agrees is short, and counted for rarity, joined and compared
    from a table.
    """
    windows = written(item_windows(items, window), "windows")
    pieces = window_shingles(windows, shingle)
    sizes = F.least(F.size("window_words"), F.lit(shingle))
    lengths = sorted(windows.agg(F.collect_set(sizes).alias("s")).first().s) or [shingle]
    keys = pieces.select("key").distinct()
    passes = -(-keys.count() // keys_per_pass) or 1
    parts = [keys.filter(F.pmod("key", F.lit(passes)) == i) if passes > 1 else keys for i in range(passes)]
    found = written(reduce(DataFrame.unionByName, [
        _matches(docs, part, lengths, window, shingle, ids=i == 0) for i, part in enumerate(parts)]), "matches")
    matched = found.filter(F.col("key").isNotNull()).drop("doc_id")
    frequency = matched.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))
    # A window with a shingle the corpus lacks cannot occur and goes here.
    rarest = (
        pieces.join(frequency, "key", "left")
        .groupBy("window_id").agg(
            F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "key", "offset")).alias("p"),
            F.first("window_words").alias("window_words"))
        .filter(F.col("p.rows") > 0)
        .select("window_id", "window_words", F.col("p.key").alias("key"), F.col("p.offset").alias("offset")))
    start, size = F.col("at") - F.col("offset"), F.size("window_words")
    spans = (
        matched.join(rarest, "key").filter((start >= 0) & (start + size <= F.col("n")))
        .filter(_lowered(F.slice("around", start - F.col("begin") + 1, size)) == F.col("window_words"))
        .select("row", "window_id", start.alias("start"), size.alias("size")).distinct())
    # A one-word shingle row and a longer one may both stand for the document.
    rows = found.filter(F.coalesce("at", F.lit(0)) == 0).select("doc_id", "row", "n").distinct()
    return rows, spans, windows


def _covered(spans: Column) -> Column:
    """Words inside the union of spans (start, size), sorted by start."""
    end = lambda s: s["start"] + s["size"]
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach")),
        lambda acc, s: F.struct(
            (acc["total"] + F.greatest(end(s) - F.greatest(acc["reach"], s["start"]), F.lit(0))).alias("total"),
            F.greatest(acc["reach"], end(s)).alias("reach")),
        lambda acc: acc["total"])


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 13, shingle: int = 5, share: int = 20,
    keys_per_pass: int = KEYS_PER_PASS,
) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, item_ids.

    A word is hit if it lies in any occurrence of a window; a document is contaminated if a word
    is hit and ``share`` times the hit words are at least its words. NULL and empty texts have no
    words and are clean; an item without an id hits words but is not counted. Each row counts
    for itself, repeated ids and texts too.
    """
    rows, spans, windows = occurrences(docs, items, window, shingle, keys_per_pass)
    spans = written(spans, "spans")
    hits = spans.groupBy("row").agg(
        _covered(F.sort_array(F.collect_set(F.struct("start", "size")))).alias("n_hit"))
    named = (
        spans.select("row", "window_id").distinct()
        .join(windows.select("window_id", F.explode("item_ids").alias("item")), "window_id")
        .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_ids")))
    out = rows.join(hits.join(named, "row", "left"), "row", "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        ((hit > 0) & (share * hit >= F.col("n"))).alias("contaminated"), ids.alias("item_ids"))


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, all columns as they came.

    Judged by text, so that rows need no id: equal texts have equal results.
    """
    keyed = docs.select(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("doc_id"), "text")
    bad = contamination(keyed, items).filter("contaminated").select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.md5(F.coalesce("text", F.lit("")).cast("binary")) == F.col("_bad"), "left_anti")
