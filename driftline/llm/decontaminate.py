"""Benchmark passages in documents, by what windows of an item's size share with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.bitmaps import bits_for, packed, position, with_maybe
from driftline.llm.common import GAP, identity, unused
from driftline.session import if_small, stored

SHINGLE = 5
SIMILARITY = 0.8


def _words(text: str) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), GAP), lambda w: w != "")


def _shingles(width: int) -> Column:
    """Hashes of each `width` consecutive `words`."""
    terms = ", ".join(["w"] + [f"words[i + {k}]" for k in range(1, width)])
    return F.expr(f"transform(slice(words, 1, greatest(size(words) - {width - 1}, 0)), (w, i) -> xxhash64({terms}))")


def benchmark_items(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Items with words: `item_id`, `words`, `length`, `width` of a shingle, `shingles`."""
    items = benchmark.select(F.col(item_col).alias("item_id"), _words(text_col).alias("words")).filter(F.size("words") > 0)
    items = items.withColumn("length", F.size("words")).withColumn("width", F.least(F.size("words"), F.lit(SHINGLE)))
    by_width = F.coalesce(*[F.when(F.col("width") == k, _shingles(k)) for k in range(1, SHINGLE + 1)])
    return items.withColumn("shingles", by_width)


def _telling(items: DataFrame, least: float) -> DataFrame:
    """`h` and `item_id`: of each item the rarest shingles, of which a similar window must hold one.

    A window of n shingles shares 2 * n * least / (1 + least) of them with the item, so it can lack the others only.
    A text shorter than the item is one window, and may lack more: least * n are shared at least.
    """
    each = items.select("item_id", F.explode("shingles").alias("h"))
    often = each.groupBy("h").agg(F.count(F.lit(1)).alias("often"))
    ranked = each.join(often, "h").groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct("often", "h"))).alias("ranked"))
    lacking = F.floor(F.size("ranked") * (1 - least) + F.lit(1e-9)).cast("int")
    return ranked.select("item_id", F.explode(F.slice("ranked", F.lit(1), lacking + 1)).alias("r")).select("item_id", F.col("r.h").alias("h")).distinct()


def _terms(items: DataFrame) -> DataFrame:
    """`item_id`, `h`: how often the item has the shingle (`often`), and where first (`first_at`)."""
    each = items.select("item_id", F.posexplode("shingles").alias("o", "h"))
    return each.groupBy("item_id", "h").agg(F.count(F.lit(1)).cast("int").alias("often"), F.min("o").alias("first_at"))


def find_passages(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, item_col: str = "item_id", item_text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """Texts that hold a passage like a benchmark item: `h1`, `h2`, `item_id`, `at_word`, `similarity`.

    `h1` and `h2` are the text's `identity`. A window of a document has the item's number of words (or is the whole of a
    shorter document); it matches if the weighted Jaccard similarity of the shingles of five words is `least` or
    more. Case is ignored. `at_word` and `similarity` are those of the best window: of equals, that with most shingles in
    line with their first place in the item, then the first.

    The documents' shingles that some item has are kept with their positions. An item is looked for in a
    document that has one of the item's rarest shingles, of which every similar window must hold one. There, what every window
    shares with the item is summed up exactly: a shingle at `at` that the item has `often` times counts in the windows that
    start after the `often`-th such shingle before it, and hold it. So each shingle adds one where these starts
    begin and takes it away where they end, and running sums over the starts give each window's similarity. The
    work grows with the shared shingles, however long items and documents are, and no similar window is passed over.

    The benchmark's shingles are broadcast where their size is known to be small, else joined by
    shuffle. Null texts count as empty; items without words match nothing, and items of fewer than five words
    have one shingle, all their words. Repeated texts are looked at as one.
    """
    items = stored(benchmark_items(benchmark, item_col, item_text_col).drop("words"), "items")
    widths = [r["width"] for r in items.select("width").distinct().collect()]
    h1, h2 = identity(text_col)
    given = docs.select(h1.alias("h1"), h2.alias("h2"), _words(text_col).alias("words"))
    hits = None
    for width in widths:
        held = if_small(stored(items.filter(F.col("width") == width).select(F.explode("shingles").alias("h")).distinct(), "shingles"))
        own = given.select("h1", "h2", F.size("words").alias("n_words"), F.posexplode(_shingles(width)).alias("at", "h")).join(held, "h")
        own = own.select("h1", "h2", "n_words", F.lit(width).alias("width"), "at", "h")
        hits = own if hits is None else hits.unionByName(own)
    if hits is None:
        empty = items.select("item_id", F.lit(0).alias("at_word"), F.lit(0.0).alias("similarity")).limit(0)
        return empty.select(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), "item_id", "at_word", "similarity")
    hits = stored(hits.distinct(), "hits")

    text, pair = ["h1", "h2"], ["h1", "h2", "item_id"]
    telling = if_small(stored(_telling(items, least), "telling"))
    near = hits.join(telling, "h").select(*pair).distinct()
    sizes = items.select("item_id", "length", "width", F.size("shingles").alias("n_item"))
    near = stored(near.join(if_small(sizes), "item_id"), "near")
    shared = near.join(hits, [*text, "width"]).join(if_small(stored(_terms(items), "terms")), ["item_id", "h"])
    shared = shared.withColumn("span", F.least("n_words", "length") - F.col("width") + 1).withColumn("last", F.greatest(F.col("n_words") - F.col("length"), F.lit(0)))
    shared = stored(shared.select(*pair, "h", "at", "often", "first_at", "span", "last", "n_item"), "shared")

    places = shared.groupBy(*pair, "h", "often", "span", "last", "n_item").agg(F.array_sort(F.collect_list("at")).alias("places"))
    counted = F.expr("inline(transform(places, (p, i) -> struct(p AS at, IF(i >= often, places[i - often], -1) AS before)))")
    counted = places.select(*pair, "span", "last", "n_item", "often", counted)
    begin, end = F.greatest(F.col("before") + 1, F.col("at") - F.col("span") + 1, F.lit(0)), F.least("at", "last") + 1
    ends = counted.select(*pair, "span", "n_item", begin.alias("begin"), end.alias("end")).filter("begin < end")
    ends = ends.select(*pair, "span", "n_item", F.inline(F.array(
        F.struct(F.col("begin").alias("start"), F.lit(1).alias("more")), F.struct(F.col("end").alias("start"), F.lit(-1).alias("more"))
    )))
    steps = ends.groupBy(*pair, "span", "n_item", "start").agg(F.sum("more").alias("more"))
    # The starts of one text and item at a time, of which there are two at most for each shared shingle.
    along = Window.partitionBy(*pair).orderBy("start")
    steps = steps.withColumns({"common": F.sum("more").over(along), "until": F.lead("start").over(along)})
    similarity = F.col("common") / (F.col("n_item") + F.col("span") - F.col("common"))
    windows = steps.withColumn("similarity", similarity).filter(F.col("similarity") >= least)
    best = windows.groupBy(*pair).agg(F.max("similarity").alias("similarity"), F.collect_list(F.struct("similarity", "start", "until")).alias("windows"))
    best = stored(best.withColumn("windows", F.expr("array_sort(filter(windows, w -> w.similarity = similarity))")), "best")

    lines = shared.select(*pair, (F.col("at") - F.col("first_at")).alias("start")).groupBy(*pair, "start").agg(F.count(F.lit(1)).alias("in_line"))
    lines = lines.join(best.select(*pair, "windows"), pair).filter(F.expr("exists(windows, w -> start >= w.start AND start < w.until)"))
    lines = lines.groupBy(*pair).agg(F.max_by("start", F.struct("in_line", -F.col("start"))).alias("line"))
    found = best.join(lines, pair, "left")
    return found.select(*pair, F.coalesce("line", F.expr("windows[0].start")).alias("at_word"), "similarity")


def _held(found: DataFrame) -> tuple[DataFrame, int]:
    bits = bits_for(found.count())
    return stored(packed(found.select(position(F.col("h1"), bits).alias("position")).distinct()), "filter"), bits


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: object) -> DataFrame:
    """One row per document and benchmark item found in it: `doc_id`, `item_id`, `at_word`, `similarity`.

    Repeated documents give repeated rows, null ids stay null; other columns are not looked at.
    """
    found = stored(find_passages(docs, benchmark, text_col, **settings), "found")
    h1, h2 = identity(text_col)
    marked = docs.select(F.col(id_col).alias("doc_id"), h1.alias("h1"), h2.alias("h2"))
    few = with_maybe(marked, "h1", *_held(found)).filter("maybe").drop("maybe")
    return few.join(found, ["h1", "h2"]).drop("h1", "h2")


def without_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings: object) -> DataFrame:
    """The input's rows whose texts hold no benchmark passage, unchanged and, but for look-alikes of the filter, unshuffled."""
    found = stored(find_passages(docs, benchmark, text_col, **settings).select("h1", "h2").distinct(), "found")
    h1, h2 = identity(text_col)
    one, other, maybe = unused(docs, "_h1", "_h2", "_maybe")
    looked = with_maybe(docs.withColumns({one: h1, other: h2}), one, *_held(found), maybe)
    clean = looked.filter(~F.col(maybe))
    checked = looked.filter(maybe).join(found.withColumnsRenamed({"h1": one, "h2": other}), [one, other], "left_anti")
    return clean.select(*docs.columns).unionByName(checked.select(*docs.columns))
