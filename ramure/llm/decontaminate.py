"""Benchmark passages in documents: spaced seeds find places, alignments around them are verified with substitutions allowed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ramure.llm.common import stored

#: Token positions that a seed compares (1) and ignores (0); all begin with two compared ones. No layout of SUBSTITUTIONS in WINDOW
#: tokens hits them all.
MASKS = ("110111", "1101011", "11100101", "110010011", "11111")
#: More of them for items of fewer than WINDOW tokens: with these no layout that is allowed there hits them all, from five tokens on.
SHORT_MASKS = ("111", "11011")
#: Tokens of an overlap, and how many of them may differ.
WINDOW, SUBSTITUTIONS = 13, 3


def tokens(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; null and blank texts have none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda token: token != "")


def _places(hashes: Column, span: int) -> Column:
    """Every place of an array of token hashes with the `span` hashes from there, fewer at the end."""
    return F.transform(hashes, lambda _, at: F.slice(hashes, at + 1, span))


def _seeds(masks: Sequence[str]) -> Column:
    """The seed hashes of the window `w`: one per mask that fits into it."""
    def seed(number: int, mask: str) -> Column:
        compared = [F.get("w", F.lit(at)) for at, sign in enumerate(mask) if sign == "1"]
        return F.when(F.size("w") >= len(mask), F.xxhash64(F.lit(number), *compared))

    return F.filter(F.array(*[seed(number, mask) for number, mask in enumerate(masks)]), lambda hash_: hash_.isNotNull())


def _anchor() -> Column:
    return F.xxhash64(F.get("w", F.lit(0)), F.get("w", F.lit(1)))


def find_overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", masks: Sequence[str] = MASKS,
                  window: int = WINDOW, substitutions: int = SUBSTITUTIONS, short_masks: Sequence[str] = SHORT_MASKS) -> DataFrame:
    """Overlaps of texts with benchmark items: (text_hash, item, position, matched, window).

    An overlap is a run of `window` tokens of an item (all of it, if it is shorter) of which at most `substitutions` in `window`
    differ from the tokens at the same distance in the document. It is found if one seed falls into its alignment with the document,
    which with the default settings one always does; `short_masks` make seeds of items of fewer than `window` tokens only.
    Tokens compare as 64-bit hashes. Per text and item the best is returned, of equal ones the first; `position` counts the document's
    tokens before it. Null and blank texts or items overlap with nothing, nor do items of fewer than five tokens; equal texts are
    looked up once, so rows that repeat make no group large. `text_hash` is xxhash64 of the text.

    Windows of documents stay in the scan's stage: first their two leading tokens, then the seeds of those that are left, look into
    tables made from the items, which Spark broadcasts where they are small and shuffles otherwise.
    """
    def hashed(rows: DataFrame, *kept: Column) -> DataFrame:
        return rows.select(*kept, F.transform(tokens(F.col(text)), lambda token: F.xxhash64(token)).alias("hashes"))

    def windows(rows: DataFrame, *kept: str) -> DataFrame:
        return (rows.select(*kept, F.posexplode(_places(F.col("hashes"), max(map(len, every)))).alias("at", "w"))
                .where(F.size("w") >= min(map(len, every))))

    benchmark = stored(hashed(items.where(F.col(item).isNotNull()), F.col(item).alias("item")).where("size(hashes) >= 5")
                       .groupBy("item", "hashes").agg(F.lit(1).alias("one")).drop("one"), "benchmark")
    short = F.size("hashes") < window
    every = [*masks] if benchmark.where(short).isEmpty() else [*masks, *short_masks]
    places = (windows(benchmark, "item", "hashes").select("item", "at", "w", F.when(short, _seeds(every)).otherwise(_seeds(masks)).alias("seeds"))
              .where(F.size("seeds") > 0))
    anchors = stored(places.select(_anchor().alias("anchor")).distinct(), "anchors")
    seeds = stored(places.select("item", F.col("at").alias("there"), F.explode("seeds").alias("seed")), "seeds")

    texts = docs.where(F.col(text).isNotNull()).select(F.xxhash64(text).alias("text_hash"), F.col(text))
    looked = (windows(hashed(texts, F.col("text_hash"), F.col(text)), "text_hash")
              .withColumn("anchor", _anchor()).join(anchors, "anchor", "left_semi")
              .select("text_hash", "at", F.explode(_seeds(every)).alias("seed")).join(seeds, "seed")
              .select("text_hash", "item", (F.col("at") - F.col("there")).alias("shift")).distinct())
    hits = stored(looked, "hits")
    of_text = stored(hits.groupBy("text_hash").agg(F.collect_list(F.struct("item", "shift")).alias("hits")), "hits")
    found = hashed(texts.join(of_text, "text_hash"), F.col("text_hash"), F.col("hits"))
    pairs = found.select("text_hash", "hashes", F.explode("hits").alias("hit")).select(
        "text_hash", F.col("hit.item").alias("item"), F.col("hit.shift").alias("shift"), "hashes")
    items_too = benchmark.withColumnRenamed("hashes", "item_hashes")
    aligned = pairs.join(items_too, "item").select("text_hash", "item", "shift", F.transform(
        "item_hashes", lambda hash_, at: F.coalesce(F.get("hashes", at + F.col("shift")) == hash_, F.lit(False)).cast("int")).alias("equal"))
    width = F.least(F.lit(window), F.size("equal"))
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.size("equal") - width), lambda at: F.struct(
        F.aggregate(F.slice("equal", at + 1, width), F.lit(0), lambda sum_, one: sum_ + one).alias("matched"),
        (-at - F.col("shift")).alias("back"))))
    scored = aligned.select("text_hash", "item", width.alias("window"), best.alias("best"))
    enough = F.col("best.matched") >= F.col("window") - F.floor(F.col("window") * F.lit(substitutions) / F.lit(window))
    return (scored.where(enough).groupBy("text_hash", "item")
            .agg(F.max(F.struct("best.matched", "best.back", "window")).alias("b"))
            .select("text_hash", "item", (-F.col("b.back")).cast("int").alias("position"), F.col("b.matched").alias("matched"),
                    F.col("b.window").alias("window")))


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", **settings) -> DataFrame:
    """Pairs of documents and the items they contain: (key, item, position, matched, window), without repetitions; null keys are left out."""
    overlaps = stored(find_overlaps(docs, items, text, item, **settings), "overlaps")
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key), F.xxhash64(text).alias("text_hash"))
    return (rows.join(overlaps, "text_hash").select(key, F.col("item").alias(item), "position", "matched", "window").distinct())


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", **settings) -> DataFrame:
    """The rows of `docs` whose text overlaps with no item; null texts stay."""
    overlaps = stored(find_overlaps(docs, items, text, item, **settings).select("text_hash").distinct(), "overlaps")
    return docs.join(overlaps, F.xxhash64(docs[text]) == overlaps["text_hash"], "left_anti")
