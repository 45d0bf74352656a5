"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A benchmark window (13 consecutive words of an item) occurs in a document only if
each of its shingles (5 consecutive words) does.  Ordered by rarity in the corpus,
the rarest shingle of a window is the prefix that any containing document must share:
documents join windows on that shingle alone, its place in window and document fixes
where the window would lie (positional bound) and whether it fits the document
(length bound), and only those places are compared word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_az, sized, stored, text_key

WINDOW, SHINGLE = 13, 5
#: What separates words, before A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text: Column, out: str = "words") -> DataFrame:
    """Add the array of words of ``text``: runs of ASCII letters and digits and non-ASCII characters, case kept."""
    parts = df.withColumn("__parts", F.split(F.coalesce(text, F.lit("")), SEPARATORS))
    lead = (F.element_at("__parts", 1) == "").cast("int")
    trail = (F.element_at("__parts", -1) == "").cast("int")
    n = F.greatest(F.size("__parts") - lead - trail, F.lit(0))
    return parts.withColumn(out, F.slice("__parts", lead + 1, n)).drop("__parts")


def _shingled(words: Column, n: int) -> Column:
    """Array of structs of ``n`` neighbouring words, one for each start."""
    starts = F.greatest(F.size(words) - (n - 1), F.lit(0))
    return F.arrays_zip(*[F.slice(words, i + 1, starts).alias(f"w{i}") for i in range(n)])


def _shingle_hash(item: str, n: int) -> Column:
    return F.xxhash64(*[F.col(f"{item}.w{i}") for i in range(n)])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, words) windows of the items; a shorter item is one window, one without words none."""
    words = with_words(items, lower_az(F.col("text")), "all").select("item_id", "all")
    at = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    return (
        words.filter(F.size("all") > 0).select("item_id", "all", F.explode(at).alias("at"))
        .select("item_id", F.slice("all", F.col("at"), window).alias("words")).distinct()
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Add n_words, n_hit, n_items, items (sorted item ids as strings) and contaminated to each document.

    ``docs`` needs a ``text`` column and ``items`` the columns item_id and text; other
    columns pass through (same-named ones are replaced).  A document word is hit when
    an occurrence of an item window covers it; a document is contaminated when hit
    words are at least a twentieth of its words.  Null and empty texts have no words and
    are never contaminated; null item ids are ignored; repeated rows stay repeated and
    each gets the same result; with no items every count is 0; no documents give no rows.
    A very long text is one array of words in one task, with some 200 bytes a word.

    Candidates are sought in upper case, which Unicode maps letter by letter, so equal
    words in any A-Z case stay equal; occurrences are then compared on exact words."""
    windows = stored(item_windows(items.filter("item_id is not null"), window), "windows")
    arity = F.least(F.size("words"), F.lit(shingle))
    arities = [r["q"] for r in windows.select(arity.alias("q")).distinct().collect()]  # at most `shingle` numbers
    docs = docs.drop("n_words", "n_hit", "n_items", "items", "contaminated").withColumn("__tk", text_key(F.col("text")))
    counted = with_words(docs, F.col("text"), "__words").withColumn("n_words", F.size("__words").cast("long")).drop("__words")
    shouted = with_words(docs.select("__tk", "text"), F.upper("text")).select("__tk", "words")
    found = []
    for q in sorted(arities):
        parts = stored(
            windows.filter(arity == q).select(
                "words", F.posexplode(_shingled(F.transform("words", lambda w: F.upper(w)), q)).alias("off", "s")
            ).select("words", "off", _shingle_hash("s", q).alias("sh")).distinct(), "window-shingles")
        hashes = sized(parts.select("sh").distinct())
        # every place of a benchmark shingle in the corpus
        hits = stored(
            shouted.select("__tk", F.posexplode(_shingled(F.col("words"), q)).alias("pos", "s"))
            .select("__tk", "pos", _shingle_hash("s", q).alias("sh")).join(hashes, "sh"), "shingle-hits")
        rarity = hits.groupBy("sh").agg(F.count(F.lit(1)).alias("df"))
        # a window with a shingle that the corpus lacks occurs nowhere
        rarest = parts.join(rarity, "sh", "left").groupBy("words").agg(
            F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "off", "sh")).alias("r")
        ).filter("r.df > 0")
        prefix = sized(stored(rarest.select("r.sh", "r.off", F.size("words").alias("len")).distinct(), "prefixes"))
        found.append(hits.join(prefix, "sh").select("__tk", (F.col("pos") - F.col("off") + 1).alias("start"), "len").filter("start >= 1"))
    if not found:
        none = {"n_hit": F.lit(0).cast("long"), "n_items": F.lit(0).cast("long"), "items": F.array().cast("array<string>"), "contaminated": F.lit(False)}
        return counted.drop("__tk").withColumns(none)
    places = found[0]
    for more in found[1:]:
        places = places.unionByName(more)
    places = stored(places.groupBy("__tk").agg(F.collect_set(F.struct("start", "len")).alias("places")), "places")
    # each distinct text with a candidate place is compared once
    texts = docs.join(sized(places.select("__tk")), "__tk", "left_semi").groupBy("__tk").agg(F.first("text").alias("text"))
    lowered = with_words(texts.join(places, "__tk"), lower_az(F.col("text")))
    fits = F.filter("places", lambda p: p["start"] + p["len"] - 1 <= F.size("words"))
    met = (
        lowered.select("__tk", F.explode(F.transform(fits, lambda p: F.struct(
            p["start"].alias("start"), p["len"].alias("len"), F.slice("words", p["start"], p["len"]).alias("words")))).alias("p"))
        .select("__tk", "p.start", "p.len", "p.words").join(sized(windows), "words")
    )
    covered = F.array_distinct(F.flatten(F.transform("__spans", lambda p: F.sequence(p["start"], p["start"] + p["len"] - 1))))
    per_text = met.groupBy("__tk").agg(
        F.collect_set(F.struct("start", "len")).alias("__spans"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("__items"),
    ).select("__tk", F.size(covered).cast("long").alias("__hit"), "__items")
    n_hit = F.coalesce("__hit", F.lit(0).cast("long"))
    out = counted.join(stored(per_text, "contaminated"), "__tk", "left").withColumns({
        "n_hit": n_hit,
        "items": F.coalesce("__items", F.array().cast("array<string>")),
        "contaminated": (n_hit > 0) & (n_hit * 20 >= F.col("n_words")),
    })
    return out.withColumn("n_items", F.size("items").cast("long")).drop("__tk", "__hit", "__items")
