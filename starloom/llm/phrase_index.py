"""Benchmark decontamination through a distributed positional inverted index.

Of the training texts, postings are stored for the terms that queries need: per occurrence the term, the
document, the position, and the words next to it. Each window of a benchmark item is looked up by its
two rarest terms, by their number in the training texts: their posting lists are shifted by the terms'
places in the item, and meet where document, item and shifted position agree. What meets is held against
the item word by word, which gives exact phrases. A proximity match is a stretch of a document that has the words of a window,
each as often, in whatever order: it holds the window's rarest term, so the words next to that term's postings tell.

Only SQL functions are used. A window in which a term occurs nowhere is not looked up. Texts are split
where they are read and never moved: only postings of rare terms are.

Defined cases: a null or empty text or item has no words, no hit and is not contaminated; an item
shorter than a window is one window; repeated documents are judged each; repeated items count once by their
id, and items without an id hit words but are not listed; empty tables give no hits. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import written_once

WINDOW = 13
# Benchmark terms that are broadcast; more are joined by a shuffle.
BROADCAST_TERMS = 200_000
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def fold_case(word: Column) -> Column:
    """A-Z lower-cased; the cheap full folding tells first whether there is anything to do."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def document_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Rows of one key have the same id and text, so they have the same result."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))


def item_words(items: DataFrame) -> DataFrame:
    """(item, item_id, words) of each different (item_id, text) that has words."""
    text = F.col("text").cast("string")
    words = F.transform(raw_words(text), fold_case)
    listed = items.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words"))
    distinct = listed.where(F.size("words") > 0).distinct()
    return distinct.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words")


def _bounded(terms: DataFrame) -> DataFrame:
    return F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms


def lookups(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(term, item, item_id, need, place, left, right, windows): the places of an item at which its windows are
    looked up. ``left`` and ``right`` are the item's words next to the place, the nearest first."""
    placed = items.select("item", "item_id", "words", F.posexplode("words").alias("place", "term"))
    terms = written_once(placed.select("term").distinct(), "benchmark-terms")
    spoken = docs.select(F.explode(raw_words(F.col("text").cast("string"))).alias("word"))
    counted = (
        spoken.select(fold_case(F.col("word")).alias("term"))
        .join(_bounded(terms), "term")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    counted = written_once(counted, "term-counts")
    rarity = (
        placed.join(counted, "term")
        .groupBy("item", "item_id", "words")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "df"))).alias("df"))
    )
    size = F.size("words")
    need = F.least(F.lit(window), size)
    starts = F.sequence(F.lit(0), size - need)
    rare = F.transform(
        starts,
        lambda s: F.array_sort(
            F.transform(F.sequence(s, s + need - 1), lambda p: F.struct(F.element_at("df", p).alias("df"), p.alias("p")))
        ),
    )
    # Null sorts last, so a window with an unseen term ends with one.
    usable = F.filter(rare, lambda w: F.element_at(w, -1)["df"].isNotNull())
    places = F.array_distinct(F.flatten(F.transform(usable, lambda w: F.transform(F.slice(w, 1, 2), lambda t: t["p"]))))
    return (
        rarity.select("item", "item_id", "words", need.alias("need"), F.explode(places).alias("place"))
        .select(
            F.element_at("words", F.col("place") + 1).alias("term"),
            "item",
            "item_id",
            "need",
            "place",
            *beside("words", "place", window),
        )
    )


def beside(words: str, place: str, window: int, each=lambda w: w) -> list[Column]:
    """Up to window - 1 words on either side of a place, from the nearest on."""
    words, place = F.col(words), F.col(place)
    reach = F.least(place, F.lit(window - 1))
    left = F.reverse(F.slice(words, place - reach + 1, reach))
    right = F.slice(words, place + 2, F.lit(window - 1))
    return [F.transform(left, each).alias("left"), F.transform(right, each).alias("right")]


def postings(docs: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """The index: (term, key, position, left, right) of each occurrence of ``terms`` in the training texts."""
    spoken = docs.select(document_key().alias("key"), raw_words(F.col("text").cast("string")).alias("words"))
    # The outer form, since the plain one would split the text twice to skip empty ones.
    each = spoken.select("key", "words", F.posexplode_outer("words").alias("position", "word"))
    return (
        each.withColumn("term", fold_case(F.col("word")))
        .join(_bounded(terms), "term")
        .select("term", "key", "position", *beside("words", "position", window, fold_case))
    )


def agreeing(a: Column, b: Column) -> Column:
    """How many first words of two lists are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    differs = F.array_position(same, False)
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("int")


def bags(words: Column, place: Column, size: Column) -> Column:
    """(start, bag) of each stretch of ``size`` words that holds the one at ``place``, from 1; a bag has no order."""
    first, last = F.greatest(place - size + 1, F.lit(1)), F.least(place, F.size(words) - size + 1)
    starts = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    bag = lambda at: F.array_join(F.array_sort(F.slice(words, at, size)), " ")
    return F.transform(starts, lambda at: F.struct(at.alias("start"), bag(at).alias("bag")))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, proximity: bool = True) -> DataFrame:
    """(key, item_id, item, first, last, exact): stretches of a document that are in an item.

    Without ``proximity`` exact ones only. An exact stretch is a phrase of at least a window that document and item share; the others have the words of a
    window in another order. An item may have both in one document.
    """
    items = written_once(item_words(benchmark), "benchmark-items")
    looked = written_once(lookups(docs, items, window), "benchmark-lookups")
    index = written_once(
        postings(docs, written_once(looked.select("term").distinct(), "index-terms"), window), "postings"
    )
    asked = looked.select("term", "item", "item_id", "need", "place", F.col("left").alias("item_left"), F.col("right").alias("item_right"))
    small = asked.count() <= BROADCAST_TERMS
    here, there = (F.concat(F.reverse(a), F.array("term"), b) for a, b in (("left", "right"), ("item_left", "item_right")))
    wanted = bags(there, F.size("item_left") + 1, F.col("need"))["bag"]
    permuted = F.filter(bags(here, F.size("left") + 1, F.col("need")), lambda s: F.array_contains(wanted, s["bag"]))
    # A word next to the posting has to be beside the item's place as well, and of the words there no more may be
    # missing here than a window leaves out.
    beside_item = F.concat("item_left", "item_right")
    held = lambda words: F.array_contains(beside_item, F.get(words, F.lit(0)))
    beside_too = (F.col("need") == 1) | F.coalesce(held("left"), F.lit(False)) | F.coalesce(held("right"), F.lit(False))
    possible = beside_too & (F.size(F.array_except(beside_item, here)) <= F.size(beside_item) + 1 - F.col("need"))
    apart = F.col("position") - F.size("left") - 1 + F.get(permuted, F.lit(0))["start"]
    near = F.when(possible, apart) if proximity else F.lit(None).cast("int")
    met = index.join(F.broadcast(asked) if small else asked, "term").select(
        "key",
        "item",
        "item_id",
        "need",
        "place",
        "position",
        (F.col("position") - F.col("place")).alias("shift"),
        agreeing(F.col("left"), F.col("item_left")).alias("before"),
        agreeing(F.col("right"), F.col("item_right")).alias("after"),
        near.alias("near"),
    )
    lists = met.groupBy("key", "item", "item_id", "need", "shift").agg(
        F.collect_set(F.struct("position", "before", "after", "near")).alias("hits")
    )
    # Both rarest terms of a window meet in its list; an item of one word has only one.
    both = F.size("hits") >= F.least(F.col("need"), F.lit(2))
    exact = (F.col("hit.before") + 1 + F.col("hit.after")) >= F.col("need")
    near = F.col("hit.near")
    return (
        lists.withColumn("hit", F.explode("hits"))
        .select(
            "key",
            "item",
            "item_id",
            F.when(exact & both, F.col("hit.position") - F.col("hit.before")).otherwise(near).alias("first"),
            F.when(exact & both, F.col("hit.position") + F.col("hit.after"))
            .otherwise(near + F.col("need") - 1)
            .alias("last"),
            (exact & both).alias("exact"),
            near.isNotNull().alias("near"),
        )
        .where("exact OR near")
        .drop("near")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, proximity: bool = False) -> DataFrame:
    """(doc_id, key, n_words, n_hit, n_items, item_ids, contaminated) of each (doc_id, text).

    A document is contaminated where at least a twentieth of its words are in exact matches. With ``proximity`` there
    is ``n_near`` as well, the items with a window whose words the document has together in whatever order.
    """
    found = matches(docs, benchmark, window, proximity)
    near = [F.countDistinct("item_id").alias("n_near")] if proximity else []
    own = lambda c: F.when(F.col("exact"), c)
    stretches = F.array_sort(F.collect_set(own(F.struct("first", "last"))))
    covered = F.aggregate(
        "stretches",
        F.struct(F.lit(0).alias("n"), F.lit(-1).alias("to")),
        lambda held, s: F.struct(
            (held["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"] - 1, held["to"]))).alias("n"),
            F.greatest(held["to"], s["last"]).alias("to"),
        ),
    )["n"]
    hits = (
        found.groupBy("key")
        .agg(
            stretches.alias("stretches"),
            F.array_sort(F.collect_set(own(F.col("item_id")))).alias("item_ids"),
            *near,
        )
        .select("key", covered.cast("long").alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"), "item_ids", *("n_near" for _ in near))
    )
    counted = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        document_key().alias("key"),
        F.size(raw_words(F.col("text").cast("string"))).cast("long").alias("n_words"),
    )
    judged = counted.join(written_once(hits, "benchmark-hits"), "key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return judged.select(
        "doc_id",
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
        *(F.coalesce("n_near", F.lit(0)).alias("n_near") for _ in near),
    )
