"""URL filters: stated host and path rules first, then association rules mined from labelled URLs.

FP-growth finds combinations of URL tokens that labelled URLs share, the label among them; rules
``tokens -> block`` stay where support and confidence reach their bounds and no shorter rule does as
well. Tokens that occur in the same labelled URLs are one item: a rule asks for all of them. FP-growth takes the
``LONGEST`` rarest items of a URL, as it lists all combinations; those of URLs with more items are counted level by
level (``of_long_urls``), so no combination is left out. Support and confidence are then counted anew over all
labelled URLs and all their tokens. Rules are matched
through an inverted index: a rule stands under its rarest token only, so a URL meets only the rules of its own
rare tokens, and then has to hold all their other tokens.

Defined cases: a null URL, or one without ``://``, has empty host and path, no tokens and is allowed; an
empty host fits no rule; repeated rows are judged each; without labels no rule is mined and what no
stated rule fits is allowed; labels other than 0 and 1 count as none. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from starloom.session import written_once

# A combination on fewer labelled URLs than ``MIN_COUNT`` is chance. The share bounds the items that FP-growth holds on
# the driver, and decides from two million labelled URLs on.
MIN_SUPPORT, MIN_CONFIDENCE, MIN_COUNT = 0.00001, 0.9, 20
# Items of a URL that FP-growth takes.
LONGEST = 12
# Items and rules that are broadcast; more are joined by a shuffle.
BROADCAST_RULES = 100_000
BLOCK = "label=block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


STATED = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/ ? #``, with A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        here = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, here).otherwise(found)
    return found


def tokens_of(host: Column, path: Column) -> Column:
    """Host labels, words within them, the last two labels, path segments and their shape; each once."""
    labels = F.split(host, r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    marked = lambda mark, parts: F.transform(parts, lambda p: F.concat(F.lit(mark), p))
    return F.when(
        host != "",
        F.array_distinct(
            F.concat(
                marked("host:", labels),
                marked("word:", F.filter(F.split(host, r"[^a-z]+"), lambda w: F.length(w) > 2)),
                F.array(F.concat(F.lit("site:"), F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1))),
                marked("path:", F.filter(segments, lambda s: ~s.rlike("[0-9]"))),
                F.array(F.concat(F.lit("depth:"), F.least(F.size(segments), F.lit(5)).cast("string"))),
            )
        ),
    ).otherwise(F.array().cast("array<string>"))


def items_of(labelled: DataFrame, min_count: float) -> tuple[DataFrame, DataFrame]:
    """(row, items): the items of each row of ``labelled`` (row, tokens), rarest first, and (item, tokens) of An item is named after its first token."""
    held = labelled.select("row", F.explode("tokens").alias("token"))
    # Equal numbers and two equal sums of hashes: the same rows.
    where = held.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("row")).alias("one"),
        F.bit_xor(F.xxhash64("row", F.lit(1))).alias("other"),
    )
    members = where.where(F.col("n") >= min_count).groupBy("n", "one", "other")
    named = members.agg(F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("tokens"))
    named = written_once(named.select("item", "tokens", "n"), "url-items")
    frequent = named.select("item", "n")
    small = F.broadcast(frequent) if frequent.count() <= BROADCAST_RULES else frequent
    rarest = F.sort_array(F.collect_list(F.struct("n", "item")))
    found = held.join(small, held.token == F.col("item")).groupBy("row").agg(rarest.alias("found"))
    return found.select("row", F.col("found.item").alias("items")), named.select("item", "tokens")


def of_long_urls(baskets: DataFrame, least: float, min_confidence: float) -> DataFrame | None:
    """(antecedent) of the combinations of (items, blocked) that reach both bounds and that a row with more than
    ``LONGEST`` items holds; None without such rows.

    Combinations of one item more are made, row by row, of those that stay. One in the same rows as a part of it adds
    nothing to that part, nor does one with a part that only blocked rows hold, and so it is with all that extend it:
    neither stays. Nested items thus make no combinations. Rows with the same items are one row, and levels are tables.
    """
    kinds = baskets.groupBy("items").agg(F.count_if("blocked").alias("hits"), F.count(F.lit(1)).alias("held"))
    kinds = kinds.withColumns({"row": F.monotonically_increasing_id(), "long": F.size("items") > LONGEST})
    kinds = written_once(kinds, "url-kinds")
    if kinds.where("long").isEmpty():
        return None
    known = ["row", "hits", "held", "long"]
    places = kinds.select(*known, F.array().cast("array<string>").alias("head"), F.explode("items").alias("last"))
    found, parts, size = None, None, 1
    while True:
        whole = F.concat("head", F.array("last")).alias("items")
        counted = places.groupBy("head", "last").agg(
            F.sum("hits").alias("hits"), F.sum("held").alias("held"), F.bool_or("long").alias("long")
        )
        counted = counted.where(F.col("long") & (F.col("hits") >= least)).select(whole, "hits", "held")
        if parts is not None:
            part = F.explode(F.transform("items", lambda t: F.array_except("items", F.array(t)))).alias("part")
            stays = counted.select("*", part).join(parts, "part").where("part_held > held")
            stays = stays.groupBy("items", "hits", "held").agg(F.count(F.lit(1)).alias("n"))
            counted = stays.where(F.col("n") == size).drop("n")
        counted = written_once(counted, "url-combinations")
        sure = counted.where(F.col("hits") >= min_confidence * F.col("held")).select(F.col("items").alias("antecedent"))
        found = sure if found is None else found.unionByName(sure)
        alive = counted.where("hits < held")
        if alive.isEmpty():
            return found
        parts = alive.select(F.col("items").alias("part"), F.col("held").alias("part_held"))
        kept = places.select("*", whole).join(alive.select("items"), "items", "left_semi").drop("items")
        kept = written_once(kept, "url-places")
        pairs = kept.join(kept.select("row", "head", F.col("last").alias("next")), ["row", "head"]).where("last < next")
        places = pairs.select(*known, whole.alias("head"), F.col("next").alias("last"))
        places = written_once(places, "url-longer-places")
        size += 1


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(tokens, support, confidence) of pruned rules from (tokens, blocked)."""
    numbered = labelled.select("tokens", "blocked").withColumn("row", F.monotonically_increasing_id())
    labelled = written_once(numbered, "labelled-urls")
    n = labelled.count()
    support = max(min_support, min_count / n) if n else 1.0
    baskets, named = items_of(labelled, support * n)
    baskets = written_once(baskets.join(labelled.select("row", "blocked"), "row").drop("row"), "url-baskets")
    schema = "tokens array<string>, support double, confidence double"
    if n < min_count or baskets.isEmpty():
        return labelled.sparkSession.createDataFrame([], schema)
    # Of the baskets' own number, which leaves out rows without items.
    share = min(1.0, support * n / baskets.count())
    rarest = F.slice("items", 1, LONGEST)
    short = baskets.select(F.when(F.col("blocked"), F.concat(rarest, F.array(F.lit(BLOCK)))).otherwise(rarest).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=min_confidence).fit(short)
    mined = model.associationRules.where(F.col("consequent")[0] == BLOCK).select("antecedent")
    rest = of_long_urls(baskets, support * n, min_confidence)
    if rest is not None:
        mined = mined.unionByName(rest).select(F.array_sort("antecedent").alias("antecedent")).distinct()
    mined = written_once(mined.withColumn("rule", F.monotonically_increasing_id()), "mined-rules")
    parts = mined.select("rule", F.explode("antecedent").alias("item")).join(named, "item")
    whole = parts.groupBy("rule").agg(F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens"))
    whole = written_once(whole, "whole-rules")
    met = matches(labelled, whole.select("tokens", F.lit(1.0).alias("confidence")), "row")
    counts = met.join(labelled.select("row", "blocked"), "row").groupBy("tokens").agg(
        F.count_if(F.col("blocked")).alias("hits"), F.count(F.lit(1)).alias("held")
    )
    sure = (F.col("hits") >= support * n) & (F.col("hits") >= min_confidence * F.col("held"))
    counted = whole.join(counts.where(sure), "tokens").join(mined, "rule")
    rules = counted.select(
        "tokens", "antecedent", (F.col("hits") / n).alias("support"), (F.col("hits") / F.col("held")).alias("confidence")
    )
    rules = written_once(rules.withColumn("antecedent", F.array_sort("antecedent")), "sure-rules")
    # A rule adds nothing to a shorter one of at least its confidence.
    part = F.explode(F.transform("antecedent", lambda t: F.array_except("antecedent", F.array(t)))).alias("part")
    shorter = rules.select(F.col("antecedent").alias("part"), F.col("confidence").alias("part_confidence"))
    beaten = (
        rules.where(F.size("antecedent") > 1)
        .select("antecedent", "confidence", part)
        .join(shorter, "part")
        .where("part_confidence >= confidence")
        .select("antecedent")
    )
    if rest is not None:
        # Of long URLs only those parts are known that are in more rows, which may be shorter by several items.
        inner = matches(
            rules.select("antecedent", F.col("antecedent").alias("tokens")),
            rules.select(F.col("antecedent").alias("tokens"), "confidence"),
            "antecedent",
        )
        numbers = rules.select("antecedent", "support", "confidence")
        inner = inner.where(F.size("tokens") < F.size("antecedent")).select("antecedent", F.col("tokens").alias("part"))
        outer = inner.join(numbers, "antecedent")
        known = numbers.select(F.col("antecedent").alias("part"), F.col("support").alias("s"), F.col("confidence").alias("c"))
        same = outer.join(known, "part").where("support = s AND confidence = c").select("antecedent")
        beaten = beaten.unionByName(same)
    return rules.join(beaten, "antecedent", "left_anti").select("tokens", "support", "confidence")


def matches(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key, tokens, confidence) of every rule whose tokens a row of ``urls`` (key, tokens) has all."""
    n = rules.count()
    frequency = rules.select(F.explode("tokens").alias("token")).groupBy("token").count()
    places = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(frequency, "token")
    # The token that the fewest rules have is where the rule stands in the index.
    index = places.groupBy("tokens", "confidence").agg(F.min_by("token", F.struct("count", "token")).alias("token"))
    index = index.select("token", F.col("tokens").alias("rule"), "confidence")
    held = urls.select(key, "tokens", F.explode("tokens").alias("token"))
    return (
        held.join(F.broadcast(index) if n <= BROADCAST_RULES else index, "token")
        .where(F.size(F.array_except("rule", "tokens")) == 0)
        .select(key, F.col("rule").alias("tokens"), "confidence")
    )


def judge(pages: DataFrame, labels: DataFrame, stated: list[Rule] = STATED) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined) of each (page_id, url).

    ``labels`` are (page_id, label) with one label per page, 0 for a page to block. ``mined`` holds the
    tokens of the surest mined rule that fits a URL which no stated rule fits.
    """
    url = F.col("url").cast("string")
    split = pages.select(F.col("page_id").cast("long"), host_of(url).alias("host"), path_of(url).alias("path"))
    known = labels.select(F.col("page_id").cast("long"), (F.col("label") == 0).alias("blocked"))
    tokens = tokens_of(F.col("host"), F.col("path")).alias("tokens")
    rules = mine(split.join(known, "page_id").select(tokens, "blocked"))
    judged = split.withColumn("stated", stated_rule(F.col("host"), F.col("path"), stated))
    # Hosts and paths decide alone, so each pair is matched once.
    open_ = judged.where("stated IS NULL").select("host", "path").distinct()
    found = (
        matches(open_.select(F.struct("host", "path").alias("at"), tokens), rules, "at")
        .groupBy("at")
        .agg(F.max(F.struct("confidence", "tokens")).alias("best"))
        .select("at.host", "at.path", F.col("best.tokens").alias("mined"))
    )
    # From a table, so that the join can split the partition of a URL that very many rows have.
    found = written_once(found, "mined-verdicts")
    verdict = F.coalesce("stated.verdict", F.when(F.col("mined").isNotNull(), "block"), F.lit("allow"))
    return judged.join(found, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("stated.text").alias("rule"),
        verdict.alias("verdict"),
        F.when(F.col("stated").isNull(), F.col("mined")).alias("mined"),
    )
