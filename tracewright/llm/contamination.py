"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Texts become templates: numbers, names (capitalised words within a sentence) and units after numbers turn into typed placeholders,
other words are lower-cased. Windows of template words are hashed and joined with those of the benchmark. Where
windows of an item meet a text on one diagonal, the words under them are compared one by one and the fillings of
the placeholders must agree: every filling of the item stands for one filling of the text, and names one to one. So
copied passages are found, and questions whose numbers, names or units were exchanged as well.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import BROADCAST_ROWS, joined, kept, temporary, written

WINDOW = 8
#: Items with fewer template words than WINDOW are searched by windows of this size; shorter ones as whole sentences.
SHORT_WINDOW = 5
#: Template words that must be covered, or all but one of an item that has fewer.
COVERED = 13

#: Units that may follow a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes lb lbs "
    "pound pounds ounce ounces ml l litre litres liter liters gallon gallons ms s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years dollar dollars cent cents euro euros percent degrees degree mph kmh km/h "
    "w kw kwh v volt volts hz khz mhz ghz kb mb gb tb"
).split()
#: A number, or a word with what ends the sentence before it, if anything; a run of marks with no word after it is
#: taken whole and left out. Possessive throughout: linear in the text and without recursion, whatever the text.
_TOKEN = r"([0-9]++(?:[.,:/][0-9]++)*+|(?:[.!?:\n][^\p{L}\p{M}0-9]*+)?+[\p{L}\p{M}]++)|[.!?:\n][^\p{L}\p{M}0-9]*+"
_ENDS = "^[.!?:\n]"
#: Where a text is cut into sentences for items of a few words.
_SENTENCES = r"(?<![.!?:])[.!?:]++(?=\s|$)|\n++"
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"


def tokens(text: Column) -> Column:
    """Numbers and words of a text, in order; a word that begins a sentence still has the end of the last before it."""
    return F.array_remove(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(1)), "")


def words(found: Column) -> Column:
    """The bare words of tokens()."""
    return F.transform(found, lambda w: F.when(w.rlike(_ENDS), F.regexp_replace(w, r"^[^\p{L}\p{M}]+", "")).otherwise(w))


def template(found: Column) -> Column:
    """The template words of tokens(). Names are capitalised words within a sentence; words all in capitals are not."""

    def typed(w: Column, i: Column) -> Column:
        low = F.lower(w)
        unit = low.isin(UNITS) & (i > 0) & F.get(found, i - 1).rlike("^[0-9]")
        name = (low != w) & (i > 0) & (F.upper(w) != w)
        return (
            F.when(w.rlike(_ENDS), F.regexp_replace(low, r"^[^\p{L}\p{M}]+", ""))
            .when(w.rlike("^[0-9]"), F.lit(NUMBER))
            .when(unit, F.lit(UNIT))
            .when(name, F.lit(NAME))
            .otherwise(low)
        )

    return F.transform(found, typed)


def plain(template_words: Column, bare_words: Column) -> Column:
    """The template with its names as lower-case words."""
    return F.zip_with(template_words, bare_words, lambda t, w: F.when(t == NAME, F.lower(w)).otherwise(t))


def _described(texts: DataFrame, key: str) -> DataFrame:
    found = texts.select(key, tokens(F.col("text")).alias("tokens"))
    return found.select(key, words(F.col("tokens")).alias("words"), template(F.col("tokens")).alias("template"))


def _hashed(template_words: Column) -> Column:
    return F.transform(template_words, lambda t: F.xxhash64(t))


def _windows(hashes: Column, size: int) -> Column:
    """array<long>: a hash of every run of `size` hashed template words."""
    last = F.size(hashes) - size
    return F.when(last >= 0, F.transform(F.sequence(F.lit(1), F.greatest(last + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(hashes, i, size)))).otherwise(F.array().cast("array<long>"))


def _text_windows(size: int) -> Column:
    """array<struct<at, hash>>: windows of `template`, and those that hold a name once more with `plain` words."""
    every = F.transform(_windows(F.col("h"), size), lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
    last = F.size("h") - size
    near = F.transform("names", lambda p: F.sequence(F.greatest(p - size + 1, F.lit(0)), F.least(p, last)))
    spots = F.when((F.size("names") > 0) & (last >= 0), F.array_distinct(F.flatten(near))).otherwise(F.array().cast("array<int>"))
    return F.concat(every, F.transform(spots, lambda i: F.struct(i.alias("at"), F.xxhash64(F.slice("plain", i + 1, size)).alias("hash"))))


def _sentence(text: Column) -> Column:
    """The lower-case words and numbers of a text."""
    return F.array_join(F.regexp_extract_all(F.lower(text), F.lit(r"[0-9]++|[\p{L}\p{M}]++"), F.lit(0)), " ")


def _short(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Items of fewer than SHORT_WINDOW words in texts (text_hash, text): as a whole sentence or line, word for word."""
    few = items.where(F.col("item_words").between(1, SHORT_WINDOW - 1)).select("item_id", "item_words", _sentence(F.array_join("words", " ")).alias("sentence"))
    few = written(few.where("sentence <> ''"), "few")
    if not few.head(1):
        return few.select(F.lit(0).cast("long").alias("text_hash"), "item_id", *(F.lit(0).alias(c) for c in ("covered", "item_words", "slots", "changed_slots"))).limit(0)
    cut = texts.select("text_hash", F.explode(F.array_distinct(F.transform(F.split("text", _SENTENCES), _sentence))).alias("sentence"))
    return joined(cut, few, ["sentence"]).select("text_hash", "item_id", F.col("item_words").alias("covered"), "item_words", F.lit(0).alias("slots"), F.lit(0).alias("changed_slots")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each text and item that it holds: text_hash, item_id, covered, item_words, slots, changed_slots.

    docs needs text, benchmark item_id and text; texts are told apart by XXH64 of the whole text (text_hash). An
    item is held if windows on one diagonal cover at least COVERED of its template words, or all but one if it has
    fewer (within another sentence its first word can look like a name), and the fillings under them are consistent;
    of several diagonals the one that covers most is reported. covered counts the words under matching windows,
    slots the placeholders among them, changed_slots those filled differently (0: a copy). Items of fewer than
    SHORT_WINDOW words are held where they are a whole sentence or line. Null and empty texts hold nothing, null and
    empty items are held by nothing; repeated rows of either table count once. Windows of documents are joined where
    they are made; only matches go on, one row a matching word, so what is shuffled grows with the contamination.
    """
    with temporary():
        items = written(_described(benchmark.where("item_id IS NOT NULL").select("item_id", "text").distinct(), "item_id"), "items")
        items = items.withColumns({"item_key": F.xxhash64("item_id", "words"), "item_words": F.size("template"), "plain": plain(F.col("template"), F.col("words"))})
        shortest = items.where(F.col("item_words").between(SHORT_WINDOW, WINDOW - 1)).limit(1).count()
        sizes = [WINDOW] + [SHORT_WINDOW] * shortest
        wanted = []
        for size in sizes:
            fitting = items.where(F.col("item_words") >= WINDOW) if size == WINDOW else items.where(F.col("item_words").between(SHORT_WINDOW, WINDOW - 1))
            for form in ("template", "plain"):
                wanted.append(fitting.select("item_key", "item_words", F.lit(size).alias("size"), F.posexplode(_windows(_hashed(F.col(form)), size)).alias("item_at", "hash")))
        windows = written(reduce(DataFrame.unionByName, wanted).distinct(), "windows")
        hashes = written(windows.select("hash").distinct(), "hashes")

        texts = docs.where("text IS NOT NULL").select(F.xxhash64("text").alias("text_hash"), "text")
        own = _described(texts, "text_hash").withColumn("names", F.filter(F.transform("template", lambda t, i: F.when(t == NAME, i)), lambda i: i.isNotNull()))
        own = own.select("text_hash", _hashed(F.col("template")).alias("h"), "names", F.when(F.size("names") > 0, _hashed(plain(F.col("template"), F.col("words")))).alias("plain"))
        made = [own.select("text_hash", F.inline(_text_windows(size))) for size in sizes]
        hits = written(joined(reduce(DataFrame.unionByName, made), hashes, ["hash"], "left_semi").distinct(), "hits")

        diagonals = (
            joined(hits, windows, ["hash"])
            .groupBy("text_hash", "item_key", "item_words", "size", (F.col("at") - F.col("item_at")).alias("shift"))
            .agg(F.collect_set("item_at").alias("starts"))
            .withColumn("under", F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + F.col("size") - 1)))))
            .where(F.size("under") >= F.least(F.lit(COVERED), F.col("item_words") - 1))
        )
        # word by word: no text is copied, however many items it holds
        cells = written(diagonals.select("text_hash", "item_key", "item_words", "shift", F.explode("under").alias("item_at")).withColumn("at", F.col("item_at") + F.col("shift")), "cells")
        needed = written(cells.groupBy("text_hash").agg(F.collect_set("at").alias("needed")), "needed")
        suspects = joined(texts, needed.select("text_hash"), ["text_hash"], "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))
        suspects = _described(suspects, "text_hash").join(needed, "text_hash")
        there = F.transform("needed", lambda i: F.struct(i.alias("at"), F.get("template", i).alias("text_kind"), F.lower(F.get("words", i)).alias("text_word")))
        here = F.transform("template", lambda t, i: F.struct(i.alias("item_at"), t.alias("kind"), F.lower(F.get("words", i)).alias("word")))
        both = joined(cells, written(items.select("item_key", "item_id", F.inline(here)), "item_words"), ["item_key", "item_at"]).join(suspects.select("text_hash", F.inline(there)), ["text_hash", "at"])
        same = (F.col("kind") == F.col("text_kind")) | ((F.col("kind") == NAME) & (F.col("word") == F.col("text_kind"))) | ((F.col("text_kind") == NAME) & (F.col("text_word") == F.col("kind")))
        slot = F.when(F.col("kind").isin(NUMBER, NAME, UNIT), F.struct("kind", F.col("word").alias("item"), F.col("text_word").alias("text")))
        diagonals = both.groupBy("text_hash", "item_key", "item_id", "item_words", "shift").agg(
            F.min(same).alias("same"), F.count("*").cast("int").alias("covered"), F.count(slot).cast("int").alias("n"), F.count(F.when(slot["item"] != slot["text"], 1)).cast("int").alias("changed"), F.collect_set(slot).alias("slots")
        )
        fillings = lambda c, *names: F.size(F.array_distinct(F.transform(c, lambda s: F.struct(*(s[n] for n in names)))))
        names = F.filter("slots", lambda s: s["kind"] == NAME)
        consistent = (F.size("slots") == fillings("slots", "kind", "item")) & (F.size(names) == fillings(names, "text"))
        best = diagonals.where(F.col("same") & consistent).groupBy("text_hash", "item_id").agg(F.max(F.struct("covered", (-F.col("changed")).alias("unchanged"), "n", "item_words")).alias("m"))
        held = best.select("text_hash", "item_id", "m.covered", "m.item_words", F.col("m.n").alias("slots"), (-F.col("m.unchanged")).alias("changed_slots"))
        return kept(written(held.unionByName(_short(texts, items)), "contaminated"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id and the columns of contaminated(): one row for each document row and item that its text holds.

    Repeated rows, and rows with equal or null doc_id, are reported each on its own; other columns are ignored.
    """
    return joined(docs.select("doc_id", F.xxhash64("text").alias("text_hash")), contaminated(docs, benchmark), ["text_hash"]).select("doc_id", "item_id", "covered", "item_words", "slots", "changed_slots")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs whose text holds no item, with all their columns, whatever their names.

    Null and empty texts stay, a null doc_id is a row like any other, repeated rows stay or go together; an empty
    benchmark drops nothing.
    """
    found = contaminated(docs, benchmark).select(F.col("text_hash").alias("_text_hash")).distinct()
    marked = F.broadcast(found) if found.count() <= BROADCAST_ROWS else found
    return docs.join(marked, F.xxhash64(docs["text"]) == marked["_text_hash"], "left_anti")
