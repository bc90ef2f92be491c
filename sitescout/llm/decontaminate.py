"""Benchmark decontamination with a distributed positional inverted index.

Each benchmark item is cut into windows of 13 words (a shorter one is one window). The words of
the windows are counted over the whole corpus. For each window the places of its two rarest
words are taken from the index of (term, document, position) postings, shifted by the word's
place in the window, and intersected. What is left is compared with the window word by word, by
the words that the index keeps around the places of the rarest. ``proximity`` returns exact and
proximity matches from the same index: each word of a window stands at most ``slack`` words from its place.

Words are runs of digits, letters a-z and all characters beyond ASCII, after A-Z are made lower
case. Null texts, and items without words, match nothing. Rows equal in id and text are one
document and get the same answer; null ids are allowed. The benchmark may be any size: it is
broadcast if it is small, and joined by shuffle otherwise. ``contamination`` reads doc_id and text
only; ``decontaminate`` passes all columns through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitescout.llm.common import broadcast_if_small, broadcast_parts, stored

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW, RAREST = 13, 2
ROW = ["doc_id", "_text_hash"]


def _lowered(word: Column) -> Column:
    is_ascii = F.octet_length(word) == F.char_length(word)
    mixed = F.when(word.rlike("[A-Z]"), F.translate(word, UPPER, LOWER)).otherwise(word)
    return F.when(is_ascii, F.lower(word)).otherwise(mixed)


def words(text: str = "text") -> Column:
    """The words of a text. A text of ASCII characters is made lower case as a whole."""
    of = F.col(text)
    is_ascii = F.octet_length(of) == F.char_length(of)
    split = F.array_remove(F.split(F.when(is_ascii, F.lower(of)).otherwise(of), SEPARATORS, -1), "")
    return F.when(is_ascii, split).otherwise(F.transform(split, _lowered))


def parsed(docs: DataFrame) -> DataFrame:
    """(doc_id, _text_hash, words, n_words), one row per document."""
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    held = held.select("doc_id", F.xxhash64("text").alias("_text_hash"), words().alias("words"))
    return held.withColumn("n_words", F.size("words").cast("long"))


def phrase_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, item_id, phrase) of every item; ``window`` numbers equal phrases alike."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("_words"))
    items = items.where(F.size("_words") > 0)
    last = F.greatest(F.size("_words") - size, F.lit(0))
    phrases = items.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_words", i + 1, size))).alias("phrase"))
    return phrases.select(F.sha2(F.array_join("phrase", " ").cast("binary"), 256).alias("window"), "item_id", "phrase").distinct()


def window_terms(phrases: DataFrame, corpus: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(window, rank, term, place): the rarest terms of each window, rank 1 being the rarest.

    Windows with a word that the corpus does not have are left out: they cannot occur.
    """
    places = phrases.select("window", "phrase").distinct().select("window", F.posexplode("phrase").alias("place", "term"))
    terms = broadcast_if_small(stored(places.select("term").distinct()))
    counts = corpus.select(F.explode("words").alias("term")).join(terms, "term").groupBy("term").agg(F.count("*").alias("n"))
    counted = places.join(counts, "term", "left")
    by_rarity = Window.partitionBy("window").orderBy("n", "place")
    ranked = counted.select(
        "*",
        F.row_number().over(by_rarity).alias("rank"),
        F.min(F.coalesce("n", F.lit(0))).over(Window.partitionBy("window")).alias("least"),
    )
    return ranked.where((F.col("least") > 0) & (F.col("rank") <= rarest)).select("window", "rank", "term", "place")


def postings(corpus: DataFrame, terms: DataFrame, size: int = WINDOW) -> DataFrame:
    """The index: (term, doc_id, _text_hash, position, around) of ``terms`` (term, is_rarest).

    ``around`` has the words within a window's length of the position, for the rarest terms. Terms
    too many for one broadcast are looked up in several passes.
    """
    position = F.col("position")
    first = F.greatest(position - (size - 1), F.lit(0))
    around = F.when(F.col("is_rarest"), F.slice("words", first + 1, position - first + size))
    placed = corpus.select(*ROW, "words", F.posexplode("words").alias("position", "term"))
    passes = [placed.join(part, "term").select("term", *ROW, "position", around.alias("around")) for part in broadcast_parts(terms, "term")]
    return reduce(DataFrame.unionByName, passes)


def intersect(index: DataFrame, terms: DataFrame, slack: int = 0) -> DataFrame:
    """(window, doc_id, _text_hash, start, position): where the rarest terms stand as in a window.

    ``position`` is that of the rarest term. With ``slack`` the second rarest may stand up to so
    many words nearer or farther: what ``proximity_matches`` looks through. Windows of one word have one list.
    """
    terms = broadcast_if_small(stored(terms))
    shifted = index.join(terms, "term").select(
        "window", "rank", *ROW, (F.col("position") - F.col("place")).alias("start"), "position"
    )
    single = terms.groupBy("window").agg(F.max("rank").alias("lists")).where("lists = 1").select("window")
    first = shifted.where("rank = 1").drop("rank")
    others = shifted.where("rank > 1").select("window", *ROW, "start")
    if slack:
        spread = F.explode(F.sequence(F.col("start") - slack, F.col("start") + slack))
        others = others.select("window", *ROW, spread.alias("start")).distinct()
    alone = first.join(single, "window", "left_semi")
    other = others.withColumnsRenamed({"window": "_w", "doc_id": "_d", "_text_hash": "_h", "start": "_s"})
    same = (first["window"] == other["_w"]) & first["doc_id"].eqNullSafe(other["_d"])
    same &= (first["_text_hash"] == other["_h"]) & (first["start"] == other["_s"])
    return first.join(other, same, "left_semi").unionByName(alone).where(F.col("start") >= -slack).distinct()


def _in_context(index: DataFrame, candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates with the words around their rarest term and the phrase that may stand there."""
    phrases = broadcast_if_small(phrases.select("window", "phrase").distinct())
    context = index.where("around is not null").select(
        F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h"), F.col("position").alias("_p"), "around"
    )
    same = candidates["doc_id"].eqNullSafe(context["_d"]) & (candidates["_text_hash"] == context["_h"])
    same &= candidates["position"] == context["_p"]
    return candidates.join(context, same).join(phrases, "window")


def phrase_matches(index: DataFrame, candidates: DataFrame, phrases: DataFrame, size: int = WINDOW) -> DataFrame:
    """(window, doc_id, _text_hash, start, length): candidates that have the window word by word."""
    first = F.greatest(F.col("position") - (size - 1), F.lit(0))
    return (
        _in_context(index, candidates, phrases)
        .where(F.slice("around", F.col("start") - first + 1, F.size("phrase")) == F.col("phrase"))
        .select("window", *ROW, "start", F.size("phrase").alias("length"))
        .distinct()
    )


def proximity_matches(index: DataFrame, candidates: DataFrame, phrases: DataFrame, size: int, slack: int) -> DataFrame:
    """(window, doc_id, _text_hash, start, length, exact): candidates with every word of the window near its place.

    ``index`` keeps ``size + slack`` words around a place. ``start`` is where the window's first word would
    be, by the place of its rarest; it is negative if the document begins later. ``exact`` says that all
    words are in place.
    """
    first = F.greatest(F.col("position") - (size + slack - 1), F.lit(0))

    def stands(j: Column, reach: int) -> Column:
        place = F.col("start") + j - first
        low = F.greatest(place - reach, F.lit(0))
        near = F.slice("around", low + 1, F.greatest(place + reach - low + 1, F.lit(0)))
        return F.array_contains(near, F.element_at("phrase", j + 1))

    places = F.sequence(F.lit(0), F.size("phrase") - 1)
    met = _in_context(index, candidates, phrases).where(F.forall(places, lambda j: stands(j, slack)))
    exact = F.forall(places, lambda j: stands(j, 0))
    return met.select("window", *ROW, "start", F.size("phrase").alias("length"), exact.alias("exact")).distinct()


def find_phrases(corpus: DataFrame, phrases: DataFrame, size: int = WINDOW) -> DataFrame:
    """Every occurrence of every window in the documents. Both tables are stored ones."""
    terms = stored(window_terms(phrases, corpus))
    keys = stored(terms.groupBy("term").agg((F.min("rank") == 1).alias("is_rarest")))
    index = stored(postings(corpus, keys, size))
    return phrase_matches(index, stored(intersect(index, terms)), phrases, size)


def find_near_phrases(corpus: DataFrame, phrases: DataFrame, slack: int, size: int = WINDOW) -> DataFrame:
    """Every place of every window's rarest word that has the others near. Both tables are stored ones."""
    terms = stored(window_terms(phrases, corpus))
    keys = stored(terms.groupBy("term").agg((F.min("rank") == 1).alias("is_rarest")))
    index = stored(postings(corpus, keys, size + slack))
    return proximity_matches(index, stored(intersect(index, terms, slack)), phrases, size, slack)


def proximity(docs: DataFrame, benchmark: DataFrame, slack: int, size: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, start, length, exact): exact phrase and proximity matches of benchmark windows.

    Repeated rows of ``docs`` or ``benchmark`` give each match once. With a ``slack`` of 0 all are exact.
    """
    if slack < 0:
        raise ValueError("slack must not be negative")
    phrases = stored(phrase_windows(benchmark, size))
    matches = find_near_phrases(stored(parsed(docs)), phrases, slack, size)
    items = broadcast_if_small(phrases.select("window", "item_id"))
    return matches.join(items, "window").select("doc_id", "item_id", "start", "length", "exact").distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, least: float = 0.05) -> DataFrame:
    """doc_id, _text_hash, n_words, n_hit, n_items, items_sha256, contaminated for each row.

    A word is hit if any occurrence of a window covers it. A document is contaminated if its hit
    words are at least the share ``least`` of its words.
    """
    phrases = stored(phrase_windows(benchmark, size))
    corpus = stored(parsed(docs))
    matches = stored(find_phrases(corpus, phrases, size))
    covered = matches.select(*ROW, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("p"))
    hits = covered.distinct().groupBy(*ROW).agg(F.count("*").alias("n_hit"))
    items = (
        matches.select("window", *ROW)
        .distinct()
        .join(broadcast_if_small(phrases.select("window", "item_id")), "window")
        .groupBy(*ROW)
        .agg(F.array_sort(F.collect_set(F.coalesce("item_id", F.lit("")))).alias("items"))
    )
    items = items.select(F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h"), "items")
    found = hits.join(items, hits["doc_id"].eqNullSafe(items["_d"]) & (hits["_text_hash"] == items["_h"]))
    found = found.select(F.col("doc_id").alias("_doc"), F.col("_text_hash").alias("_hash"), "n_hit", "items")
    found = broadcast_if_small(stored(found))
    rows = corpus.select(*ROW, "n_words")
    joined = rows.join(found, rows["doc_id"].eqNullSafe(found["_doc"]) & (rows["_text_hash"] == found["_hash"]), "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return joined.select(
        *ROW,
        "n_words",
        n_hit.alias("n_hit"),
        F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (round(1 / least) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, least: float = 0.05) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    bad = contamination(docs, benchmark, size, least).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("_doc"), F.col("_text_hash").alias("_hash")).distinct()
    bad = broadcast_if_small(stored(bad))
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_doc"]) & (text_hash == bad["_hash"]), "left_anti")
