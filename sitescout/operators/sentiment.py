"""Words of customer tips, and the sentiment of a business by a lexicon.

The words of a business are held as a bag, (word, n) rows, not as one list: a business with a
third of all tips would make a list that no task can hold, while its distinct words are few.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitescout.functions.text import ENGLISH_STOP_WORDS, is_word, words
from sitescout.joins import cut_lineage, fits_broadcast, join_hot, keep_selected, lookup_join
from sitescout.settings import SETTINGS

POSITIVE, NEGATIVE = 1, -1


def tip_tokens(
    tips: DataFrame, stop_words: tuple[str, ...] = ENGLISH_STOP_WORDS, lowercase: bool = False
) -> DataFrame:
    """One row per word of each tip, without stop words: (the columns but text, word).

    Case and repeats are kept unless ``lowercase`` asks for folded words, which the lexicon join
    would otherwise tell apart.
    """
    text = F.lower("text") if lowercase else F.col("text")
    carried = [c for c in tips.columns if c != "text"]
    return tips.select(*carried, F.explode(words(text)).alias("word")).where(
        is_word(F.col("word"), tuple(stop_words))
    )


def tip_bag(business: DataFrame, tokens: DataFrame) -> DataFrame:
    """(business_id, word, n): the words of each business with their number.

    A business without tips has one row, with no word and n = 0. Words of businesses that are
    not in the directory are left out.
    """
    counted = cut_lineage(tokens.groupBy("business_id", "word").agg(F.count("*").alias("n")))
    known = business.select("business_id").distinct()
    bags = counted.join(known, "business_id", "left_semi")
    without = known.join(counted.select("business_id").distinct(), "business_id", "left_anti")
    nothing = without.select("business_id", F.lit(None).cast("string").alias("word"), F.lit(0).cast("long").alias("n"))
    return bags.unionByName(nothing)


def split_lexicon(lexicon: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The positive (+1) and the negative (-1) words; other values go to neither."""
    return (
        lexicon.where(F.col("sentiment") == POSITIVE),
        lexicon.where(F.col("sentiment") == NEGATIVE),
    )


def union_lexicon(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """Both word tables in one; a word in both appears twice."""
    return positive.unionByName(negative)


def lexicon_join(
    tokens: DataFrame, lexicon: DataFrame, max_lexicon_bytes: int = SETTINGS.broadcast_bytes
) -> DataFrame:
    """The tokens found in the lexicon with their sentiment, matched by exact case.

    A word in both lexicons matches twice. The lexicon goes through the join as one row per
    word with its list of sentiments, so tokens need no shuffle while it fits a broadcast. Beyond
    that equal tokens are counted, looked up once, and repeated after it.
    """
    by_word = lexicon.groupBy("word").agg(F.collect_list(F.struct("sentiment")).alias("_matches"))
    columns = tokens.columns
    if fits_broadcast(by_word, max_lexicon_bytes):
        joined = tokens.join(F.broadcast(by_word), "word")
    else:
        counted = tokens.groupBy(*columns).agg(F.count("*").alias("_n"))
        joined = join_hot(counted, by_word, "word", F.struct(*columns), how="inner")
        joined = joined.withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return joined.select(*columns, F.inline("_matches"))


def _signs(lexicon: DataFrame) -> DataFrame:
    """One row per word: whether it is a positive word, a negative word, or both."""
    return (
        lexicon.where(F.col("sentiment").isin(POSITIVE, NEGATIVE))
        .groupBy("word")
        .agg(
            F.max((F.col("sentiment") == POSITIVE).cast("int")).alias("pos"),
            F.max((F.col("sentiment") == NEGATIVE).cast("int")).alias("neg"),
        )
    )


def _scored_words(
    tokens: DataFrame, lexicon: DataFrame, max_lexicon_bytes: int, per_slice: int
) -> DataFrame:
    """(business_id, word, pos, neg, n) per lexicon word of a business, and one row with no word
    for all its other tokens."""
    signs = _signs(lexicon)
    tokens = tokens.select("business_id", "word")
    if fits_broadcast(signs, max_lexicon_bytes):
        # Looked up before counting: only lexicon words are counted one by one and shuffled.
        found = tokens.join(F.broadcast(signs), "word", "left")
        weight = F.count("*")
    else:
        # Counted first, so that a word on every page is shuffled once per business only.
        counted = tokens.groupBy("business_id", "word").agg(F.count("*").alias("n"))
        found = lookup_join(
            counted, signs, "word", F.col("business_id"), max_bytes=0, per_slice=per_slice
        )
        weight = F.sum("n")
    found = found.withColumn("word", F.when(F.col("pos").isNotNull(), F.col("word")))
    return found.groupBy("business_id", "word", "pos", "neg").agg(weight.alias("n"))


def business_sentiment(
    business: DataFrame,
    tokens: DataFrame,
    lexicon: DataFrame,
    max_lexicon_bytes: int = SETTINGS.broadcast_bytes,
    per_slice: int = SETTINGS.rows_per_slice,
) -> DataFrame:
    """One row per business of the directory with the sentiment of its tips.

    (business_id, n_tokens, avg_sentiments, predicted, pos_words, neg_words). The score is the
    mean of +1 and -1 over all matches, repeats counted; ``predicted`` is 1.0 if it is above 0,
    else 0.0. ``pos_words`` and ``neg_words`` are arrays of (word, n) in the order of the words.
    Score, prediction and words are NULL where nothing matched. A token is read once, and met
    with the lexicon once.
    """
    scored = _scored_words(tokens, lexicon, max_lexicon_bytes, per_slice)
    pos, neg, n = F.col("pos"), F.col("neg"), F.col("n")

    def found(sign: Column) -> Column:
        listed = F.sort_array(F.collect_list(F.when(sign == 1, F.struct("word", "n"))))
        return F.when(F.size(listed) > 0, listed)

    summed = scored.groupBy("business_id").agg(
        F.sum("n").alias("n_tokens"),
        F.sum(n * (pos - neg)).alias("_total"),
        F.sum(n * (pos + neg)).alias("_matches"),
        found(pos).alias("pos_words"),
        found(neg).alias("neg_words"),
    )
    average = F.try_divide("_total", "_matches")
    return (
        business.select("business_id")
        .distinct()
        .join(summed, "business_id", "left")
        .select(
            "business_id",
            F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
            average.alias("avg_sentiments"),
            F.when(average > 0, F.lit(1.0)).when(average <= 0, F.lit(0.0)).alias("predicted"),
            "pos_words",
            "neg_words",
        )
    )


def sentiment_words(sentiments: DataFrame, polarity: int) -> DataFrame:
    """(business_id, word, n) of the positive (+1) or negative (-1) words."""
    column = {POSITIVE: "pos_words", NEGATIVE: "neg_words"}[polarity]
    return sentiments.select("business_id", F.inline(column))


def word_counts(sentiments: DataFrame, ids: DataFrame, polarity: int) -> DataFrame:
    """(text, size): how often the selected businesses' tips use each word of one polarity."""
    return (
        sentiment_words(keep_selected(sentiments, ids), polarity)
        .groupBy(F.col("word").alias("text"))
        .agg(F.sum("n").alias("size"))
    )
