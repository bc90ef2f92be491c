"""Offline jobs: raw files in, derived tables out.

A job writes one or more tables below ``out``. With ``previous``, the directory of an earlier
run, the new rows are written over the earlier ones by key and the merged tables go to ``out``.
Daily check-ins and sentiments are worked out anew, from all hours stored and all tips given.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitescout.operators import categories, checkins, directory, sentiment, similarity
from sitescout.schemas import KEYS
from sitescout.settings import SETTINGS, TABLES
from sitescout.sources import raw, tables


@dataclass(frozen=True)
class Run:
    spark: SparkSession
    source: str
    out: str
    previous: str | None = None
    mode: str = "FAILFAST"
    min_similarity: float = SETTINGS.containment_threshold
    word_lists: bool = False  # take the lexicon from two word lists, not from sentiments.csv
    name_gender: bool = False  # the source has a name_gender.csv

    def read(self, table: str) -> DataFrame:
        return tables.read_table(self.spark, self.out, table)

    def save(
        self,
        table: str,
        df: DataFrame,
        unique: bool = False,
        layout: Callable[[DataFrame], DataFrame] | None = None,
    ) -> None:
        """Write ``df``, merged with the previous table by key.

        Rows that lack a part of the key go to a table of their own, ``<table>_rejected``.
        ``unique`` says that no key comes twice; ``layout`` decides how the files are laid out.
        """
        keys = KEYS[table]
        rejected = df.where(reduce(or_, [F.col(k).isNull() for k in keys]))
        if not rejected.isEmpty():
            tables.write_table(rejected, self.out, f"{table}_rejected")
        rows = df.dropna(subset=list(keys))
        if self.previous is not None:
            rows = tables.upsert(tables.read_table(self.spark, self.previous, table), rows, keys)
        elif not unique:
            rows = tables.latest_per_key(rows, keys)
        tables.write_table(layout(rows) if layout else rows, self.out, table)


def save_directory(run: Run) -> None:
    businesses = raw.read_businesses(run.spark, run.source, run.mode)
    run.save(TABLES.directory, directory.business_directory(businesses), layout=tables.cluster_by_place)


def save_business_categories(run: Run) -> None:
    businesses = raw.read_businesses(run.spark, run.source, run.mode)
    run.save(TABLES.business_categories, categories.category_pairs(businesses), unique=True)


def save_categories(run: Run) -> None:
    pairs = run.read(TABLES.business_categories)
    run.save(TABLES.categories, categories.category_dictionary(pairs), unique=True)


def save_checkins(run: Run) -> None:
    """The hourly table, and the daily one from all hours stored, old and new."""
    run.save(TABLES.checkin_hourly, checkins.checkins_hourly(raw.read_checkins(run.spark, run.source, run.mode)))
    daily = checkins.checkins_daily(run.read(TABLES.checkin_hourly))
    run.save(TABLES.checkin_daily, daily, unique=True)


def save_users(run: Run) -> None:
    """The users, their genders filled in if the source names them."""
    users = directory.user_directory(raw.read_users(run.spark, run.source, run.mode))
    if run.name_gender:
        names = raw.read_name_gender(run.spark, os.path.join(run.source, "name_gender.csv"), run.mode)
        run.save(TABLES.name_gender, names)
        users = directory.enrich_users(users, run.read(TABLES.name_gender))
    elif run.previous is not None:
        users = users.drop("gender")  # those known already stay
    run.save(TABLES.users, users)


def save_lexicon(run: Run) -> None:
    """The two word tables."""
    if run.word_lists:
        lists = (("positive_words.txt", sentiment.POSITIVE), ("negative_words.txt", sentiment.NEGATIVE))
        positive, negative = [
            raw.read_word_list(run.spark, os.path.join(run.source, name), sign) for name, sign in lists
        ]
    else:
        scored = raw.read_lexicon_csv(run.spark, os.path.join(run.source, "sentiments.csv"), run.mode)
        positive, negative = sentiment.split_lexicon(scored)
    run.save(TABLES.positive_words, positive)
    run.save(TABLES.negative_words, negative)


def save_sentiments(run: Run) -> None:
    tokens = sentiment.tip_tokens(raw.read_tips(run.spark, run.source, run.mode))
    lexicon = sentiment.union_lexicon(run.read(TABLES.positive_words), run.read(TABLES.negative_words))
    scored = sentiment.business_sentiment(run.read(TABLES.directory), tokens, lexicon)
    run.save(TABLES.sentiments, scored, unique=True)


def save_similarity(run: Run) -> None:
    """Profiles and profile pairs; always of the whole category table, so never merged."""
    pairs = run.read(TABLES.business_categories)
    tables.write_table(similarity.category_profiles(pairs), run.out, TABLES.category_profiles)
    tables.write_table(
        similarity.pairwise_jaccard(pairs, run.min_similarity), run.out, TABLES.business_similarity
    )


# In the order in which they can run.
JOBS: dict[str, Callable[[Run], None]] = {
    "directory": save_directory,
    "business_categories": save_business_categories,
    "categories": save_categories,
    "checkins": save_checkins,
    "users": save_users,
    "lexicon": save_lexicon,
    "sentiments": save_sentiments,
    "similarity": save_similarity,
}


def run_jobs(run: Run, names: Iterable[str] = tuple(JOBS)) -> None:
    wanted = set(names)
    unknown = wanted - JOBS.keys()
    if unknown:
        raise ValueError(f"unknown jobs: {sorted(unknown)}")
    for name, job in JOBS.items():
        if name in wanted:
            job(run)

