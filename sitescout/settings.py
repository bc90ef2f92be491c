"""Tunable values and table names, in one immutable place."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # fixed values that decide results
    earth_radius_km: float = 6371.0
    containment_threshold: float = 0.5
    top_competitors: int = 5
    default_radius_km: float = 5.0
    suggestion_min_chars: int = 3
    suggestion_limit: int = 10

    # scale limits: they decide how a plan runs, never what it returns
    broadcast_bytes: int = 16 << 20
    rows_per_slice: int = 50_000
    pairs_per_slice: int = 25_000_000
    profiles_per_slice: int = 5_000
    places_per_slice: int = 5_000
    cell_degrees: float = 0.1


@dataclass(frozen=True)
class Tables:
    business_categories: str = "business_categories"
    category_profiles: str = "category_profiles"
    business_similarity: str = "business_similarity"
    checkin_hourly: str = "business_time_check_in"
    checkin_daily: str = "business_day_check_in"
    categories: str = "categories"
    users: str = "users"
    name_gender: str = "name_gender"
    directory: str = "business_info_table"
    sentiments: str = "business_sentiments"
    positive_words: str = "positive_words"
    negative_words: str = "negative_words"


SETTINGS = Settings()
TABLES = Tables()
