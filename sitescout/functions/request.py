"""Values of a report request, as they come from a form or command line."""

from __future__ import annotations

from collections.abc import Iterable


def wanted_categories(value: str | Iterable[str]) -> list[str]:
    """Wanted categories from a comma-separated text or a list: trimmed, no blanks, no repeats."""
    parts = value.split(",") if isinstance(value, str) else value
    wanted = list(dict.fromkeys(p.strip() for p in parts if p and p.strip()))
    if not wanted:
        raise ValueError("at least one category is needed")
    return wanted


def coordinates(lat: str | float, lon: str | float) -> tuple[float, float]:
    lat, lon = float(lat), float(lon)
    if not (-90 <= lat <= 90 and -180 <= lon <= 180):
        raise ValueError(f"not a place on Earth: latitude {lat}, longitude {lon}")
    return lat, lon


def radius(km: str | float) -> float:
    km = float(km)
    if not 0 < km < float("inf"):
        raise ValueError(f"not a radius in km: {km}")
    return km
