"""Parameters of the scorer, the surges and the reports."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class ScoringParams:
    bucket_years: int = 10
    year_start: int = 1900
    year_end: int = 2030
    min_songs_per_bucket: int = 10
    min_buckets: int = 2
    min_total_songs: int = 50

    @property
    def max_buckets(self) -> float:
        """Divisor of the presence score: 26.0 for the default decades.

        Half a bucket length is used on purpose; it caps the presence score of
        decades at 53.8 and with it the whole score near 90.8.
        """
        return float((self.year_end - self.year_start + 1) // (self.bucket_years / 2))


@dataclass(frozen=True)
class SurgeParams:
    lifetime_seconds: int = 30
    max_popularity: int = 100


# Weights of the score components.
CONSISTENCY_WEIGHT = 0.35
LONGEVITY_WEIGHT = 0.25
STABILITY_WEIGHT = 0.20
PRESENCE_WEIGHT = Decimal("0.20")

# Fixed values: (upper bound of the average popularity, penalty).
POPULARITY_PENALTIES = ((30, 15), (45, 8), (60, 3))

# Fixed values: (years before the end of the analysis, penalty).
RECENCY_PENALTIES = ((20, 12), (10, 6))

# Fixed values: (lower bound of the average popularity, tier).
POPULARITY_TIERS = ((70, "high"), (45, "medium"))
LOWEST_TIER = "low"

# Size of the report tables.
RECENT_SONGS = 10_000
RECENT_TRENDS = 1_000
RECENT_EVENTS = 1_000
