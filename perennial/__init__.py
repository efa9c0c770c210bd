"""Perennial: music-catalog analytics on Spark.

Cleans song tables, lands song and event streams, scores genres for
timelessness and builds the ranked, joined and bucketed report tables. Every
operator is a function from DataFrame to DataFrame; actions happen only in the
writers and jobs.
"""

from perennial.params import ScoringParams, SurgeParams
from perennial.session import build_session, scratch_dir, tune

__all__ = ["ScoringParams", "SurgeParams", "build_session", "scratch_dir", "tune"]
