"""cadenza: a Spark-native ETL and analytics library for music-track catalogues.

A flat table with one row per (track, genre) is cleaned, each track gets a
primary genre by cosine similarity against per-genre feature profiles, and
a star schema (artists, albums, tracks, genres, an artist-track bridge and a
popularity fact) is built.  Business questions, profiling and distribution
statistics run on that schema.  Everything is DataFrame / SQL work planned by
Catalyst; no Python runs per row.
"""

from cadenza.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
