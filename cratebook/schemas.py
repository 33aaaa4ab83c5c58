"""Declared schemas, as DDL text, of the tidy tables and of the nested inputs."""

from __future__ import annotations

LIKED_PLAYLIST_ID = "__liked_songs__"  # fixed value: id of the synthetic liked collection
MIN_PLAY_MS = 30_000  # fixed value: shorter plays do not count


TABLES: dict[str, str] = {
    "playlists": (
        "playlist_id STRING, name STRING, description STRING, public BOOLEAN, collaborative BOOLEAN,"
        " snapshot_id STRING, track_count BIGINT, owner_id STRING, owner_name STRING,"
        " is_owned BOOLEAN, is_liked_songs BOOLEAN, uri STRING"
    ),
    "playlist_tracks": (
        "playlist_id STRING, track_id STRING, track_uri STRING, is_local BOOLEAN,"
        " added_at TIMESTAMP, added_by STRING, position BIGINT"
    ),
    "tracks": (
        "track_id STRING, name STRING, duration_ms BIGINT, explicit BOOLEAN, popularity INT,"
        " album_id STRING, album_name STRING, release_date STRING, track_number INT, isrc STRING,"
        " uri STRING, genres ARRAY<STRING>"
    ),
    "track_artists": ("track_id STRING, artist_id STRING, position INT"),
    "artists": (
        "artist_id STRING, name STRING, genres ARRAY<STRING>, popularity INT, followers BIGINT, uri STRING"
    ),
    "streaming_history": (
        "timestamp TIMESTAMP, artist_name STRING, track_name STRING, ms_played BIGINT, date DATE,"
        " hour INT, day_of_week STRING, day_of_week_num INT, month STRING, minutes_played DOUBLE,"
        " source STRING, album_name STRING, track_uri STRING, skipped BOOLEAN, track_id STRING"
    ),
    "search_queries": (
        "platform STRING, searchTime STRING, searchQuery STRING, searchInteractionURIs ARRAY<STRING>,"
        " timestamp TIMESTAMP, date DATE, hour INT, month STRING"
    ),
    "follow_data": ("user STRING, relationship STRING"),
    "library_snapshot": (
        "track_uri STRING, track_name STRING, artist_name STRING, album_name STRING,"
        " added_at TIMESTAMP, added_date DATE, track_id STRING"
    ),
    "sync_state": ("playlist_id STRING, snapshot_id STRING, synced_at TIMESTAMP"),
    "wrapped_data": ("file STRING, body STRING"),
}

# Nested inputs.
COLLECTION_PAGE = (
    "items ARRAY<STRUCT<id STRING, name STRING, description STRING, public BOOLEAN,"
    " collaborative BOOLEAN, snapshot_id STRING, tracks STRUCT<total BIGINT>,"
    " owner STRUCT<id STRING, display_name STRING>, uri STRING>>, next STRING"
)
MEMBERSHIP_PAGE = (
    "playlist_id STRING, offset BIGINT, items ARRAY<STRUCT<added_at STRING, added_by STRUCT<id STRING>,"
    " is_local BOOLEAN, track STRUCT<id STRING, uri STRING, is_local BOOLEAN>>>, total BIGINT, next STRING"
)
ITEMS_RESPONSE = (
    "tracks ARRAY<STRUCT<id STRING, name STRING, duration_ms BIGINT, explicit BOOLEAN, popularity INT,"
    " album STRUCT<id STRING, name STRING, release_date STRING>, track_number INT,"
    " external_ids STRUCT<isrc STRING>, uri STRING, artists ARRAY<STRUCT<id STRING, name STRING>>>>"
)
CREATORS_RESPONSE = (
    "artists ARRAY<STRUCT<id STRING, name STRING, genres ARRAY<STRING>, popularity INT,"
    " followers STRUCT<total BIGINT>, uri STRING>>"
)
BASIC_HISTORY = ("endTime STRING, artistName STRING, trackName STRING, msPlayed BIGINT")
EXTENDED_HISTORY = (
    "ts STRING, platform STRING, ms_played BIGINT, conn_country STRING,"
    " master_metadata_track_name STRING, master_metadata_album_artist_name STRING,"
    " master_metadata_album_album_name STRING, spotify_track_uri STRING, reason_start STRING,"
    " reason_end STRING, shuffle BOOLEAN, skipped BOOLEAN, offline BOOLEAN, incognito_mode BOOLEAN"
)
SEARCH_FILE = (
    "platform STRING, searchTime STRING, searchQuery STRING, searchInteractionURIs ARRAY<STRING>"
)
FOLLOW_FILE = (
    "userIsFollowing ARRAY<STRING>, userIsFollowedBy ARRAY<STRING>, userIsBlocking ARRAY<STRING>"
)
LIBRARY_FILE = (
    "tracks ARRAY<STRUCT<uri STRING, name STRING, artist STRUCT<name STRING>,"
    " album STRUCT<name STRING>, addedAt STRING>>"
)
TECH_LOG = ("timestamp_utc STRING, context_time BIGINT, fatal BOOLEAN, message_error_code STRING")
