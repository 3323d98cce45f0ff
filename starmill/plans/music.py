"""Song catalogue and play log to a star schema (PIPE-1 to PIPE-3, JN-1 to JN-7, JN-10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.clean import or_default, safe_cast, text_or_default
from starmill.functions.keys import play_md5, play_uuid
from starmill.functions.timeparts import epoch_millis, time_parts
from starmill.operators.dedupe import distinct_of, first_of_repeated, first_per_key, latest_attributes, repeated_keys
from starmill.operators.filters import keep_type, require_values
from starmill.operators.joins import lookup_join

PLAY_PAGE = "NextSong"


# --- staging -------------------------------------------------------------------------------


def normalise_events(raw: DataFrame) -> DataFrame:
    """Raw log rows with plain names and types; a user id that is no number becomes NULL."""
    return raw.select(
        "page", "level", "gender", "location", "song", "artist", "length",
        epoch_millis(F.col("ts")).alias("start_time"),
        safe_cast(F.col("userId"), "int").alias("user_id"),
        F.col("sessionId").alias("session_id"),
        F.col("itemInSession").alias("item_in_session"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        F.col("userAgent").alias("user_agent"),
    )


def plays_of(events: DataFrame) -> DataFrame:
    """The play rows of a normalised log that have a time."""
    return require_values(keep_type(events, "page", PLAY_PAGE), ["start_time"])


# --- dimensions ----------------------------------------------------------------------------


def _artist_columns(impute: bool) -> list[Column]:
    location, lat, lon = F.col("artist_location"), F.col("artist_latitude"), F.col("artist_longitude")
    if impute:
        location, lat, lon = text_or_default(location), or_default(lat, 0.0), or_default(lon, 0.0)
    return [
        F.col("artist_id"),
        F.col("artist_name").alias("name"),
        location.alias("location"),
        lat.alias("latitude"),
        lon.alias("longitude"),
    ]


def songs_distinct(raw_songs: DataFrame) -> DataFrame:
    """Every distinct song row with an id."""
    songs = require_values(raw_songs, ["song_id"])
    return distinct_of(songs, ["song_id", "title", "artist_id", "year", "duration"])


def artists_distinct(raw_songs: DataFrame, impute: bool = True) -> DataFrame:
    """Every distinct artist row with an id; an artist may have several."""
    return distinct_of(require_values(raw_songs, ["artist_id"]), _artist_columns(impute))


def users_distinct(events: DataFrame, page: str | None = PLAY_PAGE) -> DataFrame:
    """Every distinct user row; a user who changed level has several."""
    rows = keep_type(events, "page", page) if page else events
    columns = ["user_id", "first_name", "last_name", "gender", "level"]
    return distinct_of(require_values(rows, ["user_id"]), columns)


def build_songs(raw_songs: DataFrame) -> DataFrame:
    """One row per song id."""
    songs = require_values(raw_songs, ["song_id", "title", "artist_id", "year"])
    return first_per_key(songs.select("song_id", "title", "artist_id", "year", "duration"), ["song_id"])


def build_artists(raw_songs: DataFrame, impute: bool = True) -> DataFrame:
    """One row per artist id, missing place and coordinates imputed."""
    artists = require_values(raw_songs, ["artist_id", "artist_name"])
    return first_per_key(artists.select(*_artist_columns(impute)), ["artist_id"])


def build_catalogue(raw_songs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(songs, artists) from the raw catalogue."""
    return build_songs(raw_songs), build_artists(raw_songs)


def build_users(plays: DataFrame) -> DataFrame:
    """One row per user: names of the first play, level of the most recent one."""
    rows = require_values(plays, ["user_id", "gender", "level", "start_time"]).select(
        "user_id", "first_name", "last_name", "gender", "level", F.col("start_time").alias("last_start_time")
    )
    users = latest_attributes(
        rows, ["user_id"], "last_start_time", ["level"], ["first_name", "last_name", "gender"]
    )
    return users.select("user_id", "first_name", "last_name", "gender", "level", "last_start_time")


def build_time(df: DataFrame, column: str = "start_time", convention: str = "monday0") -> DataFrame:
    """Distinct times with their calendar parts; only the time itself is shuffled."""
    times = require_values(df, [column]).select(F.col(column).alias("start_time")).distinct()
    return times.select("start_time", *time_parts(F.col("start_time"), convention))


def times_of(plays: DataFrame) -> DataFrame:
    """The times of plays with their partition, one row per play."""
    return plays.select("start_time", F.year("start_time").alias("year"), F.month("start_time").alias("month"))


def finish_time(rows: DataFrame) -> DataFrame:
    """Times with their calendar parts, made anew where they are written."""
    return rows.select("start_time", *time_parts(F.col("start_time")))


# --- facts ---------------------------------------------------------------------------------


def song_lookup(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with their artist's name: song_id, artist_id, title, name, duration."""
    names = artists.select("artist_id", "name")
    return lookup_join(songs, names, ["artist_id"]).select("song_id", "artist_id", "title", "name", "duration")


def _on_title_name_length(lookup: DataFrame, scale: int | None) -> DataFrame:
    return lookup.select(
        "song_id",
        "artist_id",
        F.col("title").alias("song"),
        F.col("name").alias("artist"),
        _at_scale(F.col("duration"), scale).alias("length"),
    )


def _at_scale(value: Column, scale: int | None) -> Column:
    return value if scale is None else F.round(value, scale)


def fact_first_match(plays: DataFrame, songs: DataFrame, artists: DataFrame, scale: int | None = None) -> DataFrame:
    """Each play with the ids of the first song that has its title, artist and length, or NULL.

    The lookup is cut to one row per (title, artist, length) first, so plays never multiply.
    """
    on = ["song", "artist", "length"]
    named = _on_title_name_length(song_lookup(songs, artists), scale)
    lookup = first_per_key(named, on, ["song_id"])
    rows = plays.withColumn("length", _at_scale(F.col("length"), scale))
    return lookup_join(rows, lookup, on, "left", measured=named)


def fact_inner_title(plays: DataFrame, songs: DataFrame, columns: list[str]) -> DataFrame:
    """Plays joined to songs on the title alone: a title that several songs share repeats the play.

    A song id has one title. Equal plays and equal songs are merged before the join, so the
    repeated rows are already distinct and are not shuffled again.
    """
    lookup = songs.select(F.col("title").alias("song"), "song_id", "artist_id").distinct()
    rows = require_values(plays, ["song"]).select(*columns, "song").distinct()
    joined = lookup_join(rows, lookup, ["song"], measured=songs, hot_from=plays)
    return joined.select(*columns, "song_id", "artist_id")


def fact_three_key(plays: DataFrame, raw_songs: DataFrame, scale: int | None = None) -> DataFrame:
    """Plays whose title, artist and length all match a song, keyed by MD5.

    ``scale`` rounds the length on both sides (0 compares whole seconds).
    """
    on = ["song", "artist", "length"]
    lookup = _on_title_name_length(raw_songs.withColumnRenamed("artist_name", "name"), scale)
    rows = require_values(plays, ["start_time"]).withColumn("length", _at_scale(F.col("length"), scale))
    joined = lookup_join(rows, lookup, on)
    return joined.select(
        play_md5(F.col("song_id"), F.col("start_time"), F.col("user_id")).alias("songplay_id"),
        "start_time",
        F.coalesce(F.col("user_id"), F.lit(-9999)).alias("user_id"),
        "level", "song_id", "artist_id", "session_id", "location", "user_agent",
    )


def fact_left_chain(plays: DataFrame, songs: DataFrame, artists: DataFrame, columns: list[str]) -> DataFrame:
    """Plays with the song of the same title and the artist of the same name, both optional.

    The artist id of the name match wins over the song's. Each lookup is cut to its distinct
    (text, id) pairs, which gives the same distinct result without repeating plays for
    artist rows that differ in place only.
    """
    by_title = songs.select(F.col("title").alias("song"), "song_id", F.col("artist_id").alias("_song_artist")).distinct()
    by_name = artists.select(F.col("name").alias("artist"), F.col("artist_id").alias("_artist")).distinct()
    rows = plays.select(*columns, "song", "artist")
    titled = lookup_join(rows, by_title, ["song"], "left", measured=songs)
    joined = lookup_join(titled, by_name, ["artist"], "left", measured=artists, hot_from=rows)
    return joined.select(
        *columns,
        "song_id",
        F.coalesce("_artist", "_song_artist").alias("artist_id"),
    ).distinct()


def unique_plays(plays: DataFrame, stored: bool = False) -> DataFrame:
    """The first play of each time, user and song, of which the key of the fact is made.

    ``stored`` tells that the plays lie in files, where a search for repeated ones costs less than moving all.
    """
    columns = ["level", "session_id", "item_in_session", "location", "user_agent", "artist", "length"]
    rows = require_values(plays, ["start_time", "user_id"]).select("start_time", "user_id", "song", *columns)
    key, order = ["start_time", "user_id", "song"], ["session_id", "item_in_session"]
    return first_of_repeated(rows, key, repeated_keys(rows, key), order) if stored else first_per_key(rows, key, order)


def keyed_plays(plays: DataFrame) -> DataFrame:
    """Unique plays with the key of the fact and its partition."""
    return plays.select(
        play_uuid(F.col("song"), F.col("start_time"), F.col("user_id"), six_digit_text=True).alias("songplay_id"),
        "*", F.year("start_time").alias("year"), F.month("start_time").alias("month"),
    )


def _fact_columns(rows: DataFrame) -> DataFrame:
    return keyed_plays(rows).select(
        "songplay_id", "start_time", "user_id", "level", "song_id", "artist_id", "session_id", "location",
        "user_agent", "year", "month", "song",
    )


def complete_plays(plays: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Keyed plays with the ids of their songs, and the song's title, which is in the key."""
    return _fact_columns(fact_first_match(plays.drop("songplay_id", "year", "month"), songs, artists))


def finish_plays(rows: DataFrame) -> DataFrame:
    """The fact's columns of complete plays; the key is made anew, a title moves cheaper than a digest."""
    return _fact_columns(rows.drop("songplay_id", "year", "month")).drop("song")


def build_songplays(plays: DataFrame, songs: DataFrame, artists: DataFrame) -> DataFrame:
    """The fact table: one row per play key, ids from the first full match.

    The key is a function of time, user and song, so repeated plays are removed on those
    columns before the join, and the key is computed once per row that stays.
    """
    return _fact_columns(fact_first_match(unique_plays(plays), songs, artists)).drop("song")


def build_plays(events: DataFrame, songs: DataFrame, artists: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(users, time, songplays) from a normalised log."""
    plays = plays_of(events)
    return build_users(plays), build_time(plays), build_songplays(plays, songs, artists)


def build_star(events: DataFrame, raw_songs: DataFrame) -> dict[str, DataFrame]:
    """The five tables from a normalised log and the raw catalogue.

    Both inputs are read several times: pass staged parquet, not parsed text.
    """
    songs, artists = build_catalogue(raw_songs)
    users, time, songplays = build_plays(events, songs, artists)
    return {"users": users, "songs": songs, "artists": artists, "time": time, "songplays": songplays}


# --- star queries --------------------------------------------------------------------------


def join_time(songplays: DataFrame, time: DataFrame) -> DataFrame:
    """Plays with their row of the time table."""
    return lookup_join(songplays, time, ["start_time"])


def join_all(star: dict[str, DataFrame]) -> DataFrame:
    """Plays with all four dimensions.

    Times and songs, which grow with the plays and the catalogue, come first: when they are shuffled,
    plays have few columns yet.
    """
    users = star["users"].select("user_id", "first_name", "last_name", "gender")
    songs = star["songs"].select("song_id", "title", "duration", F.col("year").alias("song_year"))
    artists = star["artists"].select("artist_id", "name", F.col("location").alias("artist_location"))
    time = star["time"].select("start_time", "hour", "day", "week", "weekday")
    rows = star["songplays"]
    for dimension, key in ((time, "start_time"), (songs, "song_id"), (artists, "artist_id"), (users, "user_id")):
        rows = lookup_join(rows, dimension, [key], hot_from=star["songplays"])
    return rows
