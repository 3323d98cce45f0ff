"""Event files to three tables, each shaped for one query (PIPE-9, SNK-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.filters import lookup, require_text
from starmill.schemas import QUERY_FIRST_TABLES, SLIM_EVENT_COLUMNS
from starmill.sinks.tables import upsert_last_write

SLIM_NAMES = {
    "firstName": "first_name",
    "lastName": "last_name",
    "itemInSession": "item_in_session",
    "sessionId": "session_id",
    "userId": "user_id",
}


def slim_events(raw: DataFrame) -> DataFrame:
    """The eleven used columns of rows that name an artist."""
    return require_text(raw, ["artist"]).select(*SLIM_EVENT_COLUMNS)


def table_rows(slim: DataFrame, name: str) -> DataFrame:
    """Columns of one query-first table, in its types; an empty user id is NULL."""
    schema = QUERY_FIRST_TABLES[name].schema
    renamed = slim.withColumnsRenamed(SLIM_NAMES)
    return renamed.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


# Which key columns choose the partition; the rest order rows inside it.
PARTITION_KEYS = {
    "session_songs": ["session_id"],
    "user_sessions": ["user_id", "session_id"],
    "song_users": ["song"],
}


def load_query_tables(slim: DataFrame, base: str) -> None:
    """Write the three tables, one row per primary key."""
    for name, table in QUERY_FIRST_TABLES.items():
        rows = table_rows(slim, name)
        partition = PARTITION_KEYS[name]
        clustering = [c for c in table.key if c not in partition]
        upsert_last_write(rows, f"{base}/{name}", partition, clustering, [], distinct=name == "song_users")


def item_of_session(session_songs: DataFrame, session_id: int, item: int) -> DataFrame:
    """Artist, song and length at one place of a session."""
    row = lookup(session_songs, session_id=session_id, item_in_session=item)
    return row.select("artist", "song", "length")


def songs_of_session(user_sessions: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """What a user heard in a session, in order."""
    rows = lookup(user_sessions, user_id=user_id, session_id=session_id)
    return rows.orderBy("item_in_session").select("artist", "song", "first_name", "last_name")


def listeners_of(song_users: DataFrame, song: str) -> DataFrame:
    """Names of everyone who heard a song."""
    return lookup(song_users, song=song).select("first_name", "last_name")
