"""Deterministic keys computed from row content (KEY-1, KEY-2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_ID = "-9999"


def uuid5_nil(name: Column) -> Column:
    """RFC 4122 version-5 UUID of ``name`` in the nil namespace, as 36 characters."""
    digest = F.sha1(F.concat(F.unhex(F.lit("0" * 32)), F.encode(name, "UTF-8")))
    # the variant digit keeps its two low bits and gets the high bits 10
    low_bits = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(F.lower(F.hex(low_bits + 8)), F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def six_digit_time_text(ts: Column) -> Column:
    """Time as text with six fraction digits, or none when the fraction is zero."""
    whole = F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
    return F.when(F.date_trunc("SECOND", ts) == ts, whole).otherwise(
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def play_uuid(song: Column, ts: Column, user_id: Column, six_digit_text: bool = False) -> Column:
    """Key of one play: UUIDv5 of song, time and user written one after the other.

    ``six_digit_text`` writes the time as dataframe libraries print it and a missing value as
    ``None``; the default uses Spark's own text and an empty string.
    """
    missing = F.lit("None" if six_digit_text else "")
    time_text = six_digit_time_text(ts) if six_digit_text else ts.cast("string")
    parts = (song.cast("string"), time_text, user_id.cast("string"))
    return uuid5_nil(F.concat(*[F.coalesce(p, missing) for p in parts]))


def play_md5(song_id: Column, ts: Column, user_id: Column) -> Column:
    """MD5 of song id, time and user; a missing user counts as ``-9999``.

    NULL when song id or time is NULL, as SQL's ``||`` gives.
    """
    user = F.coalesce(user_id.cast("string"), F.lit(MISSING_ID))
    return F.md5(F.concat(song_id.cast("string"), ts.cast("string"), user).cast("binary"))
