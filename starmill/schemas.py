"""Declared tables: columns, keys, constraints, widths and layout (SNK-11).

Parquet enforces no constraints, so the declarations feed the checks in
``operators.quality`` and the layout arguments of ``sinks.tables``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starmill.operators import quality


def _schema(**columns: str | T.DataType) -> T.StructType:
    schema = T.StructType()
    for name, type_name in columns.items():
        schema.add(name, type_name)
    return schema


_TEXTS = T.ArrayType(T.StringType())

# Field names of the raw inputs, spelled as the sources spell them, and the
# column names, keys and widths of the tables built from them.

RAW_SONGS = _schema(
    artist_id="string", artist_latitude="double", artist_location="string",
    artist_longitude="double", artist_name="string", duration="double", num_songs="integer",
    song_id="string", title="string", year="integer",
)

RAW_EVENTS = _schema(
    artist="string", auth="string", firstName="string", gender="string", itemInSession="integer",
    lastName="string", length="double", level="string", location="string", method="string",
    page="string", registration="double", sessionId="integer", song="string", status="integer",
    ts="long", userAgent="string", userId="string",
)

RAW_EVENTS_CSV = _schema(
    artist="string", auth="string", firstName="string", gender="string", itemInSession="integer",
    lastName="string", length="double", level="string", location="string", method="string",
    page="string", registration="string", sessionId="integer", song="string", status="integer",
    ts="string", userId="string",
)

SLIM_EVENT_COLUMNS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length",
    "level", "location", "sessionId", "song", "userId",
]

RAW_LABEL_DOCUMENT = _schema(
    results=T.ArrayType(
        _schema(
            active_ingredient=_TEXTS, adverse_reactions=_TEXTS, drug_interactions=_TEXTS,
            indications_and_usage=_TEXTS, warnings=_TEXTS,
            openfda=_schema(package_ndc=_TEXTS, generic_name=_TEXTS, brand_name=_TEXTS),
        )
    )
)

RAW_REPORT_DOCUMENT = _schema(
    results=T.ArrayType(
        _schema(
            safetyreportid="string", receivedate="string", receiptdate="string",
            seriousnesshospitalization="string", seriousnessdeath="string",
            seriousnesslifethreatening="string", seriousnessdisabling="string",
            seriousnesscongenitalanomali="string",
            patient=_schema(
                patientdeath=_schema(patientdeathdate="string"),
                drug=T.ArrayType(_schema(openfda=_schema(package_ndc=_TEXTS))),
                reaction=T.ArrayType(_schema(reactionmeddrapt="string")),
            ),
        )
    )
)

RAW_PRICING = _schema(
    as_of_date="string", classification_for_rate_setting="string",
    corresponding_generic_drug_effective_date="string",
    corresponding_generic_drug_nadac_per_unit="double", effective_date="string",
    explanation_code="string", nadac_per_unit="double", ndc="string", ndc_description="string",
    otc="string", pharmacy_type_indicator="string", pricing_unit="string",
)


@dataclass(frozen=True)
class Table:
    """One declared table."""

    name: str
    schema: T.StructType
    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)


MUSIC_TABLES = {
    t.name: t
    for t in [
        Table(
            "users",
            _schema(
                user_id="integer", first_name="string", last_name="string", gender="string",
                level="string", last_start_time="timestamp_ntz",
            ),
            key=("user_id",),
            not_null=("user_id", "gender", "level"),
            sort_by=("user_id",),
        ),
        Table(
            "songs",
            _schema(song_id="string", title="string", artist_id="string", year="integer", duration="double"),
            key=("song_id",),
            not_null=("song_id", "title", "artist_id", "year"),
            partition_by=("year",),
            sort_by=("song_id",),
        ),
        Table(
            "artists",
            _schema(
                artist_id="string", name="string", location="string", latitude="double",
                longitude="double",
            ),
            key=("artist_id",),
            not_null=("artist_id", "name"),
            sort_by=("artist_id",),
        ),
        Table(
            "time",
            _schema(
                start_time="timestamp_ntz", hour="integer", day="integer", week="integer",
                month="integer", year="integer", weekday="integer",
            ),
            key=("start_time",),
            not_null=("start_time", "hour", "day", "week", "month", "year", "weekday"),
            partition_by=("year", "month"),
            sort_by=("start_time",),
        ),
        Table(
            "songplays",
            _schema(
                songplay_id="string", start_time="timestamp_ntz", user_id="integer", level="string",
                song_id="string", artist_id="string", session_id="integer", location="string",
                user_agent="string", year="integer", month="integer",
            ),
            key=("songplay_id",),
            not_null=("songplay_id", "start_time", "user_id"),
            foreign_keys=(
                ("start_time", "time", "start_time"),
                ("user_id", "users", "user_id"),
                ("song_id", "songs", "song_id"),
                ("artist_id", "artists", "artist_id"),
            ),
            partition_by=("year", "month"),
            sort_by=("start_time",),
        ),
    ]
}

QUERY_FIRST_TABLES = {
    t.name: t
    for t in [
        Table(
            "session_songs",
            _schema(
                session_id="integer", item_in_session="integer", artist="string", song="string",
                length="double",
            ),
            key=("session_id", "item_in_session"),
            sort_by=("session_id", "item_in_session"),
        ),
        Table(
            "user_sessions",
            _schema(
                user_id="integer", session_id="integer", item_in_session="integer", artist="string",
                song="string", first_name="string", last_name="string",
            ),
            key=("user_id", "session_id", "item_in_session"),
            sort_by=("user_id", "session_id", "item_in_session"),
        ),
        Table(
            "song_users",
            _schema(song="string", user_id="integer", first_name="string", last_name="string"),
            key=("song", "user_id"),
            sort_by=("song", "user_id"),
        ),
    ]
}

DRUG_TABLES = {
    t.name: t
    for t in [
        Table(
            "drug_events",
            _schema(
                drug_event_id="long", formatted_ndc="string", package_ndc="string",
                safetyreportid="string",
            ),
            key=("drug_event_id",),
            not_null=("formatted_ndc", "package_ndc", "safetyreportid"),
            foreign_keys=(
                ("formatted_ndc", "ndc", "ndc"),
                ("safetyreportid", "safety_reports", "safetyreportid"),
            ),
            sort_by=("formatted_ndc",),
            widths={"formatted_ndc": 11, "package_ndc": 20, "safetyreportid": 9},
        ),
        Table(
            "reactions",
            _schema(reactions_id="long", reactionmeddrapt="string", safetyreportid="string"),
            key=("reactions_id",),
            not_null=("reactionmeddrapt", "safetyreportid"),
            foreign_keys=(("safetyreportid", "safety_reports", "safetyreportid"),),
            sort_by=("safetyreportid",),
            widths={"safetyreportid": 9},
        ),
        Table(
            "safety_reports",
            _schema(
                patientdeath="boolean", receiptdate="date", receivedate="date",
                safetyreportid="string", seriousnesscongenitalanomali="boolean",
                seriousnessdeath="boolean", seriousnessdisabling="boolean",
                seriousnesshospitalization="boolean", seriousnesslifethreatening="boolean",
            ),
            key=("safetyreportid",),
            not_null=("safetyreportid",),
            sort_by=("safetyreportid",),
            widths={"safetyreportid": 9},
        ),
        Table(
            "labels",
            _schema(
                labels_id="long", active_ingredient="string", adverse_reactions="string",
                brand_name="string", drug_interactions="string", formatted_ndc="string",
                generic_name="string", indications_and_usage="string", package_ndc="string",
                warnings="string",
            ),
            key=("labels_id",),
            foreign_keys=(("formatted_ndc", "ndc", "ndc"),),
            sort_by=("formatted_ndc",),
            widths={"formatted_ndc": 11, "package_ndc": 20},
        ),
        Table(
            "pricing",
            _schema(
                pricing_id="long", as_of_date="timestamp_ntz",
                classification_for_rate_setting="string",
                corresponding_generic_drug_effective_date="timestamp_ntz",
                corresponding_generic_drug_nadac_per_unit="double", effective_date="timestamp_ntz",
                explanation_code="string", nadac_per_unit="double", ndc="string",
                ndc_description="string", otc="string", pharmacy_type_indicator="string",
                pricing_unit="string",
            ),
            key=("pricing_id",),
            not_null=("ndc",),
            foreign_keys=(("ndc", "ndc", "ndc"),),
            sort_by=("ndc",),
            widths={"ndc": 11},
        ),
        Table("ndc", _schema(ndc="string"), key=("ndc",), not_null=("ndc",), sort_by=("ndc",), widths={"ndc": 11}),
    ]
}


def create_tables(spark: SparkSession, tables: dict[str, Table], base: str, database: str = "default") -> None:
    """Register each declared table as an external parquet table under ``base``."""
    for table in tables.values():
        name = f"{database}.{table.name}"
        if spark.catalog.tableExists(name):
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
        layout = f"PARTITIONED BY ({', '.join(table.partition_by)})" if table.partition_by else ""
        location = f"LOCATION '{base}/{table.name}'"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} {location}")


def drop_tables(spark: SparkSession, tables: dict[str, Table], database: str = "default") -> None:
    """Remove the registrations; files of external tables stay."""
    for name in tables:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")


def table_checks(
    tables: dict[str, Table], frames: dict[str, DataFrame], loaded: dict[str, DataFrame] | None = None
) -> list[quality.Check]:
    """Checks for every declared key, NOT NULL column and foreign key of the given frames.

    ``loaded`` names the part of a table to look at, such as the partitions a load has touched;
    that a table is not empty is asked of the whole. The part of a parent must hold all keys that the
    parts of its children use.
    """
    checks = []
    for name, whole in frames.items():
        table = tables[name]
        checks.append(quality.not_empty(name, whole))
        df = (loaded or {}).get(name, whole)
        if table.key:
            checks.append(quality.unique_key(name, df, list(table.key)))
        if table.not_null:
            checks.append(quality.no_nulls(name, df, list(table.not_null)))
        for column, parent, parent_column in table.foreign_keys:
            if parent in frames:
                checks.append(quality.no_orphans(name, df, column, (loaded or {}).get(parent, frames[parent]), parent_column))
    return checks
