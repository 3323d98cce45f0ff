"""One scheduled run: stage, fact, dimensions, checks (PIPE-4)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.clean import fit_widths
from starmill.operators.quality import run_checks
from starmill.plans import drug, music
from starmill.schemas import DRUG_TABLES, MUSIC_TABLES, RAW_EVENTS, RAW_SONGS, create_tables, table_checks
from starmill.session import released_shuffles
from starmill.sinks.tables import (
    RowCount, append_new, in_partitions, load_fact, load_partitions, refresh_table, upsert_latest_into, write_table,
)
from starmill.sources.files import read_table, stage


def run(
    spark: SparkSession, run_date: date | datetime, events_template: str, songs_template: str,
    warehouse: str, database: str = "default", events_mapping: Mapping[str, str] | None = None,
    check: bool = True, counts: dict[str, tuple[int, int]] | None = None,
) -> dict[str, DataFrame]:
    """Load the star for one run date; the same run again leaves the tables as they are.

    ``counts`` is filled with (rows staged from the table's source, rows written) by table name, as the
    writes count them; no table is read again for it.

    Facts and times join their months by key, so late rows are added and none is lost.
    Songs and artists gain the ids they lack, users take the most recent level. All five
    are tables of ``database``, ready for SQL. Times and facts are checked in the months of the run.
    """
    with released_shuffles(spark):
        events_in, songs_in = RowCount(), RowCount()
        staged_events = stage(
            spark, events_template, run_date, RAW_EVENTS, "json", mapping=events_mapping,
            to=f"{warehouse}/staging_events", count=events_in,
        )
        staged_songs = stage(
            spark, songs_template, run_date, RAW_SONGS, "json", to=f"{warehouse}/staging_songs", count=songs_in
        )
        written = {name: RowCount() for name in MUSIC_TABLES}
        create_tables(spark, MUSIC_TABLES, warehouse, database)
        paths = {name: f"{warehouse}/{name}" for name in MUSIC_TABLES}
        names = {name: f"{database}.{name}" for name in MUSIC_TABLES}

        for name, df in zip(("songs", "artists"), music.build_catalogue(staged_songs)):
            table = MUSIC_TABLES[name]
            append_new(spark, df, paths[name], table.key, partition_by=table.partition_by, sort_by=table.sort_by, count=written[name])
            refresh_table(spark, names[name])
        songs, artists = spark.table(names["songs"]), spark.table(names["artists"])

        plays = music.plays_of(music.normalise_events(staged_events))
        upsert_latest_into(
            spark, music.build_users(plays), names["users"], paths["users"], ["user_id"], "last_start_time", ["level"],
            written["users"],
        )
        touched = load_plays(spark, plays, songs, artists, paths, names, written)
        star = {name: spark.table(full) for name, full in names.items()}
        if counts is not None:
            sources = {name: songs_in if name in ("songs", "artists") else events_in for name in MUSIC_TABLES}
            counts.update({name: (sources[name].rows, written[name].rows) for name in MUSIC_TABLES})
        if check:
            # a key determines its month, so the months of this run hold all that could be wrong in them
            loaded = {name: in_partitions(star[name], months) for name, months in touched.items()}
            run_checks(spark, table_checks(MUSIC_TABLES, star, loaded))
        return star


def load_plays(
    spark: SparkSession, plays: DataFrame, songs: DataFrame, artists: DataFrame,
    paths: Mapping[str, str], names: Mapping[str, str], written: Mapping[str, RowCount] | None = None,
) -> dict[str, DataFrame]:
    """Add stored plays to times and facts; returns the months touched by table.

    Plays whose key is stored already are left out before the others are joined with their songs.
    """
    touched, written = {}, written or {}

    def load(name: str, df: DataFrame, **how) -> None:
        table = MUSIC_TABLES[name]
        touched[name] = load_partitions(
            df, paths[name], table.key, table.partition_by, table.sort_by, written.get(name), **how
        )
        refresh_table(spark, names[name])

    load("time", music.times_of(plays), unique=True, complete=music.build_time, finish=music.finish_time)
    load(
        "songplays", music.keyed_plays(music.unique_plays(plays, stored=True)),
        complete=lambda new: music.complete_plays(new, songs, artists), finish=music.finish_plays,
    )
    return touched


def steps(
    spark: SparkSession, events_template: str, songs_template: str, warehouse: str, database: str = "default"
) -> dict[str, Callable[[date], object]]:
    """The parts of ``run`` as steps of a ledger; each works from what the one before it has written."""
    paths = {name: f"{warehouse}/{name}" for name in MUSIC_TABLES}
    names = {name: f"{database}.{name}" for name in MUSIC_TABLES}

    def staged(day: date, name: str, schema) -> DataFrame:
        return read_table(spark, f"{warehouse}/staging/{day}/{name}", schema)

    def stage_files(day: date) -> None:
        for name, template, schema in (("events", events_template, RAW_EVENTS), ("songs", songs_template, RAW_SONGS)):
            stage(spark, template, day, schema, "json", to=f"{warehouse}/staging/{day}/{name}")
        create_tables(spark, MUSIC_TABLES, warehouse, database)

    def load_catalogue(day: date) -> None:
        for name, df in zip(("songs", "artists"), music.build_catalogue(staged(day, "songs", RAW_SONGS)), strict=True):
            table = MUSIC_TABLES[name]
            append_new(spark, df, paths[name], table.key, partition_by=table.partition_by, sort_by=table.sort_by)
            refresh_table(spark, names[name])

    def plays(day: date) -> DataFrame:
        return music.plays_of(music.normalise_events(staged(day, "events", RAW_EVENTS)))

    def load_users(day: date) -> None:
        users = music.build_users(plays(day))
        upsert_latest_into(spark, users, names["users"], paths["users"], ["user_id"], "last_start_time", ["level"])

    def load_facts(day: date) -> None:
        load_plays(spark, plays(day), spark.table(names["songs"]), spark.table(names["artists"]), paths, names)

    def released(step: Callable[[date], object]) -> Callable[[date], object]:
        def run_step(day: date) -> None:
            with released_shuffles(spark):
                step(day)

        return run_step

    done = {"stage": stage_files, "catalogue": load_catalogue, "users": load_users, "plays": load_facts}
    return {name: released(step) for name, step in done.items()}


def run_drug_warehouse(
    spark: SparkSession, label_results: DataFrame, report_results: DataFrame, raw_pricing: DataFrame,
    warehouse: str, database: str = "default", check: bool = True,
) -> dict[str, DataFrame]:
    """First load: write the six drug tables with their numbers and check them."""
    staged = {}
    for name, df in (("labels", label_results), ("reports", report_results), ("pricing", raw_pricing)):
        write_table(df, f"{warehouse}/staging_{name}")
        staged[name] = read_table(spark, f"{warehouse}/staging_{name}", df.schema)
    create_tables(spark, DRUG_TABLES, warehouse, database)
    tables = {}
    for name, df in drug.build_warehouse(staged["labels"], staged["reports"], staged["pricing"]).items():
        table = DRUG_TABLES[name]
        df = fit_widths(df, table.widths)
        numbered = drug.number_rows(name, df) if table.key[0] not in df.columns else df
        write_table(numbered.select(*table.schema.names), f"{warehouse}/{name}", sort_by=table.sort_by)
        refresh_table(spark, f"{database}.{name}")
        tables[name] = spark.table(f"{database}.{name}")
    if check:
        # reports may name codes that no label or price knows, so that key is not enforced
        checks = table_checks(DRUG_TABLES, tables)
        run_checks(spark, [c for c in checks if (c.table, c.name) != ("drug_events", "foreign_key_formatted_ndc")])
    return tables


def update_pricing(
    spark: SparkSession, raw_pricing: DataFrame, warehouse: str, database: str = "default"
) -> DataFrame:
    """Periodic load: append every price snapshot that is newer than the stored ones.

    Numbers go on from the greatest one in the table. The bridge gains the codes of all stored
    prices that it lacks, so a run that failed between the two writes is made good by the next.
    """
    table = DRUG_TABLES["pricing"]
    for name in ("pricing", "ndc"):  # files of an earlier run, finished or not
        refresh_table(spark, f"{database}.{name}")
    stored = spark.table(f"{database}.pricing")
    last_id, last_date = stored.agg(F.max("pricing_id"), F.max("as_of_date")).first()
    fresh = drug.build_pricing(raw_pricing)
    if last_date is not None:
        fresh = fresh.filter(F.col("as_of_date") > F.lit(last_date).cast("timestamp_ntz"))
    numbered = drug.number_rows("pricing", fit_widths(fresh, table.widths), start=(last_id or 0) + 1)
    load_fact(numbered, f"{warehouse}/pricing", table.schema)
    refresh_table(spark, f"{database}.pricing")
    codes = spark.table(f"{database}.pricing").select("ndc").filter(F.col("ndc").isNotNull())
    append_new(spark, codes, f"{warehouse}/ndc", ["ndc"])
    refresh_table(spark, f"{database}.ndc")
    return spark.table(f"{database}.pricing")
