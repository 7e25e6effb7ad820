"""Every query by name: (spark, sf_dir) -> DataFrame.

Each reads the given tables whole. Results are cast to a few plain types (BIGINT, DOUBLE, text
dates), so that they compare equal with another engine's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchgrain.operators.choose import keep_one
from pitchgrain.operators.merge import merge_latest, replace_scope
from pitchgrain.operators.scope import Scope
from pitchgrain.functions.encoder import encode_column
from pitchgrain.operators.topk import cosine_topk
from pitchgrain.plans import analytics as A
from pitchgrain.plans import documents as D
from pitchgrain.plans import explore as X
from pitchgrain.plans import matchup as M
from pitchgrain.plans import normalise as N
from pitchgrain.plans import quality as Q
from pitchgrain.plans import reporting as R
from pitchgrain.plans import search as V
from pitchgrain.plans.runlog import run_states
from pitchgrain.plans.tables import MatchTables
from pitchgrain.sources.landing import Landing
from pitchgrain.sources.match_events import (
    base_stream,
    raw_competitions,
    raw_events,
    raw_lineups,
    raw_matches,
    read_tables,
)
from pitchgrain.sql import run_statement
from pitchgrain.schemas import DATA_SOURCE
from pitchgrain.sources.warehouse import Warehouse
from pitchgrain.session import checkpoint_root, materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SCOPE = Scope()
STAMPS = ("aggregated_at", "ingested_at", "created_at")


def _plain(name: str, dtype: T.DataType) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(dtype, T.IntegralType):
        return col.cast("bigint").alias(name)
    if isinstance(dtype, (T.DecimalType, T.FloatType)):
        return col.cast("double").alias(name)
    if isinstance(dtype, T.DateType):
        return col.cast("string").alias(name)
    if isinstance(dtype, T.ArrayType):
        return F.array_join(col.cast("array<string>"), ", ").alias(name)
    return col


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[_plain(f.name, f.dataType) for f in df.schema if f.name not in STAMPS])


def over_matches(name: str):
    """Register a query over the match tables."""

    def wrap(build: Callable[[MatchTables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(read_tables(spark, sf_dir)))

        QUERIES[name] = run
        return build

    return wrap


def over_dir(name: str):
    """Register a query that opens its inputs itself."""

    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(spark, sf_dir))

        QUERIES[name] = run
        return build

    return wrap


# ---------------------------------------------------------------- derived tables

over_matches("fact_player_match_stats")(lambda t: t.facts)
over_matches("team_match_formation")(lambda t: t.timeline)
over_matches("formation_at_minute")(A.formation_at_minute)

# ---------------------------------------------------------------- analysis questions

over_matches("validation_counts")(lambda t: A.validation_counts(t, SCOPE))
over_matches("goals_by_stage")(lambda t: A.goals_by_stage(t, SCOPE))
over_matches("top_xg")(lambda t: A.top_xg(t, SCOPE))
over_matches("pass_accuracy_vs_result")(lambda t: A.pass_accuracy_vs_result(t, SCOPE))
over_matches("pass_under_pressure")(A.pass_under_pressure)
over_matches("pass_pressure_drop")(A.pass_pressure_drop)
over_matches("opponent_defense")(lambda t: A.opponent_defense(t, SCOPE))
over_matches("finishing_efficiency")(lambda t: A.finishing_efficiency(t, SCOPE))
over_matches("defence_by_stage")(lambda t: A.defence_by_stage(t, SCOPE))
over_matches("xg_balance")(lambda t: A.xg_balance(t, SCOPE))
over_matches("focus_matches")(lambda t: A.focus_matches(t, SCOPE))
over_matches("team_aggregates")(lambda t: A.team_aggregates(t, SCOPE))
over_matches("team_formations")(lambda t: A.team_formations(t, SCOPE))
over_matches("player_profiles")(lambda t: A.player_profiles(t.stored("facts"), SCOPE))
over_matches("h2h_meta")(A.match_headers)
over_matches("h2h_formations")(A.match_formations)
over_matches("h2h_players")(A.match_players)
over_matches("match_formation_timeline")(A.formation_timeline)

# ---------------------------------------------------------------- the four benchmark statements


def _statement(name: str, tables: Callable[[MatchTables], dict[str, DataFrame]], args: dict):
    def build(t: MatchTables) -> DataFrame:
        return run_statement(t.events.sparkSession, name, args, **tables(t))

    return build


over_matches("bench_match_pass_agg")(
    _statement("match_pass_counts", lambda t: {"events": t.events}, {"match_id": None})
)
over_matches("bench_team_defence")(
    _statement("team_match_defence", lambda t: {"facts": t.facts}, {"team_id": None})
)
over_matches("bench_player_rows")(
    _statement("player_rows", lambda t: {"facts": t.facts}, {"player_id": None})
)
over_matches("bench_formation")(
    _statement(
        "team_timeline", lambda t: {"timeline": t.timeline}, {"match_id": None, "team_id": None}
    )
)

# ---------------------------------------------------------------- counts

FOCUS_TEAM, RIVAL_TEAM = 0, 4

over_matches("staging_counts")(lambda t: R.staging_counts(t, SCOPE))
over_matches("analytics_counts")(lambda t: R.analytics_counts(t, SCOPE, FOCUS_TEAM))
over_matches("compression")(lambda t: R.compression(t, SCOPE))
over_matches("rows_per_match")(lambda t: R.rows_per_match(t.events))

# ---------------------------------------------------------------- looking into matches

over_matches("goal_timeline")(X.goal_timeline)
over_matches("event_type_share")(X.event_type_share)
over_matches("shot_summary")(X.shot_summary)
over_matches("event_sample")(X.event_sample)

# ---------------------------------------------------------------- documents, context, prompts

over_matches("doc_match_reports")(lambda t: D.match_reports(t, SCOPE))
over_matches("doc_tactical_patterns")(lambda t: D.tactical_patterns(t, SCOPE))
over_matches("doc_player_profiles")(lambda t: D.player_documents(t.stored("facts"), SCOPE))


@over_matches("doc_counts")
def _doc_counts(t: MatchTables) -> DataFrame:
    """The three types as the focus team's rebuild makes them."""
    stored = t.stored("matches", "teams", "facts")
    return D.counts_by_type(D.build(stored, SCOPE, FOCUS_TEAM, RIVAL_TEAM))


# what a context reads several times
MATCHUP_TABLES = ("matches", "teams", "players", "facts", "timeline")


def _season_matchups(t: MatchTables) -> DataFrame:
    """Each season match seen from its home side."""
    return SCOPE.filter(t.matches).select(
        F.col("match_id").cast("bigint").alias("matchup_id"),
        F.col("home_team_id").alias("focus_team_id"),
        F.col("away_team_id").alias("rival_team_id"),
        "match_id",
    )


@over_matches("matchup_context")
def _matchup_context(t: MatchTables) -> DataFrame:
    stored = t.stored(*MATCHUP_TABLES)
    return M.context_lines(stored, SCOPE, _season_matchups(stored))


@over_matches("prompt_batch")
def _prompt_batch(t: MatchTables) -> DataFrame:
    stored = t.stored(*MATCHUP_TABLES)
    docs = D.tactical_patterns(stored, SCOPE).unionByName(D.player_documents(stored, SCOPE))
    embedded = materialise(V.embed_pending(D.as_rows(docs)), "documents")
    teams = stored.teams
    questions = (
        _season_matchups(stored)
        .withColumnRenamed("matchup_id", "question_id")
        .join(teams.select(F.col("team_id").alias("rival_team_id"), "team_name"), "rival_team_id")
        .withColumn("question", F.concat(F.lit("Who should start against "), "team_name", F.lit("?")))
        .drop("team_name")
    )
    return M.prompts(stored, embedded, SCOPE, questions)


@over_matches("document_search")
def _document_search(t: MatchTables) -> DataFrame:
    """Reports of both sides and profiles of players of several teams, asked once for each team."""
    stored = t.stored("matches", "teams", "facts")
    docs = D.match_reports(stored, SCOPE).unionByName(D.player_documents(stored, SCOPE))
    embedded = materialise(V.embed_pending(D.as_rows(docs)), "documents")
    asked = stored.teams.select(
        F.col("team_id").cast("bigint").alias("query_id"),
        F.concat("team_name", F.lit(" pressing and passing")).alias("text"),
        F.lit(None).cast("string").alias("doc_type"), F.lit(3).alias("k"),
    )
    found = V.search(embedded, V.embed_queries(asked))
    return found.select("query_id", "rank", "doc_id", "doc_type", "ref_id", "content")


# ---------------------------------------------------------------- vectors


@over_dir("embed_documents")
def _embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded whole; per vector its length and two sums that any change moves."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    vectors = V.evened(docs).select("doc_id", encode_column(F.col("text")).alias("v"))
    terms = F.transform("v", lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return vectors.select(
        "doc_id",
        F.size(F.filter("v", lambda x: x != 0)).alias("used"),
        F.round(F.sqrt(norm), 5).alias("norm"),
        F.round(total, 4).alias("weighted_sum"),
    )


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("string").alias("doc_type"), "embedding"
    )


def _mean_vector(df: DataFrame, *keys: str) -> DataFrame:
    mean = Summarizer.mean(array_to_vector(F.col("embedding")))
    return df.groupBy(*keys).agg(vector_to_array(mean).alias("embedding"))


def _type_queries(docs: DataFrame) -> DataFrame:
    """The mean vector of each type, asked within its type (k=3) and over all types (k=5)."""
    means = _mean_vector(docs, "doc_type").withColumn("base", F.col("doc_type").cast("bigint") * 2)
    within = F.struct(F.lit(0).alias("source"), F.col("doc_type"), F.lit(3).alias("k"))
    over_all = F.struct(
        F.lit(1).alias("source"), F.lit(None).cast("string").alias("doc_type"), F.lit(5).alias("k")
    )
    asked = means.select("base", "embedding", F.explode(F.array(within, over_all)).alias("a"))
    return asked.select(
        (F.col("base") + F.col("a.source")).alias("query_id"), "embedding", "a.doc_type", "a.k"
    )


def _hits(found: DataFrame, docs: DataFrame) -> DataFrame:
    shown = found.join(docs.select("doc_id", "doc_type"), "doc_id")
    return shown.select("query_id", "rank", "doc_id", "doc_type", F.round("score", 6).alias("score"))


@over_dir("vector_topk")
def _vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten vectors nearest to the mean of all."""
    docs = _vectors(spark, sf_dir)
    query = _mean_vector(docs).select(
        F.lit(0).alias("query_id"), "embedding",
        F.lit(None).cast("string").alias("doc_type"), F.lit(10).alias("k"),
    )
    return _hits(cosine_topk(docs, query), docs)


@over_dir("vector_topk_batch")
def _vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _vectors(spark, sf_dir)
    return _hits(cosine_topk(docs, _type_queries(docs)), docs)


@over_dir("vector_topk_lsh")
def _vector_topk_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _vectors(spark, sf_dir)
    return _hits(V.approximate_topk(docs, _type_queries(docs)), docs)


# ---------------------------------------------------------------- normalising landed rows


def over_landing(name: str):
    """Register a query over the stream in its raw landing form."""

    def wrap(build: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(build(base_stream(spark, f"{sf_dir}/events.parquet")))

        QUERIES[name] = run
        return build

    return wrap


def _landed_tables(base: DataFrame, t: MatchTables) -> MatchTables:
    """The match tables with events taken through the raw form, so payloads hold all attributes."""
    return t.having(events=N.events(raw_events(base)))


over_landing("competitions_dim")(lambda b: N.competitions(SCOPE.filter(raw_competitions(b))))
over_landing("seasons_dim")(lambda b: N.seasons(raw_competitions(b)))
over_landing("normalize_matches")(lambda b: N.matches(raw_matches(b)))
over_landing("teams_dim")(lambda b: N.teams(raw_matches(b)))
over_landing("players_dim")(lambda b: N.players(raw_lineups(b), raw_matches(b)))
over_landing("normalize_events")(lambda b: N.events(raw_events(b)).drop("payload"))
over_landing("event_payload")(lambda b: N.events(raw_events(b)).select("event_id", "payload"))
over_landing("lineups")(lambda b: N.lineups(raw_lineups(b), raw_matches(b)))
over_landing("lineup_positions")(lambda b: N.positions(raw_lineups(b), raw_matches(b)))


def landed(base: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Line-ups and matches written as files without an order column and read back through ``Landing``.

    The files' order is that of ``row_order``, which only the file names and lines tell afterwards.
    """
    spark = base.sparkSession
    root = f"{checkpoint_root(spark).rstrip('/')}/landing-{uuid.uuid4().hex}"
    for feed, rows, keys in (
        ("matches", raw_matches(base), ["row_order"]),
        ("lineups", raw_lineups(base), ["match_id", "row_order"]),
    ):
        placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        placed.drop("row_order").write.json(f"{root}/{feed}")
    land = Landing(spark, root)
    return land.in_feed_order(land.read("lineups")), land.in_feed_order(land.read("matches"))


def over_landed(name: str, build: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(*landed(base_stream(spark, f"{sf_dir}/events.parquet"))))

    QUERIES[name] = run


over_landed("landed_teams", lambda _, matches: N.teams(matches))
over_landed("landed_players", N.players)
over_landed("landed_lineups", N.lineups)
over_landed("landed_positions", N.positions)
over_landing("unplaced_lineups")(
    lambda b: N.unplaced_lineups(
        # matches won by the away side land with that side misspelt
        raw_lineups(b),
        raw_matches(b).withColumn(
            "away_team",
            F.when(F.col("away_score") > F.col("home_score"), "Unknown").otherwise(F.col("away_team")),
        ),
    )
)


@over_dir("starting_xi")
def _starting_xi(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = base_stream(spark, f"{sf_dir}/events.parquet")
    return X.starting_xi(_landed_tables(base, read_tables(spark, sf_dir)))


@over_dir("bench_players")
def _bench_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = base_stream(spark, f"{sf_dir}/events.parquet")
    return X.bench_players(_landed_tables(base, read_tables(spark, sf_dir)))


# ---------------------------------------------------------------- merges


@over_matches("upsert_latest")
def _upsert_latest(t: MatchTables) -> DataFrame:
    """Players known from the first halves, then a load with what the other periods say."""

    def said(events: DataFrame, order: Column) -> DataFrame:
        named = events.filter(F.col("player_id").isNotNull()).select(
            "player_id", F.col("type").alias("last_type"), "match_id", "index"
        )
        return keep_one(named, ["player_id"], [order])

    first = F.col("period") == 1
    known = said(t.events.filter(first), F.col("index"))
    load = said(t.events.filter(~first), -F.col("index"))
    return merge_latest(known, load, ["player_id"], order="index")


@over_matches("scoped_replace")
def _scoped_replace(t: MatchTables) -> DataFrame:
    """Event counts of all matches, then the season's recounted over scoring matches only."""
    counted = t.events.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if((F.col("type") == "Shot") & (F.col("outcome") == "Goal")).alias("goals"),
    )
    old = counted.select("match_id", "events", F.lit("old").alias("version"))
    season = SCOPE.filter(t.matches).select("match_id")
    new = counted.filter(F.col("goals") > 1).join(season, "match_id", "left_semi")
    fresh = new.select("match_id", "events", F.lit("new").alias("version"))
    return replace_scope(old, fresh, season, ["match_id"])


def _new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, f"{checkpoint_root(spark).rstrip('/')}/stored-{uuid.uuid4().hex}")


@over_matches("stored_upsert")
def _stored_upsert(t: MatchTables) -> DataFrame:
    """Stored teams after a load that renames every second one and adds some."""
    store = _new_warehouse(t.teams.sparkSession)
    store.upsert("teams", t.teams)
    renamed = t.teams.filter("team_id % 2 = 0").withColumn("team_name", F.concat("team_name", F.lit(" again")))
    added = t.teams.filter("team_id % 5 = 0").withColumn("team_id", (F.col("team_id") + 1000).cast("int"))
    store.upsert("teams", renamed.unionByName(added))
    return store.read("teams").select("team_id", "team_name")


@over_matches("stored_replace")
def _stored_replace(t: MatchTables) -> DataFrame:
    """Stored matches of the season after every third was replaced, by a row with another score or by none."""
    store, season = _new_warehouse(t.matches.sparkSession), SCOPE.filter(t.matches)
    store.replace_season("matches", season, SCOPE)
    third = season.filter("match_id % 3 = 0")
    ids = [r.match_id for r in third.select("match_id").collect()]
    fresh = third.filter("match_id % 2 = 0").withColumn("home_score", (F.col("home_score") + 1).cast("int"))
    store.replace_matches("matches", fresh, SCOPE, ids)
    return store.read("matches").select("match_id", "home_score")


@over_matches("run_log_state")
def _run_log_state(t: MatchTables) -> DataFrame:
    """A log with one run per match: a start row, and an end row once the match has a goal."""
    day = F.col("match_date").cast("timestamp")
    void = F.lit(None)
    m = t.matches
    goals = F.col("home_score") + F.col("away_score")
    base = {
        "run_id": F.col("match_id").cast("string"),
        "source": F.lit(DATA_SOURCE),
        "competition_id": F.col("competition_id"),
        "season_id": F.col("season_id"),
    }
    started = {
        **base, "started_at": day, "finished_at": void.cast("timestamp"),
        "status": F.lit("running"), "matches_processed": void.cast("bigint"),
        "events_processed": void.cast("bigint"), "error_message": void.cast("string"),
        "logged_at": day,
    }
    later = day + F.expr("INTERVAL 1 HOUR")
    good = F.col("home_score") >= F.col("away_score")
    ended = {
        **base, "started_at": void.cast("timestamp"), "finished_at": later,
        "status": F.when(good, "success").otherwise("failed"),
        "matches_processed": F.lit(1).cast("bigint"), "events_processed": goals.cast("bigint"),
        "error_message": F.when(~good, "away win"), "logged_at": later,
    }

    def rows(values: dict) -> list[Column]:
        return [c.alias(n) for n, c in values.items()]

    log = m.select(*rows(started)).unionByName(m.filter(goals > 0).select(*rows(ended)))
    state = run_states(log)
    return state.select(
        "run_id", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
        F.date_format("finished_at", "yyyy-MM-dd HH:mm:ss").alias("finished_at"),
        "status", "matches_processed", "events_processed", "error_message",
    )


# ---------------------------------------------------------------- quality

# everything but the events themselves, whose checks read narrow columns of the stream
DERIVED_TABLES = (
    "seasons", "competitions", "teams", "players", "matches", "lineups", "positions", "facts", "timeline",
)

over_matches("dq_schema")(lambda t: Q.check_schema(t.named()))
over_matches("dq_keys")(lambda t: Q.check_keys(t.stored(*DERIVED_TABLES).named()))
over_matches("dq_foreign_keys")(lambda t: Q.check_foreign_keys(t.stored(*DERIVED_TABLES).named()))


@over_matches("dq_damaged")
def _damaged(t: MatchTables) -> DataFrame:
    """Teams stored twice without a name, matches of teams nobody knows, and event ids of no such form."""
    again = t.teams.filter(F.col("team_id") % 2 == 0).withColumn("team_name", F.lit(None).cast("string"))
    teams = t.teams.unionByName(again)
    lost = F.when(F.col("match_id") % 5 == 0, F.col("home_team_id") + 100).otherwise(F.col("home_team_id"))
    matches = t.matches.withColumn("home_team_id", lost.cast("int"))
    return (
        Q.check_keys({"teams": teams})
        .unionByName(Q.check_foreign_keys({"matches": matches, "teams": teams}))
        .unionByName(Q.check_event_ids(t.events))
    )


over_matches("dq_matches")(lambda t: Q.check_matches(t, SCOPE, FOCUS_TEAM))
over_matches("dq_event_profile")(Q.check_event_profile)
over_matches("dq_lineups")(Q.check_lineups)
over_matches("dq_formations")(Q.check_formations)
over_matches("dq_feasibility")(Q.check_feasibility)
