"""Facts turned into text documents with typed metadata."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.functions.text import percent, shown
from pitchgrain.operators.scope import Scope
from pitchgrain.operators.sides import unpivot_sides
from pitchgrain.plans import analytics as A
from pitchgrain.plans import wording as W
from pitchgrain.plans.tables import MatchTables
from pitchgrain.plans.wording import Labels

DOC_TYPES = ("match_report", "tactical_pattern", "player_profile")


def filled(template: str, *values: Column | str) -> Column:
    """The template with its marks filled; NULL shows as n/a."""
    return F.format_string(template, *[shown(F.lit(v) if isinstance(v, str) else v) for v in values])


def as_json(**fields: Column) -> Column:
    """A JSON object that keeps NULL fields."""
    return F.to_json(
        F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"}
    )


def _named(name: str | None, fallback: Column) -> Column:
    return F.lit(name) if name is not None else fallback


def _or_zero(col: str, kind: str) -> Column:
    return F.coalesce(F.col(col).cast(kind), F.lit(0).cast(kind))


def _document(doc_type: str, ref_id: str, content: Column, metadata: Column) -> list[Column]:
    return [
        F.lit(doc_type).alias("doc_type"),
        F.col(ref_id).cast("bigint").alias("ref_id"),
        content.alias("content"),
        metadata.alias("metadata"),
    ]


def match_reports(
    t: MatchTables, scope: Scope, team_id: int | None = None, labels: Labels = Labels()
) -> DataFrame:
    """One report per match of the team (or per match and side). Matches without score are left out."""
    played = A.focus_matches(t, scope, team_id).filter(
        F.col("team_score").isNotNull() & F.col("opp_score").isNotNull()
    )
    m = played.join(t.teams.select("team_id", "team_name"), "team_id")
    own, other = F.col("team_score"), F.col("opp_score")
    result = F.when(own > other, "win").when(own < other, "loss").otherwise("draw")
    title = _named(labels.team_title, F.col("team_name"))
    short = _named(labels.team_short, F.col("team_name"))
    opponent, against = F.col("opponent_name"), F.col("opp_def_actions")
    press = F.when(against >= W.HIGH_PRESS_FROM, W.HIGH_PRESS).otherwise(W.MEASURED)
    content = filled(
        W.MATCH_REPORT,
        labels.event, title, own, other, opponent, F.col("competition_stage"), F.col("match_date"),
        short, result,
        short, F.col("team_xg"), opponent, F.col("opp_xg"),
        short, F.col("team_def_actions"), opponent, against,
        opponent, against, short, press,
    )
    metadata = as_json(
        match_id=F.col("match_id"),
        opponent_id=F.col("opponent_id"),
        opponent_name=opponent,
        stage=F.col("competition_stage"),
        **{f"{labels.key_prefix}_score": own},
        opp_score=other,
        **{f"{labels.key_prefix}_xg": _or_zero("team_xg", "double")},
        opp_xg=_or_zero("opp_xg", "double"),
        opp_def_actions=_or_zero("opp_def_actions", "bigint"),
    )
    return m.select(*_document("match_report", "match_id", content, metadata))


def covered_teams(t: MatchTables, scope: Scope, team_id: int) -> DataFrame:
    """The team and everyone it meets in the season that has facts to show."""
    met = unpivot_sides(scope.filter(t.matches), team_id)
    opponents = met.select(F.col("opponent_id").alias("team_id"))
    own = t.teams.filter(F.col("team_id") == team_id).select("team_id")
    return opponents.union(own).distinct()


def tactical_patterns(
    t: MatchTables, scope: Scope, team_id: int | None = None, labels: Labels = Labels()
) -> DataFrame:
    """One pattern per team: of a team and its opponents, or of all teams."""
    totals = A.team_aggregates(t, scope)
    if team_id is not None:
        totals = totals.join(covered_teams(t, scope, team_id), "team_id", "left_semi")
    a = totals.join(A.team_formations(t, scope), "team_id", "left")
    used = F.coalesce("formations", F.array().cast("array<string>"))
    used_text = F.when(F.size(used) > 0, F.array_join(used, ", "))
    c, n = F.col("passes_completed"), F.col("passes_attempted")
    content = filled(
        W.TACTICAL_PATTERN,
        F.col("team_name"), labels.event, F.col("matches"), used_text,
        F.col("tackles"), F.col("interceptions"), F.col("pressures"), F.col("blocks"),
        F.col("goals"), F.col("xg"), percent(c, n), c, n,
    )
    metadata = as_json(
        team_id=F.col("team_id"),
        team_name=F.col("team_name"),
        formations=used,
        matches=F.col("matches"),
        tackles=F.col("tackles"),
        interceptions=F.col("interceptions"),
        pressures=F.col("pressures"),
        blocks=F.col("blocks"),
        goals=F.col("goals"),
        xg=_or_zero("xg", "double"),
    )
    return a.select(*_document("tactical_pattern", "team_id", content, metadata))


def player_documents(
    t: MatchTables,
    scope: Scope,
    team_ids: Iterable[int] | None = None,
    labels: Labels = Labels(),
) -> DataFrame:
    """One profile per player of the teams."""
    p = A.player_profiles(t, scope, team_ids)
    c, n = F.col("passes_completed"), F.col("passes_attempted")
    content = filled(
        W.PLAYER_PROFILE,
        F.col("player_name"), F.col("team_name"),
        F.coalesce(F.nullif("position", F.lit("")), F.lit(W.UNKNOWN_POSITION)),
        labels.event, F.col("matches"), F.col("minutes"),
        F.col("goals"), F.col("assists"), F.col("shots"), F.col("xg"),
        c, n, percent(c, n),
        F.col("tackles"), F.col("interceptions"), F.col("pressures"), F.col("blocks"),
    )
    metadata = as_json(
        player_id=F.col("player_id"),
        player_name=F.col("player_name"),
        team_id=F.col("team_id"),
        team_name=F.col("team_name"),
        position=F.col("position"),
        minutes=_or_zero("minutes", "double"),
        goals=F.col("goals"),
        assists=F.col("assists"),
        xg=_or_zero("xg", "double"),
    )
    return p.select(*_document("player_profile", "player_id", content, metadata))


def build(
    t: MatchTables,
    scope: Scope,
    team_id: int,
    rival_id: int,
    doc_types: Iterable[str] = DOC_TYPES,
    labels: Labels = Labels(),
) -> DataFrame:
    """The requested document types, without embeddings, as rows of the document table.

    doc_id is made of what identifies a document (see ``as_rows``), so a rebuild gives a document the
    same id again.
    """
    makers = {
        "match_report": lambda: match_reports(t, scope, team_id, labels),
        "tactical_pattern": lambda: tactical_patterns(t, scope, team_id, labels),
        "player_profile": lambda: player_documents(t, scope, [team_id, rival_id], labels),
    }
    unknown = set(doc_types) - set(makers)
    if unknown:
        raise ValueError(f"unknown doc_types: {sorted(unknown)}")
    docs = None
    for kind in DOC_TYPES:
        if kind in doc_types:
            made = makers[kind]()
            docs = made if docs is None else docs.unionByName(made)
    if docs is None:
        raise ValueError("no doc_types given")
    return as_rows(docs)


def as_rows(docs: DataFrame) -> DataFrame:
    """Rows of the document table. Type and ref_id do not identify a document: a match has a report for
    each side, told apart by the opponent, and a player a profile for each team. 60 bits of their
    hash do; ``repeated_ids`` says whether two ever met."""
    side = F.coalesce(F.get_json_object("metadata", "$.opponent_id"), F.get_json_object("metadata", "$.team_id"), F.lit(""))
    digest = F.md5(F.concat_ws("|", "doc_type", "ref_id", side))
    return docs.select(
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("doc_id"),
        "doc_type",
        "ref_id",
        "content",
        F.lit(None).cast("array<float>").alias("embedding"),
        "metadata",
        F.current_timestamp().alias("created_at"),
    )


def repeated_ids(docs: DataFrame) -> DataFrame:
    """doc_id that more than one row has; none in a sound table."""
    return docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def counts_by_type(docs: DataFrame) -> DataFrame:
    return docs.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n")).orderBy("doc_type")
