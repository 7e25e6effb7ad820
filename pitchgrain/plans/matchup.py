"""Context and prompts for questions about a coming match-up, for a batch of questions at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain.functions.encoder import Encoder, token_hash_encoder
from pitchgrain.functions.text import fixed, shown
from pitchgrain.operators.scope import Scope
from pitchgrain.plans import analytics as A
from pitchgrain.plans import wording as W
from pitchgrain.plans.documents import filled
from pitchgrain.plans.search import embed_queries, search
from pitchgrain.plans.tables import MatchTables
from pitchgrain.plans.wording import Labels

KEY = "decimal(28,2)"
TACTICAL_HITS = 3
PLAYER_HITS = 5


def _line(section: int, line: Column, *keys: Column) -> list[Column]:
    """A context line with what orders it: its section, then up to three numbers."""
    padded = [*keys, *[F.lit(0)] * (3 - len(keys))]
    return [
        F.col("matchup_id"),
        F.lit(section).alias("section"),
        *[k.cast(KEY).alias(f"key{i + 1}") for i, k in enumerate(padded)],
        line.alias("line"),
    ]


def _with_names(t: MatchTables, matchups: DataFrame, labels: Labels) -> DataFrame:
    """Match-ups with the rival's name (its id if it has no facts) and the focus team's label."""
    focus = t.teams.select(F.col("team_id").alias("focus_team_id"), F.col("team_name").alias("focus_name"))
    named = matchups.join(focus, "focus_team_id", "left")
    local = F.coalesce(F.lit(labels.team_local), "focus_name", F.col("focus_team_id").cast("string"))
    return named.withColumn("focus_label", local).drop("focus_name")


def _rival_totals(t: MatchTables, scope: Scope) -> DataFrame:
    totals = A.team_aggregates(t, scope).join(A.team_formations(t, scope), "team_id", "left")
    return totals.withColumn(
        "used", F.when(F.size(F.col("formations")) > 0, F.array_join("formations", ", "))
    ).withColumnRenamed("team_id", "rival_team_id")


def context_lines(
    t: MatchTables, scope: Scope, matchups: DataFrame, labels: Labels = Labels()
) -> DataFrame:
    """Lines of each match-up's context: matchup_id, section, key1..key3, line.

    matchups: matchup_id, focus_team_id, rival_team_id, match_id. Sections without data are
    missing, headers of the rival and the squad always appear.
    """
    base = _with_names(t, matchups, labels)
    rival = base.join(_rival_totals(t, scope), "rival_team_id", "left")
    opponent = F.coalesce("team_name", F.col("rival_team_id").cast("string"))

    profile = rival.filter(F.col("team_name").isNotNull())
    c, n = F.col("passes_completed"), F.col("passes_attempted")
    parts = [
        rival.select(*_line(1, filled(W.RIVAL_HEADER, opponent))),
        profile.select(
            *_line(
                2,
                filled(
                    W.RIVAL_LINE, opponent, F.col("matches"), F.col("used"), F.col("goals"),
                    F.col("xg"), F.col("tackles"), F.col("interceptions"), F.col("pressures"),
                    F.col("blocks"), c, n,
                ),
            )
        ),
    ]

    met = base.join(A.match_headers(t), "match_id")
    met_line = filled(
        W.MEETING_LINE, F.col("competition_stage"), F.col("match_date"), F.col("home"),
        F.col("home_score"), F.col("away_score"), F.col("away"),
    )
    parts += [
        met.select(*_line(3, filled(W.MEETING_HEADER, F.col("match_id")))),
        met.select(*_line(4, met_line)),
    ]

    until = F.coalesce(F.concat(F.col("to_minute").cast("string"), F.lit("'")), F.lit(W.UNTIL_END))
    shapes = met.select("matchup_id", "match_id").join(A.match_formations(t), "match_id")
    parts.append(
        shapes.select(
            *_line(
                5,
                filled(
                    W.FORMATION_LINE, F.col("team_name"), F.col("formation_code"),
                    F.col("from_minute"), until,
                ),
                F.col("team_id"),
                F.col("from_minute"),
            )
        )
    )

    def position(col: str) -> Column:
        return shown(F.nullif(col, F.lit("")), "?")

    lines = A.match_players(t).withColumnRenamed("team_id", "focus_team_id")
    seen = base.join(lines, ["match_id", "focus_team_id"])
    tag = F.when(F.col("is_starter"), W.STARTED).otherwise(W.CAME_ON)
    header = filled(W.APPEARED_HEADER, F.col("focus_label"), F.col("match_id"))
    appeared = base.join(lines.select("match_id", "focus_team_id"), ["match_id", "focus_team_id"], "left_semi")
    parts += [
        appeared.select(*_line(6, header)),
        seen.select(
            *_line(
                7,
                filled(
                    W.APPEARED_LINE, F.col("player_name"), position("position_played"), tag,
                    F.col("minutes_played"), c, n, F.col("tackles"), F.col("interceptions"),
                    F.col("pressures"), F.col("goals"), F.col("assists"),
                ),
                F.when(F.col("is_starter"), 0).otherwise(1),
                -F.col("minutes_played"),
                F.col("player_id"),
            )
        ),
    ]

    squad_header = filled(
        W.SQUAD_HEADER, F.col("focus_label"), labels.event_short, F.col("focus_team_id")
    )
    pool = A.player_profiles(t, scope).withColumnRenamed("team_id", "focus_team_id")
    parts += [
        base.select(*_line(8, squad_header)),
        base.join(pool, "focus_team_id").select(
            *_line(
                9,
                filled(
                    W.SQUAD_LINE, F.col("player_name"), position("position"), F.col("matches"),
                    F.col("minutes"), F.col("goals"), F.col("assists"), F.col("xg"), c, n,
                    F.col("tackles"), F.col("interceptions"), F.col("pressures"), F.col("blocks"),
                ),
                -F.col("minutes"),
                F.col("player_id"),
            )
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def joined_lines(lines: DataFrame, key: str, order: list[str], text: str) -> DataFrame:
    """The lines of each key as one text. One prompt is one text value, so its lines have to meet;
    a group is as large as the prompt that is asked for."""
    sorted_lines = F.array_sort(F.collect_list(F.struct(*order, "line")))
    return lines.groupBy(key).agg(
        F.array_join(F.transform(sorted_lines, lambda x: x.getField("line")), "\n").alias(text)
    )


def retrieved(
    t: MatchTables,
    docs: DataFrame,
    scope: Scope,
    questions: DataFrame,
    labels: Labels = Labels(),
    player_hits: int = PLAYER_HITS,
    make_encoder: Callable[[], Encoder] = token_hash_encoder,
) -> DataFrame:
    """Search hits per question: patterns of the rival first, then players fitting the question.

    docs carry embeddings. questions: question_id, question and the columns of a match-up.
    """
    short = F.coalesce(F.lit(labels.team_short), "focus_label")
    rivals = t.teams.select(
        F.col("team_id").alias("rival_team_id"), F.col("team_name").alias("rival_name")
    )
    q = _with_names(t, questions, labels).join(rivals, "rival_team_id", "left")
    rival = F.coalesce("rival_name", F.col("rival_team_id").cast("string"))
    tactical = F.struct(
        F.lit(0).alias("source"),
        filled(W.TACTICAL_SEARCH, rival, short).alias("text"),
        F.lit("tactical_pattern").alias("doc_type"),
        F.lit(TACTICAL_HITS).alias("k"),
    )
    players = F.struct(
        F.lit(1).alias("source"),
        F.col("question").alias("text"),
        F.lit("player_profile").alias("doc_type"),
        F.lit(player_hits).alias("k"),
    )
    asked = q.select("question_id", F.explode(F.array(tactical, players)).alias("a")).select(
        (F.col("question_id") * 2 + F.col("a.source")).alias("query_id"), "a.*"
    )
    hits = search(docs, embed_queries(asked, make_encoder))
    return hits.select(
        F.floor(F.col("query_id") / 2).cast("bigint").alias("question_id"),
        F.pmod("query_id", F.lit(2)).cast("int").alias("source"),
        "rank", "doc_type", "ref_id", "score", "content",
        filled(
            W.HIT_LINE, F.col("doc_type"), F.col("ref_id"), fixed(F.col("score"), 3), F.col("content")
        ).alias("line"),
    )


def prompts(
    t: MatchTables,
    docs: DataFrame,
    scope: Scope,
    questions: DataFrame,
    labels: Labels = Labels(),
    guidance: str = W.GUIDANCE,
    player_hits: int = PLAYER_HITS,
    make_encoder: Callable[[], Encoder] = token_hash_encoder,
) -> DataFrame:
    """One prompt per question: guidance, facts, hits, question.

    questions: question_id, question, focus_team_id, rival_team_id, match_id. ``guidance`` has places
    for the rival's name and the match.
    """
    matchups = questions.withColumnRenamed("question_id", "matchup_id").drop("question")
    facts = joined_lines(
        context_lines(t, scope, matchups, labels),
        "matchup_id", ["section", "key1", "key2", "key3"], "facts",
    ).withColumnRenamed("matchup_id", "question_id")
    found = joined_lines(
        retrieved(t, docs, scope, questions, labels, player_hits, make_encoder),
        "question_id", ["source", "rank"], "found",
    )
    rivals = t.teams.select(F.col("team_id").alias("rival_team_id"), F.col("team_name").alias("rival"))
    asked = questions.join(rivals, "rival_team_id", "left").select("question_id", "question", "rival", "match_id")
    texts = asked.join(facts, "question_id").join(found, "question_id", "left")
    guided = filled(guidance, F.col("rival"), F.col("match_id"))
    hits = F.concat_ws("\n", F.lit(W.HITS_HEADER), F.col("found"))
    return texts.select(
        "question_id",
        F.format_string(W.PROMPT, guided, F.col("facts"), hits, F.col("question")).alias("prompt"),
    )
