"""Quality checks, one row per finding: check, scope, observed, expected, status.

Duplicates and orphans are found on grouped keys, so a key with very many rows is one row before
it is shuffled. ``expected`` is NULL where a check only reports.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.functions.numeric import is_true
from pitchgrain.operators.scope import Scope
from pitchgrain.operators.sides import unpivot_sides
from pitchgrain.plans.facts import CARD_EVENTS, formation_reports
from pitchgrain.plans.tables import MatchTables

OK, WARN, FAIL = "ok", "warn", "fail"

# What the checks compare with.
EXPECTED_MATCHES = 64
EXPECTED_EVENTS = 100_000
EXPECTED_FACTS = 10_000
METRIC_EVENTS = {
    "passes_attempted": "Pass",
    "shots": "Shot",
    "pressures": "Pressure",
    "tackles": "Tackle",
    "interceptions": "Interception",
    "blocks": "Block",
    "dribbles_attempted": "Dribble",
    "carries": "Carry",
}


def _finding(
    check: str, scope: Column | str, observed: Column, expected: Column | None, status: Column | str
) -> Column:
    none = F.lit(None).cast("double")
    return F.struct(
        F.lit(check).alias("check"),
        (F.lit(scope) if isinstance(scope, str) else scope).cast("string").alias("scope"),
        observed.cast("double").alias("observed"),
        (none if expected is None else expected.cast("double")).alias("expected"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
    )


def _findings(df: DataFrame, findings: list[Column]) -> DataFrame:
    return df.select(F.explode(F.array(*findings)).alias("f")).select("f.*")


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    out = None
    for part in parts:
        out = part if out is None else out.unionByName(part)
    return out


def _judge(good: Column, otherwise: str) -> Column:
    return F.when(good, OK).otherwise(otherwise)


# ---------------------------------------------------------------- structure


def check_schema(tables: dict[str, DataFrame]) -> DataFrame:
    """Per expected column its filled rows, or that it is missing; columns beyond the layout."""
    parts = []
    for name, df in tables.items():
        wanted = S.columns(S.TABLES[name])
        present = [c for c in wanted if c in df.columns]
        known = {*wanted, *S.SEASON_KEYS}
        if name == "events":
            known |= set(S.columns(S.EVENTS_PROMOTED))
        extra = [c for c in df.columns if c not in known]
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count(f"`{c}`").alias(c) for c in present]
        )
        findings = [
            _finding("column", f"{name}.{c}", F.col(c), F.col("_rows"), OK) for c in present
        ]
        findings += [
            _finding("missing column", f"{name}.{c}", F.lit(None), F.col("_rows"), FAIL)
            for c in wanted
            if c not in present
        ]
        findings += [
            _finding("extra column", f"{name}.{c}", F.lit(None), F.col("_rows"), WARN) for c in extra
        ]
        parts.append(_findings(counts, findings))
    return _union(parts)


def _entry(tag: int, key: list[Column], kept: Column, parent: bool = False) -> Column:
    return F.struct(
        F.lit(tag).alias("tag"),
        F.array(*[k.cast("string") for k in key]).alias("key"),
        F.lit(parent).alias("parent"),
        kept.alias("kept"),
    )


def _tagged(entries: dict[str, list[Column]], tables: dict[str, DataFrame]) -> DataFrame:
    """tag, key, n, parents: each table read once, its entries counted, all of them in one shuffle.

    An entry is one row for each row of the table that it keeps; the map-side count makes one of a key that many rows have.
    """
    parts = []
    for name, own in entries.items():
        each = tables[name].select(F.explode(F.filter(F.array(*own), lambda e: e["kept"])).alias("e"))
        parts.append(each.select("e.tag", "e.key", "e.parent"))
    return _union(parts).groupBy("tag", "key").agg(
        F.count_if(~F.col("parent")).alias("n"), F.count_if(F.col("parent")).alias("parents")
    )


def _counted(spark, checks: list[tuple[str, str]], counts: DataFrame) -> DataFrame:
    """A finding for each of ``checks`` (check, scope), whose place is the tag in ``counts`` (tag, n); none means 0."""
    named = spark.createDataFrame([(i, *c) for i, c in enumerate(checks)], "tag int, check string, scope string")
    n = F.coalesce("n", F.lit(0))
    return named.join(counts, "tag", "left").select(
        "check",
        "scope",
        n.cast("double").alias("observed"),
        F.lit(0.0).alias("expected"),
        _judge(n == 0, FAIL).alias("status"),
    )


def check_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Duplicate keys, NULLs in keys and NULLs in required columns of each table, in one pass over each."""
    checks, entries = [], {}
    for name, df in tables.items():
        keys = [k for k in S.PRIMARY_KEYS[name] if k in df.columns]
        entries[name] = [_entry(len(checks), [F.col(k) for k in keys], F.lit(True))]
        checks.append(("duplicate key", name))
        for c in [*keys, *S.NOT_NULL[name]]:
            if c in df.columns:
                entries[name].append(_entry(len(checks), [F.lit(None)], F.col(c).isNull()))
                checks.append(("null", f"{name}.{c}"))
    spark = next(iter(tables.values())).sparkSession
    kinds = F.lit([c[0] == "duplicate key" for c in checks])
    faults = F.when(F.get(kinds, F.col("tag")), (F.col("n") > 1).cast("bigint")).otherwise(F.col("n"))
    return _counted(spark, checks, _tagged(entries, tables).groupBy("tag").agg(F.sum(faults).alias("n")))


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each child table whose reference has no parent, all references in one pass over each table.

    NULL references are allowed.
    """
    checks, entries = [], {}
    for child, child_keys, parent, parent_keys in S.FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        whole = [reduce(Column.__and__, [F.col(c).isNotNull() for c in keys]) for keys in (child_keys, parent_keys)]
        entries.setdefault(child, []).append(_entry(len(checks), [F.col(c) for c in child_keys], whole[0]))
        entries.setdefault(parent, []).append(_entry(len(checks), [F.col(c) for c in parent_keys], whole[1], True))
        checks.append(("orphan", f"{child}({', '.join(child_keys)}) -> {parent}"))
    spark = next(iter(tables.values())).sparkSession
    orphans = _tagged(entries, tables).filter("parents = 0").groupBy("tag").agg(F.sum("n").alias("n"))
    return _counted(spark, checks, orphans)


def check_event_ids(events: DataFrame) -> DataFrame:
    """Event ids that do not look like a UUID."""
    uuid = "^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"
    odd = events.agg(F.count_if(~F.col("event_id").cast("string").rlike(uuid)).alias("n"))
    finding = _finding("event id", "events", F.col("n"), F.lit(0), _judge(F.col("n") == 0, WARN))
    return _findings(odd, [finding])


def check_tables(warehouse) -> DataFrame:
    """Which expected tables exist, and which others are there. A listing, no data is read."""
    rows = [
        ("table", name, float(found), 1.0, OK if found else FAIL)
        for name in S.TABLES
        for found in [warehouse.exists(name)]
    ]
    rows += [("extra table", name, 1.0, 0.0, WARN) for name in warehouse.others()]
    return warehouse.spark.createDataFrame(
        rows, "check string, scope string, observed double, expected double, status string"
    )


# ---------------------------------------------------------------- content


def check_matches(
    t: MatchTables, scope: Scope, team_id: int, expected: int = EXPECTED_MATCHES
) -> DataFrame:
    """The season exists, its id is shared or not, its matches, their stages and the team's part."""
    rows = scope.filter(t.seasons).agg(F.count(F.lit(1)).alias("n"))
    shared = t.seasons.filter(F.col("season_id") == scope.season_id).agg(
        F.count_distinct("competition_id").alias("n")
    )
    season = scope.filter(t.matches)
    n = F.col("n")
    count = season.agg(F.count(F.lit(1)).alias("n"))
    stages = season.groupBy("competition_stage").agg(F.count(F.lit(1)).alias("n"))
    own = unpivot_sides(season, team_id).agg(F.count(F.lit(1)).alias("n"))
    ids = unpivot_sides(season).agg(F.count_distinct("team_id").alias("n"))
    return _union(
        [
            _findings(rows, [_finding("season row", "seasons", n, F.lit(1), _judge(n >= 1, FAIL))]),
            # more than one: the season id alone is no key
            _findings(shared, [_finding("season id shared", "seasons", n, None, _judge(n > 1, WARN))]),
            _findings(
                count,
                [_finding("match count", "matches", n, F.lit(expected), _judge(n == expected, WARN))],
            ),
            _findings(stages, [_finding("stage", F.col("competition_stage"), n, None, OK)]),
            _findings(own, [_finding("team matches", "matches", n, None, _judge(n > 0, WARN))]),
            _findings(ids, [_finding("teams", "matches", n, None, OK)]),
        ]
    )


def check_event_profile(t: MatchTables, top: int = 5) -> DataFrame:
    """Event volume, top types, sparse attributes, outcome fill and goal and assist markers.

    Everything that needs no grouping comes from one pass over the events.
    """
    kind = F.col("type")
    is_pass, is_shot = kind == "Pass", kind == "Shot"
    filled = F.col("outcome").isNotNull()
    assist = is_pass & F.get_json_object("payload", "$.pass_goal_assist").isNotNull()
    sums = t.events.agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(F.col("location_x").isNotNull()).alias("located"),
        F.count_if(is_pass).alias("passes"),
        F.count_if(is_pass & filled).alias("pass_outcomes"),
        F.count_if(is_shot).alias("shots"),
        F.count_if(is_shot & filled).alias("shot_outcomes"),
        F.count_if(is_shot & (F.col("outcome") == "Goal")).alias("goals"),
        F.count_if(assist).alias("assists"),
        F.count_if(is_true(F.col("under_pressure"))).alias("pressed"),
    )
    per_match = t.events.groupBy("match_id").agg(F.count(F.lit(1)).alias("n"))
    average = per_match.agg(F.round(F.avg("n"), 0).alias("n"))
    types = (
        t.events.groupBy("type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "type")
        .limit(top)
    )
    keys = (
        t.events.select(F.explode(F.json_object_keys("payload")).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = F.col("events")
    return _union(
        [
            _findings(
                sums,
                [
                    _finding("events", "events", total, F.lit(EXPECTED_EVENTS), _judge(total >= EXPECTED_EVENTS, WARN)),
                    _finding("located", "events", F.col("located"), total, OK),
                    _finding("outcome filled", "Pass", F.col("pass_outcomes"), F.col("passes"), OK),
                    _finding("outcome filled", "Shot", F.col("shot_outcomes"), F.col("shots"), OK),
                    _finding("goals", "Shot", F.col("goals"), None, OK),
                    _finding("assist key", "Pass", F.col("assists"), None, _judge(F.col("assists") > 0, WARN)),
                    _finding("under pressure", "events", F.col("pressed"), None, OK),
                ],
            ),
            _findings(average, [_finding("events per match", "events", F.col("n"), None, OK)]),
            _findings(types, [_finding("frequent type", F.col("type"), F.col("n"), None, OK)]),
            _findings(keys, [_finding("sparse attribute", F.col("key"), F.col("n"), None, OK)]),
        ]
    )


def check_lineups(t: MatchTables) -> DataFrame:
    """Per match and team: squad size, players with positions, players without (the bench)."""
    placed = t.positions.select("match_id", "team_id", "player_id").distinct().withColumn("has", F.lit(1))
    squads = (
        t.lineups.select("match_id", "team_id", "player_id")
        .join(placed, ["match_id", "team_id", "player_id"], "left")
        .groupBy("match_id", "team_id")
        .agg(F.count(F.lit(1)).alias("squad"), F.count("has").alias("placed"))
    )
    where = F.concat_ws("/", F.col("match_id").cast("string"), F.col("team_id").cast("string"))
    squad, used = F.col("squad"), F.col("placed")
    return _findings(
        squads,
        [
            _finding("squad size", where, squad, None, OK),
            _finding("with positions", where, used, squad, _judge(used > 0, FAIL)),
            _finding("bench", where, squad - used, None, _judge(squad > used, WARN)),
        ],
    )


def check_formations(t: MatchTables) -> DataFrame:
    """Formation reports by event type and by code; fewer than matches is a warning."""
    reports = formation_reports(t.events)
    by_type = reports.groupBy("source_event_type").agg(F.count(F.lit(1)).alias("n"))
    by_code = reports.groupBy("formation_code").agg(F.count(F.lit(1)).alias("n"))
    total = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    games = t.matches.agg(F.count(F.lit(1)).alias("matches"))
    both = total.select("n", F.lit(0).alias("matches")).unionByName(
        games.select(F.lit(0).alias("n"), "matches")
    ).agg(F.sum("n").alias("n"), F.sum("matches").alias("matches"))
    n = F.col("n")
    return _union(
        [
            _findings(by_type, [_finding("formation type", F.col("source_event_type"), n, None, OK)]),
            _findings(by_code, [_finding("formation code", F.col("formation_code"), n, None, OK)]),
            _findings(
                both,
                [_finding("formation reports", "events", n, F.col("matches"), _judge(n >= F.col("matches"), WARN))],
            ),
        ]
    )


def check_feasibility(t: MatchTables, limit: int = EXPECTED_FACTS) -> DataFrame:
    """Each metric's event type occurs; how many facts there will be and how much that reduces."""
    kinds = t.events.agg(
        *[F.count_if(F.col("type") == kind).alias(metric) for metric, kind in METRIC_EVENTS.items()],
        F.count_if(F.col("type").isin(CARD_EVENTS)).alias("cards"),
        F.count(F.lit(1)).alias("events"),
    )
    pairs = (
        t.events.filter(F.col("player_id").isNotNull())
        .select("match_id", "player_id")
        .distinct()
        .agg(F.count(F.lit(1)).alias("facts"))
    )
    volumes = (
        kinds.select("events", F.lit(0).alias("facts"))
        .unionByName(pairs.select(F.lit(0).alias("events"), "facts"))
        .agg(F.sum("events").alias("events"), F.sum("facts").alias("facts"))
    )
    facts, events = F.col("facts"), F.col("events")
    ratio = F.round(F.try_divide(events.cast("double"), facts.cast("double")), 0)
    return _union(
        [
            _findings(
                kinds,
                [
                    _finding("metric source", metric, F.col(metric), None, _judge(F.col(metric) > 0, WARN))
                    for metric in [*METRIC_EVENTS, "cards"]
                ],
            ),
            _findings(
                volumes,
                [
                    _finding("fact rows", "facts", facts, F.lit(limit), _judge(facts <= limit, WARN)),
                    _finding("reduction", "facts", ratio, None, OK),
                ],
            ),
        ]
    )
