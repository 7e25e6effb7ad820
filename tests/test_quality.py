from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.operators.scope import Scope
from pitchgrain.plans import quality as Q


def found(df, check):
    return {r.scope: (r.observed, r.status) for r in df.filter(F.col("check") == check).collect()}


def test_clean_tables_pass(tables):
    assert Q.check_keys(tables.named()).filter("status <> 'ok'").count() == 0
    assert Q.check_foreign_keys(tables.named()).filter("status <> 'ok'").count() == 0


def test_duplicate_and_null_keys(spark, tables):
    teams = tables.teams.union(tables.teams.filter("team_id < 2"))
    teams = teams.withColumn("team_name", F.when(F.col("team_id") != 5, F.col("team_name")))
    out = Q.check_keys({"teams": teams})
    assert found(out, "duplicate key") == {"teams": (2.0, "fail")}
    assert found(out, "null")["teams.team_name"] == (1.0, "fail")


def test_orphans(tables):
    named = {**tables.named(), "teams": tables.teams.filter("team_id <> 3")}
    out = found(Q.check_foreign_keys(named), "orphan")
    count = tables.matches.filter("away_team_id = 3").count()
    assert out["matches(away_team_id) -> teams"] == (float(count), "fail")
    assert out["matches(home_team_id) -> teams"] == (0.0, "ok")


def test_every_reference_and_key_at_once(spark, tables):
    """A parent row lost from each table, and each child row of it found; no reference is checked against another's keys."""
    named = {n: df.cache() for n, df in tables.named().items()}
    lost = {
        "competitions": "competition_id <> 43", "seasons": "season_id <> 106", "teams": "team_id <> 3", "players": "player_id % 50 <> 7",
        "matches": "match_id % 9 <> 4", "match_lineups": "player_id % 40 <> 1",
    }
    damaged = {n: df.filter(lost.get(n, "true")) for n, df in named.items()}
    out = found(Q.check_foreign_keys(damaged), "orphan")
    assert len(out) == len(S.FOREIGN_KEYS)
    for child, keys, parent, parent_keys in S.FOREIGN_KEYS:
        known = {tuple(r) for r in damaged[parent].select(*parent_keys).distinct().collect()}
        used = [tuple(r) for r in damaged[child].select(*keys).dropna().collect()]
        assert out[f"{child}({', '.join(keys)}) -> {parent}"][0] == sum(k not in known for k in used)


def test_missing_and_extra_columns(tables):
    changed = tables.teams.drop("team_gender").withColumn("colour", F.lit("red"))
    out = Q.check_schema({"teams": changed})
    assert found(out, "missing column") == {"teams.team_gender": (None, "fail")}
    assert found(out, "extra column") == {"teams.colour": (None, "warn")}


def test_season_shared_by_two_competitions(spark, tables):
    more = tables.seasons.union(spark.sql("select 9 as competition_id, 106 as season_id, 'x' as season_name"))
    out = Q.check_matches(tables.having(seasons=more), Scope(), 0)
    assert found(out, "season id shared")["seasons"] == (2.0, "ok")
    assert found(Q.check_matches(tables, Scope(), 0), "season id shared")["seasons"] == (1.0, "warn")


def test_event_ids(spark):
    df = spark.createDataFrame([("123e4567-e89b-12d3-a456-426614174000",), ("17",)], "event_id string")
    assert found(Q.check_event_ids(df), "event id")["events"] == (1.0, "warn")
