"""The staging and analytics tables in Spark's catalog: tables of single runs behind views.

Each write makes a table of its own, named after the run; what readers see is a view for each table,
the union of those parts that count. A load writes all its tables first and redefines the views at the
end, so a run that fails leaves all views as they were. Season tables have one part for each
(competition_id, season_id), whose values are constants in the view: a filter on the scope leaves out
the others, and a change rewrites one part, also where it ends up without rows. As nothing is
overwritten, a rewrite may read what it replaces. Tables with matches are bucketed and sorted by
match_id, so joins by match need no exchange where one part is read, and statistics skip matches.

The database is named after ``root``, where the files lie. How long it is known is the catalog's affair:
with the session's own catalog it ends with the session. One load at a time may publish.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchgrain import schemas as S
from pitchgrain.operators.merge import merge_latest, replace_scope
from pitchgrain.operators.scope import Scope
from pitchgrain.plans.facts import with_promoted
from pitchgrain.plans.tables import MatchTables

WHOLE = ""  # the part of a table without parts
BUCKETS = 8

Parts = dict[str, str]  # part, such as competition_id=43/season_id=106 -> table of the run that wrote it


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    _pending: dict[str, Parts] | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.database = f"pitchgrain_{hashlib.md5(self.root.rstrip('/').encode()).hexdigest()[:16]}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION {_literal(self.root)}")

    def view(self, table: str) -> str:
        return f"{self.database}.{table}"

    def _stored(self, table: str) -> str:
        ddl = S.TABLES[table]
        return f"{ddl}, {S.EVENTS_PROMOTED}" if table == "events" else ddl

    def _layout(self, table: str) -> str:
        ddl = self._stored(table)
        if table in S.SEASON_PARTITIONED and table != "matches":
            ddl += ", competition_id INT, season_id INT"
        return ddl

    # ------------------------------------------------------------ parts and views

    def _published(self, table: str) -> Parts:
        if not self.spark.catalog.tableExists(self.view(table)):
            return {}
        return json.loads(self.spark.sql(f"SHOW TBLPROPERTIES {self.view(table)} ('parts')").first()["value"])

    def _parts(self, table: str) -> Parts:
        return self._published(table) | (self._pending or {}).get(table, {})

    def _select(self, table: str, parts: Parts) -> str:
        """The rows of all parts in the table's layout, as SQL."""
        fields = T.StructType.fromDDL(self._layout(table)).fields
        selects = []
        for part, stored in sorted(parts.items()):
            fixed = dict(piece.split("=", 1) for piece in part.split("/") if "=" in piece)
            columns = (
                f"CAST({_literal(fixed[f.name]) if f.name in fixed else f'`{f.name}`'} AS {f.dataType.simpleString()}) AS `{f.name}`"
                for f in fields
            )
            selects.append(f"SELECT {', '.join(columns)} FROM {self.database}.{stored}")
        return " UNION ALL ".join(selects)

    @contextmanager
    def publishing(self) -> Iterator[None]:
        """What is written inside becomes visible together at the end, or, on an error, not at all."""
        if self._pending is not None:
            yield
            return
        self._pending = {}
        try:
            yield
            for table in self._pending:
                parts = self._parts(table)
                named = f"TBLPROPERTIES ('parts' = {_literal(json.dumps(parts))})"
                self.spark.sql(f"CREATE OR REPLACE VIEW {self.view(table)} {named} AS {self._select(table, parts)}")
        finally:
            self._pending = None

    def _write(self, table: str, part: str, df: DataFrame, keep: bool = False) -> None:
        """``df`` as the part's rows, or with ``keep`` in addition to the table's others."""
        run = uuid.uuid4().hex
        name = f"{table}_run_{run}"
        writer = df.write.format("parquet")
        if "match_id" in df.columns:
            writer = writer.bucketBy(BUCKETS, "match_id").sortBy("match_id")
        writer.saveAsTable(f"{self.database}.{name}")
        with self.publishing():
            self._pending.setdefault(table, {})[run if keep else part] = name

    def drop_unused(self) -> int:
        """Drop tables of runs that no view reads; how many. For times without readers or loads."""
        used = {stored for table in S.TABLES for stored in self._published(table).values()}
        gone = [t.name for t in self.spark.catalog.listTables(self.database) if "_run_" in t.name and t.name not in used]
        for name in gone:
            self.spark.sql(f"DROP TABLE {self.database}.{name}")
        return len(gone)

    def exists(self, table: str) -> bool:
        return bool(self._parts(table))

    def others(self) -> list[str]:
        """Tables and views of the database that no layout names."""
        found = [t.name for t in self.spark.catalog.listTables(self.database)]
        return sorted(n for n in found if n not in S.TABLES and n.partition("_run_")[0] not in S.TABLES)

    def read(self, table: str) -> DataFrame:
        """The table, or no rows if nothing was ever written."""
        parts = self._parts(table)
        if not parts:
            return self.spark.createDataFrame([], self._layout(table))
        return self.spark.sql(self._select(table, parts))

    # ------------------------------------------------------------ season tables

    def replace_season(self, table: str, df: DataFrame, scope: Scope) -> None:
        """All rows of the season become ``df``."""
        if table == "events":
            df = with_promoted(df)
        columns = [c for c in S.columns(self._stored(table)) if c not in S.SEASON_KEYS]
        part = f"competition_id={scope.competition_id}/season_id={scope.season_id}"
        self._write(table, part, df.select(*columns))

    def replace_matches(
        self, table: str, df: DataFrame | None, scope: Scope, match_ids: Iterable[int] | None
    ) -> None:
        """Rows of the matches (all of the season without ids) are deleted, then ``df`` is added.

        ``df=None`` deletes only.
        """
        if df is None and not self.exists(table):
            return
        if match_ids is None:
            new = df if df is not None else self.spark.createDataFrame([], S.TABLES[table])
            self.replace_season(table, new, scope)
            return
        ids = sorted(set(match_ids))
        season = scope.filter(self.read(table))
        old = season.select(*S.columns(self._stored(table)))
        if df is not None and table == "events":
            df = with_promoted(df)
        named = self.spark.createDataFrame([(i,) for i in ids], "match_id int")
        self.replace_season(table, replace_scope(old, old.limit(0) if df is None else df, named, ["match_id"]), scope)

    # ------------------------------------------------------------ dimensions and logs

    def upsert(self, table: str, df: DataFrame, order: str | None = None) -> None:
        """Insert rows or replace those with the same key."""
        keys = S.PRIMARY_KEYS[table]
        merged = merge_latest(self.read(table), df, keys, order)
        self._write(table, WHOLE, merged)

    def append(self, table: str, df: DataFrame) -> None:
        self._write(table, WHOLE, df.select(*S.columns(S.TABLES[table])), keep=True)

    # ------------------------------------------------------------ documents

    def rebuild_documents(self, docs: DataFrame, doc_types: Iterable[str]) -> None:
        """Replace the listed types; the new rows have no embeddings yet."""
        table = "embedding_documents"
        with self.publishing():
            for kind in doc_types:
                rows = docs.select(*S.columns(S.DOCUMENTS)).filter(F.col("doc_type") == kind)
                self._write(table, f"doc_type={kind}", rows.drop("doc_type"))

    def store_embeddings(self, make_encoder=None) -> int:
        """Encode the rows without embedding and rewrite the types that had any. Returns how many."""
        from pitchgrain.plans.search import embed_pending, evened

        table = "embedding_documents"
        docs = self.read(table)
        pending = docs.filter(F.col("embedding").isNull())
        todo = {r.doc_type: r.n for r in pending.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n")).collect()}
        with self.publishing():
            for kind in todo:
                touched = evened(docs.filter(F.col("doc_type") == kind))
                done = embed_pending(touched, make_encoder) if make_encoder else embed_pending(touched)
                self._write(table, f"doc_type={kind}", done.drop("doc_type"))
        return sum(todo.values())

    # ------------------------------------------------------------ reading for plans

    def tables(self) -> MatchTables:
        return MatchTables(
            persistent=True,
            competitions=lambda: self.read("competitions"),
            seasons=lambda: self.read("seasons"),
            teams=lambda: self.read("teams"),
            players=lambda: self.read("players"),
            matches=lambda: self.read("matches"),
            events=lambda: self.read("events"),
            lineups=lambda: self.read("match_lineups"),
            positions=lambda: self.read("match_lineup_positions"),
            facts=lambda: self.read("fact_player_match_stats"),
            timeline=lambda: self.read("team_match_formation"),
        )


def snapshot(results: dict[str, DataFrame], root: str) -> None:
    """Each result as JSON lines under its name; decimals as numbers, dates in ISO form, NULLs kept."""
    for name, df in results.items():
        columns = [
            F.col(f.name).cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f.name)
            for f in df.schema
        ]
        df.select(*columns).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root.rstrip('/')}/{name}")
