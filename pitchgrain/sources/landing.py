"""Reading landed files with declared schemas.

A landing folder has one sub-folder per feed: competitions, matches, events, lineups. Events and
line-ups of all matches are one distributed scan, not a loop over matches. A feed laid out by
competition_id=/season_id= folders is pruned to the scope. Matches and line-ups carry their place in
the feed, which decides what came first where the feed has no order of its own.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchgrain import schemas as S
from pitchgrain.operators.choose import where_in
from pitchgrain.operators.scope import Scope, resolve_matches


@dataclass
class Landing:
    spark: SparkSession
    root: str
    file_format: str = "json"
    # feeds with more sparse attributes than the default layout declare them here
    layouts: dict[str, str] = field(default_factory=dict)

    def read(self, feed: str) -> DataFrame:
        if feed not in S.LANDING:
            raise ValueError(f"unknown feed {feed!r}, expected one of {sorted(S.LANDING)}")
        ddl = self.layouts.get(feed, S.LANDING[feed])
        path = f"{self.root.rstrip('/')}/{feed}"
        return self.spark.read.format(self.file_format).schema(ddl).load(path)

    def in_feed_order(self, rows: DataFrame) -> DataFrame:
        """Adds where each row stands in its feed: file, block, and place within the block.

        Row numbers rise within a block whatever filters stand before, so earlier rows of a file stay
        earlier. Added behind the pushed-down filters, which numbering would otherwise hold up.
        """
        place = F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
        return rows.select("*", place.alias("feed_order"))

    def competition_row(self, scope: Scope) -> DataFrame:
        """The row of the scope; an error when the feed lacks it."""
        row = scope.filter(self.read("competitions"))
        if not row.limit(1).collect():
            raise ValueError(
                f"competition {scope.competition_id} season {scope.season_id} not found"
            )
        return row

    def matches(self, scope: Scope, match_ids: Iterable[int] | None = None) -> DataFrame:
        """Matches of the scope; any requested id that is missing is an error."""
        return resolve_matches(self.in_feed_order(scope.filter(self.read("matches"))), scope, match_ids)

    def of_matches(
        self, feed: str, scope: Scope, matches: DataFrame, match_ids: Iterable[int] | None = None
    ) -> DataFrame:
        """Rows of a match-keyed feed that belong to ``matches``.

        Folder pruning and a short id list reach the scan; the semi join makes it exact.
        """
        rows = self.read(feed)
        if set(S.SEASON_KEYS) <= set(rows.columns):
            # folders already say which season a row is of
            rows = where_in(scope.filter(rows), "match_id", match_ids)
            return (self.in_feed_order(rows) if feed == "lineups" else rows).drop(*S.SEASON_KEYS)
        rows = where_in(rows, "match_id", match_ids)
        rows = self.in_feed_order(rows) if feed == "lineups" else rows
        return rows.join(matches.select("match_id"), "match_id", "left_semi")
