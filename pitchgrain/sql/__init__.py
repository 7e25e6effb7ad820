"""Named SQL statements shipped with the package."""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import DataFrame, SparkSession


def load_statement(name: str) -> str:
    path = files(__package__).joinpath(f"{name}.sql")
    if not path.is_file():
        raise FileNotFoundError(f"no SQL statement named {name!r}")
    return path.read_text(encoding="utf-8")


def run_statement(
    spark: SparkSession, name: str, args: dict | None = None, **tables: DataFrame
) -> DataFrame:
    """Run a statement; ``{table}`` in its text names a DataFrame, ``:arg`` a bound value."""
    return spark.sql(load_statement(name), args=args or {}, **tables)
