"""Named queries over the supplied tables, each with DuckDB SQL where it can be said."""

from __future__ import annotations

from importlib import import_module

from ..session import ship

FLAGSHIP = "frame_presence_gaps"
MODULES = ("timeline", "vector", "rollup", "words", "choice", "shapes", "records")


def _all() -> dict:
    out: dict = {}
    for name in MODULES:
        out |= import_module(f"{__package__}.{name}").QUERIES
    return out


def _shipped(apply):
    def run(spark, sf_dir):
        ship(spark)
        return apply(spark, sf_dir)

    return run


def queries() -> dict:
    return {name: _shipped(fn) for name, (fn, _) in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _all().items() if sql}
