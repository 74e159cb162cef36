"""The registered queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from importlib import import_module

from ..session import ship

#: query -> module
_WHERE = {
    "op1_quality": "quality",
    "op2_line_dedup": "line_dedup",
    "op3_language_id": "language_id",
    "op4_decontaminate": "decontaminate",
    "op5_url_filter": "url_filter",
    "op6_substring_dedup": "substring_dedup",
    "op7_near_dedup": "near_dedup",
    "op8_license_scan": "license_scan",
    "op9_packing": "packing",
    "op10_host_rules": "host_rules",
}


def _shipped(name: str, module: str):
    apply = getattr(import_module(f"{__package__}.{module}"), name)

    def query(spark, sf_dir):
        ship(spark)
        return apply(spark, sf_dir)

    return query


def queries() -> dict:
    return {name: _shipped(name, module) for name, module in _WHERE.items()}


def oracle_sql() -> dict[str, str]:
    found = {name: getattr(import_module(f"{__package__}.{module}"), "SQL", None) for name, module in _WHERE.items()}
    return {name: sql for name, sql in found.items() if sql}
