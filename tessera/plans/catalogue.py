"""Imports every module that registers queries."""

from tessera.plans import aggregation, changes, functions_scalar, functions_time, joins, predicates, scans, setops, sql_front, windows  # noqa: F401
