"""Registered queries over the shared test tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from . import clinical, evaluation, features, modelling, relational, stored

_MODULES = (relational, features, evaluation, modelling, clinical, stored)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
