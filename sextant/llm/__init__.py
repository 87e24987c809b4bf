"""Training-data operators: language mixtures, near-duplicate joins, line
templates, sharding, source mixing, token files, toxicity, licence scans,
nearest neighbours, benchmark decontamination. Nothing else in the library
imports this subpackage."""

from __future__ import annotations


def queries():
    from . import bindings as bound
    return bound.queries()


def oracle_sql():
    from . import bindings as bound
    return bound.oracle_sql()
