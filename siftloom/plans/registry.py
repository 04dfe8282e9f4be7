"""Registered queries over the reference's operator families."""

from . import addresses, curation, driver, editorial, fetching, identity, ledgers, reports, runs, sources, validation

_PLANS = (identity, addresses, curation, sources, fetching, ledgers, runs, reports, validation, driver, editorial)
QUERIES: dict = {n: q for p in _PLANS for n, q in p.QUERIES.items()}
ORACLE_SQL: dict[str, str] = {n: s for p in _PLANS for n, s in p.ORACLE_SQL.items()}
