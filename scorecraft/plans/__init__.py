"""Derived views and the registered queries (``queries()`` / ``oracle_sql()``)."""

from .registry import ORACLES, QUERIES, register  # noqa: F401


def load_all() -> None:
    """Import every query module so that it registers its keys."""
    from . import q_additive, q_basic, q_evaluation, q_io, q_ml, q_profile, q_selection  # noqa: F401
