"""Every operator as a runnable query over the test tables, with its SQL counterpart."""

from .registry import oracle_sql, queries  # noqa: F401
