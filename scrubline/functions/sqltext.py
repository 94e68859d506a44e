"""Small SQL-text builders for expressions that would otherwise need many
JVM round trips (one ``F.expr`` call is parsed inside the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cache import cached_expr


class Ref(str):
    """A column reference inside a ``stack_rows`` cell."""


class Expr(str):
    """Raw SQL expression text inside a ``stack_rows`` cell."""


def sql_literal(v) -> str:
    if isinstance(v, Expr):
        return str(v)
    if isinstance(v, Ref):
        return "`" + v.replace("`", "``") + "`"
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def stack_rows(names: tuple, rows: tuple) -> Column:
    """A generator turning one input row into ``len(rows)`` output rows with
    columns ``names``; cells are literals, ``Ref`` column references or
    ``Expr`` SQL text."""
    typed = tuple(tuple((type(v).__name__, v) for v in row) for row in rows)
    return _stack_rows(tuple(names), typed)


@cached_expr
def _stack_rows(names: tuple, typed_rows: tuple) -> Column:
    cells = ", ".join(sql_literal(v) for row in typed_rows for _, v in row)
    cols = ", ".join(f"`{n}`" for n in names)
    return F.expr(f"stack({len(typed_rows)}, {cells}) as ({cols})")
