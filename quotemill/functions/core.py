"""Shared column helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


_CHEAP = {"UnresolvedAttribute", "UnresolvedNamedLambdaVariable", "NamedLambdaVariable",
          "AttributeReference", "Literal"}


def is_cheap(value: ColumnOrName) -> bool:
    """True for a column or lambda-variable reference or a literal (free to repeat)."""
    if isinstance(value, str):
        return True
    try:
        jc = value._jc
        node = jc.node() if hasattr(jc, "node") else jc.expr()  # Spark 4 column nodes / Spark 3 expressions
        return node.getClass().getSimpleName() in _CHEAP
    except Exception:  # noqa: BLE001 - other Column implementations: assume not cheap
        return False


def let(value: ColumnOrName, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so ``body`` can use it many times.

    Column expressions are trees: using an input three times copies its whole
    subtree three times, and nested helpers multiply that.  A one-element
    ``transform`` evaluates ``value`` once per row and hands ``body`` a cheap
    variable reference instead.  A value that is already a reference is passed
    straight through, keeping ``body`` in whole-stage codegen.
    """
    if is_cheap(value):
        return body(col(value))
    return F.get(F.transform(F.array(col(value)), body), 0)
