"""SQL statements over a warehouse's models, named as users name them.

``marts.fct_orders``, ``staging.stg_orders`` and ``raw.orders`` (or a bare model
name) may stand in a statement. The analyzer says which relation it does not
know and where in the text it stands; that model alone is bound there, under a
private name, and the statement is analysed again. So a statement builds the
plans of the models it names and no others, whatever else its text (strings,
comments, column names) may contain, and no view is left in the session.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import Warehouse

SCHEMAS = ("raw", "staging", "marts")
_UNKNOWN = "TABLE_OR_VIEW_NOT_FOUND"
_SKIPPED = re.compile(r"(?:\s|--[^\n]*|/\*.*?\*/)*", re.DOTALL)
_WORD = re.compile(r"[A-Za-z_]\w*|`")
# Words that may follow a relation and are no alias of it.
_CLAUSES = frozenset("""ANTI CLUSTER CROSS DISTRIBUTE EXCEPT FOR FULL GROUP HAVING INNER INTERSECT JOIN LATERAL LEFT
LIMIT MINUS NATURAL OFFSET ON ORDER PIVOT RIGHT SEMI SORT TABLESAMPLE TIMESTAMP UNION UNPIVOT USING VERSION WHERE
WINDOW""".split())


def _parts(name: str) -> list[str]:
    """`a`.`b` -> [a, b]."""
    return [p.strip("`").lower() for p in name.split(".")]


def _model(w: Warehouse, parts: list[str]) -> DataFrame | None:
    if len(parts) == 1:
        return w.model(parts[0]) if parts[0] in w.MODELS else None
    schema, name = parts[-2:]
    if len(parts) > 2 or schema not in SCHEMAS:
        return None
    if schema == "raw":
        return w.raw.get(name) if name in w.raw.NAMES else None
    wanted = schema == "staging"
    return w.model(name) if name in w.MODELS and name.startswith("stg_") == wanted else None


def read_sql(spark: SparkSession, statement: str, warehouse: Warehouse,
             parse_dates: Sequence[str] = ()) -> DataFrame:
    """The rows of ``statement``; the columns ``parse_dates`` as timestamps
    (a text that is none is an error). A name that is neither a model nor a
    table of the session is an error, as in any statement."""
    bound: dict[str, str] = {}  # the name as written -> view
    text = statement
    try:
        while True:
            try:
                out = spark.sql(text)
                break
            except AnalysisException as e:
                where = [c for c in e.getQueryContext() or [] if c.stopIndex() >= c.startIndex() >= 0]
                name = (e.getMessageParameters() or {}).get("relationName", "")
                model = _model(warehouse, _parts(name)) if e.getCondition() == _UNKNOWN and where else None
                if model is None:
                    raise
                if name not in bound:
                    bound[name] = f"_model_{uuid.uuid4().hex}"
                    model.createOrReplaceTempView(bound[name])
                a, b = where[0].startIndex(), where[0].stopIndex()
                end = a + _end_of_name(text[a:b + 1])
                # without an alias, columns may be qualified by the model's own name
                alias = "" if _has_alias(text[end:]) else f" AS `{_parts(name)[-1]}`"
                text = f"{text[:a]}`{bound[name]}`{alias}{text[end:]}"
    finally:
        for view in bound.values():
            spark.catalog.dropTempView(view)
    unknown = set(parse_dates) - set(out.columns)
    if unknown:
        raise ValueError(f"no such columns to parse as dates: {sorted(unknown)}")
    return out.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in parse_dates})


def _end_of_name(written: str) -> int:
    """Length of the (possibly quoted and qualified) name that ``written`` begins with."""
    at, quoted = 0, False
    while at < len(written) and (quoted or not written[at].isspace()):
        quoted ^= written[at] == "`"
        at += 1
    return at


def _has_alias(rest: str) -> bool:
    """Whether what follows a relation's name in a statement is an alias."""
    word = _WORD.match(rest, _SKIPPED.match(rest).end())
    return word is not None and word[0].upper() not in _CLAUSES
