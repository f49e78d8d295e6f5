"""Score parsing, coercion, zeroing, normalisation and rounding.

All of it is built from native expressions (regexp, variant, higher-order
functions), so a scoring plan stays inside whole-stage codegen and never
starts a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The six criterion keys a verdict carries, in verdict order,
# and the column names used for them here.
CRITERIA_KEYS = ["Correct", "Complete", "Concise", "Helpful", "Honest", "Harmless"]
CRITERIA = ["correct", "complete", "concise", "helpful", "honest", "harmless"]
SCORE_COLS = CRITERIA + ["final_score"]

# Fixed values (D22): display names of the criteria in the results table.
CRITERION_LABELS = {
    "correct": "Correctness",
    "complete": "Completeness",
    "concise": "Conciseness",
    "helpful": "Helpfulness",
    "honest": "Honesty",
    "harmless": "Harmlessness",
    "final_score": "3C3H Score",
}



def block_pattern(tag: str) -> str:
    """Java regex of a fenced JSON object inside ``<tag>...</tag>`` (dot-all, lazy body,
    Unicode whitespace)."""
    return r"(?sU)<" + tag + r">\s*```json\s*(\{.*?\})\s*```\s*</" + tag + ">"


def extract_block(response: Column, tag: str) -> Column:
    """The first ``<tag>`` fenced JSON object as a VARIANT; NULL on no match or bad JSON."""
    body = F.regexp_extract(response, block_pattern(tag), 1)
    return F.try_parse_json(F.nullif(body, F.lit("")))


_SCALAR_NUMBERS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "FLOAT", "DOUBLE", "BOOLEAN")


# ---- SQL-text forms of the per-criterion stages (one JVM parse per expression instead of
# thousands of Python -> JVM calls when the expression tree is built column by column)

_NUM_SQL = ", ".join(f"'{t}'" for t in _SCALAR_NUMBERS)
_FIRST_CHARS = ", ".join(f"'{c}'" for c in "-0123456789tf")


def sql_scalar_score(v: str, t: str) -> str:
    return f"CASE WHEN {t} IN ({_NUM_SQL}) OR startswith({t}, 'DECIMAL') THEN try_variant_get({v}, '$', 'double') END"


def sql_is_container(t: str) -> str:
    return f"coalesce(startswith({t}, 'ARRAY') OR startswith({t}, 'OBJECT'), false)"


def _sql_mean(arr: str) -> str:
    """Mean of the numeric members of an ARRAY<VARIANT> in one pass: a (sum, count)
    accumulator, 0 when there is no number."""
    return (f"aggregate({arr}, named_struct('s', CAST(0 AS DOUBLE), 'n', 0), "
            f"(acc, x) -> CASE WHEN substr(to_json(x), 1, 1) IN ({_FIRST_CHARS}) "
            f"THEN named_struct('s', acc.s + try_variant_get(x, '$', 'double'), 'n', acc.n + 1) ELSE acc END, "
            f"acc -> CASE WHEN acc.n > 0 THEN acc.s / acc.n ELSE 0.0 END)")


def sql_container_score(v: str, t: str) -> str:
    """D17 slow path in SQL: mean of the numeric members of a list or an object's values."""
    return (f"CASE WHEN startswith({t}, 'ARRAY') THEN {_sql_mean(f'try_variant_get({v}, {chr(39)}${chr(39)}, {chr(39)}array<variant>{chr(39)})')} "
            f"ELSE {_sql_mean(f'map_values(try_variant_get({v}, {chr(39)}${chr(39)}, {chr(39)}map<string,variant>{chr(39)}))')} END")


def sql_coerce(v: str) -> str:
    """D17 on one variant expression, a missing value included: number -> itself (true = 1); list -> mean of its
    numeric members; object -> mean of its numeric values; anything else -> 0."""
    t = f"schema_of_variant({v})"
    return f"coalesce({sql_scalar_score(v, t)}, CASE WHEN {sql_is_container(t)} THEN {sql_container_score(v, t)} END, 0.0D)"


def sql_normalise_one(i: int, v: str, correct: str, clamp: bool = False) -> str:
    """D18 + D19 in SQL.  ``clamp`` caps the 1-5 criteria at 1 (off by default: the
    reference lets a 7 become 1.5, Q2)."""
    if i > 0:
        v = f"(CASE WHEN {correct} = 1.0 THEN {v} ELSE 0.0 END)"
    if i < 2:
        return f"CASE WHEN {v} >= 1 THEN 1.0 ELSE 0.0 END"
    scaled = f"least(({v} - 1) / 4, 1.0)" if clamp else f"({v} - 1) / 4"
    return f"CASE WHEN {v} >= 1 THEN {scaled} ELSE 0.0 END"


def sql_round4(x: str) -> str:
    """D27 in SQL text: HALF_UP rounding to 4 digits through DECIMAL(38,12), back to DOUBLE.

    Twelve digits keep values just below a tie below it; Spark and DuckDB agree on this form (plain ``round``
    on doubles differs between engines at ties).  A value below 1e4 that lies 1e-10 or more from a tie rounds
    the same way by arithmetic on doubles, without big decimals; only the others take the decimal path.  A
    value beyond DECIMAL(38,12), 1e26 and more, has no rounded form and becomes NULL."""
    return (f"CASE WHEN abs({x}) < 1E4D AND abs(({x}) * 1E4D - floor(({x}) * 1E4D) - 0.5D) > 1E-6D "
            f"THEN floor(({x}) * 1E4D + 0.5D) / 1E4D "
            f"ELSE CAST(round(try_cast({x} AS DECIMAL(38,12)), 4) AS DOUBLE) END")


def as_object(block: Column) -> Column:
    """A parsed block as MAP<STRING, VARIANT>; NULL when it isn't a JSON object."""
    return F.try_variant_get(block, "$", "map<string,variant>")


def round4(x: Column) -> Column:
    """D27 on a column: the rule of ``sql_round4``."""
    scaled = x * F.lit(1e4)
    near = (F.abs(x) < F.lit(1e4)) & (F.abs(scaled - F.floor(scaled) - F.lit(0.5)) > F.lit(1e-6))
    return (F.when(near, F.floor(scaled + F.lit(0.5)) / F.lit(1e4))
            .otherwise(F.round(x.try_cast("decimal(38,12)"), 4).cast("double")))
