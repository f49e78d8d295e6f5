"""Operator 8, chat formatting: layouts are told apart by a fingerprint of their nested field paths.

``LAYOUTS`` declares, for each record layout, the paths it has and how they become turns.  The paths
present in a record are hashed, the hash selects the mapping, and the turns are rendered with a template
whose control strings are escaped inside roles and texts, so that ``read_back`` restores them exactly.
Everything is built-in Spark functions.

Defined results: null text or role: empty.  A record whose paths fit no layout: layout and turns null,
so it can be set aside.  Rows of one conversation are ordered by turn, then role, then text; repeated
rows are repeated turns; a null conv_id is a conversation of its own.  A conversation is one row and must
fit a task.  Extra fields and columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
#: layout -> (paths of the record that must be there, then how each turn is made)
LAYOUTS: dict[str, dict] = {
    "messages": {"paths": ["$.messages[0].role", "$.messages[0].content"], "list": "$.messages", "role": "role", "text": "content"},
    "from_value": {"paths": ["$.conversations[0].from", "$.conversations[0].value"], "list": "$.conversations", "role": "from", "text": "value"},
    "prompt_response": {"paths": ["$.prompt", "$.response"], "turns": [("user", ["$.prompt"]), ("assistant", ["$.response"])]},
    "prompt_completion": {"paths": ["$.prompt", "$.completion"], "turns": [("user", ["$.prompt"]), ("assistant", ["$.completion"])]},
    "instruction": {"paths": ["$.instruction", "$.output"], "turns": [("user", ["$.instruction"]), ("assistant", ["$.output"])]},
    "instruction_input": {"paths": ["$.instruction", "$.input", "$.output"], "turns": [("user", ["$.instruction", "$.input"]), ("assistant", ["$.output"])]},
    "question_answer": {"paths": ["$.question", "$.answer"], "turns": [("user", ["$.question"]), ("assistant", ["$.answer"])]},
    # tables that hold one turn a row; their paths are columns
    "turn_rows": {"paths": ["$[*].conv_id", "$[*].role", "$[*].text", "$[*].turn"], "row": ("turn", "role", "text")},
    "turn_rows_from_value": {"paths": ["$[*].conv_id", "$[*].from", "$[*].turn", "$[*].value"], "row": ("turn", "from", "value")},
}
SYSTEM_PATH = "$.system"
PATHS = sorted({SYSTEM_PATH, *(p for x in LAYOUTS.values() if "row" not in x for p in x["paths"])})
ROLE_NAMES = {"human": "user", "gpt": "assistant", "model": "assistant", "bot": "assistant"}

OPEN, COLON, CLOSE = "### ", ": ", "</turn>\n"
#: Escaped in this order, undone in the reverse; each code is a backslash and one digit.
TEXT_ESCAPES = [("\\", "\\0"), ("###", "\\1"), ("</turn>", "\\2")]
ROLE_ESCAPES = [*TEXT_ESCAPES, (":", "\\3"), ("\n", "\\4")]


def _escape(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def _unescape(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda x, p: F.replace(x, F.lit(p[1]), F.lit(p[0])), reversed(pairs), c)


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(record: Column) -> Column:
    """Hash of the declared paths that a variant record has."""
    return _hash(F.array_compact(F.array(*(F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in PATHS))))


def _turns(record: Column, layout: dict, system: bool) -> Column:
    if "list" in layout:
        kind = f"array<struct<`{layout['role']}`:string,`{layout['text']}`:string>>"
        names = F.create_map(*(F.lit(x) for pair in ROLE_NAMES.items() for x in pair))
        turns = F.transform(F.try_variant_get(record, layout["list"], kind), lambda m: F.struct(
            F.coalesce(names[m[layout["role"]]], m[layout["role"]], F.lit("")).alias("role"), F.coalesce(m[layout["text"]], F.lit("")).alias("text")))
    else:
        turns = F.array(*(F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *(F.try_variant_get(record, p, "string") for p in paths)).alias("text")) for role, paths in layout["turns"]))
    if system:
        turns = F.concat(F.array(F.struct(F.lit("system").alias("role"), F.coalesce(F.try_variant_get(record, SYSTEM_PATH, "string"), F.lit("")).alias("text"))), turns)
    return turns.cast(TURNS)


def canonical_records(records: DataFrame, key: str = "conv_id", record: str = "record") -> DataFrame:
    """(conv_id, layout, turns) of JSON records in any declared layout."""
    parsed = records.select(F.col(key).cast("long").alias("conv_id"), F.try_parse_json(F.col(record)).alias("v")).withColumn("print", fingerprint(F.col("v")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, spec in LAYOUTS.items():
        if "row" in spec:
            continue
        for system in (False, True):
            has = F.col("print") == _hash(F.array(*map(F.lit, sorted([*spec["paths"], *[SYSTEM_PATH] * system]))))
            layout = F.when(has, F.lit(name)).otherwise(layout)
            turns = F.when(has, _turns(F.col("v"), spec, system)).otherwise(turns)
    return parsed.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def canonical_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, layout, turns) of a table with one turn a row.

    The paths of every declared row layout that the table's schema has are hashed; the layout whose own hash that is
    maps the rows.  A table in no declared layout is set aside: its conversations (one without an id, where it has no
    conv_id) have NULL layout and turns."""
    have = {f"$[*].{c.lower()}": c for c in rows.columns}
    one = F.struct(F.lit(None).cast("string").alias("layout"), F.struct(F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text")).alias("t"))
    for name, spec in LAYOUTS.items():
        if "row" in spec:
            found = [p for p in spec["paths"] if p in have]
            turn, role, text = (F.col(f"`{have[p]}`") if (p := f"$[*].{c}") in have else F.lit(None) for c in spec["row"])
            said = F.struct(turn.cast("long").alias("turn"), F.coalesce(role.cast("string"), F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
            print_ = _hash(F.array(*map(F.lit, found))) if found else F.lit(None).cast("long")
            one = F.when(print_ == _hash(F.array(*map(F.lit, spec["paths"]))), F.struct(F.lit(name).alias("layout"), said.alias("t"))).otherwise(one)
    key = F.col(f"`{have['$[*].conv_id']}`").cast("long") if "$[*].conv_id" in have else F.lit(None).cast("long")
    grouped = rows.select(key.alias("conv_id"), one.alias("o")).groupBy("conv_id").agg(F.max("o.layout").alias("layout"), F.sort_array(F.collect_list("o.t")).alias("ts"))
    turns = F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(TURNS)
    return grouped.select("conv_id", "layout", F.when(F.col("layout").isNotNull(), turns).alias("turns"))


def _chunks(array: str) -> Column:
    """An array cut into about as many pieces as each has elements, so that work within and over pieces stays small."""
    n = F.size(array)
    step = F.ceil(F.sqrt(n.cast("double"))).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, step), lambda s: F.slice(F.col(array), s + 1, step))).otherwise(F.transform(F.array().cast("array<int>"), lambda s: F.col(array)))


def render(canonical: DataFrame) -> DataFrame:
    """(conv_id, layout, formatted, loss_spans): spans are code points of assistant texts, end exclusive.

    Positions are running sums of the parts' lengths: over pieces of about the root of the number of turns, then
    within each piece."""
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), _escape(t["role"], ROLE_ESCAPES), F.lit(COLON)).alias("head"), _escape(t["text"], TEXT_ESCAPES).alias("body"), (t["role"] == "assistant").alias("loss")))
    sized = F.transform("parts", lambda p: F.struct(F.length(p["head"]).cast("long").alias("h"), F.length(p["body"]).cast("long").alias("b"), p["loss"].alias("loss")))
    whole = lambda p: p["h"] + p["b"] + len(CLOSE)
    totals = F.transform("pieces", lambda ps: F.aggregate(ps, F.lit(0).cast("long"), lambda acc, p: acc + whole(p)))
    starts = F.aggregate("totals", F.expr("array(0L)"), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    empty = "cast(array() as array<struct<start:bigint,end:bigint>>)"
    inside = F.transform("pieces", lambda ps, i: F.aggregate(
        ps, F.struct(F.get(F.col("starts"), i).alias("at"), F.expr(empty).alias("spans")), lambda acc, p: F.struct(
            (acc["at"] + whole(p)).alias("at"),
            F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + p["h"]).alias("start"), (acc["at"] + p["h"] + p["b"]).alias("end"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"]))
    laid = canonical.select("conv_id", "layout", parts.alias("parts")).withColumn("sized", sized).withColumn("pieces", _chunks("sized"))
    laid = laid.withColumn("totals", totals).withColumn("starts", starts)
    return laid.select("conv_id", "layout", F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
                       F.flatten(inside).alias("loss_spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """Adds the turns and the unescaped text under the loss mask, read from the formatted string alone."""
    pieces = F.split(F.col("formatted"), CLOSE, -1)
    bodies = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda x: F.substring(x, F.lit(len(OPEN) + 1), F.length(x)))
    turns = F.transform(bodies, lambda x: F.struct(
        _unescape(F.substring_index(x, COLON, 1), ROLE_ESCAPES).alias("role"),
        _unescape(F.substring(x, F.length(F.substring_index(x, COLON, 1)) + len(COLON) + 1, F.length(x)), TEXT_ESCAPES).alias("text")))
    # the stretch that a piece of the mask covers, then each span within it: no span is looked up from the text's start
    cut = lambda text, a, b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int"))
    stretches = F.transform("masks", lambda ss: F.struct(
        cut(F.col("formatted"), F.element_at(ss, 1)["start"], F.element_at(ss, -1)["end"]).alias("text"), F.element_at(ss, 1)["start"].alias("at"), ss.alias("spans")))
    masked = F.transform("stretches", lambda x: F.array_join(F.transform(x["spans"], lambda s: _unescape(cut(x["text"], s["start"] - x["at"], s["end"] - x["at"]), TEXT_ESCAPES)), ""))
    return (rendered.withColumn("turns", turns).withColumn("masks", _chunks("loss_spans")).withColumn("stretches", stretches)
            .withColumn("loss_text", F.array_join(masked, "")).drop("masks", "stretches"))


def digests(read: DataFrame) -> DataFrame:
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
escaped AS (
  SELECT *, length(replace(replace(replace(text, '\', '\0'), '###', '\1'), '</turn>', '\2')) AS text_chars,
    length(replace(replace(replace(replace(replace(role, '\', '\0'), '###', '\1'), '</turn>', '\2'), ':', '\3'), chr(10), '\4')) AS role_chars
  FROM rows),
whole AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns, sum(4 + role_chars + 2 + text_chars + 8)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss
  FROM escaped GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM whole
"""
