"""String and routing functions on model names, requests and items (Column -> Column).

Every function here compiles to native expressions (CASE, contains, rlike, split,
regexp_replace, higher-order functions).  Ordered rule lists are turned into one
CASE expression by ``first_match``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ----------------------------------------------------------------- generic helpers


def strip(c: Column) -> Column:
    """Remove all (Unicode) whitespace at both ends, like Python's ``str.strip()``.
    Spark's ``trim`` removes only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    """Stripped text, NULL when empty or missing."""
    return F.nullif(strip(c), F.lit(""))


def first_match(rules: list[tuple[Column, str]], default: Column | str | None = None) -> Column:
    """Ordered rule list -> one CASE expression: the first rule whose condition holds wins."""
    out = None
    for cond, value in rules:
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    if default is None:
        return out
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def _has(c: Column, *words: str) -> Column:
    cond = None
    for w in words:
        x = c.contains(w)
        cond = x if cond is None else (cond | x)
    return cond


# ----------------------------------------------------------------- routing rules


def route_provider(model: Column) -> Column:
    """D3: provider of a proprietary model by ordered substring rules on the lower-cased
    name; NULL when no rule matches (the caller treats that as an error)."""
    m = F.lower(model)
    # Provider rules, in the order they are tried.
    return first_match([
        (_has(m, "gpt", "o1", "o3", "o4"), "openai"),
        (_has(m, "claude"), "anthropic"),
        (_has(m, "jais", "k2", "llama"), "inception"),
        (_has(m, "gemini"), "google"),
        (_has(m, "deepseek"), "deepseek"),
        (_has(m, "mistral"), "mistral"),
        (_has(m, "grok"), "xai"),
    ])


def request_org(model: Column) -> Column:
    """Organisation folder of a request for a name without ``/``: a different rule list
    (``gpt`` anywhere or a leading ``o``; ``nanda`` but not ``llama``); ``unknown`` otherwise."""
    m = F.lower(model)
    # Request organisation rules, in the order they are tried.
    return first_match([
        (_has(m, "gpt") | m.startswith("o"), "openai"),
        (_has(m, "claude"), "anthropic"),
        (_has(m, "gemini"), "google"),
        (_has(m, "jais", "k2", "nanda"), "inception"),
        (_has(m, "deepseek"), "deepseek"),
        (_has(m, "mistral"), "mistral"),
        (_has(m, "grok"), "xai"),
    ], "unknown")


# Judges served by the inception endpoint (exact names).
INCEPTION_JUDGES = ["jais-30b", "jais-70b", "k2-65b"]


def route_judge(name: Column) -> Column:
    """Judge backend: regex ``gpt|o\\d+`` on the lower-cased name -> openai; contains
    ``claude`` -> anthropic; one of the exact inception names -> inception; else NULL
    (unknown judge, skipped)."""
    m = F.lower(name)
    return first_match([
        (m.rlike(r"gpt|o\d+"), "openai"),
        (m.contains("claude"), "anthropic"),
        (name.isin(*INCEPTION_JUDGES), "inception"),
    ])


def detect_license(model: Column) -> Column:
    """A name with ``/`` is an open (hub) model, anything else proprietary."""
    return F.when(model.contains("/"), F.lit("Open")).otherwise(F.lit("Proprietary"))


def request_bucket(model: Column) -> Column:
    """The request folder the licence selects."""
    return F.when(model.contains("/"), F.lit("OpenRequests")).otherwise(F.lit("ProprietaryRequests"))


# ----------------------------------------------------------------- names


def model_path_parts(path: Column) -> tuple[Column, Column]:
    """D7 (answer generation): org and model id = the last two parts of the path with
    leading/trailing ``/`` removed; NULL when fewer than two parts."""
    parts = F.split(F.regexp_replace(path, r"^/+|/+$", ""), "/")
    ok = F.size(parts) >= 2
    return (F.when(ok, F.element_at(parts, -2)), F.when(ok, F.element_at(parts, -1)))


def model_name_fields(model: Column) -> tuple[Column, Column]:
    """D7 (request registration): org and model id = first and second ``/`` fields; a name
    without ``/`` keeps itself as the id and takes its org from ``request_org``."""
    has = model.contains("/")
    org = F.when(has, F.split_part(model, F.lit("/"), F.lit(1))).otherwise(request_org(model))
    mid = F.when(has, F.split_part(model, F.lit("/"), F.lit(2))).otherwise(model)
    return org, mid


def safe_name(model: Column) -> Column:
    """``/`` and spaces -> ``_``."""
    return F.translate(model, "/ ", "__")


def answers_file_name(prefix: Column, model: Column, revision: Column, precision: Column) -> Column:
    """``<prefix>_<safe model>_<revision>_<precision>_answers.json``."""
    return F.concat_ws("_", prefix, safe_name(model), revision, precision, F.lit("answers.json"))


def request_file_name(model_id: Column, revision: Column, precision: Column) -> Column:
    """``<model id>_eval_request_<revision>_<precision>.json``."""
    return F.concat(model_id, F.lit("_eval_request_"), revision, F.lit("_"), precision, F.lit(".json"))


# ----------------------------------------------------------------- sizes


def precision_bits(precision: Column) -> Column:
    """Bits per parameter: float32/fp32 32, float16/fp16/bfloat16/bf16 16, int8 8,
    anything else 32."""
    p = F.lower(precision)
    return (F.when(p.isin("float32", "fp32"), 32)
            .when(p.isin("float16", "fp16", "bfloat16", "bf16"), 16)
            .when(p == "int8", 8).otherwise(32))


def params_from_bytes(total_bytes: Column, bits: Column) -> Column:
    """Estimated parameter count: folder size in GiB over the bytes of one parameter,
    in billions, truncated to an integer."""
    return F.floor(total_bytes / F.lit(float(1 << 30)) / (bits / 8) * 1e9).cast("bigint")


def params_billion(params: Column, total_bytes: Column, precision: Column) -> Column:
    """Parameters in billions, rounded to 3 digits.  An all-digit ``params`` string is
    already the count in billions (``"7"`` -> 7.0, ``"0"`` -> 0.0, Q21); anything else
    (``"0.5"``, ``"7B"``, empty, missing) is estimated from the folder size and precision."""
    given = F.coalesce(params, F.lit("")).rlike(r"\A[0-9]+\z")
    billions = (F.when(given, params.try_cast("double"))
                .otherwise(params_from_bytes(total_bytes, precision_bits(precision)) / F.lit(1e9)))
    return F.round(billions.try_cast("decimal(30,12)"), 3).cast("double")


def params_source(params: Column) -> Column:
    """Whether D10 used the given count (Q21) or the size estimate."""
    return (F.when(F.coalesce(params, F.lit("")).rlike(r"\A[0-9]+\z"), F.lit("given"))
            .otherwise(F.lit("estimated")))


# ----------------------------------------------------------------- requests


def status_category(status: Column) -> Column:
    """Upper-cased PENDING / FINISHED / FAILED -> folder name; anything else (and a
    missing status, which counts as PENDING) -> ``pending``."""
    s = F.upper(F.coalesce(status, F.lit("PENDING")))
    return (F.when(s == "FINISHED", F.lit("finished")).when(s == "FAILED", F.lit("failed"))
            .otherwise(F.lit("pending")))


#: The folders that requests lie in.
STATUS_CATEGORIES = ["pending", "finished", "failed"]


def unknown_status(status: Column) -> Column:
    """Q14 flag: a status outside PENDING / RUNNING / FINISHED / FAILED (e.g. REJECTED)."""
    return ~F.upper(F.coalesce(status, F.lit("PENDING"))).isin("PENDING", "RUNNING", "FINISHED", "FAILED")


def parse_list(arg: Column, lower: bool = False) -> Column:
    """Comma separated list -> array; judges are stripped and lower-cased, model
    names are kept verbatim."""
    parts = F.split(arg, ",")
    if lower:
        return F.filter(F.transform(parts, lambda x: F.lower(strip(x))), lambda x: x != "")
    return parts


# ----------------------------------------------------------------- answers and timing


def default_answer(answer: Column, license_: Column) -> Column:
    """An empty generated answer becomes ``None`` for open models and ``ERROR`` for
    proprietary ones."""
    fallback = F.when(license_ == "Proprietary", F.lit("ERROR")).otherwise(F.lit("None"))
    return F.coalesce(F.nullif(answer, F.lit("")), fallback)


def hms(seconds: Column) -> Column:
    """Elapsed seconds as ``HH:MM:SS.ss``."""
    h = F.floor(seconds / 3600)
    m = F.floor((seconds - h * 3600) / 60)
    # seconds rounded to 2 digits in decimal (HALF_UP) before formatting, so the text does
    # not depend on how a formatter rounds a binary double
    s = F.round((seconds - h * 3600 - m * 60).cast("decimal(20,8)"), 2).cast("double")
    return F.format_string("%02d:%02d:%05.2f", h.cast("int"), m.cast("int"), s)


def is_o_series(model: Column) -> Column:
    """Names whose calls drop the system message: ``o<digit>`` at the start, or
    ``o1`` / ``o3`` anywhere."""
    m = F.lower(model)
    return m.rlike(r"^o\d") | m.contains("o1") | m.contains("o3")
