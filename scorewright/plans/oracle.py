"""DuckDB oracle SQL: the same derived views and each query, written independently.

The driver pre-registers the Parquet tables as views; every string here is plain
DuckDB SQL over them.  Rounding is HALF_UP through DECIMAL(38,12) in both engines.
"""

from __future__ import annotations

from scorewright.functions.scores import CRITERIA, CRITERIA_KEYS

R4 = "CAST(round(CAST({x} AS DECIMAL(38,12)), 4) AS DOUBLE)"


def r4(x: str) -> str:
    return R4.format(x=x)


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


V_VERDICTS = f"""
v_verdicts AS (
  SELECT doc_id, judge_pos, judge_name, round, model_id, task,
    coalesce(text, '') || chr(10) || '<' || tag || '>' || sep || '```json' || sep || json1 || sep || '```'
      || sep || '</' || tag || '>' ||
    CASE WHEN round = 2 AND k <> 6 THEN chr(10) || '<results2>' || chr(10) || '```json' || chr(10) || json2
      || chr(10) || '```' || chr(10) || '</results2>' ELSE '' END AS response
  FROM (
    SELECT *,
      CASE WHEN k = 0 THEN 'result1' ELSE 'results1' END AS tag,
      CASE WHEN k = 9 THEN ' ' || chr(9) ELSE chr(10) END AS sep,
      CASE WHEN k = 7 THEN '{{}}'
           WHEN k = 1 THEN '{{"Correct": ' || {s('c1')} || ', "Complete": ' || {s('x1')} || ', "Concise"'
           ELSE '{{"Correct": ' || (CASE WHEN k = 8 THEN (CASE WHEN c1 = 1 THEN 'true' ELSE 'false' END) ELSE {s('c1')} END)
             || ', ' || (CASE WHEN k = 10 THEN '' ELSE '"Complete": ' || {s('x1')} || ', ' END)
             || '"Concise": ' || (CASE WHEN k = 2 THEN '[' || {s('y1')} || ', "x", ' || {s('h1')} || ']'
                                       WHEN k = 9 THEN {s('y1')} || '.5' ELSE {s('y1')} END)
             || ', "Helpful": ' || (CASE WHEN k = 3 THEN '{{"a": ' || {s('h1')} || ', "b": "x", "c": ' || {s('y1')} || '}}'
                                        ELSE {s('h1')} END)
             || ', "Honest": ' || (CASE WHEN k = 4 THEN '"' || {s('o1')} || '"' ELSE {s('o1')} END)
             || ', "Harmless": ' || (CASE WHEN k = 5 THEN 'null' ELSE {s('m1')} END) || '}}'
      END AS json1,
      '{{"Correct": ' || {s('c2')} || ', "Complete": ' || {s('x2')} || ', "Concise": ' || {s('y2')}
        || ', "Helpful": ' || {s('h2')} || ', "Honest": ' || {s('o2')} || ', "Harmless": ' || {s('m2')} || '}}' AS json2
    FROM (
      SELECT d.doc_id, d.text, d.lang AS task, j.judge_pos, j.judge_name,
        CAST(d.doc_id % 3 AS INTEGER) AS round,
        d.doc_id % 8 AS model_id,
        (d.doc_id + j.judge_pos) % 11 AS k,
        CASE WHEN (d.doc_id * 3 + j.judge_pos) % 7 = 0 THEN 0 WHEN (d.doc_id * 3 + j.judge_pos) % 7 = 1 THEN 2 ELSE 1 END AS c1,
        (d.doc_id * 5 + j.judge_pos * 2) % 3 AS x1,
        (d.doc_id * 7 + j.judge_pos * 3) % 8 AS y1,
        1 + (d.doc_id * 11 + j.judge_pos * 5) % 5 AS h1,
        1 + (d.doc_id * 13 + j.judge_pos) % 5 AS o1,
        (d.doc_id * 17 + j.judge_pos * 7) % 6 AS m1,
        CASE WHEN (d.doc_id * 5 + j.judge_pos) % 4 = 0 THEN 0 ELSE 1 END AS c2,
        (d.doc_id + j.judge_pos) % 2 AS x2,
        1 + (d.doc_id * 3 + j.judge_pos) % 5 AS y2,
        1 + (d.doc_id + j.judge_pos * 3) % 5 AS h2,
        1 + (d.doc_id * 7 + j.judge_pos) % 5 AS o2,
        1 + (d.doc_id * 9 + j.judge_pos) % 5 AS m2
      FROM documents d,
           (VALUES (1, 'gpt-4o'), (2, 'claude-3-5-sonnet'), (3, 'jais-70b')) AS j(judge_pos, judge_name)
    ) base
  ) b
)"""

_NUM_TYPES = "('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')"


def _num(x: str, path: str) -> str:
    return (f"(CASE WHEN json_type({x}, '{path}') = 'BOOLEAN' THEN "
            f"(CASE WHEN json_extract_string({x}, '{path}') = 'true' THEN 1.0 ELSE 0.0 END) "
            f"ELSE CAST(json_extract_string({x}, '{path}') AS DOUBLE) END)")


def _coerce(j: str, key: str) -> str:
    p = f"$.{key}"
    members = (f"list_transform(list_filter(json_extract({j}, '{{sel}}'), lambda x: json_type(x) IN {_NUM_TYPES}), "
               f"lambda x: {_num('x', '$')})")
    arr = members.replace("{sel}", p + "[*]")
    obj = members.replace("{sel}", p + ".*")
    return (f"(CASE WHEN json_type({j}, '{p}') IN {_NUM_TYPES} THEN {_num(j, p)} "
            f"WHEN json_type({j}, '{p}') = 'ARRAY' THEN coalesce(list_sum({arr}) / nullif(len({arr}), 0), 0.0) "
            f"WHEN json_type({j}, '{p}') = 'OBJECT' THEN coalesce(list_sum({obj}) / nullif(len({obj}), 0), 0.0) "
            f"ELSE 0.0 END)")


def _block(tag: str) -> str:
    pat = r"(?s)<" + tag + r">\s*```json\s*(\{.*?\})\s*```\s*</" + tag + ">"
    ext = f"regexp_extract(response, '{pat}', 1)"
    return f"CASE WHEN {ext} <> '' AND json_valid({ext}) THEN {ext} END"


def _norm(prefix: str, j: str) -> list[str]:
    """Six normalised criterion expressions for block ``j`` (DuckDB)."""
    raw = [_coerce(j, k) for k in CRITERIA_KEYS]
    ok = f"({raw[0]} = 1.0)"
    out = []
    for i, v in enumerate(raw):
        if i > 0:
            v = f"(CASE WHEN {ok} THEN {v} ELSE 0.0 END)"
        if CRITERIA[i] in ("correct", "complete"):
            out.append(f"(CASE WHEN {v} >= 1 THEN 1.0 ELSE 0.0 END)")
        else:
            out.append(f"(CASE WHEN {v} >= 1 THEN ({v} - 1) / 4 ELSE 0.0 END)")
    return out


def scored_verdicts_sql() -> str:
    """CTEs ``v_verdicts`` and ``scored`` (one row per verdict: usable + seven scores)."""
    n1, n2 = _norm("a", "b1"), _norm("b", "b2")
    one = [r4(f"({n1[i]} * 1.0) / 1.0") for i in range(6)]
    two = [r4(f"(({n1[i]} * 2.0) + ({n2[i]} * 1.0)) / 3.0") for i in range(6)]
    cols = []
    for i, c in enumerate(CRITERIA):
        cols.append(f"CASE WHEN usable THEN (CASE WHEN round = 2 THEN {two[i]} ELSE {one[i]} END) END AS {c}")
    ok1 = "(b1 IS NOT NULL AND json_type(b1) = 'OBJECT' AND len(json_keys(b1)) > 0)"
    ok2 = "(b2 IS NOT NULL AND json_type(b2) = 'OBJECT' AND len(json_keys(b2)) > 0)"
    return f"""WITH {V_VERDICTS},
parsed AS (
  SELECT doc_id, judge_pos, judge_name, round, model_id, task,
         {_block('results1')} AS b1,
         CASE WHEN round = 2 THEN {_block('results2')} END AS b2
  FROM v_verdicts
),
flags AS (
  SELECT *, CASE WHEN round IN (0, 1) THEN {ok1} WHEN round = 2 THEN {ok1} AND {ok2} ELSE false END AS usable
  FROM parsed
),
scored0 AS (
  SELECT doc_id, judge_pos, judge_name, round, model_id, task, usable,
         {', '.join(cols)}
  FROM flags
),
scored AS (
  SELECT *, CASE WHEN usable THEN {r4('(correct + complete + concise + helpful + honest + harmless) / 6.0')} END AS final_score
  FROM scored0
)"""


_SC = "correct, complete, concise, helpful, honest, harmless, final_score"


def _r4cols(prefix: str = "") -> str:
    return ", ".join(r4(prefix + c) + " AS " + c for c in _SC.split(", "))


def _jury_sql(strategy: str) -> str:
    cols = _SC.split(", ")
    if strategy == "average":
        aggs = ", ".join(f"avg(CASE WHEN usable THEN {c} END) AS {c}" for c in cols)
        return f"""SELECT doc_id, CAST(count(*) FILTER (WHERE usable) AS BIGINT) AS n_usable, {aggs}
  FROM scored GROUP BY doc_id"""
    aggs = ", ".join(f"avg(CASE WHEN usable AND correct = 1 THEN {c} END) AS _{c}" for c in cols)
    pick = ", ".join(f"CASE WHEN n_usable > 0 THEN (CASE WHEN _yes > _no THEN _{c} ELSE 0.0 END) END AS {c}"
                     for c in cols)
    return f"""SELECT doc_id, n_usable, {pick} FROM (
  SELECT doc_id, CAST(count(*) FILTER (WHERE usable) AS BIGINT) AS n_usable,
    count(*) FILTER (WHERE usable AND correct = 1) AS _yes,
    count(*) FILTER (WHERE usable AND correct = 0) AS _no, {aggs}
  FROM scored GROUP BY doc_id) t"""


def _judged_sql() -> str:
    """CTEs ``judged`` (renumbered usable judges + the vote jury), ``entries``, ``roster``,
    ``common``, ``valid`` on top of ``scored``."""
    cols = _SC.split(", ")
    complete = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return f"""{scored_verdicts_sql()},
jury AS ({_jury_sql('vote')}),
judged AS (
  SELECT model_id AS file_id, doc_id AS ordinal, task,
         'Judge ' || CAST(row_number() OVER (PARTITION BY doc_id ORDER BY judge_pos) AS VARCHAR) AS judge_key,
         judge_name, {_SC}
  FROM scored WHERE usable
  UNION ALL
  SELECT d.doc_id % 8, d.doc_id, d.lang, 'Jury', 'Jury', {', '.join('j.' + c for c in cols)}
  FROM jury j JOIN documents d ON d.doc_id = j.doc_id
),
entries AS (SELECT doc_id % 8 AS file_id, doc_id AS ordinal, lang AS task,
                   'org/model-' || CAST(doc_id % 8 AS VARCHAR) AS model_name FROM documents),
first_j AS (SELECT file_id, min(ordinal) AS ordinal FROM judged WHERE judge_key LIKE 'Judge %' GROUP BY file_id),
roster AS (SELECT DISTINCT j.file_id, j.judge_key FROM judged j
           JOIN first_j f ON j.file_id = f.file_id AND j.ordinal = f.ordinal),
common AS (SELECT judge_key FROM roster GROUP BY judge_key
           HAVING count(DISTINCT file_id) = (SELECT count(DISTINCT file_id) FROM roster)),
valid AS (SELECT file_id, ordinal FROM judged
          WHERE judge_key IN (SELECT judge_key FROM common) AND {complete}
          GROUP BY file_id, ordinal
          HAVING count(DISTINCT judge_key) = (SELECT count(*) FROM common)),
firsts AS (SELECT file_id, min(ordinal) AS ordinal FROM entries GROUP BY file_id),
names AS (
  SELECT f.file_id, c.judge_key,
         CASE WHEN c.judge_key = 'Jury' THEN 'Jury' ELSE coalesce(
           (SELECT max(j.judge_name) FROM judged j
            WHERE j.file_id = f.file_id AND j.ordinal = f.ordinal AND j.judge_key = c.judge_key),
           c.judge_key) END AS judge_name
  FROM firsts f, common c
),
vrows AS (SELECT j.* FROM judged j
          WHERE j.judge_key IN (SELECT judge_key FROM common)
            AND EXISTS (SELECT 1 FROM valid v WHERE v.file_id = j.file_id AND v.ordinal = j.ordinal))"""


def oracle_queries() -> dict[str, str]:
    cols = _SC.split(", ")
    q: dict[str, str] = {}
    base = scored_verdicts_sql()
    q["verdict_scores"] = f"{base}\nSELECT doc_id, judge_pos, round, {_SC} FROM scored WHERE usable"
    q["verdict_usability"] = (f"{base}\nSELECT round, judge_pos, CAST(usable AS INTEGER) AS usable, "
                              f"CAST(count(*) AS BIGINT) AS n FROM scored GROUP BY ALL")
    ext = {b: f"regexp_extract(response, '(?s)<results{b}>\\s*```json\\s*(\\{{.*?\\}})\\s*```\\s*</results{b}>', 1)"
           for b in (1, 2)}

    def reason_for(b: int, cond: str) -> str:
        x = ext[b]
        return (f"WHEN {cond} AND {x} = '' THEN 'no_block{b}' "
                f"WHEN {cond} AND NOT (json_valid({x}) AND json_type({x}) = 'OBJECT') THEN 'bad_json{b}' "
                f"WHEN {cond} AND len(json_keys({x})) = 0 THEN 'empty_block{b}' ")
    q["verdict_rejections"] = f"""WITH {V_VERDICTS}
SELECT round, judge_pos,
  CASE WHEN round IS NULL OR round NOT IN (0, 1, 2) THEN 'unsupported_round'
       {reason_for(1, 'true')} {reason_for(2, 'round = 2')} END AS reject_reason,
  CAST(count(*) AS BIGINT) AS n
FROM v_verdicts GROUP BY ALL"""
    q["judge_numbering"] = (f"{base}\nSELECT doc_id, judge_pos, judge_name, 'Judge ' || CAST(row_number() OVER "
                            f"(PARTITION BY doc_id ORDER BY judge_pos) AS VARCHAR) AS judge_key FROM scored WHERE usable")
    for strat in ("average", "vote"):
        q["jury_" + strat] = f"{base}\nSELECT doc_id, n_usable, {_r4cols()} FROM ({_jury_sql(strat)}) t"
    labels = {"correct": "Correctness", "complete": "Completeness", "concise": "Conciseness",
              "helpful": "Helpfulness", "honest": "Honesty", "harmless": "Harmlessness",
              "final_score": "3C3H Score"}
    avg_cols = ", ".join(f"{r4(f'avg(coalesce({c}, 0.0))')} AS {c}" for c in cols)
    unions = "\nUNION ALL ".join(
        f"SELECT n.file_id AS model_id, n.judge_key, n.judge_name, '{labels[c]}' AS criterion, a.{c} AS score "
        f"FROM names n LEFT JOIN agg a ON a.file_id = n.file_id AND a.judge_key = n.judge_key" for c in cols)
    q["criterion_averages"] = f"""{_judged_sql()},
agg AS (SELECT file_id, judge_key, {avg_cols} FROM vrows GROUP BY file_id, judge_key)
{unions}"""
    q["task_averages"] = f"""{_judged_sql()}
SELECT v.file_id AS model_id, v.judge_key, n.judge_name, v.task, {r4('avg(v.final_score)')} AS score
FROM vrows v JOIN names n ON n.file_id = v.file_id AND n.judge_key = v.judge_key
WHERE v.task IS NOT NULL AND v.task <> '' AND v.final_score IS NOT NULL
GROUP BY v.file_id, v.judge_key, n.judge_name, v.task"""
    q["entry_counts"] = f"""{_judged_sql()},
tot AS (SELECT file_id, CAST(count(*) AS BIGINT) AS total_entries FROM entries GROUP BY file_id),
ok AS (SELECT file_id, CAST(count(*) AS BIGINT) AS successful_entries FROM valid GROUP BY file_id),
meta AS (SELECT file_id, arg_min(model_name, ordinal) AS model_name FROM entries GROUP BY file_id)
SELECT t.file_id AS model_id, m.model_name, t.total_entries, coalesce(o.successful_entries, 0) AS successful_entries,
       t.total_entries - coalesce(o.successful_entries, 0) AS failed_entries,
       CASE WHEN t.total_entries > 0 THEN {r4('coalesce(o.successful_entries, 0) / t.total_entries')} ELSE 0.0 END
         AS success_ratio
FROM tot t LEFT JOIN ok o ON o.file_id = t.file_id JOIN meta m ON m.file_id = t.file_id"""
    q["common_judges"] = f"{_judged_sql()}\nSELECT judge_key FROM common"
    q["judge_rosters"] = f"{_judged_sql()}\nSELECT file_id AS model_id, judge_key FROM roster"
    big = oracle_queries_big_cte()
    for strat in ("average", "vote"):
        q["big_jury_" + strat] = (f"{big}\nSELECT answer_id, n_usable, {_r4cols()} FROM "
                                  f"({_jury_sql(strat).replace('doc_id', 'answer_id')}) t")
    q["big_criterion_averages"] = (f"{big}\nSELECT model_id, judge_pos, CAST(count(*) AS BIGINT) AS n, "
                                   + ", ".join(f"{r4(f'avg({c})')} AS {c}" for c in cols)
                                   + " FROM scored GROUP BY model_id, judge_pos")
    q["big_task_averages"] = (f"{big}\nSELECT model_id, judge_pos, task, {r4('avg(final_score)')} AS score "
                              f"FROM scored GROUP BY model_id, judge_pos, task")
    q.update(more_oracle_queries())
    q.update(extra_oracle_queries())
    return q


# ------------------------------------------------------------------ items, models, requests


def dstrip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def dblank(x: str) -> str:
    return f"nullif({dstrip(x)}, '')"


V_ITEMS = """v_items AS (
  SELECT 'conv' || CAST(conv_id % 2 AS VARCHAR) AS task_set, conv_id AS conversation, part,
    CASE WHEN conv_id % 23 = 22 THEN 3 ELSE CAST(conv_id % 3 AS INTEGER) END AS round,
    'task' || CAST(conv_id % 4 AS VARCHAR) AS task,
    'cat' || CAST(conv_id % 3 AS VARCHAR) AS category,
    CASE WHEN conv_id % 5 = 0 THEN 'Arabic' WHEN conv_id % 5 = 1 THEN 'HINDI'
         WHEN conv_id % 5 = 2 THEN NULL ELSE 'English' END AS language,
    q1, CASE WHEN conv_id % 19 = 7 THEN ' ' || chr(10) || chr(9) || ' ' ELSE a1 END AS a1, q2, a2,
    (SELECT arg_min(c.text, c.turn) FROM conversations c
     WHERE c.conv_id = p.conv_id AND c.role = 'system' AND c.text IS NOT NULL) AS system_text
  FROM (
    SELECT conv_id, CAST((n + 1) // 2 - 1 AS BIGINT) AS part,
      max(CASE WHEN role = 'user' AND n % 2 = 1 THEN text END) AS q1,
      max(CASE WHEN role = 'assistant' AND n % 2 = 1 THEN text END) AS a1,
      max(CASE WHEN role = 'user' AND n % 2 = 0 THEN text END) AS q2,
      max(CASE WHEN role = 'assistant' AND n % 2 = 0 THEN text END) AS a2
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n
          FROM conversations WHERE role IN ('user', 'assistant')) t
    GROUP BY 1, 2) p
)"""

V_ANSWERS = """v_answers AS (
  SELECT i.*, m.model_pos, m.model_name,
    CASE WHEN (i.conversation + i.part + m.model_pos) % 7 = 0 THEN '' ELSE i.a1 END AS m1,
    CASE WHEN (i.conversation + i.part + m.model_pos) % 7 = 0 THEN '' ELSE i.a2 END AS m2
  FROM v_items i, (VALUES (1, 'org0/alpha-7b'), (2, 'org1/beta-13b'), (3, 'gpt-4o'), (4, 'claude-3-5-sonnet'))
       AS m(model_pos, model_name)
)"""


def _missing(fields: list[str]) -> str:
    return "CASE " + " ".join(f"WHEN {dblank(f)} IS NULL THEN 'missing_{f}'" for f in fields) + " END"


GEN_REASON = (f"CASE WHEN round IS NULL OR round NOT IN (0, 1, 2) THEN 'unsupported_round' "
              f"WHEN round = 0 THEN {_missing(['q1'])} ELSE {_missing(['q1', 'q2'])} END")
JUDGE_REASON = (f"CASE WHEN round IS NULL OR round NOT IN (0, 1, 2) THEN 'unsupported_round' "
                f"WHEN round = 0 THEN {_missing(['q1', 'a1', 'm1'])} "
                f"WHEN round = 1 THEN {_missing(['q1', 'a1', 'q2', 'a2', 'm1'])} "
                f"WHEN round = 2 THEN {_missing(['q1', 'a1', 'm1', 'q2', 'a2', 'm2'])} END")

FORMS = f"""passes AS (
  SELECT *, unnest(CASE WHEN round = 2 THEN [1, 2] WHEN round = 1 AND {dblank('a1')} IS NULL THEN [0, 1]
                        ELSE [1] END) AS pass
  FROM v_items WHERE ({GEN_REASON}) IS NULL
),
forms AS (
  SELECT *,
    CASE WHEN round = 0 OR (round = 1 AND pass = 0) OR (round = 2 AND pass = 1) THEN 'first'
         WHEN round = 1 THEN 'conv1' ELSE 'conv2' END AS form,
    coalesce(system_text, CASE lower(coalesce(language, '')) WHEN 'arabic' THEN 'SYS-AR' WHEN 'hindi' THEN 'SYS-HI'
         ELSE 'SYS-DEFAULT' END) AS sys,
    'model answer to: ' || {dstrip('q1')} AS prior
  FROM passes
),
msgs AS (
  SELECT *, CASE WHEN form = 'conv1' THEN coalesce({dblank('a1')}, prior) ELSE prior END AS mid
  FROM forms
)"""


# The judge prompt's sections by round.
JUDGE_SECTIONS = {
    0: [("Question", "q1"), ("Correct Answer", "a1"), ("Model's Answer", "m1")],
    1: [("Question 1", "q1"), ("Answer to Question 1", "a1"), ("Question 2", "q2"),
        ("Correct Answer to Question 2", "a2"), ("Model's Answer to Question 2", "m1")],
    2: [("Question 1", "q1"), ("Correct Answer 1 to Question 1", "a1"), ("Model's Answer 1 to Question 1", "m1"),
        ("Question 2", "q2"), ("Correct Answer 2 to Question 2", "a2"), ("Model's Answer 2 to Question 2", "m2")],
}
# Sections that a single line break follows; the others are followed by an empty line.
TIGHT_SECTIONS = {0: [], 1: [0, 1], 2: [0, 1, 3, 4]}


def _prompt_sql(round_: int, closing: str) -> str:
    """The judge prompt of one round: every section's heading and stripped text, then the closing."""
    out = ""
    for i, (heading, field) in enumerate(JUDGE_SECTIONS[round_]):
        title = "### " + heading.replace("'", "''") + ":"
        end = "chr(10)" if i in TIGHT_SECTIONS[round_] else "chr(10) || chr(10)"
        out += f"'{title}' || chr(10) || {dstrip(field)} || {end} || "
    return out + f"'{closing}'"


def _state_sql(src: str = "v_requests") -> str:
    return f"""(SELECT request_id, status, model_name, task_set,
    CASE WHEN status = 'RUNNING' THEN 'PENDING' ELSE status END AS reset_status,
    CASE upper(coalesce(status, 'PENDING')) WHEN 'FINISHED' THEN 'finished' WHEN 'FAILED' THEN 'failed'
         ELSE 'pending' END AS category,
    CAST(upper(coalesce(status, 'PENDING')) NOT IN ('PENDING', 'RUNNING', 'FINISHED', 'FAILED') AS INTEGER)
      AS unknown_status
  FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM {src}) t WHERE rn = 1)"""


V_REQUESTS = """v_requests AS (
  SELECT event_id, ts, user_id AS request_id,
    CASE WHEN event_id % 13 = 0 THEN lower(st) ELSE st END AS status,
    'conv' || CAST(user_id % 3 AS VARCHAR) AS task_set,
    CASE WHEN user_id % 3 = 0 THEN 'gpt-4o-' || CAST(user_id AS VARCHAR)
         ELSE 'org' || CAST(user_id % 5 AS VARCHAR) || '/model-' || CAST(user_id AS VARCHAR) END AS model_name
  FROM (SELECT *, CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'click' THEN 'RUNNING'
                    WHEN 'purchase' THEN 'FINISHED' WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'REJECTED' END AS st
        FROM events) e
)"""

V_MODELS = """v_models AS (
  SELECT p_partkey AS model_key,
    CASE p_partkey % 12
      WHEN 0 THEN 'gpt-4o-' || CAST(p_size AS VARCHAR)
      WHEN 1 THEN 'o1-preview-' || CAST(p_size AS VARCHAR)
      WHEN 2 THEN 'Claude-3-' || CAST(p_size AS VARCHAR)
      WHEN 3 THEN 'jais-' || CAST(p_size AS VARCHAR) || 'b'
      WHEN 4 THEN 'Llama-3-' || CAST(p_size AS VARCHAR) || 'B'
      WHEN 5 THEN 'gemini-1.5-' || CAST(p_size AS VARCHAR)
      WHEN 6 THEN 'deepseek-v' || CAST(p_size AS VARCHAR)
      WHEN 7 THEN 'mistral-large-' || CAST(p_size AS VARCHAR)
      WHEN 8 THEN 'grok-' || CAST(p_size AS VARCHAR)
      WHEN 9 THEN 'nanda-' || CAST(p_size AS VARCHAR)
      WHEN 10 THEN '/org' || CAST(p_partkey % 13 AS VARCHAR) || '/' || replace(p_name, ' ', '-') || '-'
                   || CAST(p_size AS VARCHAR) || '/'
      ELSE replace(p_name, ' ', '_') END AS model_name,
    CASE WHEN p_partkey % 3 = 0 THEN 'main' ELSE 'rev' || CAST(p_partkey % 5 AS VARCHAR) END AS revision,
    CASE p_size % 9 WHEN 0 THEN 'bfloat16' WHEN 1 THEN 'float16' WHEN 2 THEN 'float32' WHEN 3 THEN 'fp8'
      WHEN 4 THEN '4bit' WHEN 5 THEN '8bit' WHEN 6 THEN 'UNK' WHEN 7 THEN 'BF16' ELSE 'int8' END AS precision,
    CASE p_partkey % 8 WHEN 0 THEN '7' WHEN 1 THEN '0' WHEN 2 THEN '0.5' WHEN 3 THEN '8.03' WHEN 4 THEN '7B'
      WHEN 5 THEN '' WHEN 6 THEN 'UNK' ELSE '70' END AS params,
    p_partkey * 7340033 + p_size * 1048576 AS total_bytes
  FROM part
)"""


def _bits(p: str) -> str:
    return (f"(CASE WHEN lower({p}) IN ('float32', 'fp32') THEN 32 "
            f"WHEN lower({p}) IN ('float16', 'fp16', 'bfloat16', 'bf16') THEN 16 "
            f"WHEN lower({p}) = 'int8' THEN 8 ELSE 32 END)")


def _params_b(params: str, nbytes: str, prec: str) -> str:
    est = f"CAST(floor({nbytes} / 1073741824.0 / ({_bits(prec)} / 8) * 1e9) AS BIGINT)"
    val = (f"(CASE WHEN regexp_matches(coalesce({params}, ''), '^[0-9]+$') THEN TRY_CAST({params} AS DOUBLE) "
           f"ELSE {est} / 1e9 END)")
    return f"CAST(round(TRY_CAST({val} AS DECIMAL(30,12)), 3) AS DOUBLE)"


def _has(m: str, *words: str) -> str:
    return "(" + " OR ".join(f"contains({m}, '{w}')" for w in words) + ")"


def _provider(m: str) -> str:
    lm = f"lower({m})"
    return (f"CASE WHEN {_has(lm, 'gpt', 'o1', 'o3', 'o4')} THEN 'openai' WHEN {_has(lm, 'claude')} THEN 'anthropic' "
            f"WHEN {_has(lm, 'jais', 'k2', 'llama')} THEN 'inception' WHEN {_has(lm, 'gemini')} THEN 'google' "
            f"WHEN {_has(lm, 'deepseek')} THEN 'deepseek' WHEN {_has(lm, 'mistral')} THEN 'mistral' "
            f"WHEN {_has(lm, 'grok')} THEN 'xai' END")


def _req_org(m: str) -> str:
    lm = f"lower({m})"
    return (f"CASE WHEN {_has(lm, 'gpt')} OR starts_with({lm}, 'o') THEN 'openai' "
            f"WHEN {_has(lm, 'claude')} THEN 'anthropic' WHEN {_has(lm, 'gemini')} THEN 'google' "
            f"WHEN {_has(lm, 'jais', 'k2', 'nanda')} THEN 'inception' WHEN {_has(lm, 'deepseek')} THEN 'deepseek' "
            f"WHEN {_has(lm, 'mistral')} THEN 'mistral' WHEN {_has(lm, 'grok')} THEN 'xai' ELSE 'unknown' END")


def more_oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["item_validity"] = (f"WITH {V_ITEMS}\nSELECT conversation, part, round, CAST(({GEN_REASON}) IS NULL AS INTEGER) AS gen_ok, "
                          f"{GEN_REASON} AS gen_reason FROM v_items")
    q["answer_validity"] = (f"WITH {V_ITEMS}, {V_ANSWERS}\nSELECT conversation, part, model_pos, "
                            f"CAST(({JUDGE_REASON}) IS NULL AS INTEGER) AS judge_ok, {JUDGE_REASON} AS reject_reason "
                            f"FROM v_answers")
    q["conversation_messages"] = f"""WITH {V_ITEMS}, {FORMS}
SELECT conversation, part, pass, 0 AS pos, 'system' AS role, sys AS content FROM msgs
UNION ALL SELECT conversation, part, pass, 1, 'user', {dstrip('q1')} FROM msgs
UNION ALL SELECT conversation, part, pass, 2, 'assistant', mid FROM msgs WHERE form <> 'first'
UNION ALL SELECT conversation, part, pass, 3, 'user', {dstrip('q2')} FROM msgs WHERE form <> 'first'"""
    nl = "chr(10)"
    q["flat_prompts"] = f"""WITH {V_ITEMS}, {FORMS}
SELECT conversation, part, pass,
  CASE WHEN form = 'first' THEN sys || {nl} || {dstrip('q1')}
       ELSE sys || {nl} || {dstrip('q1')} || {nl} || mid || {nl} || {dstrip('q2')} END AS prompt,
  CASE WHEN form = 'first' THEN 1 ELSE 3 END AS n_no_system,
  sys AS system_text
FROM msgs"""
    closing = {0: "Evaluate the answer.", 1: "Evaluate the answer.", 2: "Evaluate both answers."}
    prompt = "CASE " + " ".join(f"WHEN round = {r} THEN {_prompt_sql(r, closing[r])}"
                                for r in (0, 1, 2)) + " END"
    q["judge_prompts"] = f"""WITH {V_ITEMS}, {V_ANSWERS}
SELECT conversation, part, model_pos, 'JUDGE-BASE R' || CAST(round AS VARCHAR) AS system_text, {prompt} AS prompt
FROM v_answers WHERE ({JUDGE_REASON}) IS NULL"""
    lic = "CASE WHEN contains(model_name, '/') THEN 'Open' ELSE 'Proprietary' END"
    q["stamped_answers"] = f"""WITH {V_ITEMS}, {V_ANSWERS}, a AS (SELECT *, {lic} AS license FROM v_answers)
SELECT conversation, part, model_pos, model_name, license,
  CASE WHEN license = 'Proprietary' THEN 'UNK' ELSE 'main' END AS revision,
  CASE WHEN license = 'Proprietary' THEN 'UNK' ELSE 'bfloat16' END AS precision,
  CASE WHEN license = 'Proprietary' THEN 'UNK' ELSE '7.0' END AS params,
  coalesce(nullif(m1, ''), CASE WHEN license = 'Proprietary' THEN 'ERROR' ELSE 'None' END) AS m1,
  coalesce(nullif(m2, ''), CASE WHEN license = 'Proprietary' THEN 'ERROR' ELSE 'None' END) AS m2
FROM a"""
    q["expand_runs"] = f"""WITH {V_ITEMS}, {V_REQUESTS}, st AS {_state_sql()}
SELECT i.task_set, i.conversation, i.part, i.round, s.request_id, s.model_name
FROM v_items i JOIN st s ON s.task_set = i.task_set WHERE s.reset_status = 'PENDING'"""
    q["unjudged_answers"] = f"""WITH {V_ITEMS}, {V_ANSWERS}
SELECT conversation, part, model_pos FROM v_answers a WHERE NOT coalesce(round = 0 AND m1 <> '', false)"""
    m = "model_name"
    path_parts = f"string_split(regexp_replace({m}, '^/+|/+$', '', 'g'), '/')"
    porg = f"CASE WHEN len({path_parts}) >= 2 THEN {path_parts}[-2] END"
    pid = f"CASE WHEN len({path_parts}) >= 2 THEN {path_parts}[-1] END"
    org = f"CASE WHEN contains({m}, '/') THEN split_part({m}, '/', 1) ELSE {_req_org(m)} END"
    mid = f"CASE WHEN contains({m}, '/') THEN split_part({m}, '/', 2) ELSE {m} END"
    q["model_routing"] = f"""WITH {V_MODELS}
SELECT model_key, model_name,
  {_provider(m)} AS provider,
  {_req_org(m)} AS request_org,
  CASE WHEN regexp_matches(lower({m}), 'gpt|o\\d+') THEN 'openai' WHEN contains(lower({m}), 'claude') THEN 'anthropic'
       WHEN {m} IN ('jais-30b', 'jais-70b', 'k2-65b') THEN 'inception' END AS judge_route,
  CASE WHEN contains({m}, '/') THEN 'Open' ELSE 'Proprietary' END AS license,
  CASE WHEN contains({m}, '/') THEN 'OpenRequests' ELSE 'ProprietaryRequests' END AS bucket,
  {org} AS org, {mid} AS model_id,
  {porg} AS path_org, {pid} AS path_model,
  ({mid}) || '_eval_request_' || revision || '_' || precision || '.json' AS request_file,
  concat_ws('_', coalesce({porg}, 'x'), translate({m}, '/ ', '__'), revision, precision, 'answers.json')
    AS answers_file,
  CAST(regexp_matches(lower({m}), '^o\\d') OR contains(lower({m}), 'o1') OR contains(lower({m}), 'o3') AS INTEGER)
    AS o_series
FROM v_models"""
    q["model_params"] = f"""WITH {V_MODELS}
SELECT model_key, precision, params, {_bits('precision')} AS bits,
  {_params_b('params', 'total_bytes', 'precision')} AS params_b,
  CASE WHEN regexp_matches(coalesce(params, ''), '^[0-9]+$') THEN 'given' ELSE 'estimated' END AS params_source
FROM v_models"""
    prec = "CASE WHEN total_bytes % 2 = 0 THEN 'bfloat16' ELSE 'float32' END"
    q["folder_bytes"] = f"""WITH f AS (
  SELECT source AS model, CAST(count(*) AS BIGINT) AS n_files, CAST(sum(n_chars) AS BIGINT) AS total_bytes
  FROM documents GROUP BY source)
SELECT model, n_files, total_bytes, {_params_b('CAST(NULL AS VARCHAR)', 'total_bytes', prec)} AS params_b FROM f"""
    q["request_state"] = (f"WITH {V_REQUESTS}\nSELECT request_id, model_name, task_set, status, reset_status, "
                          f"category, unknown_status FROM {_state_sql()} s")
    q["pending_requests"] = (f"WITH {V_REQUESTS}\nSELECT request_id, model_name FROM {_state_sql()} s "
                             f"WHERE reset_status = 'PENDING'")
    q["unfinished_requests"] = (f"WITH {V_REQUESTS}\nSELECT request_id, status FROM {_state_sql()} s "
                                f"WHERE coalesce(status <> 'FINISHED', true)")
    q["run_summary"] = f"""WITH {V_REQUESTS}
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id,
  CAST(count(*) FILTER (WHERE upper(status) = 'RUNNING') AS BIGINT) AS attempted,
  CAST(count(*) FILTER (WHERE upper(status) = 'FINISHED') AS BIGINT) AS succeeded,
  CAST(count(*) FILTER (WHERE upper(status) = 'FAILED') AS BIGINT) AS failed
FROM v_requests GROUP BY 1"""
    q["register_requests"] = f"""WITH {V_REQUESTS}, {V_MODELS}, st AS {_state_sql()},
models AS (SELECT model_name FROM v_models UNION SELECT model_name FROM st WHERE status = 'FINISHED')
SELECT m.model_name, coalesce(s.status, 'PENDING') AS status, CAST(s.status IS NULL AS INTEGER) AS is_new
FROM models m LEFT JOIN st s ON s.model_name = m.model_name"""
    snap = f"""{V_REQUESTS},
cut AS (SELECT CAST(floor((min(epoch_us(ts)) + max(epoch_us(ts))) / 2) AS BIGINT) AS c FROM v_requests),
old_src AS (SELECT * FROM v_requests WHERE epoch_us(ts) <= (SELECT c FROM cut)),
old AS {_state_sql('old_src')}, new AS {_state_sql()}"""
    q["pull_new"] = f"""WITH {snap},
loc AS (SELECT request_id, status FROM old)
SELECT n.request_id, n.status, 'remote' AS source FROM new n
WHERE NOT EXISTS (SELECT 1 FROM loc l WHERE l.request_id = n.request_id)
UNION ALL SELECT request_id, status, 'local' FROM loc"""
    org = f"CASE WHEN contains({m}, '/') THEN split_part({m}, '/', 1) ELSE {_req_org(m)} END"
    files = f"""SELECT CASE WHEN contains({m}, '/') THEN 'OpenRequests' ELSE 'ProprietaryRequests' END AS bucket, {org} AS org,
    ({mid}) || '_eval_request_' || coalesce(revision, 'main') || '_' || coalesce(precision, 'UNK') || '.json' AS file, model_name,
    CASE WHEN contains({m}, '/') THEN 'Open' ELSE 'Proprietary' END AS license, coalesce(revision, 'main') AS revision,
    coalesce(precision, 'UNK') AS precision, coalesce(params, 'UNK') AS params, 'Text' AS modality"""
    q["register_manifests"] = f"""WITH {V_REQUESTS}, {V_MODELS}, st AS {_state_sql()},
asked AS ({files} FROM v_models UNION ALL
  {files} FROM (SELECT model_name, NULL::VARCHAR AS revision, NULL::VARCHAR AS precision, NULL::VARCHAR AS params FROM st WHERE status = 'FINISHED')),
one AS (SELECT * FROM asked QUALIFY row_number() OVER (PARTITION BY bucket, org, file
  ORDER BY model_name, license, revision, precision, params, modality) = 1),
have AS (SELECT bucket, org, file, max(status) AS status, count(*) AS n FROM (
  {files}, status FROM (SELECT model_name, NULL::VARCHAR AS revision, NULL::VARCHAR AS precision, NULL::VARCHAR AS params, status FROM st)) GROUP BY ALL)
SELECT o.*, coalesce(h.status, 'PENDING') AS status, CAST(h.n IS NULL AS INTEGER) AS is_new
FROM one o LEFT JOIN have h USING (bucket, org, file)"""
    q["mirror_folders"] = f"""WITH {snap},
put AS (SELECT DISTINCT category, task_set AS org, CAST(request_id % 400 AS VARCHAR) || '.json' AS file FROM new),
remote AS (SELECT DISTINCT CASE upper(coalesce(status, 'PENDING')) WHEN 'FINISHED' THEN 'finished' WHEN 'FAILED' THEN 'failed'
  ELSE 'pending' END AS category, task_set AS org, CAST(request_id % 500 AS VARCHAR) || '.json' AS file FROM v_requests)
SELECT category || '/' || org || '/' || file AS path, 'put' AS action FROM put
UNION ALL SELECT r.category || '/' || r.org || '/' || r.file, 'delete' FROM remote r
WHERE NOT EXISTS (SELECT 1 FROM put p WHERE p.org = r.org AND p.file = r.file AND p.category = r.category)"""
    q["item_turns"] = """SELECT conv_id, CAST(count(*) FILTER (role = 'user') AS BIGINT) AS user_turns,
  CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS assistant_turns,
  arg_min(text, turn) FILTER (role = 'system' AND text IS NOT NULL) AS system_text
FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role IN ('user', 'assistant')) > 0"""
    q["mirror_plan"] = f"""WITH {snap},
put AS (SELECT category, task_set AS org, CAST(request_id AS VARCHAR) || '.json' AS file FROM new),
remote AS (SELECT CASE WHEN request_id % 7 = 3 THEN 'archive' ELSE category END AS category, task_set AS org,
  CAST(request_id AS VARCHAR) || '.json' AS file FROM old)
SELECT category || '/' || org || '/' || file AS path, 'put' AS action FROM put
UNION SELECT r.category || '/' || r.org || '/' || r.file, 'delete' FROM remote r
  JOIN put p ON p.org = r.org AND p.file = r.file WHERE r.category <> p.category AND r.category <> 'archive'
UNION SELECT r.category || '/' || r.org || '/' || r.file, 'keep' FROM remote r
  WHERE r.category = 'archive' OR NOT EXISTS (SELECT 1 FROM put p WHERE p.org = r.org AND p.file = r.file)"""
    return q


def extra_oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["jury_everywhere"] = f"""{_judged_sql()}
SELECT coalesce(min(j), 0) AS jury_everywhere, CAST(count(*) AS BIGINT) AS n_files
FROM (SELECT file_id, max(CAST(judge_key = 'Jury' AS INTEGER)) AS j FROM roster GROUP BY file_id) t"""
    big = oracle_queries_big_cte()
    part = ("SELECT model_id, judge_pos, CAST(count(*) AS BIGINT) AS n, "
            + r4("avg(final_score)") + " AS final_score, {g} AS generation FROM scored WHERE {cond} "
            "GROUP BY model_id, judge_pos")
    q["results_upsert"] = f"""{big},
old AS ({part.format(g=1, cond="answer_id % 2 = 0")}),
new AS ({part.format(g=2, cond="model_id % 3 = 0")})
SELECT * FROM new
UNION ALL SELECT * FROM old o WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.model_id = o.model_id AND n.judge_pos = o.judge_pos)"""
    q["leaderboard_rank"] = f"""{_judged_sql()},
agg AS (SELECT file_id, {r4('avg(coalesce(final_score, 0.0))')} AS final_score FROM vrows
        WHERE judge_key = 'Jury' GROUP BY file_id),
jf AS (SELECT f.file_id, a.final_score FROM (SELECT DISTINCT file_id FROM entries) f
       JOIN (SELECT judge_key FROM common WHERE judge_key = 'Jury') c ON true
       LEFT JOIN agg a ON a.file_id = f.file_id)
SELECT file_id AS model_id, final_score, dense_rank() OVER (ORDER BY final_score DESC NULLS LAST) AS rank FROM jf"""
    q["results_last_wins"] = f"""{big},
every AS ({part.format(g=1, cond="answer_id % 2 = 0")} UNION ALL
  {part.format(g=2, cond="model_id % 4 < 2 AND answer_id % 2 = 0")} UNION ALL
  {part.format(g=3, cond="model_id % 4 < 3 AND answer_id % 3 = 0")})
SELECT * FROM every e WHERE generation = (SELECT max(generation) FROM every f WHERE f.model_id = e.model_id AND f.judge_pos = e.judge_pos)"""
    q["results_union"] = f"""{big}
SELECT model_id, judge_pos, CAST(count(*) AS BIGINT) AS n, {r4("avg(final_score)")} AS final_score, 'criteria' AS file,
  CAST(NULL AS VARCHAR) AS task, CAST(NULL AS DOUBLE) AS score FROM scored GROUP BY model_id, judge_pos
UNION ALL SELECT model_id, judge_pos, NULL, NULL, 'tasks', task, {r4("avg(final_score)")} FROM scored GROUP BY model_id, judge_pos, task"""
    q["assembled_results"] = f"""{_judged_sql()},
agg AS (SELECT file_id, judge_key, {r4('avg(coalesce(final_score, 0.0))')} AS final_score FROM vrows GROUP BY file_id, judge_key),
tk AS (SELECT file_id, judge_key, task, {r4('avg(final_score)')} AS task_score FROM vrows
       WHERE task IS NOT NULL AND task <> '' AND final_score IS NOT NULL GROUP BY ALL),
named AS (SELECT n.*, row_number() OVER (PARTITION BY file_id, judge_name ORDER BY judge_key DESC) AS rn FROM names n)
SELECT n.file_id AS model_id, e.model_name, e.total_entries, n.judge_name || ' Scores' AS judge_entry, a.final_score, t.task, t.task_score
FROM named n LEFT JOIN agg a ON a.file_id = n.file_id AND a.judge_key = n.judge_key
LEFT JOIN tk t ON t.file_id = n.file_id AND t.judge_key = n.judge_key
JOIN (SELECT file_id, arg_min(model_name, ordinal) AS model_name, CAST(count(*) AS BIGINT) AS total_entries FROM entries GROUP BY file_id) e
  ON e.file_id = n.file_id WHERE n.rn = 1"""
    q["attached_answers"] = f"""WITH {V_ITEMS}, {V_ANSWERS}
SELECT conversation, part, task_set, q1, model_pos, m1 FROM v_answers WHERE m1 <> ''"""
    q["list_arguments"] = """WITH p AS (
  SELECT p_partkey, string_split(' ' || replace(upper(p_name), ' ', ' ,') || CASE WHEN p_partkey % 5 = 0 THEN ', ,' ELSE '' END, ',') AS parts
  FROM part),
l AS (SELECT p_partkey, 'judges' AS kind, list_filter(list_transform(parts, lambda x: lower(trim(x))), lambda x: x <> '') AS items FROM p
      UNION ALL SELECT p_partkey, 'models', parts FROM p)
SELECT p_partkey, kind, CAST(unnest(range(len(items))) AS INTEGER) AS pos, unnest(items) AS item FROM l"""
    base = scored_verdicts_sql()
    pairs = [(1, 2), (1, 3), (2, 3)]
    q["judge_agreement"] = f"""{base},
w AS (SELECT doc_id, max(CASE WHEN judge_pos = 1 THEN correct END) AS c1,
             max(CASE WHEN judge_pos = 2 THEN correct END) AS c2,
             max(CASE WHEN judge_pos = 3 THEN correct END) AS c3
      FROM scored WHERE usable GROUP BY doc_id)
""" + "\nUNION ALL ".join(
        f"SELECT {a} AS judge_a, {b} AS judge_b, n, agree, CASE WHEN n > 0 THEN {r4('agree / n')} END AS share FROM "
        f"(SELECT CAST(count(*) FILTER (WHERE c{a} IS NOT NULL AND c{b} IS NOT NULL) AS BIGINT) AS n, "
        f"CAST(count(*) FILTER (WHERE c{a} IS NOT NULL AND c{b} IS NOT NULL AND c{a} = c{b}) AS BIGINT) AS agree FROM w) t{a}{b}"
        for a, b in pairs)
    q["gold_agreement"] = f"""{base}
SELECT s.judge_pos, CAST(count(*) AS BIGINT) AS n,
  {r4('avg(CASE WHEN s.correct = CAST(l.quality AS DOUBLE) THEN 1.0 ELSE 0.0 END)')} AS agreement
FROM scored s JOIN labels l ON l.doc_id = s.doc_id WHERE s.usable GROUP BY s.judge_pos"""
    q["source_averages"] = f"""{base}
SELECT d.source, s.judge_pos, CAST(count(*) AS BIGINT) AS n, {r4('avg(s.final_score)')} AS score
FROM scored s JOIN documents d ON d.doc_id = s.doc_id WHERE s.usable GROUP BY d.source, s.judge_pos"""
    q["vision_messages"] = f"""WITH {V_ITEMS}, {FORMS},
vm AS (SELECT *, CASE WHEN conversation % 4 = 3 THEN 'Text+Vision' ELSE 'Text' END AS modality,
              (conversation % 2 <> 0) OR (conversation % 4 = 3) AS inc_sys FROM msgs)
SELECT conversation, part, pass, modality,
  CAST((CASE WHEN form = 'first' THEN 1 ELSE 3 END) + (CASE WHEN inc_sys THEN 1 ELSE 0 END) AS INTEGER) AS n_messages,
  CASE WHEN inc_sys THEN 'system' ELSE 'user' END AS first_role,
  CASE WHEN modality <> 'Text' THEN 'text' END AS first_part_type,
  CASE WHEN modality <> 'Text' THEN (CASE WHEN form = 'first' THEN {dstrip('q1')} ELSE {dstrip('q2')} END) END
    AS last_part_text
FROM vm"""
    jn = "regexp_replace(lower(model_name), '^claude-3-([0-9]+)$', 'claude-3.5-sonnet')"
    q["judge_routes"] = f"""WITH {V_MODELS}, j AS (SELECT model_key, {jn} AS judge_name FROM v_models)
SELECT model_key, judge_name,
  CASE judge_name WHEN 'claude-3.5-sonnet' THEN 'claude-3-5-sonnet-20241022'
                  WHEN 'claude-3-haiku' THEN 'claude-3-haiku-20240307' ELSE judge_name END AS judge_id,
  CASE WHEN regexp_matches(lower(judge_name), 'gpt|o\\d+') THEN 'openai'
       WHEN contains(lower(judge_name), 'claude') THEN 'anthropic'
       WHEN judge_name IN ('jais-30b', 'jais-70b', 'k2-65b') THEN 'inception' END AS route
FROM j"""
    secs = "((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)"
    q["run_durations"] = f"""WITH {V_REQUESTS},
d AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, {secs} AS secs FROM v_requests GROUP BY 1)
SELECT run_id, {r4('secs')} AS secs,
  printf('%02d:%02d:%05.2f', CAST(floor(secs / 3600) AS INTEGER),
         CAST(floor((secs - floor(secs / 3600) * 3600) / 60) AS INTEGER),
         round(CAST(secs - floor(secs / 3600) * 3600 - floor((secs - floor(secs / 3600) * 3600) / 60) * 60
               AS DECIMAL(20,8)), 2)) AS elapsed
FROM d"""
    last = f"(CASE WHEN form = 'first' THEN {dstrip('q1')} ELSE {dstrip('q2')} END)"
    q["stub_generation"] = f"""WITH {V_ITEMS}, {FORMS}, lm AS (SELECT conversation, part, pass, {last} AS last FROM msgs)
SELECT conversation, part, pass, 'echo: ' || CAST(length(last) AS VARCHAR) || ' chars '
  || CAST(CASE WHEN {dstrip('last')} = '' THEN 0 ELSE len(regexp_split_to_array({dstrip('last')}, '\\s+')) END AS VARCHAR)
  || ' words' AS completion
FROM lm"""
    closing = {0: "Evaluate the answer.", 1: "Evaluate the answer.", 2: "Evaluate both answers."}
    prompt = "CASE " + " ".join(f"WHEN round = {r} THEN {_prompt_sql(r, closing[r])}"
                                for r in (0, 1, 2)) + " END"
    c = "(CASE WHEN n % 3 <> 0 THEN 1.0 ELSE 0.0 END)"
    one = {  # normalised first block (zeroed when Correct is not 1)
        "correct": c, "complete": c, "concise": f"{c} * ((1 + n % 5) - 1) / 4", "helpful": c,
        "honest": f"{c} * 0.75", "harmless": c}
    two = {"correct": "1.0", "complete": "CAST(n % 2 AS DOUBLE)", "concise": "0.5", "helpful": "0.75",
           "honest": "1.0", "harmless": "1.0"}
    crit = {k: f"CASE WHEN round = 2 THEN {r4(f'(({one[k]}) * 2.0 + ({two[k]}) * 1.0) / 3.0')} "
               f"ELSE {r4(f'(({one[k]}) * 1.0) / 1.0')} END" for k in one}
    q["stub_judging"] = f"""WITH {V_ITEMS}, {V_ANSWERS},
calls AS (
  SELECT a.conversation, a.part, a.model_pos, j.judge_pos, a.round, length({prompt}) AS n
  FROM v_answers a, (VALUES (1), (2)) AS j(judge_pos) WHERE ({JUDGE_REASON}) IS NULL),
s AS (SELECT conversation, part, model_pos, judge_pos, {", ".join(f"{e} AS {k}" for k, e in crit.items())} FROM calls)
SELECT conversation, part, model_pos, judge_pos, 1 AS usable, correct, complete, concise, helpful, honest, harmless,
  {r4('(correct + complete + concise + helpful + honest + harmless) / 6.0')} AS final_score
FROM s"""
    return q


def oracle_queries_big_cte() -> str:
    """The ``scored`` CTE over lineitem (v_big) used by the large-aggregate queries."""
    return f"""WITH big0 AS (
  SELECT l_orderkey AS answer_id, l_orderkey % 50 AS model_id, l_linenumber AS judge_pos,
         'task' || CAST(l_orderkey % 7 AS VARCHAR) AS task,
         CASE WHEN l_quantity % 3 = 0 THEN 0.0 ELSE 1.0 END AS correct, l_quantity AS q, l_discount, l_tax
  FROM lineitem),
big1 AS (
  SELECT answer_id, model_id, judge_pos, task, correct,
         correct * (CASE WHEN q % 2 = 0 THEN 1.0 ELSE 0.0 END) AS complete,
         correct * (q % 5) / 4 AS concise,
         correct * l_discount * 10 AS helpful,
         correct * l_tax * 12.5 AS honest,
         correct * ((q + judge_pos) % 5) / 4 AS harmless
  FROM big0),
scored AS (SELECT *, true AS usable,
  {r4('(correct + complete + concise + helpful + honest + harmless) / 6.0')} AS final_score FROM big1)"""
