"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (every row computed, nothing
collected to the driver).  One warm-up pass per query, then the best of
$BENCH_REPEAT timed passes.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "verdict_scores",          # regex + variant parse + coercion over whole verdict texts
    "jury_vote",               # scoring + jury aggregate
    "criterion_averages",      # scoring + renumbering + jury + roster + complete-case averages
    "big_jury_vote",           # 600k judge rows -> per-answer vote
    "big_jury_average",
    "big_criterion_averages",  # 600k rows -> per model x judge
    "big_task_averages",
    "conversation_messages",   # item assembly from conversations
    "judge_prompts",
    "request_state",           # latest status per request from events
    "expand_runs",             # pending requests x items of their task set
    "judge_agreement",         # pivot over configured judges, no pair join
    "stub_generation",         # caller-supplied model function through mapInPandas
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    from scorewright.plans.queries import QUERIES
    from scorewright.session import get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus), extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        if name not in QUERIES:
            continue
        best = None
        try:
            for i in range(repeat + 1):
                t0 = time.time()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.time() - t0
                if i > 0:
                    best = dt if best is None else min(best, dt)
        except Exception as e:  # report the failure, keep timing the others
            print(f"{name} failed: {type(e).__name__}: {e}", file=sys.stderr)
            best = None
        times[name] = round(best, 3) if best is not None else None
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(v for v in times.values() if v), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
