"""scorewright: Spark-native scoring and aggregation of judged model answers.

Every public function takes and returns Spark ``DataFrame`` or ``Column`` objects.
Scoring, jury combination and averaging are native Catalyst expressions; Python workers
run only where a caller-supplied model or judge function is invoked
(``operators.inference``).

Typical use::

    from scorewright import get_spark, read_judged, model_results
    spark = get_spark()
    judged, entries = read_judged(spark, "judged/")
    results = model_results(judged, entries, "vote")
    results["criteria"].show()
"""

from scorewright.session import checkpoint_dir, cluster_conf, get_spark, materialize  # noqa: F401
from scorewright.operators.scoring import number_judges, score_verdicts  # noqa: F401
from scorewright.operators.jury import expand_judges, jury_rows, jury_scores  # noqa: F401
from scorewright.operators.results import model_results, upsert_results  # noqa: F401
from scorewright.operators.flows import average_results, generate_answers, judge_answers  # noqa: F401
from scorewright.sources.files import (  # noqa: F401
    read_answers, read_items, read_judged, read_requests, read_results,
)

__version__ = "0.1.0"
