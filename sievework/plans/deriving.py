"""State that follows its facts, batch by batch.

Stand-ins on the test tables: events are claims as in the resolution queries, a batch is a week's events together with those of
the week before, which come again."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import claims as cl
from ..registry import query
from ..sources.sinks import work_folder
from ..streaming.derived import DerivedState
from .resolution import _SUPPORT, claims_of

KEYS = ["subject", "predicate", "object"]
FACTS = "event_id long, subject long, predicate string, object long, v double, lineage string, family long"
DERIVED = "subject long, predicate string, object long, support double, families long, best double, claims long"
WEEKS = 5  # of a month, as `family` counts them


@query(f"WITH {_SUPPORT} SELECT * FROM sup")
def incremental_support(spark, sf_dir):
    """The support of every claim after all weekly batches: what one pass over all events gives."""
    events = claims_of(spark, sf_dir)
    state = DerivedState(work_folder(spark, "support-state"), FACTS, DERIVED, ["subject"], ["event_id"], lambda f: cl.support(f, KEYS, "lineage", "family", "v"), buckets=16)
    for week in range(WEEKS):
        state.merge(events.where(F.col("family").between(week - 1, week)), week)
    return state.current(spark)
