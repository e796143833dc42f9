"""Wait for replication to catch up, then compare source and target."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.sync import sync_report, sync_verdict, table_counts
from ..session import shuffles_cleared
from .store import KeyedTable

# Fixed value: seconds to wait for the target.
VERIFY_TIMEOUT = 60

POLL_SECONDS = 0.25


@dataclass(frozen=True)
class SyncOutcome:
    """The report at the end of the wait, and how it ended.

    ``synced`` is true when no target is behind its source, null when a count is unknown.
    """

    report: DataFrame
    synced: bool | None
    timed_out: bool
    waited_ms: int


def _settled(query: StreamingQuery) -> bool:
    """True when a query has ended, or has worked off all it knows of; its failure is raised."""
    error = query.exception()
    if error is not None:
        raise error
    if not query.isActive:
        return True
    status = query.status
    return query.lastProgress is not None and not status["isDataAvailable"] and not status["isTriggerActive"]


def verify_sync(
    queries: Iterable[StreamingQuery],
    source: Mapping[str, DataFrame],
    target: Mapping[str, KeyedTable],
    timeout: float = VERIFY_TIMEOUT,
    ended: Callable[[], None] | None = None,
) -> SyncOutcome:
    """Wait for the queries, all of them ``timeout`` seconds at most, and compare the counts.

    The wait is over when every query has ended, or when all are idle and no target is behind.  A query that
    failed, before or meanwhile, raises its error.  ``ended`` is called before the last comparison, when all queries have ended.
    """
    queries, began = list(queries), time.monotonic()
    deadline = began + timeout

    def compare() -> tuple[DataFrame, bool | None]:
        # A few rows, one per table: computed once, as the tables are now.
        current = {n: t.current(columns=[]) for n, t in target.items()}
        with shuffles_cleared(next(iter(current.values())).sparkSession):
            counts = sync_report(table_counts(source), table_counts(current))
            report = counts.sparkSession.createDataFrame(counts.collect(), counts.schema)
            return report, sync_verdict(report, "at_least").first()["synced"]

    while True:
        settled = all([_settled(q) for q in queries])
        over = settled and not any(q.isActive for q in queries)
        late = time.monotonic() >= deadline
        if over and ended:
            ended()
        if settled or late:
            report, synced = compare()
            if synced or over or late:
                waited = int((time.monotonic() - began) * 1000)
                return SyncOutcome(report, synced, late and not synced and not over, waited)
        time.sleep(min(POLL_SECONDS, max(0.0, deadline - time.monotonic())))
