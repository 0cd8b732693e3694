"""Do two hops hold the same documents? Digests taken while each hop writes, and compared.

A digest (:func:`nestweave.operators.metrics.digest_columns`) is a sum over rows, so it doesn't matter how the
hops cut their batches or order their rows. Nothing is read again for it.
"""

from __future__ import annotations

from collections import defaultdict
from threading import Event

from pyspark.sql import DataFrame, Observation
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from nestweave.functions.nested import column
from nestweave.operators.conform import conformed_columns
from nestweave.operators.metrics import add_digests, digest_columns, digest_of

#: The name under which a stream reports its digests.
DIGEST = "digest"

Digest = tuple[int, int, int]


def digested(stream: DataFrame) -> DataFrame:
    """``stream``, which reports a digest of every micro-batch with its progress."""
    return stream.observe(DIGEST, *digest_columns([column(c) for c in stream.columns]))


def digested_as(df: DataFrame, schema: T.StructType, observation: Observation) -> DataFrame:
    """``df``, whose rows in the shape of ``schema`` are digested while it is written.

    Fields that were added since, such as names looked up, take no part.
    """
    return df.observe(observation, *digest_columns(conformed_columns(df, schema)))


class DigestLog(StreamingQueryListener):
    """Adds up the digests that :func:`digested` streams report, by run of a query."""

    def __init__(self) -> None:
        self._parts: dict[str, list[Digest]] = defaultdict(list)
        self._ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        observed = event.progress.observedMetrics.get(DIGEST)
        # A trigger that found nothing to do reports no rows.
        if observed is not None and observed["n_rows"] is not None:
            self._parts[str(event.progress.runId)].append(digest_of(observed.asDict()))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._ended[str(event.runId)].set()

    def total(self, query: StreamingQuery, timeout: float = 60) -> Digest:
        """The digest of everything that ``query`` read; it must have ended. Its last events come a little later."""
        run = str(query.runId)
        if not self._ended[run].wait(timeout):
            raise TimeoutError("the listener was not told of the end of the stream")
        return add_digests(self._parts[run])
