"""What a run did: who ran it, what kind of work, when, how many rows, and whether it failed."""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablewarden.functions.documents import default_description
from tablewarden.functions.naming import DEFAULT_CLUSTER, process_name
from tablewarden.functions.times import run_stamp
from tablewarden.operators.entities import PROCESS_KIND, PROCESS_TYPE, SERVICE_OWNER, entity_rows

# How a run ended, and what is kept of each.
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"
RUN_FACTS = (
    "name STRING, description STRING, user_name STRING, operation STRING, start_time TIMESTAMP_NTZ, "
    "end_time TIMESTAMP_NTZ, rows_in BIGINT, rows_out BIGINT, status STRING, message STRING"
)
# Characters of an error that are kept.
MESSAGE_CHARS = 500


@dataclass
class Run:
    """A run that is under way. Frames that pass through ``reads`` and ``writes`` are counted
    by the action that the run makes anyway."""

    _in: list[Observation] = field(default_factory=list)
    _out: list[Observation] = field(default_factory=list)

    def reads(self, df: DataFrame) -> DataFrame:
        return self._counted(df, self._in)

    def writes(self, df: DataFrame) -> DataFrame:
        return self._counted(df, self._out)

    def _counted(self, df: DataFrame, into: list[Observation]) -> DataFrame:
        into.append(Observation())
        return df.observe(into[-1], F.count(F.lit(1)).alias("n"))


def _total(counts: list[Observation], failed: bool) -> int | None:
    # Asking for a count whose action never came to its end would wait for ever.
    return None if failed or not counts else sum(c.get["n"] for c in counts)


@contextmanager
def record_run(
    spark: SparkSession, facts: list[DataFrame], name: str, operation: str = PROCESS_KIND, description: str | None = None
) -> Iterator[Run]:
    """Put one row of facts into ``facts`` when the run ends, also when it fails; the error goes on.

    The rows of a frame count when an action on it is made within the run. A failed run has no
    row counts. The user is the one that the session runs as.
    """
    run, begun, error = Run(), time.time(), None
    try:
        yield run
    except BaseException as raised:
        error = raised
        raise
    finally:
        counts = [_total(c, error is not None) for c in (run._in, run._out)]
        status = SUCCEEDED if error is None else FAILED
        message = None if error is None else f"{type(error).__name__}: {error}"[:MESSAGE_CHARS]
        moments = [datetime.fromtimestamp(t, timezone.utc).replace(tzinfo=None) for t in (begun, time.time())]
        row = (name, description, spark.sparkContext.sparkUser(), operation, *moments, *counts, status, message)
        facts.append(spark.createDataFrame([row], RUN_FACTS))


def run_processes(facts: DataFrame, cluster: str = DEFAULT_CLUSTER) -> DataFrame:
    """Process entities of runs, named by their start, with the facts as attributes.

    Facts that are not known are no attributes. A process is new each run.
    """
    names = ["user_name", "operation", "start_time", "end_time", "rows_in", "rows_out", "status", "message"]
    every = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("process_type", *names)]),
        F.array(F.col("operation"), *[F.col(n).cast("string") for n in names]),
    )
    return entity_rows(
        facts,
        F.lit(PROCESS_TYPE),
        process_name("name", run_stamp("start_time"), cluster),
        "name",
        F.lit(SERVICE_OWNER),
        default_description("description", "name", "process"),
        "start_time",
        F.map_filter(every, lambda _, value: value.isNotNull()),
    )
