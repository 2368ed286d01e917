"""Audited steps: what a step of a run did, taken from the step itself.

Start and end come from the clock around the step, row counts from the Observations of its writes,
gate figures from its verdict. A step that raises leaves rows with FAILED and the error, and raises on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from strata.ops.audit import DAG_ID, AuditRecord, append_audit, audit_frame


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Step:
    """What a running step reports: figures for each month, or for the whole run under None."""

    figures: dict[dt.date | None, dict] = field(default_factory=dict)

    def report(self, month: dt.date | None = None, **figures) -> None:
        """Figures are fields of :class:`AuditRecord`; a later report of a month adds to an earlier one."""
        self.figures.setdefault(month, {}).update(figures)


@dataclass(frozen=True)
class Steps:
    """Appends a row for each step and month to the audit table at ``path``."""

    spark: SparkSession
    path: str
    run_id: str
    source_url: str = ""
    schema_version: int = 1
    clock: Callable[[], dt.datetime] = utc_now

    @contextmanager
    def audited(self, task_id: str, layer: str, table_name: str, months: list[dt.date] | None = None) -> Iterator[Step]:
        """A step over ``months``: those without figures of their own are on record as well, with none."""
        step, started = Step(), self.clock()
        error = None
        try:
            yield step
        except BaseException as e:
            error = e
            raise
        finally:
            finished = self.clock()
            records = []
            for month in months if months is not None else [None]:
                given = {"status": "SUCCESS"} | step.figures.get(month, {})
                if error is not None:
                    given |= {"status": "FAILED", "error_message": f"{type(error).__name__}: {error}", "ge_pass_rate": 0.0}
                records.append(AuditRecord(
                    run_id=self.run_id if month is None else f"{self.run_id}-{month:%Y%m}", dag_id=DAG_ID, task_id=task_id,
                    layer=layer, table_name=table_name, started_at=started, finished_at=finished, source_url=self.source_url,
                    schema_version=self.schema_version, **given,
                ))
            append_audit(audit_frame(self.spark, records), self.path)
