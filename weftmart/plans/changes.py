"""Runs of a warehouse table that write change sets: bytes in proportion to the window, resumed where they failed.

The plans of ``plans.warehouse`` give the next state of whatever rows they are handed. Here they are handed only the
stored rows of the window's keys, so that what they return is the change itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, functions as F

from weftmart.functions.scalars import literal
from weftmart.operators.changesets import ChangeSets, Journal
from weftmart.operators.joins import deleted_keys
from weftmart.operators.project import UPDATED_DATE, named
from weftmart.operators.sinks import Stamp
from weftmart.plans.extract import next_watermark
from weftmart.plans.jobs import key_rows, just_before, window_rows
from weftmart.plans.warehouse import (
    audit_rows, dimension_staging, dimension_warehouse, transaction_keys, transaction_staging, transaction_warehouse,
)
from weftmart.session import scratch_scope
from weftmart.sources.windows import Period
from weftmart.spec import DIMENSION, LoadSettings, WarehouseSpec

STAGING, WAREHOUSE, KEYS, DELETES, END = "staging", "warehouse", "keys", "deletes", "end"


class ChangeRuns:
    """The tables of one target, and its runs."""

    def __init__(self, journal: Journal, spec: WarehouseSpec):
        self.journal, self.spec = journal, spec
        self.staging, self.warehouse, self.key_table = (ChangeSets(journal, n, tuple(spec.keys)) for n in (STAGING, WAREHOUSE, KEYS))

    def deletes(self) -> DataFrame | None:
        """Audit rows of all runs."""
        every = None
        for entry in self.journal.entries(DELETES):
            rows = self.journal.read(entry)
            every = rows if every is None else every.unionByName(rows)
        return every

    def _last(self) -> tuple[Any, int]:
        """Watermark and greatest surrogate key of the last finished run."""
        ends = self.journal.entries(END)
        if not ends:
            return None, 0
        row = self.journal.read(ends[-1]).first()
        seen = row.id if row.id is not None else row.time and dt.datetime.fromisoformat(row.time)
        return seen, row.greatest

    def run(
        self,
        run: str,
        source: DataFrame,
        settings: LoadSettings,
        stamp: Stamp,
        dimensions: Mapping[str, DataFrame] | None = None,
        as_of: Any = None,
        period: Period | None = None,
        zone: str = "UTC",
        formats: Mapping[str, str] | None = None,
        newest_by: Sequence[str] = (),
        salt: int = 1,
        since: Any = None,
    ) -> None:
        """One upsert run under a name of its own; a name that has finished is left alone, one that failed goes on.

        The window starts where the last finished run ended, or at ``since`` if given.
        Scratch tables made on the way are removed when the run has ended.
        """
        if settings.write_mode != "upsert":
            raise ValueError("change sets are for upserts; an overwrite writes the whole table (run_table)")
        journal, spec, spark = self.journal, self.spec, source.sparkSession
        if journal.found(run, END) is not None:
            return
        watermark, greatest = self._last()
        watermark = watermark if since is None else since
        with scratch_scope(spark):
            rows = journal.step(run, "window", lambda: window_rows(source, spec, settings, watermark, as_of, period, formats, newest_by))
            # tables that only this run has written so far hold nothing older
            first = all(e.run == run for e in journal.entries(WAREHOUSE))
            if settings.delete_flag and not first:
                keys = key_rows(source, spec, formats)
                gone = journal.step(run, "gone", lambda: deleted_keys(self.warehouse.rows(spec.keys), keys, spec.keys))
                journal.step(run, DELETES, lambda: audit_rows(self.warehouse.rows(wanted=gone), gone, spec, stamp, zone))
                for table in (self.staging, self.warehouse, self.key_table)[: 2 if spec.kind == DIMENSION else 3]:
                    table.remove(f"{run} deletes", gone)
            if spec.kind == DIMENSION:
                self._dimension(run, rows, first, stamp, formats, greatest)
            else:
                self._transactions(run, rows, first, stamp, dimensions or {}, formats, salt)
            if spec.kind == DIMENSION and spec.surrogate:
                added = journal.found(run, WAREHOUSE).agg(F.max(named(spec.surrogate))).first()[0]
                greatest = max(greatest, added or 0)
            seen = next_watermark(rows, settings)
            seen = watermark if seen is None else seen
            ids = seen if isinstance(seen, int) else None
            times = None if ids is not None or seen is None else seen.isoformat()
            journal.step(run, END, lambda: spark.createDataFrame([(greatest, ids, times)], "greatest long, id long, time string").coalesce(1))

    def _of_run(self, rows: DataFrame, stamp: Stamp) -> DataFrame:
        """Rows that this run inserted or changed."""
        return rows.where(named(UPDATED_DATE) == literal(stamp[0]))

    def _touched(self, table: ChangeSets, rows: DataFrame, first: bool) -> DataFrame | None:
        # keys are cleansed before they are stored
        return None if first else table.rows_of(rows, null_safe=False)

    def _dimension(self, run: str, rows: DataFrame, first: bool, stamp: Stamp, formats: Any, greatest: int) -> None:
        spec = self.spec
        keys = key_rows(rows, spec, formats)
        staged = self.staging.commit(
            run, lambda: self._of_run(dimension_staging(rows, spec, self._touched(self.staging, keys, first), stamp, formats), stamp)
        )
        self.warehouse.commit(
            run, lambda: self._of_run(dimension_warehouse(staged, spec, self._touched(self.warehouse, staged, first), stamp, greatest=greatest), stamp)
        )

    def _transactions(self, run: str, rows: DataFrame, first: bool, stamp: Stamp, dimensions: Mapping, formats: Any, salt: int) -> None:
        spec = self.spec
        keys = key_rows(rows, spec, formats)
        staged = self.staging.commit(
            run, lambda: self._of_run(transaction_staging(rows, spec, self._touched(self.staging, keys, first), stamp, formats), stamp)
        )
        keyed = self.key_table.commit(
            run, lambda: self._of_run(transaction_keys(staged, spec, self._touched(self.key_table, staged, first), stamp), stamp)
        )
        since = None if first else just_before(stamp)

        def loaded() -> DataFrame:
            old = self._touched(self.warehouse, staged, first)
            return self._of_run(transaction_warehouse(staged, spec, keyed, dimensions, old, stamp, since, salt), stamp)

        self.warehouse.commit(run, loaded)

    def compact(self, run: str) -> None:
        for table in (self.staging, self.warehouse, self.key_table):
            if table.exists():
                table.compact(run)
