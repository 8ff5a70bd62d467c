"""Targets kept as a base and the change sets of each run, under a journal of finished steps.

A run writes only the rows it changes, so its bytes follow its window and not its target. Readers take the newest
row per key: the base without the changed keys, which is not shuffled while these are few, and the newest changes.
``compact`` writes a new base as a step of its own and changes no result.

Every step writes its rows under a new folder and is then entered in the journal by one small file. A step without an
entry does not exist for readers, and a step with one is not done again: a run that failed is simply started anew and
goes on at its first unfinished step. One run writes at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from weftmart.operators.aggregate import last_row
from weftmart.operators.diff import DELETED, SAME, keyed_diff
from weftmart.operators.project import named
from weftmart.session import read_if_there, write_table

GONE = "__gone"
_NUMBER = "__number"
_BASE = ":base"
_ENTRY = "number long, run string, step string, folder string, schema string"


class Entry(NamedTuple):
    number: int
    run: str
    step: str
    folder: str
    schema: str


class Journal:
    """The finished steps of all runs under a folder, in order."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._known: list | None = None

    def entries(self, step: str | None = None) -> list:
        """A row of names per finished step. They are read once: only this object adds to them while a run writes."""
        if self._known is None:
            rows = read_if_there(self.spark, f"{self.path}/journal", _ENTRY).collect()
            self._known = sorted(rows, key=lambda r: r.number)
        return self._known if step is None else [e for e in self._known if e.step in (step, step + _BASE)]

    def found(self, run: str, step: str) -> DataFrame | None:
        entry = next((e for e in self.entries() if e.run == run and e.step == step), None)
        return None if entry is None else self.read(entry)

    def read(self, entry) -> DataFrame:
        return self.spark.read.schema(entry.schema).parquet(entry.folder)

    def step(self, run: str, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The rows of a step: those it left if it is finished, else what ``build`` gives, written and entered."""
        done = self.found(run, step)
        if done is not None:
            return done
        folder = f"{self.path}/data/{step.replace(':', '-')}-{uuid.uuid4().hex}"
        rows = build()
        written = write_table(rows, folder)
        number = max((e.number for e in self.entries()), default=0) + 1
        entry = Entry(number, run, step, folder, rows.schema.toDDL())
        self.spark.createDataFrame([tuple(entry)], _ENTRY).coalesce(1).write.mode("append").parquet(f"{self.path}/journal")
        self._known = [*self.entries(), entry]
        return written


def _keys_alike(rows: DataFrame, others: DataFrame, keys: Sequence[str], how: str, null_safe: bool = True) -> DataFrame:
    """Semi or anti join by keys, a null key equal to a null key.

    Keys that are never null (``null_safe=False``) are compared as they are, so rows that lie by their keys are not
    shuffled again.
    """
    if not null_safe:
        return rows.join(others.select(*[named(k) for k in keys]), list(keys), how).select(*[named(c) for c in rows.columns])
    renamed = others.select(*[named(k).alias(f"__k_{i}") for i, k in enumerate(keys)])
    condition = F.lit(True)
    for i, k in enumerate(keys):
        equal = named(k).eqNullSafe(F.col(f"__k_{i}"))
        condition = equal if i == 0 else condition & equal
    return rows.join(renamed, condition, how)


@dataclass(frozen=True)
class ChangeSets:
    """One keyed table of a journal. Each set holds a key once; deleted keys are marked."""

    journal: Journal
    name: str
    keys: tuple[str, ...]

    def _parts(self) -> tuple[DataFrame | None, list]:
        """The last base, and the entries of the sets after it."""
        base, sets = None, []
        for entry in self.journal.entries(self.name):
            if entry.step == self.name:
                sets.append(entry)
            else:
                base, sets = self.journal.read(entry), []
        return base, sets

    def exists(self) -> bool:
        return bool(self.journal.entries(self.name))

    def _taken(self, rows: DataFrame, columns: Sequence[str] | None, wanted: DataFrame | None) -> DataFrame:
        if columns is not None:
            rows = rows.select(*[named(c) for c in rows.columns if c in columns or c in self.keys or c == GONE])
        return rows if wanted is None else _keys_alike(rows, wanted, self.keys, "left_semi")

    def newest(self, sets: list, columns: Sequence[str] | None = None, wanted: DataFrame | None = None) -> DataFrame:
        """The newest version of every key in some sets."""
        read = [self._taken(self.journal.read(e), columns, wanted).withColumn(_NUMBER, F.lit(e.number)) for e in sets]
        if len(read) == 1:
            return read[0].drop(_NUMBER)
        every = read[0]
        for more in read[1:]:
            every = every.unionByName(more)
        return last_row(every, self.keys, [_NUMBER]).drop(_NUMBER)

    def rows(self, columns: Sequence[str] | None = None, wanted: DataFrame | None = None) -> DataFrame:
        """All rows. With ``columns`` only these and the keys, with ``wanted`` only a few keys take part when versions are compared."""
        base, sets = self._parts()
        base = None if base is None else self._taken(base, columns, wanted)
        if not sets:
            if base is None:
                raise LookupError(f"{self.name} has no rows yet")
            return base
        changed = self.newest(sets, columns, wanted)
        alive = changed.where(~F.col(GONE)).drop(GONE)
        return alive if base is None else _keys_alike(base, changed, self.keys, "left_anti").unionByName(alive)

    def rows_of(self, wanted: DataFrame, null_safe: bool = True) -> DataFrame:
        """The rows of the given keys."""
        return _keys_alike(self.rows(), wanted, self.keys, "left_semi", null_safe)

    def commit(self, run: str, build: Callable[[], DataFrame]) -> DataFrame:
        """Add the rows that ``build`` gives as the run's change set, or return the set it already has."""
        return self.journal.step(run, self.name, lambda: build().withColumn(GONE, F.lit(False))).where(~F.col(GONE)).drop(GONE)

    def remove(self, run: str, gone: DataFrame) -> None:
        """Mark keys as deleted, as a set of its own."""
        stored = self.rows()
        others = [F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema if f.name not in self.keys]
        self.journal.step(run, self.name, lambda: gone.select(*[named(k) for k in self.keys], *others, F.lit(True).alias(GONE)).select(*stored.columns, GONE))

    def merge(self, run: str, incoming: DataFrame, next_rows: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """The rows that change when ``next_rows(stored rows of the incoming keys, incoming)`` replaces these; written as the run's set."""

        def build() -> DataFrame:
            old = self.rows_of(incoming)
            changes = keyed_diff(next_rows(old, incoming), old, self.keys, "__change")
            return changes.where(~F.col("__change").isin(SAME, DELETED)).select(*[named(c) for c in old.columns])

        return self.commit(run, build)

    def compact(self, run: str) -> DataFrame:
        """Write all rows as a new base; later readers start from it."""
        return self.journal.step(run, self.name + _BASE, self.rows)
