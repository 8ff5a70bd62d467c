"""A mart kept up to date by mergeable aggregate states.

Beside the mart lie the states of its last grouping: per group the number of rows, per measured column the count,
sum, mean and summed squared deviations, and for distinct counts, least and greatest values the values themselves with
the times they occur. A window brings the affected rows of the driving table as they were and as they are now; both are
aggregated once, merged into the states of their groups, and only these groups are written, as change sets. The rest of
the mart is neither read nor rebuilt.

A condition on groups may use the kept aggregates in the form ``name(column)``. Counts and sums of exact types stay
exact; deviations are merged in doubles. A group whose rows all went is removed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from weftmart.operators.changesets import ChangeSets, Journal
from weftmart.operators.project import named
from weftmart.plans.mart import finished, ungrouped
from weftmart.session import scratch_scope
from weftmart.spec import GroupColumn, MartSpec

# The aggregates whose states are kept.
MOMENTS = ("stddev_samp", "var_samp", "stddev", "variance", "stddev_pop", "var_pop")
VALUES = ("distinct_count", "min", "max", "random")
SUMS = ("sum", "avg", "mean", "count")
_CALL = re.compile(r"\b([A-Za-z_]+)\s*\(\s*`?(\w+)`?\s*\)")
_ROWS, _SIGN, _VALUE, _TIMES = "__rows", "__sign", "__value", "__times"


def _merged(a: Column, b: Column) -> Column:
    """Moments ``(n, mean, m2)`` of two sets of rows together."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    mean = a["mean"] + apart * b["n"] / n
    m2 = a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n
    both = F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(both)


def _without(a: Column, b: Column) -> Column:
    """Moments of a set of rows after some of them went."""
    n = a["n"] - b["n"]
    mean = (a["mean"] * a["n"] - b["mean"] * b["n"]) / n
    apart = b["mean"] - mean
    m2 = F.greatest(a["m2"] - b["m2"] - apart * apart * n * b["n"] / a["n"], F.lit(0.0))
    left = F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.when(n == 0, none).when(b["n"] == 0, a).otherwise(left)


def _moments(column: str, sign: int) -> Column:
    x = F.when((F.col(_SIGN) == sign) & named(column).isNotNull(), named(column).cast("double"))
    n = F.count(x)
    return F.struct(n.alias("n"), F.coalesce(F.avg(x), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("m2"))


class MartStates:
    """The mart of one specification whose last step groups, and the states behind it."""

    def __init__(self, journal: Journal, spec: MartSpec):
        step = spec.derived_step
        if step is None or not step.columns or all(c.is_key for c in step.columns):
            raise ValueError(f"{spec.name}: its last step does not aggregate, so there are no states to keep")
        self.journal, self.spec = journal, spec
        self.keys = [c for c in step.columns if c.is_key]
        self.measures = [c for c in step.columns if not c.is_key]
        self.condition = step.condition
        if step.condition and step.flow == "G":
            self.condition = _CALL.sub(self._asked, step.condition)
            if "(" in re.sub(r"\bin\s*\(", "", self.condition, flags=re.IGNORECASE):
                raise ValueError(f"{spec.name}: {step.condition!r} uses more than kept aggregates of columns")
        for c in self.measures:
            if c.aggregate.lower() not in (*MOMENTS, *VALUES, *SUMS) or c.order_by:
                raise ValueError(f"{spec.name}: no state is kept for {c.aggregate} of {c.column}")
        names = tuple(c.column for c in self.keys)
        by = lambda kinds: list(dict.fromkeys(c.column for c in self.measures if c.aggregate.lower() in kinds))
        self.summed, self.moved, self.valued = by(SUMS), by(MOMENTS), by(VALUES)
        self.groups = ChangeSets(journal, "groups", names)
        self.values = {c: ChangeSets(journal, f"values {i}", (*names, _VALUE)) for i, c in enumerate(self.valued)}

    def _asked(self, call: re.Match) -> str:
        """The name of an aggregate in a condition on groups, which becomes a measure of its own."""
        name, column = call.group(1).lower(), call.group(2)
        if name not in (*SUMS, *MOMENTS, "min", "max"):
            return call.group(0)
        alias = f"__having_{len(self.measures)}"
        self.measures.append(GroupColumn(column, name, alias))
        return alias

    # -- windows -----------------------------------------------------------------------------------------------------

    def apply(self, run: str, before: Mapping[str, DataFrame] | None, after: Mapping[str, DataFrame] | None) -> None:
        """Bring one window in: sources that hold only the affected rows of the driving table, as they were and as they
        are now. Other tables may differ between both, such as a renamed dimension. ``None`` means no rows."""
        sides = [(1, after), (-1, before)]
        with scratch_scope(self.journal.spark):
            signed = None
            for sign, sources in sides:
                if sources is None:
                    continue
                rows = ungrouped(self.spec, sources)
                step = self.spec.derived_step
                if step.condition and step.flow == "F":
                    rows = rows.where(step.condition)
                used = dict.fromkeys([*(c.column for c in self.keys), *self.summed, *self.moved, *self.valued])
                rows = rows.select(*[named(c) for c in used], F.lit(sign).alias(_SIGN))
                signed = rows if signed is None else signed.unionByName(rows)
            if signed is None:
                return
            # the window's rows are joined once; every state reads what was written
            signed = self.journal.step(run, "window", lambda: signed)
            for column, table in self.values.items():
                self._count_values(run, signed, column, table)
            self._merge_groups(run, signed)

    def _by(self, *more: str) -> list[Column]:
        return [named(c.column) for c in self.keys] + [F.col(m) for m in more]

    def _count_values(self, run: str, signed: DataFrame, column: str, table: ChangeSets) -> None:
        named_rows = signed.where(named(column).isNotNull()).select(*self._by(), named(column).alias(_VALUE), _SIGN)
        moved = named_rows.groupBy(*self._by(_VALUE)).agg(F.sum(_SIGN).alias(_TIMES)).where(F.col(_TIMES) != 0)

        def build() -> DataFrame:
            if not table.exists():
                return moved
            stored = table.rows_of(moved).select(*moved.columns)
            return moved.unionByName(stored).groupBy(*self._by(_VALUE)).agg(F.sum(_TIMES).alias(_TIMES))

        table.commit(run, build)

    def _merge_groups(self, run: str, signed: DataFrame) -> None:
        sums = {c: signed.agg(F.sum(named(c)).alias("s")).schema["s"].dataType for c in self.summed if self._is_number(signed, c)}
        turned = lambda c: F.when(F.col(_SIGN) == 1, named(c)).otherwise(-named(c))
        here = F.when(F.col(_SIGN) == 1, 1).otherwise(-1).cast("long")
        parts = [F.sum(here).alias(_ROWS)]
        parts += [F.sum(F.when(named(c).isNotNull(), here).otherwise(0)).alias(f"n_{c}") for c in self.summed]
        parts += [F.sum(turned(c)).cast(kind).alias(f"s_{c}") for c, kind in sums.items()]
        for c in self.moved:
            parts += [_moments(c, 1).alias(f"add_{c}"), _moments(c, -1).alias(f"del_{c}")]
        moved = signed.groupBy(*self._by()).agg(*parts)
        plain = [_ROWS, *[f"n_{c}" for c in self.summed], *[f"s_{c}" for c in sums]]
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

        def build() -> DataFrame:
            rows = moved.withColumns({f"m_{c}": zero for c in self.moved})
            if self.groups.exists():
                stored = self.groups.rows_of(moved).select(*self._by(*plain), *[F.col(f"m_{c}") for c in self.moved])
                rows = rows.unionByName(stored, allowMissingColumns=True)
            added = [F.sum(p).cast(rows.schema[p].dataType).alias(p) for p in plain]
            for c in self.moved:
                # a group has one stored state at most, and one change
                added += [F.max_by(F.col(f"m_{c}"), F.col(f"m_{c}.n")).alias(f"m_{c}")]
                added += [F.coalesce(F.max(F.col(f"{k}_{c}")), zero).alias(f"{k}_{c}") for k in ("add", "del")]
            state = rows.groupBy(*self._by()).agg(*added)
            for c in self.moved:
                state = state.withColumn(f"m_{c}", _without(_merged(F.col(f"m_{c}"), F.col(f"add_{c}")), F.col(f"del_{c}"))).drop(f"add_{c}", f"del_{c}")
            return self._with_values(state)

        self.groups.commit(run, build)

    def _with_values(self, state: DataFrame) -> DataFrame:
        """Distinct counts, least and greatest values of the changed groups, from the values kept of them."""
        for i, (c, table) in enumerate(self.values.items()):
            names = [k.column for k in self.keys]
            alive = table.rows().where(F.col(_TIMES) > 0)
            found = alive.groupBy(*self._by()).agg(
                F.count("*").alias(f"d_{c}"), F.min(_VALUE).alias(f"low_{c}"), F.max(_VALUE).alias(f"high_{c}")
            )
            found = found.select(*[named(k).alias(f"__v{i}_{j}") for j, k in enumerate(names)], f"d_{c}", f"low_{c}", f"high_{c}")
            alike = F.lit(True)
            for j, k in enumerate(names):
                alike = alike & named(k).eqNullSafe(F.col(f"__v{i}_{j}"))
            state = state.join(found, alike, "left_outer").drop(*[f"__v{i}_{j}" for j in range(len(names))])
            state = state.withColumn(f"d_{c}", F.coalesce(F.col(f"d_{c}"), F.lit(0).cast("long")))
        return state

    @staticmethod
    def _is_number(rows: DataFrame, column: str) -> bool:
        return dict(rows.dtypes)[column].split("(")[0] in ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")

    # -- the mart ----------------------------------------------------------------------------------------------------

    def _output(self, c: GroupColumn) -> Column:
        name, x = c.aggregate.lower(), c.column
        if name == "count":
            return F.col(f"n_{x}")
        if name == "sum":
            return F.when(F.col(f"n_{x}") > 0, F.col(f"s_{x}"))
        if name in ("avg", "mean"):
            return F.when(F.col(f"n_{x}") > 0, F.col(f"s_{x}") / F.col(f"n_{x}"))
        if name in MOMENTS:
            m, whole = F.col(f"m_{x}"), name.endswith("_pop")
            spread = F.when(m["n"] > (0 if whole else 1), m["m2"] / (m["n"] - (0 if whole else 1)))
            return F.sqrt(spread) if name.startswith("stddev") else spread
        return F.col({"distinct_count": "d", "max": "high"}.get(name, "low") + f"_{x}")

    def mart(self) -> DataFrame:
        """The mart as a full build would give it now."""
        rows = self.groups.rows().where(F.col(_ROWS) > 0)
        rows = rows.select(*[named(c.column).alias(c.name) for c in self.keys], *[self._output(c).alias(c.name) for c in self.measures])
        if self.condition and self.spec.derived_step.flow == "G":
            rows = rows.where(self.condition)
        return finished(self.spec, rows.drop(*[c.name for c in self.measures if c.name.startswith("__having_")]))

    def compact(self, run: str) -> None:
        for table in (self.groups, *self.values.values()):
            table.compact(run)
