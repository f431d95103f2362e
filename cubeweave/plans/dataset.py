"""Virtual datasets: a tree of aggregations that becomes one DataFrame when it is read.

Reading prunes members first, from what is known about them without opening
them: their variables, their period, their label. Everything else (filters,
columns, join strategies) is left to the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeweave.functions import times
from cubeweave.operators import edit, virtual


@dataclass(frozen=True)
class VirtualDataset:
    """``kind`` is leaf, concat (along an existing dimension), merge (of variables), stack (along a new one)
    or mapped (a step on the rows of another dataset)."""

    kind: str
    coords: tuple[str, ...]
    variables: tuple[str, ...]
    children: tuple["VirtualDataset", ...] = ()
    table: DataFrame | None = None
    # first and last time held, as ISO dates
    period: tuple[str, str] | None = None
    dim: str | None = None
    labels: tuple[str, ...] = ()
    fixed: DataFrame | None = None
    attributes: dict[str, str] = field(default_factory=dict)
    # a leaf that is read for the variables asked for, and the step of a mapped dataset
    open: Callable[[tuple[str, ...]], DataFrame] | None = None
    step: Callable[[DataFrame], DataFrame] | None = None
    # names of a mapped dataset's variables in the dataset below, None for those that the step makes
    names: dict[str, str | None] = field(default_factory=dict)
    pruned: bool = True

    @classmethod
    def of(cls, table: DataFrame, coords: Iterable[str], period: tuple[str, str] | None = None, **attributes: str):
        """A table with one row per coordinate tuple."""
        coords = tuple(coords)
        names = tuple(c for c in table.columns if c not in coords)
        return cls("leaf", coords, names, table=table, period=period, attributes=attributes)

    @classmethod
    def files(cls, open: Callable[[tuple[str, ...]], DataFrame], coords: Iterable[str], variables: Iterable[str], period: tuple[str, str] | None = None):
        """Files that ``open`` reads, for some variables, as a table with one row per coordinate tuple."""
        return cls("leaf", tuple(coords), tuple(variables), open=open, period=period)

    def then(
        self,
        step: Callable[[DataFrame], DataFrame],
        coords: Iterable[str] | None = None,
        names: dict[str, str | None] | None = None,
        pruned: bool = True,
    ) -> "VirtualDataset":
        """The rows after a step. ``names``: variables there, with their names here (None: the step makes them).

        A step that needs every member, as one that counts along a dimension does, is not ``pruned``: periods and labels
        are looked at after it.
        """
        names = {v: v for v in self.variables} if names is None else names
        return replace(
            self, kind="mapped", children=(self,), coords=self.coords if coords is None else tuple(coords), variables=tuple(names), names=names,
            step=step, pruned=pruned, fixed=None, table=None, open=None, period=self.period if pruned else None,
        )

    @classmethod
    def concat(cls, members: list["VirtualDataset"], dim: str = "time"):
        """Members one after the other along a dimension they have. The result
        has the attributes of the last member but one."""
        spans = [m.period for m in members]
        period = None if None in spans else (min(s[0] for s in spans), max(s[1] for s in spans))
        names = tuple(dict.fromkeys(v for m in members for v in m.variables))
        attributes = members[-2 if len(members) > 1 else -1].attributes
        return cls("concat", members[0].coords, names, tuple(members), period=period, dim=dim, attributes=attributes)

    @classmethod
    def merge(cls, members: list["VirtualDataset"]):
        """Variables of all members on shared coordinates; the first that has a name gives it."""
        names = tuple(dict.fromkeys(v for m in members for v in m.variables))
        return cls("merge", members[0].coords, names, tuple(members), attributes=members[0].attributes)

    @classmethod
    def stack(cls, members: dict[str, "VirtualDataset"], dim: str = "realization", variables: Iterable[str] = ()):
        """Members along a new dimension, labelled; variables that are not listed come from the first."""
        first = next(iter(members.values()))
        return cls(
            "stack", (*first.coords, dim), tuple(variables) or first.variables, tuple(members.values()),
            dim=dim, labels=tuple(members), attributes=first.attributes,
        )

    def attach(self, fixed: DataFrame) -> "VirtualDataset":
        """Add time-less variables, keyed by the coordinates they share with the dataset."""
        return replace(self, fixed=fixed)

    def with_attributes(self, **attributes: str) -> "VirtualDataset":
        """Set attributes; they win over those of the members."""
        return replace(self, attributes={**self.attributes, **attributes})

    def without_attribute(self, name: str) -> "VirtualDataset":
        return replace(self, attributes={k: v for k, v in self.attributes.items() if k != name})

    def frame(
        self,
        variables: Iterable[str] | None = None,
        period: tuple[str, str] | None = None,
        labels: Iterable[str] | None = None,
    ) -> DataFrame:
        """The dataset as a DataFrame, restricted to some variables, a period and some labels."""
        wanted = tuple(self.variables if variables is None else variables)
        df = self._read(wanted, period, None if labels is None else tuple(labels))
        if self.fixed is not None:
            shared = [c for c in self.fixed.columns if c in self.coords]
            df = virtual.attach_fixed(df, self.fixed, shared)
        return df

    def _read(self, wanted, period, labels) -> DataFrame:
        if self.kind == "mapped":
            (below,) = self.children
            needed = [self.names[v] for v in wanted if self.names[v] is not None]
            # without a variable the rows are still those of the dataset below
            needed = needed or below.variables
            df = self.step(below.frame(needed, period, labels) if self.pruned else below.frame(needed))
            if not self.pruned and period is not None and "time" in self.coords:
                df = df.where(times.within("time", period))
            if not self.pruned and labels is not None and self.dim in self.coords:
                df = df.where(F.col(self.dim).isin(*labels))
            return df.select(*self.coords, *wanted)
        if self.kind == "leaf":
            df = edit.explicit(self.table, [*self.coords, *wanted]) if self.open is None else self.open(wanted)
            if period is not None and "time" in self.coords:
                df = df.where(times.within("time", period))
            return df
        if self.kind == "concat":
            kept = [m for m in self.children if period is None or m.period is None or _meet(m.period, period)]
            # a period that no member meets still has a schema: that of the first member
            return virtual.join_existing([m.frame(wanted, period, labels) for m in kept or self.children[:1]])
        if self.kind == "merge":
            # every member gives its coordinates, so the choice of variables does not change the rows
            kept, left = [], list(wanted)
            for m in self.children:
                mine = [v for v in left if v in m.variables]
                kept.append(m.frame(mine, period, labels))
                left = [v for v in left if v not in mine]
            return virtual.union_variables(kept, list(self.coords)).select(*self.coords, *wanted)
        unknown = [] if labels is None else [x for x in labels if x not in self.labels]
        if unknown:
            raise ValueError(f"no members with the labels {', '.join(unknown)}; there are {', '.join(self.labels)}")
        chosen = {}
        for i, (name, m) in enumerate(zip(self.labels, self.children)):
            # variables that are not stacked come from the first member alone
            given = m.variables if i == 0 else [v for v in m.variables if v in self.variables]
            if labels is None or name in labels:
                chosen[name] = m.frame([v for v in wanted if v in given], period)
        stacked = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn(self.dim, F.lit(name)) for name, df in chosen.items()]
        )
        absent = [v for v in wanted if v not in stacked.columns]
        if absent:
            types = dict(self.children[0].frame(absent).dtypes)
            stacked = stacked.withColumns({v: F.lit(None).cast(types[v]) for v in absent})
        return stacked.select(*self.coords, *wanted)


def _meet(a: tuple[str, str], b: tuple[str, str]) -> bool:
    """Whether two periods share a moment; a date ends with its day."""

    def begin(text: str) -> datetime:
        return datetime.fromisoformat(text)

    def end(text: str) -> datetime:
        return begin(text) + timedelta(days=1, microseconds=-1) if len(text) <= 10 else begin(text)

    return begin(a[0]) <= end(b[1]) and begin(b[0]) <= end(a[1])
