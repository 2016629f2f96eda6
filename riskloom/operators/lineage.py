"""From which source columns each column of a frame is computed, read off its analysed plan."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, functions as F

#: Metadata key under which stored columns keep their sources.
SOURCES = "sources"


def _items(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))


def _ids(attributes) -> list[int]:
    return [a.exprId().id() for a in _items(attributes)]


class _Walk:
    """Definitions of all attributes of a plan: the attributes each is computed from, or a source."""

    def __init__(self, plan):
        self.needs: dict[int, set[int]] = {}
        self.named: dict[int, set[str]] = {}
        self.alias: dict[int, str] = {}
        self.visit(plan)

    def visit(self, plan) -> None:
        children = list(_items(plan.children()))
        for child in children:
            self.visit(child)
        if not children:
            for a in _items(plan.output()):
                carried = json.loads(a.metadata().json()).get(SOURCES)
                self.named[a.exprId().id()] = set(carried) if carried is not None else {a.name()}
            return
        kind = plan.getClass().getSimpleName()
        if kind == "Generate":
            self.define(_ids(plan.generatorOutput()), self.references(plan.generator()))
        elif kind == "Union":
            for i, out in enumerate(_ids(plan.output())):
                self.define([out], {c.output().apply(i).exprId().id() for c in children} - {out})
        elif kind == "Expand":
            for i, out in enumerate(_ids(plan.output())):
                self.define([out], {x for p in _items(plan.projections()) for x in self.references(p.apply(i))} - {out})
        else:
            for e in _items(plan.expressions()):
                if e.getClass().getSimpleName() == "Alias":
                    self.define([e.exprId().id()], self.references(e))
                    self.alias[e.exprId().id()] = e.name()
        # Operators that run foreign code, or that aren't known, may use whatever they read.
        before = {x for c in children for x in _ids(c.output())}
        unknown = [x for x in _ids(plan.output()) if x not in before and x not in self.needs and x not in self.named]
        if unknown:
            self.define(unknown, before)

    def define(self, outputs: Sequence[int], inputs: set[int]) -> None:
        for out in outputs:
            self.needs.setdefault(out, set()).update(inputs)

    def references(self, expression) -> set[int]:
        """Attributes of an expression, those of its subqueries' results included."""
        found = set(_ids(expression.references().toSeq()))
        stack = [expression]
        while stack:
            e = stack.pop()
            if e.getClass().getSimpleName().endswith("Subquery"):
                self.visit(e.plan())
                found |= set(_ids(e.plan().output()))
            stack += list(_items(e.children()))
        return found

    def sources(self, attribute: int) -> set[str]:
        found: set[str] = set()
        seen, stack = set(), [attribute]
        while stack:
            x = stack.pop()
            if x in seen:
                continue
            seen.add(x)
            found |= self.named.get(x, set())
            if x != attribute and x in self.alias:
                found.add(self.alias[x])
            stack += self.needs.get(x, ())
        return found


def sources(df: DataFrame) -> dict[str, set[str]]:
    """Names of the columns that every column is computed from, at any step down to the scans.

    Projections, aggregates, windows, generators, unions, joins and scalar subqueries are followed;
    a column made by Python code counts as made from all that the code reads. What only filters,
    orders, groups or joins rows is no source. A checkpoint or a written table begins a new plan: ``traced``
    carries the sources across.
    """
    plan = df._jdf.queryExecution().analyzed()
    walk = _Walk(plan)
    return {name: walk.sources(x) for name, x in zip(df.columns, _ids(plan.output()))}


def traced(df: DataFrame) -> DataFrame:
    """The frame with each column's sources in its metadata, for frames that are stored next."""
    known = sources(df)
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata, SOURCES: sorted(known[c])}) for c in df.columns])
