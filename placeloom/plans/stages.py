"""Stages of a build as a graph: order, countries, records of what was run, and the gate at the end."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Stage = Callable[[DataFrame, dict], DataFrame]


@dataclass(frozen=True)
class Step:
    """A stage, what it must follow, and the countries it is for (none: all). ``owns`` are the columns it makes, which are emptied first, so that it can be run again."""

    name: str
    run: Stage
    after: tuple[str, ...] = ()
    countries: tuple[str, ...] = ()
    owns: tuple[str, ...] = ()


@dataclass
class Build:
    """Steps in an order that their ``after`` gives; ties in the order given."""

    steps: list[Step]
    ledger: list[tuple[str, str, str]] = field(default_factory=list)

    def order(self) -> list[Step]:
        by = {s.name: s for s in self.steps}
        graph = TopologicalSorter({s.name: [a for a in s.after if a in by] for s in self.steps})
        graph.prepare()
        out, place = [], {s.name: i for i, s in enumerate(self.steps)}
        while graph.is_active():
            ready = sorted(graph.get_ready(), key=place.__getitem__)
            out += [by[n] for n in ready]
            graph.done(*ready)
        return out

    def run(self, df: DataFrame, country: str, context: dict | None = None, begin: str | None = None) -> DataFrame:
        """``df`` through every allowed step from ``begin`` on; the ledger tells which ran and which were skipped, and why."""
        on = begin is None
        for step in self.order():
            on = on or step.name == begin
            if not on:
                self.ledger.append((step.name, "skipped", "before the first"))
            elif step.countries and country not in step.countries:
                self.ledger.append((step.name, "skipped", f"not for {country}"))
            else:
                for c in step.owns:
                    if c in df.columns:
                        df = df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
                df = step.run(df, context or {})
                self.ledger.append((step.name, "ran", ""))
        return df

    def record(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.ledger, "stage string, state string, reason string")


def gate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` unchanged if no row breaks a rule; else raises with the number of rows that break each. One pass for all rules."""
    counts = df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items())).first().asDict()
    if broken := {n: c for n, c in counts.items() if c}:
        raise ValueError(f"invariants broken: {broken}")
    return df


def violations(df: DataFrame, by: str, rules: dict[str, Column]) -> DataFrame:
    """The same counts by area: (area, rows, one column for each rule, total)."""
    out = df.groupBy(by).agg(F.count("*").alias("rows"), *(F.count_if(~F.coalesce(ok, F.lit(False))).alias(n) for n, ok in rules.items()))
    return out.withColumn("violations", sum((F.col(n) for n in list(rules)[1:]), F.col(next(iter(rules)))))
