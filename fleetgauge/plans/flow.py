"""Named views and tables that depend on each other, run in that order.

A table whose builder returns a stream is fed incrementally; one whose
builder returns a batch frame is overwritten. Inputs are passed by name, as
frames; those listed in ``streams`` are passed as streams of the table. A
streamed table with rules stores its counts, see :mod:`fleetgauge.sinks.ledger`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetgauge import catalog
from fleetgauge.operators.quality import Expectation, apply_expectations, metric_columns
from fleetgauge.settings import Settings
from fleetgauge.sinks.ledger import BATCH, rule_totals, stream_with_ledger
from fleetgauge.sinks.tables import overwrite_table, stream_to_table
from fleetgauge.sources.tables import stream_table
from fleetgauge.streaming.runner import drain, start_in_pool

Builder = Callable[[SparkSession, Mapping[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Node:
    name: str
    builder: Builder
    reads: tuple[str, ...] = ()
    streams: tuple[str, ...] = ()
    stored: bool = True
    comment: str | None = None
    expectations: tuple[Expectation, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def parents(self) -> tuple[str, ...]:
        return self.reads + self.streams


@dataclass
class Flow:
    spark: SparkSession
    settings: Settings
    nodes: dict[str, Node] = field(default_factory=dict)
    queries: dict[str, StreamingQuery] = field(default_factory=dict)
    _observations: dict[str, Observation] = field(default_factory=dict)

    def _add(self, node: Node) -> None:
        if node.name in self.nodes:
            raise ValueError(f"{node.name} is already defined")
        self.nodes[node.name] = node

    def view(self, name: str, builder: Builder, reads: tuple[str, ...] = ()) -> None:
        """A named frame that is not stored."""
        self._add(Node(name, builder, reads, stored=False))

    def table(
        self,
        name: str,
        builder: Builder,
        reads: tuple[str, ...] = (),
        streams: tuple[str, ...] = (),
        comment: str | None = None,
        expectations: tuple[Expectation, ...] = (),
        partition_by: tuple[str, ...] = (),
    ) -> None:
        """A stored table; its rules count all rows and drop as they say."""
        self._add(
            Node(name, builder, reads, streams, True, comment, expectations, partition_by)
        )

    def sql_table(
        self,
        name: str,
        text: str,
        reads: tuple[str, ...] = (),
        streams: tuple[str, ...] = (),
        comment: str | None = None,
        expectations: tuple[Expectation, ...] = (),
        partition_by: tuple[str, ...] = (),
    ) -> None:
        """A table given by a SELECT over its inputs' names."""

        def build(spark: SparkSession, inputs: Mapping[str, DataFrame]) -> DataFrame:
            for view, df in inputs.items():
                df.createOrReplaceTempView(view)
            return spark.sql(text)

        self.table(name, build, reads, streams, comment, expectations, partition_by)

    def order(self) -> list[str]:
        """Definition names, every one after those it reads."""
        for node in self.nodes.values():
            missing = [p for p in node.parents if p not in self.nodes]
            if missing:
                raise LookupError(f"{node.name} reads undefined {missing}")
        return list(TopologicalSorter({n.name: n.parents for n in self.nodes.values()}).static_order())

    def lineage(self) -> DataFrame:
        """(child, parent) pairs."""
        pairs = [(n.name, p) for n in self.nodes.values() for p in n.parents]
        return self.spark.createDataFrame(pairs, "child string, parent string")

    def ancestry(self) -> DataFrame:
        """(child, ancestor, depth): all that a definition is made of, at any distance."""
        view = f"lineage_{uuid.uuid4().hex}"
        self.lineage().createOrReplaceTempView(view)
        return self.spark.sql(
            f"""
            WITH RECURSIVE above (child, ancestor, depth) AS (
                SELECT child, parent, 1 FROM {view}
                UNION ALL
                SELECT a.child, l.parent, a.depth + 1
                FROM above a JOIN {view} l ON l.child = a.ancestor
                WHERE a.depth < {len(self.nodes)}
            )
            SELECT DISTINCT child, ancestor, depth FROM above
            """
        )

    def run(self, wait: bool = True) -> None:
        """Build every definition; with ``wait``, drain each stream in turn.

        Without it, streams keep running under the trigger of the settings,
        each in the next of its scheduler pools.
        """
        catalog.init_catalog(self.spark, self.settings.database, self.settings.data_path(""))
        frames: dict[str, DataFrame] = {}
        for name in self.order():
            node = self.nodes[name]
            inputs = {p: frames[p] for p in node.reads}
            for p in node.streams:
                parent = self.nodes[p]
                inputs[p] = (
                    stream_table(
                        self.spark,
                        self.settings.table(p),
                        self.settings.max_files_per_trigger,
                        self.settings.max_bytes_per_trigger,
                    ).drop(BATCH)
                    if parent.stored
                    else frames[p]
                )
            df = node.builder(self.spark, inputs)
            frames[name] = self._store(node, df, wait) if node.stored else df

    def _store(self, node: Node, df: DataFrame, wait: bool) -> DataFrame:
        table = self.settings.table(node.name)
        path = self.settings.data_path(node.name)
        if not df.isStreaming:
            if node.expectations:
                seen = self._observations[node.name] = Observation(node.name)
                df = df.observe(seen, *metric_columns(node.expectations))
            df = apply_expectations(df, node.expectations)
            stored = overwrite_table(
                df, table, path, self.settings.table_format, node.partition_by
            )
        else:
            pools = self.settings.pools
            pool = pools[len(self.queries) % len(pools)] if pools else None
            trigger = "availableNow" if wait else self.settings.trigger
            checkpoint = self.settings.checkpoint_path(node.name)

            def start() -> StreamingQuery:
                places = {"query_name": node.name, "trigger": trigger, "partition_by": node.partition_by}
                if node.expectations:
                    return stream_with_ledger(df, node.expectations, path, checkpoint, table, **places)
                fmt = self.settings.table_format
                return stream_to_table(df, table, path, checkpoint, fmt=fmt, **places)

            query = self.queries[node.name] = start_in_pool(self.spark, pool, start)
            if wait:
                drain(query)
            stored = self.spark.table(table).drop(BATCH)
        if node.comment:
            catalog.comment_on(self.spark, table, node.comment)
        return stored

    def stop(self) -> None:
        """Stop what still runs."""
        for query in self.queries.values():
            query.stop()

    def quality(self, name: str) -> dict[str, dict[str, int]]:
        """Passed, failed and null counts per rule of a table.

        Of a streamed table they are read from its ledger and cover every
        batch that it holds; of another, the last run.
        """
        rules = self.nodes[name].expectations
        kinds = ("passed", "failed", "nulls")
        if name in self.queries:
            rows = rule_totals(self.spark, self.settings.data_path(name)).collect()
            totals = {row.rule: row for row in rows}
            return {r.name: {k: totals[r.name][k] if r.name in totals else 0 for k in kinds} for r in rules}
        counts = self._observations[name].get
        return {r.name: {k: counts[f"{r.name}_{k}"] for k in kinds} for r in rules}
