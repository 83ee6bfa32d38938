"""Runs that a new driver can go on with.

A run with a folder of its own keeps there the prepared graph, its states and a manifest: one small JSON table for the graph,
written when it is complete, and one per round, written after the round's state. A folder of the manifest without data
is a write that did not end and counts as nothing. Round ``k`` overwrites the state of round ``k - 2``, so the
state that the last manifest names is always whole. When the run ends the manifest goes first, then the graph; the last
state stays for the result until the driver's Python ends. The caller must give the same edges again; settings that change the
ranks are compared.
"""

from __future__ import annotations

import atexit
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphloom.plans.layout import GraphLayout
from graphloom.plans.loop import RoundInfo, TableStore
from graphloom.plans.tables import RunTables

# what a layout is beside its tables
SCALARS = ("num_vertices", "num_edges", "num_distinct_edges", "num_sinks", "bucket_size", "partitions", "mode", "weighted",
           "min_weight")


class RestartableRun:
    def __init__(self, spark: SparkSession, folder: str, settings: dict):
        self.spark, self.folder, self.settings = spark, folder.rstrip("/"), settings
        self.graph = RunTables(spark, "graph", f"{self.folder}/graph", lasting=True)
        self.states = RunTables(spark, "state", f"{self.folder}/state", lasting=True)
        self.manifest = RunTables(spark, "manifest", f"{self.folder}/manifest", lasting=True)
        noted = self._noted()
        self.known = noted.get(0)
        if self.known and self.known["settings"] != settings:
            raise ValueError(f"{folder} holds a run with other settings: {self.known['settings']}")
        self.rounds = [RoundInfo(k, noted[k]["metrics"], noted[k]["seconds"]) for k in sorted(noted) if k and self.known]

    def _noted(self) -> dict[int, dict]:
        """The manifest by round (0: the graph): one small row each."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.manifest.root)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return {}
        rows = (self.spark.read.schema("round INT, told STRING").option("recursiveFileLookup", "true")
                .json(self.manifest.root).collect())
        return {r["round"]: json.loads(r["told"]) for r in rows}

    def _note(self, k: int, told: dict) -> None:
        row = self.spark.createDataFrame([(k, json.dumps(told))], "round INT, told STRING").coalesce(1)
        row.write.mode("overwrite").json(self.manifest.path(f"round-{k}"))

    def layout(self, prepare: Callable[[RunTables], GraphLayout]) -> GraphLayout:
        """The graph of the run: attached where it was complete, else prepared."""
        if not self.known:
            made = prepare(self.graph)
            self._note(0, {"settings": self.settings, "hot": made.hot is not None, **{s: getattr(made, s) for s in SCALARS}})
            return made
        scalars = {s: self.known[s] for s in SCALARS}
        parts = scalars["partitions"]
        return GraphLayout(vertices=self.graph.attach("vertices", parts, ("id",)),
                           cold=self.graph.attach("cold", parts, ("src",), "block"),
                           hot=self.graph.attach("hot", parts, ("src", "salt")) if self.known["hot"] else None,
                           tables=self.graph, **scalars)

    def store(self, layout: GraphLayout) -> TableStore:
        return TableStore(self.spark, buckets=layout.partitions, tables=self.states)

    def state(self, layout: GraphLayout) -> DataFrame | None:
        """The state of the last complete round, if there is one."""
        if not self.rounds:
            return None
        return self.states.attach(self.store(layout).name(self.rounds[-1].round), layout.partitions, ("id",))

    def note(self, done: RoundInfo) -> None:
        self._note(done.round, {"metrics": done.metrics, "seconds": done.seconds})

    def finish(self) -> None:
        self.manifest._delete(self.manifest.root)
        atexit.register(self.states.close)
