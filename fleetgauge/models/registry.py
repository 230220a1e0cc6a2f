"""Numbered model versions with stages, kept in a shared folder.

``<root>/<name>/version=<n>/model`` holds the model. Facts about a version
are written as revisions of one row; the latest revision counts. A stage is served by
the version that was moved there last, whatever its number.
"""

from __future__ import annotations

import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from fleetgauge import storage

STAGES = ("None", "Staging", "Production", "Archived")
#: Stages that one version holds at a time.
SERVING = ("Staging", "Production")
#: moved is when the version got its stage, in ms; null in rows written without it.
_FACTS = (
    "name string, version int, stage string, description string, metric string, score double, "
    "moved long"
)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/version={version}"

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        found = storage.names(self.spark, folder)
        return sorted(int(n.removeprefix(prefix)) for n in found if n.startswith(prefix))

    def versions(self, name: str) -> list[int]:
        """Versions whose model has been saved whole."""
        numbers = self._numbers(f"{self.root}/{name}", "version=")
        return [n for n in numbers if self._revisions(name, n)]

    def _revisions(self, name: str, version: int) -> list[int]:
        folder = self._folder(name, version)
        numbers = self._numbers(folder, "facts=")
        return [n for n in numbers if storage.exists(self.spark, f"{folder}/facts={n}/_SUCCESS")]

    def _write_facts(self, facts: dict) -> None:
        folder = self._folder(facts["name"], facts["version"])
        number = max(self._numbers(folder, "facts="), default=0) + 1
        row = [tuple(facts[c.split()[0]] for c in _FACTS.split(", "))]
        frame = self.spark.createDataFrame(row, _FACTS).coalesce(1)
        frame.write.parquet(f"{folder}/facts={number}")

    def register(
        self,
        name: str,
        model: PipelineModel,
        description: str = "",
        metric: str | None = None,
        score: float | None = None,
    ) -> int:
        """Save a model as the next version and return its number."""
        taken = self._numbers(f"{self.root}/{name}", "version=")
        version = max(taken, default=0) + 1
        while not storage.claim(self.spark, f"{self._folder(name, version)}/_claimed"):
            version += 1
        model.write().save(f"{self._folder(name, version)}/model")
        self._write_facts(
            {
                "name": name,
                "version": version,
                "stage": "None",
                "description": description,
                "metric": metric,
                "score": score,
                "moved": None,
            }
        )
        return version

    def facts(self, name: str, version: int) -> dict:
        revisions = self._revisions(name, version)
        if not revisions:
            raise LookupError(f"{name} has no version {version}")
        folder = f"{self._folder(name, version)}/facts={revisions[-1]}"
        return self.spark.read.schema(_FACTS).parquet(folder).first().asDict()

    def describe(self, name: str, version: int, description: str) -> None:
        self._write_facts(self.facts(name, version) | {"description": description})

    def transition(self, name: str, version: int, stage: str, retire: bool = True) -> None:
        """Move a version to a stage; earlier versions of a serving stage are archived.

        The new version is written first, so a stage is never empty. In between, or if
        the second step fails, ``load`` already takes the new one, as it was moved last.
        """
        if stage not in STAGES:
            raise ValueError(f"stage is one of {STAGES}, not {stage!r}")
        held = self._holders(name, stage) if stage in SERVING else []
        now = max([int(time.time() * 1000), *(f["moved"] + 1 for f in held if f["moved"])])
        self._write_facts(self.facts(name, version) | {"stage": stage, "moved": now})
        for facts in held if retire else ():
            if facts["version"] != version:
                self._write_facts(facts | {"stage": "Archived", "moved": now})

    def _holders(self, name: str, stage: str) -> list[dict]:
        """Versions of a stage, the one moved there last at the end."""
        found = [self.facts(name, v) for v in self.versions(name)]
        held = [f for f in found if f["stage"] == stage]
        return sorted(held, key=lambda f: (f["moved"] or 0, f["version"]))

    def listing(self, name: str) -> DataFrame:
        """One row per version."""
        rows = [tuple(self.facts(name, v).values()) for v in self.versions(name)]
        return self.spark.createDataFrame(rows, _FACTS)

    def load(
        self, name: str, version: int | None = None, stage: str | None = None
    ) -> PipelineModel:
        """A version by number, the one moved to a stage last, or the newest of all."""
        numbers = self.versions(name) if version is None else [version]
        if stage is not None:
            held = [f["version"] for f in self._holders(name, stage)]
            numbers = [v for v in held if v in numbers]
        if not numbers:
            raise LookupError(f"{name} has no version for stage {stage!r}")
        chosen = numbers[-1]
        if chosen not in self.versions(name):
            raise LookupError(f"{name} has no version {chosen}")
        return PipelineModel.load(f"{self._folder(name, chosen)}/model")
