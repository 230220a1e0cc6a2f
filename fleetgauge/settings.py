"""Settings of one deployment, in place of notebook widgets and UI fields."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Where tables live and how the layers run.

    ``trigger`` is a processing-time interval such as ``"10 seconds"``, or
    ``"availableNow"`` to drain what is there and stop.
    """

    database: str
    base_path: str
    trigger: str = "10 seconds"
    table_format: str = "parquet"
    window: str = "30 seconds"
    watermark: str = "1 minute"
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: str | None = None
    pools: tuple[str, ...] = ("pool1", "pool2", "pool3", "pool4")

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def data_path(self, name: str) -> str:
        return f"{self.base_path.rstrip('/')}/data/{name}"

    def checkpoint_path(self, name: str) -> str:
        """One checkpoint per query: sharing one mixes up two queries' offsets."""
        return f"{self.base_path.rstrip('/')}/cp/{name}"
