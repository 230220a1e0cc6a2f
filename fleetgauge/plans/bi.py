"""The saved queries of the BI layer, over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import catalog
from fleetgauge.operators.alerts import alerts
from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.settings import Settings


class SavedQueries:
    """Queries over the tables of one database.

    Table names are arguments so that the same queries serve several flows.
    """

    def __init__(
        self,
        spark: SparkSession,
        settings: Settings,
        devices: str = "device_info",
        dates: str = "dim_date",
        thresholds: str = "thresholds",
        bronze: str = "bronze",
        silver: str = "silver",
        gold: str = "gold",
    ) -> None:
        self.spark = spark
        self.settings = settings
        self.names = {
            "devices": devices,
            "dates": dates,
            "thresholds": thresholds,
            "bronze": bronze,
            "silver": silver,
            "gold": gold,
        }

    def _table(self, role: str) -> DataFrame:
        return self.spark.table(self.settings.table(self.names[role]))

    def sensor_reference(self) -> DataFrame:
        return self._table("devices")

    def date_dimension(self) -> DataFrame:
        return self._table("dates")

    def silver(self) -> DataFrame:
        return self._table("silver")

    def gold(self) -> DataFrame:
        """Gold with its window's start and end in front."""
        return self._table("gold").select("window.start", "window.end", "*")

    def alerts(self, ordered: bool = False, measure: str = "sensor5_avg") -> DataFrame:
        """Windows whose average is above the device's threshold."""
        thresholds = bounded_broadcast(self._table("thresholds"))
        return alerts(self._table("gold"), thresholds, measure, ordered)

    def device(self, device: int, layer: str = "silver") -> DataFrame:
        """All rows of one device in bronze or silver; the filter reaches the scan."""
        return self._table(layer).where(F.col("device") == device)

    def device_count(self) -> DataFrame:
        """How many device names reached gold."""
        return self._table("gold").agg(F.countDistinct("deviceName").alias("device_count"))

    def star_schema(self) -> dict[str, DataFrame]:
        """Persistent views for a BI tool: fact, dimensions and aggregate."""
        views = {
            "fact_reading": ("silver", "* EXCEPT (deviceName, location, CalendarDay)"),
            "dim_device": ("devices", "*"),
            "dim_calendar": ("dates", "*"),
            "agg_window": ("gold", "window.start, window.end, * EXCEPT (window)"),
        }
        return {
            view: catalog.create_view(
                self.spark,
                self.settings.table(view),
                f"SELECT {columns} FROM {self.settings.table(self.names[role])}",
            )
            for view, (role, columns) in views.items()
        }
