"""Where each layer lives, and the few knobs of a run."""

from __future__ import annotations

from dataclasses import dataclass

# The reference's defaults.
DEFAULT_TOPIC = "sales-events"
DEFAULT_TOPIC_PARTITIONS = 3
DEFAULT_SOURCE_FILENAME = "2m Sales Records.csv"

LAYERS = ("landing", "archive", "topic", "bronze", "silver", "sums", "runs", "quarantine", "state")


@dataclass(frozen=True)
class Settings:
    """A folder per layer under ``root``, which may be any path URI Spark can read."""

    root: str = "data"
    kafka_topic: str = DEFAULT_TOPIC
    kafka_num_partitions: int = DEFAULT_TOPIC_PARTITIONS
    kafka_consumer_timeout_ms: int = -1
    source_filename: str = DEFAULT_SOURCE_FILENAME
    max_rows: int | None = None

    def layer(self, name: str) -> str:
        """The folder of a layer. A topic has one of its own."""
        if name not in LAYERS:
            raise ValueError(f"no layer {name!r}, only {', '.join(LAYERS)}")
        folder = f"{self.root.rstrip('/')}/{name}"
        return f"{folder}/{self.kafka_topic}" if name == "topic" else folder

    @property
    def landing_file(self) -> str:
        return f"{self.layer('landing')}/{self.source_filename}"

    @property
    def stop_when_idle(self) -> bool:
        """A positive consumer timeout means "drain what is there, then stop"."""
        return self.kafka_consumer_timeout_ms > 0
