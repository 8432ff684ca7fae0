"""The three prompt templates: hook and safe (slot ``body_snippet``), critic (``body_snippet`` and ``headline``)."""

from __future__ import annotations

from dataclasses import dataclass
from importlib import resources
from string import Formatter

from pyspark.sql import SparkSession

_SLOTS = {
    "hook": {"body_snippet"},
    "safe": {"body_snippet"},
    "critic": {"body_snippet", "headline"},
}


@dataclass(frozen=True)
class Templates:
    hook: str
    safe: str
    critic: str

    def __post_init__(self) -> None:
        for name, slots in _SLOTS.items():
            found = {slot for _, slot, _, _ in Formatter().parse(getattr(self, name)) if slot is not None}
            if found != slots:
                raise ValueError(f"template {name!r} has slots {sorted(found)}, needs {sorted(slots)}")


def load_templates(spark: SparkSession | None = None, folder: str | None = None) -> Templates:
    """The packaged templates, or ``hook.txt``, ``safe.txt`` and ``critic.txt`` of a folder any Spark
    file system can reach. A missing file or slot fails here, before any article is read."""
    if folder is None:
        packaged = resources.files("masthead.sources") / "templates"
        return Templates(**{name: (packaged / f"{name}.txt").read_text("utf-8") for name in _SLOTS})
    if spark is None:
        raise ValueError("reading templates from a folder needs the Spark session")
    texts = {
        name: spark.read.text(f"{folder}/{name}.txt", wholetext=True).first()["value"] for name in _SLOTS
    }
    return Templates(**texts)
