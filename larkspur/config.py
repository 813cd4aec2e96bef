"""The storage configuration file."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from pathlib import Path

# The configuration's keys, by field.
KEYS = {
    "connection": "azure.connection",
    "container": "azure.container.name",
    "prefix": "azure.blob.prefix",
    "suffix": "azure.blob.suffix",
    "rows_per_part": "azure.blob.break",
    "flush": "azure.blob.flush",
    "compress": "azure.blob.enable-compression",
}


@dataclass
class StorageConfig:
    """Where named outputs go. connection is any folder or file-system URI; container is a folder in it."""

    connection: str = ""
    container: str = field(default_factory=lambda: str(uuid.uuid4()))
    prefix: str = "output"
    suffix: str | None = None
    rows_per_part: int = 1_000_000
    flush: int = 1_000
    compress: bool = False

    def __post_init__(self) -> None:
        if self.suffix is None:
            self.suffix = ".gz" if self.compress else ".txt"

    @classmethod
    def load(cls, path: str | Path) -> StorageConfig:
        """From a JSON file: booleans are kept, all other values are read from their text."""
        return cls.of(json.loads(Path(path).read_text(encoding="utf-8")))

    @classmethod
    def of(cls, values: dict) -> StorageConfig:
        own = {f: values[k] for f, k in KEYS.items() if values.get(k) is not None}
        for f in ("rows_per_part", "flush"):
            if f in own:
                own[f] = int(own[f])
        return cls(**{f: v if isinstance(v, (bool, int)) else str(v) for f, v in own.items()})

    @property
    def folder(self) -> str:
        return "/".join(x.rstrip("/") for x in (self.connection, self.container) if x)
