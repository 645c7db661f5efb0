"""Settings of a deployment, from a TOML file; what is required is checked before anything starts."""

from __future__ import annotations

import dataclasses
import tomllib
from pathlib import Path


@dataclasses.dataclass
class Integration:
    """One feed of one kind: where it is, how often it is asked, and its credentials."""

    name: str
    api_url: str
    api_key: str = ""
    interval: int = 0  # seconds; 0: the source's own default
    client_id: str = ""
    client_secret: str = ""
    token_url: str = ""
    stream: str = ""  # of a bus that keeps messages: the stream that holds the subject


@dataclasses.dataclass
class Settings:
    store: str = ""
    checkpoints: str = ""
    spool: str = ""
    bus: str = ""
    city_db: str = ""
    asn_db: str = ""
    ttl_hours: int = 24
    integrations: dict[str, list[Integration]] = dataclasses.field(default_factory=dict)

    def check(self) -> Settings:
        for name in ("store", "checkpoints", "spool", "bus"):
            if not getattr(self, name):
                raise ValueError(f"settings: {name} is required")
        return self


def load(path: str) -> Settings:
    """Unknown names are errors, so that a typing error isn't a silent default."""
    raw = tomllib.loads(Path(path).read_text())
    feeds = {kind: [Integration(**x) for x in many] for kind, many in raw.pop("integrations", {}).items()}
    try:
        return Settings(**raw, integrations=feeds).check()
    except TypeError as e:
        raise ValueError(f"settings: {e}") from e
