"""Settings, with defaults, read from the environment as RIVULET_<NAME>."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, fields

_UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(text: str) -> float:
    """A duration such as 500ms, 1m30s or 2h in seconds; a bare number is seconds."""
    if re.fullmatch(r"\d+(\.\d+)?", text):
        return float(text)
    if not re.fullmatch(r"(\d+(\.\d+)?(ms|s|m|h))+", text):
        raise ValueError(f"not a duration: {text!r}")
    return sum(float(n) * _UNITS[u] for n, _, u in re.findall(r"(\d+(\.\d+)?)(ms|s|m|h)", text))


@dataclass(frozen=True)
class Config:
    log_url: str = ""  # where the change log is read
    sink_url: str = ""  # comma-separated destinations
    http_server_addr: str = "0.0.0.0:9000"
    buffer_size: int = 10_000  # publications of a shard that a destination may wait for
    files_per_trigger: int = 1000  # files of the log that a micro-batch takes at most
    timestamp_flush_interval: float = 1.0
    max_catch_up: float = 120.0
    dedupe_expiration: float = 150.0
    positions_url: str = ""  # where positions and published keys are kept; the checkpoint folder if empty
    extract_subfield_changes: bool = False
    write_parallelism: int = 1
    denylist_url: str = ""
    resume_read_retries: int = 5
    resume_read_retry_delay: float = 0.5
    resume_from_end_on_failure: bool = False
    batch_size: int = 1

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Config:
        """log_url and sink_url are required."""
        env = dict(os.environ if env is None else env)
        got = {}
        for f in fields(cls):
            raw = env.get(f"RIVULET_{f.name.upper()}")
            if raw is None:
                if f.name in ("log_url", "sink_url"):
                    raise ValueError(f"RIVULET_{f.name.upper()} is not set")
                continue
            kind = type(f.default)
            got[f.name] = raw.strip().lower() in ("1", "t", "true") if kind is bool else seconds(raw) if kind is float else kind(raw)
        return cls(**got)

    @property
    def destinations(self) -> list[str]:
        return [x for x in self.sink_url.split(",") if x]
