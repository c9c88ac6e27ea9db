"""Pipeline configuration and the fixed values shared with message producers and configuration files."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

REFERENCE = "reference"
CORRECTED = "corrected"

# They must equal what producers send and what existing configuration files contain.
DSID_SCHEME = "fedora-types:dsID"
DEFAULT_TOPIC_FILTER = "fedora.apim.*"
DEFAULT_INDEX_NAME = "fedora"
REPOSITORY_BLOCK = "fedora"
DEFAULT_HARVEST_URL = "http://localhost:8080/fedora/oai"
DEFAULT_POLL_INTERVAL_S = 300.0
ERROR_RETENTION_WEEKS = 6

# Duration suffixes in seconds; a bare number means milliseconds.
DURATION_UNITS = {"ms": 0.001, "s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


@dataclass(frozen=True)
class JobRule:
    """One job a repository method gives rise to."""

    method: str
    kind: str
    op: str
    keep_dsid: bool
    delay_s: int


# Method -> jobs, in the order in which they are queued.
DEFAULT_RULES: tuple[JobRule, ...] = (
    JobRule("ingest", "object", "CREATE", False, 1),
    JobRule("addDatastream", "datastream", "CREATE", True, 1),
    JobRule("purgeObject", "object", "DELETE", False, 0),
    JobRule("purgeDatastream", "datastream", "DELETE", True, 0),
    JobRule("modifyObject", "object", "UPDATE", False, 5),
    JobRule("modifyDatastreamByReference", "object", "UPDATE", True, 1),
    JobRule("modifyDatastreamByReference", "datastream", "UPDATE", True, 5),
    JobRule("modifyDatastreamByValue", "object", "UPDATE", True, 1),
    JobRule("modifyDatastreamByValue", "datastream", "UPDATE", True, 5),
    JobRule("setDatastreamState", "object", "UPDATE", True, 1),
    JobRule("setDatastreamState", "datastream", "UPDATE", True, 5),
)


def check_mode(mode: str) -> str:
    if mode not in (REFERENCE, CORRECTED):
        raise ValueError(f"mode must be {REFERENCE!r} or {CORRECTED!r}, not {mode!r}")
    return mode


def parse_duration(value: Any) -> float:
    """Seconds for ``90``, ``"90"`` (milliseconds) or ``"5m"``-like text."""
    match = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*(ms|[smhdw])?\s*", str(value).lower())
    if not match:
        raise ValueError(f"not a duration: {value!r}")
    return float(match[1]) * DURATION_UNITS[match[2] or "ms"]


def _as_list(value: Any) -> tuple[str, ...]:
    if value is None:
        return ()
    if isinstance(value, (list, tuple, set)):
        return tuple(str(v) for v in value)
    return (str(value),)


@dataclass(frozen=True)
class PipelineConfig:
    mode: str = REFERENCE
    index_name: str = DEFAULT_INDEX_NAME
    pid_match: str = ""
    exclude_datastreams: tuple[str, ...] = ()
    relevant_datastreams: tuple[str, ...] = ()
    sdef_pid: str = ""
    method: str = ""
    properties: dict[str, Any] = field(default_factory=dict)
    broker_url: str = ""
    message_selector: str = ""
    topic_filter: str = DEFAULT_TOPIC_FILTER
    repository_url: str = ""
    harvest_url: str | None = None
    poll_interval_s: float = DEFAULT_POLL_INTERVAL_S
    rules: tuple[JobRule, ...] = DEFAULT_RULES
    delay_unit_s: int = 1
    waiting_delays_s: tuple[int, ...] = ()  # waits of stored jobs, which earlier rules may have given

    @property
    def delays_s(self) -> tuple[int, int]:
        """Shortest and longest non-zero waiting time of the rules and of stored jobs, in seconds."""
        waits = [r.delay_s * self.delay_unit_s for r in self.rules if r.delay_s > 0] or [self.delay_unit_s]
        waits += self.waiting_delays_s
        return min(waits), max(waits)

    @classmethod
    def from_json(cls, source: str | dict[str, Any], mode: str = REFERENCE) -> PipelineConfig:
        """Read a configuration map.

        ``reference`` mode looks for the index name and the relevant datastreams only where the original does and insists
        on a harvest block; ``corrected`` mode also accepts the places the sample configuration uses.
        """
        check_mode(mode)
        settings = json.loads(source) if isinstance(source, str) else source
        values: dict[str, Any] = {"mode": mode}

        index = settings.get("index") or {}
        name = index.get("indexName")
        if name is None and mode == CORRECTED:
            name = index.get("name")
        values["index_name"] = DEFAULT_INDEX_NAME if name is None else str(name)
        values["pid_match"] = index.get("pid_match") or ""
        values["exclude_datastreams"] = _as_list(index.get("exclude_datastreams"))
        dissemination = index.get("dissemination")
        if dissemination is not None:
            values["sdef_pid"] = dissemination.get("sdef_pid") or ""
            values["method"] = dissemination.get("method") or ""
            values["properties"] = dict(dissemination.get("properties") or {})
            relevant = _as_list(index.get("relevant_datastreams"))
            if mode == CORRECTED:
                relevant += _as_list(dissemination.get("relevant_datastreams"))
            values["relevant_datastreams"] = relevant

        messages = settings.get("jms") or {}
        if not messages.get("brokerUrl"):
            raise ValueError("no message broker configured: jms.brokerUrl is required")
        values["broker_url"] = messages["brokerUrl"]
        values["message_selector"] = messages.get("messageSelector") or ""
        values["topic_filter"] = messages.get("topicFilter") or DEFAULT_TOPIC_FILTER

        if REPOSITORY_BLOCK not in settings:
            raise ValueError(f"no repository configured: the {REPOSITORY_BLOCK!r} block is required")
        values["repository_url"] = (settings[REPOSITORY_BLOCK] or {}).get("url") or ""

        harvest = settings.get("oai")
        if harvest is not None:
            values["harvest_url"] = harvest.get("url") or DEFAULT_HARVEST_URL
            if harvest.get("poll_interval") is not None:
                values["poll_interval_s"] = parse_duration(harvest["poll_interval"])
        elif mode == REFERENCE:
            raise ValueError("no harvest block configured")
        return cls(**values)
