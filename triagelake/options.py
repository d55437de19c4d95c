"""Job parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

# Fixed value: the model asked for when none is configured.
DEFAULT_MODEL = "qwen2.5-72b-instruct"


def _flag(value: Any) -> bool:
    return value if isinstance(value, bool) else str(value).strip().lower() in {"1", "yes", "true", "on"}


def _number(kind: type, value: Any, default: Any) -> Any:
    try:
        return kind(value)
    except (TypeError, ValueError, OverflowError):
        return default


@dataclass(frozen=True)
class TriageOptions:
    """Limits, provider details and output switches of one job."""

    enabled: bool = False
    provider: str = "openai_compatible"
    model: str = ""
    system_prompt_version: str = "v1"
    temperature: float = 0.0
    max_tokens: int = 2200
    max_input_events: int = 80
    max_processes: int = 20
    max_signatures: int = 50
    max_network_artifacts: int = 50
    redact_pii: bool = True
    store_markdown: bool = True
    attach_to_results: bool = False
    usable: bool = True

    @classmethod
    def from_mapping(cls, section: Mapping[str, Any]) -> TriageOptions:
        """Read a configuration section.

        A bad temperature or token budget takes its default.  A bad limit leaves the job unable to build evidence: ``usable``
        turns False and every report gets an error assessment.
        """
        values: dict[str, Any] = {}
        for name in ("enabled", "redact_pii", "store_markdown", "attach_to_results"):
            if name in section:
                values[name] = _flag(section[name])
        for name in ("provider", "model", "system_prompt_version"):
            if name in section:
                values[name] = str(section[name])
        if "temperature" in section:
            values["temperature"] = _number(float, section["temperature"], cls.temperature)
        if "max_tokens" in section:
            values["max_tokens"] = _number(int, section["max_tokens"], cls.max_tokens)
        for name in ("max_input_events", "max_processes", "max_signatures", "max_network_artifacts"):
            if name in section:
                limit = _number(int, section[name], None)
                if limit is None:
                    values["usable"] = False
                else:
                    values[name] = limit
        return cls(**values)

    @property
    def metadata(self) -> dict[str, str]:
        """What the job itself states about the model, over anything a reply claims."""
        return {"provider": self.provider, "model": self.model, "prompt_version": self.system_prompt_version}

    @property
    def request_model(self) -> str:
        return self.model or DEFAULT_MODEL
