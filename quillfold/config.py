"""Settings from the environment, checked when they are read."""

from __future__ import annotations

import os
from dataclasses import dataclass

LOG_LEVELS = ("DEBUG", "INFO", "WARNING", "ERROR", "CRITICAL")
PROVIDERS = {"offline": None, "openai": "OPENAI_API_KEY", "deepinfra": "DEEPINFRA_API_KEY"}


@dataclass(frozen=True)
class Settings:
    """Where results go and which embedding provider is asked."""

    registry_path: str
    blob_path: str
    log_level: str = "INFO"
    embedding_provider: str = "offline"

    @classmethod
    def read(cls, env: dict[str, str] | None = None) -> Settings:
        env = {k: v.strip() for k, v in (os.environ if env is None else env).items()}
        out = cls(env.get("REGISTRY_PATH", "registry"), env.get("BLOB_PATH", "blobs"), env.get("LOG_LEVEL", "INFO").upper(), env.get("EMBEDDING_PROVIDER", "offline").lower())
        if not out.registry_path or not out.blob_path:
            raise ValueError("paths must not be blank")
        if out.log_level not in LOG_LEVELS:
            raise ValueError(f"log level must be one of {', '.join(LOG_LEVELS)}")
        if out.embedding_provider not in PROVIDERS:
            raise ValueError(f"embedding provider must be one of {', '.join(PROVIDERS)}")
        key = PROVIDERS[out.embedding_provider]
        if key and not env.get(key):
            raise ValueError(f"{out.embedding_provider} needs {key}")
        return out
