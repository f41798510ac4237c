"""Connection settings for database-backed deployments, taken from the environment (never from code)."""

from __future__ import annotations

import os
from dataclasses import dataclass


@dataclass(frozen=True)
class JdbcSettings:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    def properties(self) -> dict[str, str]:
        props = {"user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in props.items() if v is not None}


def jdbc_settings(prefix: str = "FOOTFALL_JDBC_") -> JdbcSettings | None:
    """Read <prefix>URL / USER / PASSWORD / DRIVER; None when no URL is configured."""
    url = os.environ.get(prefix + "URL")
    if not url:
        return None
    return JdbcSettings(url, os.environ.get(prefix + "USER"), os.environ.get(prefix + "PASSWORD"),
                        os.environ.get(prefix + "DRIVER"))
