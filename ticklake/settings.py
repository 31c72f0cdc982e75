"""Connection settings, from arguments or the environment only: no credentials in code."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class KafkaSettings:
    bootstrap: str
    topic: str

    @classmethod
    def from_env(
        cls, env: Mapping[str, str] | None = None, topic_variable: str = "KAFKA_TOPIC"
    ) -> KafkaSettings:
        env = os.environ if env is None else env
        return cls(env.get("KAFKA_BOOTSTRAP", "localhost:9092"), env.get(topic_variable, "ticks"))


@dataclass(frozen=True)
class JdbcSettings:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcSettings:
        env = os.environ if env is None else env
        return cls(
            env["TICKLAKE_JDBC_URL"],
            env.get("TICKLAKE_JDBC_USER"),
            env.get("TICKLAKE_JDBC_PASSWORD"),
            env.get("TICKLAKE_JDBC_DRIVER"),
        )

    def options(self) -> dict[str, str]:
        named = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {key: value for key, value in named.items() if value is not None}
