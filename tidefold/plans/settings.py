"""Settings with a value per target, then a global value, then a default.

    {"write.model": "replace", "write.model.orders": "timestamps"}
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field as attribute
from typing import Any

from tidefold.operators.project import Matcher, projection
from tidefold.operators.rename import ByMapping, ByRegExp, NameRule

DEFAULTS: dict[str, Any] = {
    "targets": "",
    "route": "",
    "topic.rewrite": "[]",
    "database": "default",
    "catalog": "",
    "value.projection.type": "none",
    "value.projection.list": "",
    "key.projection.type": "none",
    "key.projection.list": "",
    "rename.mapping": "[]",
    "rename.regexp": "[]",
    "id.strategy": "object_id",
    "processors": "id",
    "write.model": "replace",
    "cdc.handler": "",
    "delete.on.null": "false",
    "delete.model": "id",
    "max.batch.size": "0",
    "lower.case.names": "false",
    "keyless": "false",
    "on.error": "failfast",
}


@dataclass(frozen=True)
class Settings:
    values: Mapping[str, Any] = attribute(default_factory=dict)

    def get(self, name: str, target: str = "") -> Any:
        for key in ([f"{name}.{target}"] if target else []) + [name]:
            if key in self.values:
                return self.values[key]
        return DEFAULTS[name]

    def flag(self, name: str, target: str = "") -> bool:
        return str(self.get(name, target)).lower() == "true"

    def number(self, name: str, target: str = "") -> int:
        return int(self.get(name, target))

    def names(self, name: str, target: str = "") -> list[str]:
        return [p.strip() for p in str(self.get(name, target)).split(",") if p.strip()]

    def targets(self) -> list[str]:
        return self.names("targets")

    def routes(self) -> dict[str, str]:
        """topic to target, from `route.<topic>`."""
        head = "route."
        return {k[len(head):]: v for k, v in self.values.items() if k.startswith(head)}

    def rewrites(self) -> list[tuple[str, str]]:
        return [(r["regex"], r["replacement"]) for r in json.loads(self.get("topic.rewrite"))]

    def projection(self, side: str, target: str = "") -> Matcher | None:
        return projection(
            self.get(f"{side}.projection.type", target), self.get(f"{side}.projection.list", target)
        )

    def mapping(self, target: str = "") -> ByMapping:
        entries = json.loads(self.get("rename.mapping", target) or "[]")
        return ByMapping({e["oldName"]: e["newName"] for e in entries})

    def regexps(self, target: str = "") -> ByRegExp:
        entries = json.loads(self.get("rename.regexp", target) or "[]")
        return ByRegExp([NameRule(e["regexp"], e["pattern"], e["replace"]) for e in entries])
