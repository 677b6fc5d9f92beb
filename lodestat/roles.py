"""Column roles: which columns are features, which one is the label, which are only carried along."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    features: tuple[str, ...]
    label: str | None = None
    meta: tuple[str, ...] = field(default=())

    def columns(self) -> list[str]:
        return [*self.meta, *([self.label] if self.label else []), *self.features]
