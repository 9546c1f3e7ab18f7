"""Folder layout of a warehouse."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """All tables live below ``root``; pages land below ``landing``, by default ``<root>/landing``."""

    root: str
    landing_root: str | None = None

    @property
    def landing(self) -> str:
        return self.landing_root or f"{self.root}/landing"

    @property
    def archive(self) -> str:
        """Where read pages move if they are archived. Beside the landing folder: a file source may not archive into itself."""
        return f"{self.root}/archive"

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}_raw"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"
