"""Folder layout of one deployment."""

from dataclasses import dataclass

from stillwell.sources.specs import SourceSpec


@dataclass(frozen=True)
class Zone:
    """Raw tables at ``<root>/<dataset>/<table>``; target and progress beside them."""

    root: str

    def raw(self, spec: SourceSpec) -> str:
        return f"{self.root}/{spec.dataset}/{spec.readings_table}"

    def stations(self, spec: SourceSpec) -> str | None:
        return f"{self.root}/{spec.dataset}/{spec.stations_table}" if spec.stations_table else None

    def backfill(self, spec: SourceSpec) -> str:
        return f"{self.root}/{spec.dataset}/{spec.backfill_table}"

    def entity(self, name: str) -> str:
        return f"{self.root}/target/{name}"

    @property
    def observations(self) -> str:
        return f"{self.root}/target/observation"

    def progress(self, scope: str) -> str:
        """Progress of one scope; each scope has one writer at a time."""
        return f"{self.root}/progress/{scope}"
