"""Where each layer lives in the session catalog."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Layout:
    """Schema names of the layers, the table format to write, and whether the KPI tables are replaced in one step, as
    versions (see ``sinks.versions``)."""

    raw: str = "bronze_raw"
    clean: str = "bronze_clean"
    silver: str = "silver_transform"
    mart: str = "gold_mart"
    curated: str = "gold_curated"
    datacube: str = "gold_datacube"
    table_format: str = "parquet"
    versioned: bool = False

    def prefixed(self, prefix: str) -> Layout:
        """The same layout with every schema name prefixed (test runs, several tenants)."""
        names = {f.name: prefix + getattr(self, f.name) for f in fields(self) if f.name not in ("table_format", "versioned")}
        return replace(self, **names)

    @property
    def schemas(self) -> tuple[str, ...]:
        return (self.raw, self.clean, self.silver, self.mart, self.curated, self.datacube)
