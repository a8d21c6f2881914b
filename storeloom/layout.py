"""Where the tables of each layer live."""

from dataclasses import dataclass

LAYERS = ("sources", "bronze", "silver", "gold", "serving", "ml")


@dataclass(frozen=True)
class Layout:
    """``<root>/<layer>/<table>``; the root may be any Hadoop file system."""

    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def export(self, layer: str, table: str, form: str) -> str:
        """Path of a CSV or JSON copy beside the Parquet table."""
        return f"{self.path(layer, table)}.{form}"
