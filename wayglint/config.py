"""Tunables, and their loading from a mapping with templated paths."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path
from string import Formatter

# Fixed values.
EARTH_RADIUS_M = 6_371_008.0
ROAD_CLASSES = {
    "motorway": ("motorway", "motorway_link"),
    "trunk": ("trunk", "trunk_link"),
    "primary": ("primary", "primary_link"),
    "secondary": ("secondary", "secondary_link"),
    "tertiary": ("tertiary", "tertiary_link"),
    "unclassified": ("unclassified",),
    "residential": ("residential",),
}


@dataclass(frozen=True)
class Settings:
    """What the plans need to know; distances in metres."""

    zoom: int = 8
    fine_zoom: int = 14
    urban_spacing: float = 100.0
    rural_spacing: float = 1000.0
    match_distance: float = 30.0
    near_band: float = 10.0
    far_band: float = 20.0
    segment_distance: float = 15.0
    vote_distance: float = 10.0
    sigma: float = 1.0
    least_score: float = 0.8
    decision: float = 0.3
    chunk_rows: int = 500_000
    road_classes: dict = field(default_factory=lambda: dict(ROAD_CLASSES))
    paths: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        """A configured path, its ``{other}`` fields filled with other paths."""
        done, text = set(), self.paths[name]
        while names := [n for _, n, _, _ in Formatter().parse(text) if n]:
            if loop := done.intersection(names):
                raise ValueError(f"paths refer to each other: {sorted(loop)}")
            done.update(names)
            text = text.format_map({n: self.paths[n] for n in names})
        return text


def load_settings(source: str | Path | dict) -> Settings:
    """Settings from a mapping or a JSON file (YAML too, where PyYAML is installed); unknown keys are errors."""
    if not isinstance(source, dict):
        text = Path(source).read_text()
        if str(source).endswith((".yaml", ".yml")):
            import yaml

            source = yaml.safe_load(text)
        else:
            source = json.loads(text)
    if odd := set(source) - {f.name for f in fields(Settings)}:
        raise ValueError(f"unknown settings: {sorted(odd)}")
    return replace(Settings(), **source)
