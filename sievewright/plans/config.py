"""The default configuration of discovery and classification."""

from __future__ import annotations

from pathlib import Path

# Groups, their categories and their search terms, in order.
DEFAULT = {
    "wikimedia_categories": {
        "estratos": ["Limestone", "Sandstone", "Sedimentary rocks", "Shale", "Breccia", "Stratigraphy", "Siltstone", "Mudstone", "Geological strata", "Strata", "Outcrops", "Sedimentary structures", "Cross-bedding", "Bedding planes", "Rock formations", "Geological folds", "Unconformities", "Badlands", "Road cuts", "Quarries", "Turbidites", "Varves", "Flysch", "Cliffs", "Canyon walls"],
        "plastiglomerado": ["Plastiglomerate"],
        "proxy": ["Slag", "Slag glass", "Volcanic breccia", "Ignimbrite", "Agglomerate (geology)", "Clinker (waste)", "Fulgurites"],
        "legacy_noise": ["Minerals", "Fluorite", "Mineral specimens", "Quartz", "Calcite", "Rocks"],
    },
    "search_terms": {
        "estratos": ["sedimentary strata outcrop", "stratified rock layers", "laminated sandstone", "geological cross section rock", "bedded limestone cliff"],
        "plastiglomerado": ["plastiglomerate", "plastic conglomerate beach", "pyroplastic rock", "anthropocene plastic sediment", "Kamilo Beach plastic"],
        "proxy": ["industrial slag texture", "fused waste rock", "volcanic breccia inclusions", "clinker fused material"],
    },
}


def load(path: str | None = None) -> dict:
    """The configuration of a YAML or JSON file, or the default."""
    if path is None:
        return DEFAULT
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml
    except ImportError:
        import json

        return json.loads(text)
    return yaml.safe_load(text) or {}
