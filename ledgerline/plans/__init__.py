"""Query plans, by area.  Importing this package fills the registry."""

from importlib import import_module

AREAS = ["quality", "basics", "marts", "series", "forecasts", "experiments", "evaluation", "texts", "models", "segments"]


def load_all() -> None:
    for area in AREAS:
        import_module(f"{__name__}.{area}")
