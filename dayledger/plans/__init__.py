"""The jobs: landing, rebuild of the published tables."""

from dayledger.plans.landing import every_arrival, every_loaded, initial_load, land, periodic_update
from dayledger.plans.rebuild import rebuild_all, rebuild_delays, rebuild_weather

__all__ = [
    "every_arrival",
    "every_loaded",
    "initial_load",
    "land",
    "periodic_update",
    "rebuild_all",
    "rebuild_delays",
    "rebuild_weather",
]
