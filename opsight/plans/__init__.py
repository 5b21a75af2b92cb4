"""Named queries over the driver tables."""

from importlib import import_module

AREAS = (
    "scalars", "windows", "joins", "detection", "decisions", "metrics", "text", "governance", "streams", "models",
)


def load_all() -> None:
    for area in AREAS:
        import_module(f"opsight.plans.{area}")
