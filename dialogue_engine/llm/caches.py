"""Things a Python worker may keep from one task to the next."""

import sys
from types import SimpleNamespace


def process_cache(name: str) -> dict:
    """A dict that lives as long as the Python process. Spark uses a worker for many tasks; the
    functions it runs are sent anew for each, so their own globals do not last."""
    key = f"_dialogue_engine_{name}"
    return sys.modules.setdefault(key, SimpleNamespace(held={})).held
