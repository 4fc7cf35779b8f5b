"""Named queries over the test tables, one module per operator family."""

import importlib
import pkgutil


def load_all():
    """Import every plan module and return the filled registry."""
    for m in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{m.name}")
    return importlib.import_module(f"{__name__}.registry")
