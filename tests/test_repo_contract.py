"""Repository hygiene: the package imports, text files carry no merge
markers or secret-looking tokens."""

import importlib
import os
import pkgutil
import re

from conftest import ROOT

TEXT = (".py", ".md", ".toml", ".txt")
SECRET = re.compile(r"(AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|-----BEGIN [A-Z ]*PRIVATE KEY-----|xox[bp]-[0-9A-Za-z-]{10,})")
MARKERS = re.compile(r"^(<{7}|={7}|>{7})( |$)", re.M)


def _files():
    for root, dirs, files in os.walk(ROOT):
        dirs[:] = [d for d in dirs if not d.startswith(".") and d != "__pycache__"]
        for f in files:
            if f.endswith(TEXT):
                yield os.path.join(root, f)


def test_every_module_imports():
    import tripflow
    for m in pkgutil.walk_packages(tripflow.__path__, "tripflow."):
        importlib.import_module(m.name)


def test_no_merge_markers_or_secrets():
    for path in _files():
        text = open(path, encoding="utf-8", errors="replace").read()
        assert not MARKERS.search(text), path
        assert not SECRET.search(text), path
