"""The coverage map and the README name only queries and functions that exist."""

import importlib
import os
import re

from ledgerline.catalog import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _read(name):
    with open(os.path.join(ROOT, name)) as f:
        return f.read()


def test_module_function_references_exist():
    text = _read("COVERAGE.md")
    refs = re.findall(r"`((?:operators|plans|functions|sources)/\w+)\.py: ([\w /,]+)`", text)
    assert refs
    for module, names in refs:
        mod = importlib.import_module("ledgerline." + module.replace("/", "."))
        for name in re.split(r"[ ,/]+", names.strip()):
            if name:
                assert hasattr(mod, name), f"{module}.{name}"


def test_readme_query_table_lists_registered_queries():
    text = _read("README.md")
    table = text[text.index("## Registered queries"):text.index("## Designed for scale")]
    cited = set()
    for row in table.splitlines():
        if row.startswith("| `"):
            cited |= set(re.findall(r"`(\w+)`", row.split("|")[1]))
    assert cited == set(QUERIES)
