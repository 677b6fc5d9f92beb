"""The named queries survive a missing optional library or a missing training-data folder."""

import builtins
import importlib
import sys


def test_queries_without_optional_library(monkeypatch):
    import __spark_entry__

    real = builtins.__import__

    def blocked(name, *args, **kwargs):
        if name == "public_tokenizers" or name.startswith("public_tokenizers."):
            raise ModuleNotFoundError(f"No module named '{name}'", name=name)
        return real(name, *args, **kwargs)

    for name in [m for m in sys.modules if m.startswith("lodestat.llm.registered") or m == "public_tokenizers"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(builtins, "__import__", blocked)
    found = importlib.reload(__spark_entry__).queries()
    assert len(found) >= 221 and not any(n.startswith("op") for n in found)
    assert set(__spark_entry__.oracle_sql()) <= set(found)
