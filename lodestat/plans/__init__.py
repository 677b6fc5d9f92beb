"""Named queries built from the operators."""

from importlib import import_module

FAMILIES = ("text_queries", "table_queries", "model_queries", "learning_queries")


def load_all() -> None:
    for family in FAMILIES:
        import_module(f"lodestat.plans.{family}")
