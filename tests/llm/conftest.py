import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT)]
FOLDER = "/root/testdata/sf0.001"

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, key int, n_words string, hash double, component int"


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-checkpoint-"))


@pytest.fixture(scope="session")
def table(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def texts(table):
    return {r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank, very long and repeated texts, ties, and columns with clashing names."""
    passage = " ".join(f"word{i % 97}x{i}" for i in range(70))
    other = " ".join(f"ander{i}" for i in range(80))
    texts = [
        "", " \n\t ", "a", "One two three four", "one two  THREE\nfour five six seven", "été naïve façon garçon où déjà vu",
        passage, f"{other} {passage} tail of it", f"Head. {passage.upper()}", "don't we'll they've I'm 'scare' it's 12345 x's",
        "MIT License and the Apache\nLicense; general public license!", "mit license " * 40, "<|endoftext|> <|startoftext|> a<|endoftext|>b",
        "".join(chr(97 + i % 26) for i in range(120_000)), "\n".join(f"line {i} of a very long text, said {i * 7919 % 10007}" for i in range(12_000)),
        "日本語のテキスト。" * 50, "🙂🙃    x́y", "\x1c\x1d a\x85b",
    ]
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], len(t), "x", 1, "y", 0.5, 2) for i, t in enumerate(texts)]
    rows += [(100, None, None, None, None, None, None, None, None, None), (101, None, "en", "a", 0, "x", 1, "y", 0.5, 2)]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
