import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tests_llm_data import SCHEMA, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, "en", "s", None, 1, "d", "n", "p", "l", "r", "s") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    public_tokenizers = pytest.importorskip("public_tokenizers")
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(vocabulary):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)
