import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from odd_rows import ODD, documents  # noqa: E402

from lotledger.llm.nbest_pieces import load_vocabulary  # noqa: E402

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="session")
def vocabulary():
    return load_vocabulary(MODEL)


@pytest.fixture(scope="session")
def odd(spark):
    return documents(spark, ODD).cache()


@pytest.fixture(scope="session")
def none(spark):
    return documents(spark, [])
