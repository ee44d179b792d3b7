import pandas as pd
import pytest

from ..conftest import SF_SMALL


class Tables:
    """Whole tables as pandas frames, for the brute-force versions."""

    def __init__(self, path):
        self.path = path

    def __call__(self, name):
        return pd.read_parquet(f"{self.path}/{name}.parquet")


@pytest.fixture(scope="session")
def tables():
    return Tables(SF_SMALL)
