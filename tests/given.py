"""Where the tests' given data lie. Not in conftest: a folder below has one too."""

import os

import pytest

GOLDEN = os.path.join(os.path.dirname(os.path.abspath(__file__)), "golden")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def golden(name):
    path = os.path.join(GOLDEN, name)
    if not os.path.exists(path):
        pytest.skip("published files not available")
    return path
