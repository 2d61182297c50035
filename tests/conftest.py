from __future__ import annotations

import pytest

from tests.compare import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    """A fresh folder as a path Spark takes."""
    return str(tmp_path)


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL
