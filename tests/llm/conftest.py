import pytest

from mercato.llm.store import ship


@pytest.fixture(autouse=True)
def code_on_executors(request):
    """Workers find the package wherever the tests are started from."""
    if "spark" in request.fixturenames:
        ship(request.getfixturevalue("spark"))
