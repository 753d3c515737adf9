import pytest

from entitymill.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", cpus="4", spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
        spark__driver__memory="4g",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
