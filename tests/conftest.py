from __future__ import annotations

import pytest

from masthead.session import local_session, ship_package


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "*",
        "masthead-tests",
        **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.ui.showConsoleProgress": "false", "spark.sql.maxMetadataStringLength": "1000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
