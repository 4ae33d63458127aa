import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from emberflux.session import local_session

    spark = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.default.parallelism": "4"})
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return spark
