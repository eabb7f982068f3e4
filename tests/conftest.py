import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from shelfscope.session import get_spark
    yield get_spark("tests", cpus="*", shuffle_partitions=8, driver_memory="8g",
                    checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
