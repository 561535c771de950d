import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from geolake.session import get_spark
    warehouse = tempfile.mkdtemp(prefix="geolake-wh-")
    s = get_spark("local[4]", app="geolake-tests", shuffle_partitions=4,
                  extra={"spark.sql.warehouse.dir": warehouse,
                         "spark.driver.extraJavaOptions": f"-Dderby.system.home={warehouse}"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="geolake-ckpt-"))
    yield s
    s.stop()
