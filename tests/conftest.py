import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tapline import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", app_name="tapline-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture
def out(spark):
    """Fresh output paths under the session's shared folder, removed after the test."""
    made = []

    def make(label="out"):
        path = scratch_path(spark, label)
        made.append(path)
        return path

    yield make
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in made:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


BOOKINGS_SQL = """
SELECT booking_id, room_code, attendees, cancelled, CAST(amount AS DECIMAL(12,2)) AS amount
FROM VALUES ('B001', 'A-101', 10, false, 123.45), ('B002', 'A-101', 15, false, 456.78),
            ('B003', 'B-202', 4, true, NULL) AS t(booking_id, room_code, attendees, cancelled, amount)
"""


@pytest.fixture
def bookings(spark):
    return spark.sql(BOOKINGS_SQL)
