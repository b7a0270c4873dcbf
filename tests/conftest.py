import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from chartlake.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    # Tests set their own shared folder (the cluster would name one).
    if not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chartlake-test-"))
    yield s


@pytest.fixture
def tmp_dir(spark):
    """A fresh folder under the session's shared folder."""
    import uuid
    from chartlake.session import shared_dir
    d = f"{shared_dir(spark)}/tests/{uuid.uuid4().hex[:12]}"
    os.makedirs(d)
    return d


def rows(df, *cols):
    """Sorted list of tuples (of ``cols`` or all columns)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=repr)
