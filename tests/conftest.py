import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sequor.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="sequor-test-")


def write_micro_csv(path, blank_a=True, bad_b=True):
    """FIXTURES micro golden: ten rows, a = 0..9 (blank at row 5), b = 0, 10 .. 90 ('bad' at row 7)."""
    lines = ["s_ts,a,b"]
    for i in range(10):
        a = "" if (blank_a and i == 4) else str(i)
        b = "bad" if (bad_b and i == 6) else str(i * 10)
        lines.append(f"2020-05-13 00:00:{i:02d},{a},{b}")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path
