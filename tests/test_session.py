"""Scratch space comes from the cluster's shared ``spark.checkpoint.dir``."""

import os
import subprocess
import sys
import tempfile
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import os, sys, tempfile
    sys.path.insert(0, {root!r})
    from loadwright import session
    from loadwright.operators.joins import touched_values

    def no_local_temp(*a, **k):
        raise AssertionError("a local temporary folder was created")

    spark = session.build_session("local[2]", 2, extra={{"spark.checkpoint.dir": {shared!r}}})
    tempfile.mkdtemp = no_local_temp  # from here on: the library's own folders
    assert session.checkpoint_root(spark).startswith("file:" + {shared!r}) or \\
        session.checkpoint_root(spark).startswith({shared!r})
    assert {shared!r} in session.scratch_path(spark, "x")
    vals, n = touched_values(spark.range(10).selectExpr("id % 3 AS p"), "p")
    assert n == 3
    written = [os.path.join(d, f) for d, _, fs in os.walk({shared!r}) for f in fs]
    assert written, "checkpoint wrote nothing under the shared folder"
    print("OK")
    """
)


def test_scratch_and_checkpoints_use_configured_shared_folder():
    shared = tempfile.mkdtemp(prefix="shared-ckpt-")
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, shared=shared)],
        capture_output=True, text=True, timeout=300,
    )
    assert out.returncode == 0 and "OK" in out.stdout, out.stderr[-3000:]
