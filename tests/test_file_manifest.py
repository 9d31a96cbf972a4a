"""The registered manifest over real files against hashlib."""

import hashlib
import os

from hopweave.plans.registry import load_all

SF = "/root/testdata/sf0.001"


def test_manifest_and_verify_read_the_files(spark):
    queries, _ = load_all()
    got = {r.path: (r.size, r.sha256, r.md5) for r in queries["pub_manifest_files"](spark, SF).collect()}
    want = {}
    for folder, _, names in os.walk(SF):
        for name in names:
            with open(os.path.join(folder, name), "rb") as f:
                data = f.read()
            want[os.path.relpath(os.path.join(folder, name), SF)] = (len(data), hashlib.sha256(data).hexdigest(), hashlib.md5(data).hexdigest())
    assert got == want and want
    assert {r.status for r in queries["pub_verify_files"](spark, SF).collect()} == {"ok"}
