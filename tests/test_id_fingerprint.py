"""The fingerprint of many ids in small ranges, and the digest with and without Python's own library."""
import hashlib
import random

from pyspark.sql import functions as F

from cairn.functions import digest
from cairn.operators import control


def test_many_small_ranges_are_few_jobs(spark):
    ids = spark.range(4_000).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"))
    want = hashlib.sha256(b"".join(x.encode() + b"\0" for x in sorted(f"v{i}" for i in range(4_000)))).hexdigest()[:16]
    spark.sparkContext.setJobGroup("fingerprint of ids", "")
    try:
        assert control.backend_fingerprint(ids, held=10).first()[0] == want
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("fingerprint of ids"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert control.RANGES < jobs < 100  # each range is one; 401 ranges before


def test_both_digests(monkeypatch):
    r = random.Random(3)
    for native in (digest._native(), None):
        monkeypatch.setattr(digest, "_native", lambda native=native: native)
        for n in (0, 1, 55, 56, 63, 64, 65, 127, 128, 3_000, digest._STEP + 65):
            data, cut = r.randbytes(n), r.randrange(n + 1)
            assert digest.hexed(digest.taken(digest.taken(digest.start(), data[:cut]), data[cut:])) == hashlib.sha256(data).hexdigest()


def test_a_library_that_answers_otherwise_is_not_used(monkeypatch):
    plain = digest._mixed
    monkeypatch.setattr(digest, "_mixed", lambda words, data: (0,) * 8)
    assert digest._native() is None
    monkeypatch.undo()
    assert digest._native() is None or digest._native()(digest._ROOTS, bytes(64)) == plain(digest._ROOTS, bytes(64))
