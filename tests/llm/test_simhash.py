"""SimHash near-dedup against brute force."""

import re

import numpy as np
import pytest
import xxhash

from gridloom.llm import simhash
from gridloom.llm.queries import REGISTRY

SPACE = re.compile("[\x20\x09-\x0d]+")


def plain_fingerprint(text, size=4):
    words = [w for w in SPACE.split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    runs = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), 42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, k):
    """id, fingerprint, component of (id, fingerprint) rows over all pairs."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= k:
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for i, f in rows:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return sorted(((i, f, least.get(find(f))) for i, f in rows), key=str)


def cloud(seed, n, k):
    """Fingerprints in clusters, chains and alone."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(n):
        f = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 60))):
            out.append(f)
            base = f if rng.random() < 0.3 else out[-1]
            f = base
            for b in rng.choice(64, int(rng.integers(0, 2 * k + 3)), replace=False):
                f ^= 1 << int(b)
    return out


@pytest.mark.parametrize("seed,k", [(1, 4), (2, 4), (3, 3), (4, 7)])
def test_links_join_what_all_links_join(spark, seed, k):
    fps = cloud(seed, 30, k)
    rows = list(enumerate(fps))
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in set(fps)], "fp long").repartition(3)
    got = {r.node: r.root for r in simhash.components(simhash.links(nodes, k)).collect()}
    comp = lambda f: got.get(s := int(np.uint64(f).view(np.int64)), s)
    want = {f: c for _, f, c in plain_components(rows, k)}
    groups = lambda key: sorted(sorted(f for f in set(fps) if key(f) == c) for c in {key(f) for f in fps})
    assert groups(comp) == groups(lambda f: want[f])


def test_large_bucket_forest():
    fps = np.unique(np.array([f & 0xFFFFF for f in cloud(5, 40, 4)], np.uint64))
    a, b = simhash.forest(fps, 4)
    assert (np.bitwise_count(fps[a] ^ fps[b]) <= 4).all()
    label = simhash.joined(a, b, len(fps))
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None]) <= 4)
    assert (label == simhash.joined(x, y, len(fps))).all()


def test_rows_of_all_kinds(spark):
    t = " ".join(f"w{i}" for i in range(200))
    rows = [(5, t), (3, t.upper()), (9, t + " more"), (4, ""), (None, None), (2, None), (7, "One two"), (7, "One two"), (8, "one\x0btwo"), (None, "lone words stand here alone"), (6, "\x85x y")]
    df = spark.createDataFrame([(i, x, 1) for i, x in rows], "doc_id long, text string, fp int")
    got = sorted(((r.id, r.fp % 2**64, r.component) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == plain_components([(i, plain_fingerprint(x)) for i, x in rows], 4)
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_on_driver_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in REGISTRY.queries["op4_simhash"](spark, sf).collect())
    assert got == sorted((i, f"{f:016x}", c) for i, f, c in plain_components(rows, 4))


def test_few_links_take_few_tasks(spark):
    """However many shuffle partitions there are; and links that are not few still go the shuffled way to the same components."""
    links = [(i, i + 1) for i in range(1, 40) if i % 10] + [(90, 7), (90, 33)]
    own = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in own}
    want = {i: 1 if i <= 10 or 31 <= i <= 40 or i == 90 else i - (i - 1) % 10 for i in [*range(1, 41), 90]}
    want = {i: r for i, r in want.items() if i != r}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup("few links", "few links")
        found = simhash.components(spark.createDataFrame(links, "a long, b long"))
        assert {r.node: r.root for r in found.collect()} == want
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("few links") for s in tracker.getJobInfo(j).stageIds}
        wide = [s for s in stages if (i := tracker.getStageInfo(s)) and i.numTasks >= 61]
        assert found.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism and len(wide) <= 3  # only the links as they come: dealt, written, summed
        most, simhash.SMALL_BYTES = simhash.SMALL_BYTES, 0
        try:
            assert {r.node: r.root for r in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()} == want
        finally:
            simhash.SMALL_BYTES = most
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
