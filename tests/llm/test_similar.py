"""Near duplicates by exact similarity against all pairs compared one by one."""

import random

import numpy as np
import pyarrow as pa

import corpus_pipeline as cp
from gridloom.llm import blobs, similar
from tests.llm.test_simhash import plain_components, plain_fingerprint


def shingles(text, size=5):
    words = (text or "").encode().split()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def plain_removed(docs, share=0.8):
    """Ids that are not the smallest of their component, over all pairs."""
    own, root = [(i, shingles(t)) for i, t in docs], {i: i for i, _ in docs}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(own):
        for j, b in own[:k]:
            if a == b or len(a & b) >= share * len(a | b) - 1e-12:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i for i, _ in docs if find(i) != i}


def made(seed=3):
    """Texts of many lengths and their copies with some words changed, a passage in many, one large group of near copies."""
    rng = random.Random(seed)
    words = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for n in [1, 4, 5, 6, 9, 30, 100, 300] * 6:
        base = words(n)
        texts.append(base)
        for changed in (0, 1, n // 60, n // 40, n // 25):
            copy = list(base)
            for _ in range(changed):
                copy[rng.randrange(n)] = "changed"
            texts.append(copy)
    passage = words(60)
    texts += [passage + words(40) for _ in range(50)]
    base = words(200)
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(200)] = f"x{rng.randrange(99)}"
        texts.append(copy)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(9001, ""), (9002, None)]


def test_near_dedup_removes_just_what_similarity_joins(spark):
    docs = made()
    want = plain_removed(docs)
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    left = {r.doc_id for r in cp.near_dedup(spark, frame, "").collect()}
    assert {i for i, _ in docs} - left == want
    by_bits = {i for i, _, c in plain_components([(i, plain_fingerprint(t or "", 5)) for i, t in docs], cp.NEAR_BITS) if i != c}
    assert want - by_bits  # pairs at 0.8 that SimHash alone does not join


def test_near_dedup_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = sorted((r.doc_id, r.text) for r in docs.collect())
    left = {r.doc_id for r in cp.near_dedup(spark, docs, sf).collect()}
    assert {i for i, _ in own} - left == plain_removed(own)


def test_filters_lose_no_similar_pair():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 9, 10, 57, 400, 3000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
            gone = int(rng.integers(0, n // 4 + 1))
            b = np.unique(np.append(rng.permutation(a)[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), np.uint64)))
            if similar.jaccard(a, b):
                assert set(a[: similar.prefix(len(a))]) & set(b[: similar.prefix(len(b))])
                x, y = sorted((a, b), key=len)
                wide = [similar.parities(x), similar.parities(y)]
                assert similar.may_be(len(x), wide[0], len(y), wide[1])
                bits = np.stack([similar.folded(w, similar.BITS // 8) for w in wide]).view("<u8")
                assert len(similar.close(np.zeros(2, np.uint64), np.array([len(x), len(y)]), np.arange(2), bits, np.arange(2))[0]) == 1


def test_dealt_sets_are_made_a_bounded_part_at_a_time():
    """However many slots there are: each set goes once to each slot of its tokens, and no batch holds the parities of all."""
    rng = np.random.default_rng(1)
    n, each, size = 400, 120, 1024
    tokens = rng.integers(0, 1 << 62, (n, each))
    wide = [rng.bytes(size) for _ in range(n)]
    batch = pa.record_batch([pa.array(range(n), pa.int64()), pa.array([each * 5] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(wide), pa.array(tokens.tolist(), pa.list_(pa.int64()))], ["sig", "n", "label", "wide", "tokens"])
    made = list(similar._dealt_sets(100_000)(iter([batch])))
    assert max(b.nbytes for b in made) < 2 * similar.DEALT
    got = set()
    for r in pa.Table.from_batches(made).to_pylist():
        token, place = blobs.unpack(r["tokens"], ["<u8", "<i8"])
        sig, _, _, sizes = blobs.unpack(r["sets"], ["<i8"] * 4)
        data, ends = blobs.unpack(r["wide"], ["u1"])[0].tobytes(), np.cumsum(sizes)
        got |= {(int(t), int(sig[p])) for t, p in zip(token, place, strict=True)}
        assert all(data[e - z : e] == wide[s] for s, z, e in zip(sig.tolist(), sizes.tolist(), ends.tolist(), strict=True))
    assert got == {(int(t), k) for k in range(n) for t in tokens[k]}


def near_miss(each=90, seed=4):
    """Copies of one text with two words changed at one of three places: similar at one place, just not so at two, but for one pair that joins two places."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(100)]
    texts = []
    for place, wide in [(10, 2), (40, 2), (70, 2)] * each + [(40, 1), (70, 1)]:
        copy = list(base)
        copy[place : place + wide] = [f"x{rng.randrange(10**6)}" for _ in range(wide)]
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_pairs_that_only_look_alike_do_not_come_out_one_by_one(spark, monkeypatch):
    """Rows grow with a group's size, not with its square, and what is removed stays right, also where a cluster is cut into blocks."""
    docs = near_miss()
    want = plain_removed(docs)
    assert len(want) == len(docs) - 2
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    verified, made = similar.verified, []

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(similar, "verified", counted)
    for bucket in (similar.BUCKET, 20_000):
        monkeypatch.setattr(similar, "BUCKET", bucket)
        made.clear()
        found = similar.near_duplicates(frame).collect()
        assert {r.id for r in found if r.id != r.component} == want
        assert max(made[1:]) <= len(docs), made  # the first are links of SimHash; pairs that look alike are about 2800


def test_sets_of_a_cluster_meet_in_bounded_slots(spark, monkeypatch):
    """Any two of different components, whether the cluster is cut or not; clusters of one component are left out."""
    monkeypatch.setattr(similar, "BUCKET", 60 * 1024)
    size = 64  # 1024 bytes a set
    sets = range(1000)
    roots = [(s, 0) for s in range(1, 300)] + [(s, 300) for s in range(301, 330)] + [(s, 900) for s in range(901, 1000)]
    failed = [(s, 0) for s in range(300, 450)] + [(s, 600) for s in range(601, 620)]
    frames = [spark.createDataFrame(rows, schema) for rows, schema in ((failed, "a long, b long"), (roots, "node long, root long"), ([(s, size) for s in sets], "sig long, n long"))]
    label, slots, of = dict(roots), {}, {}
    for r in similar.clusters(*frames).collect():
        assert r.label == label.get(r.sig, r.sig)
        slots.setdefault(r.slot, set()).add(r.sig)
        of.setdefault(r.sig, set()).add(r.slot)
    assert set(of) == {*range(450), *range(600, 620)}
    for group in (range(450), range(600, 620)):
        assert all(of[a] & of[b] for a in group for b in group if label.get(a, a) != label.get(b, b))
    assert max(map(len, slots.values())) <= 200 and len(slots) > 10  # two blocks of 60 or so
    assert sum(map(len, slots.values())) < 450 * 8


def test_forest_joins_what_all_similar_pairs_join():
    """Of small and large clusters, with labels that join some sets before."""
    rng = np.random.default_rng(8)
    hashes, cluster, label = [], [], []
    for c, count in enumerate((2, 9, 32, 33, 400)):
        base = [np.unique(rng.integers(0, 1 << 63, n, np.uint64)) for n in (1, 12, 60, 64, 500)]
        for k in range(count):
            own = base[int(rng.integers(0, 5))]
            gone = int(rng.integers(0, len(own) // 5 + 1))
            hashes.append(np.unique(np.append(rng.permutation(own)[gone:], rng.integers(0, 1 << 63, int(rng.integers(0, len(own) // 9 + 1)), np.uint64))))
            cluster.append(c)
            label.append(1000 * c + min(k, int(rng.integers(0, count))))
    cluster, label = np.array(cluster), np.array(label)

    def parts(pairs):
        root = {x: x for x in label.tolist()}
        for i, j in pairs:
            a, b = root[int(label[i])], root[int(label[j])]
            root = {x: a if r == b else r for x, r in root.items()}
        return sorted(sorted(x for x in root if root[x] == r) for r in set(root.values()))

    every = [(i, j) for i in range(len(hashes)) for j in range(i) if cluster[i] == cluster[j] and label[i] != label[j] and similar.jaccard(hashes[i], hashes[j])]
    found = list(zip(*(x.tolist() for x in similar.forest(cluster, label, hashes)), strict=True))
    assert parts(found) == parts(every) and {tuple(sorted(p)) for p in found} <= {tuple(sorted(p)) for p in every}
    large = cluster == 4
    assert 0 < sum(large[i] for i, _ in found) < len(set(label[large].tolist())) < sum(large[i] for i, _ in every)
