from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from quaymark.llm import components, exact_dedup, near_dedup, queries, substring_dedup, vectors
from tests.conftest import SMALL


class Sets:
    def __init__(self, items):
        self.up = {i: i for i in items}

    def root(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


# ---------------------------------------------------------------- exact


def test_a_perfect_hash_is_minimal_and_checked():
    digest = [hashlib.sha256(str(i).encode()).digest() for i in range(5_000)]
    words = exact_dedup._matrix(digest)
    levels, slots = exact_dedup.build(words)
    assert sorted(slots.tolist()) == list(range(5_000))
    assert exact_dedup.look_up(levels, words).tolist() == slots.tolist()
    others = exact_dedup._matrix([hashlib.sha256(b"x%d" % i).digest() for i in range(500)])
    found = exact_dedup.look_up(levels, others)
    assert found.max() < 5_000 and found.min() >= -1


@pytest.mark.parametrize("history", ["doc_id < 7", "false", "true", "doc_id % 2 = 0"])
def test_exact_classes_of_odd_rows(spark, odd, history):
    from pyspark.sql import functions as F

    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    groups = defaultdict(list)
    for key, text in rows:
        groups["".join(c for c in text if c not in " \t\n\x0b\x0c\r")].append((key, len(text)))
    want = defaultdict(list)
    for bare, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0]))[0]
        for key, _ in members:
            want[key].append((keep, len(members), key == keep, hashlib.sha256(bare.encode()).hexdigest()))
    got = defaultdict(list)
    for r in exact_dedup.classes(odd, F.expr(history)).collect():
        got[r.doc_id].append((r.keep_id, r.group_size, r.kept, r.text_sha256))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_exact_distinct_keeps_one_row_of_each(spark, odd, none):
    left = exact_dedup.distinct(odd, exact_dedup.earlier_half(odd))
    assert left.columns == odd.columns
    bare = [(r.text or "").translate(str.maketrans("", "", " \t\n\x0b\x0c\r")) for r in odd.collect()]
    assert left.count() == len(set(bare)) and left.where("doc_id = 3").count() == 0
    assert exact_dedup.distinct(none, exact_dedup.earlier_half(none)).count() == 0


# ---------------------------------------------------------------- passages


def brute_repeats(rows, window=50):
    first, out = {}, {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        mine = set()
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if first.get(run, key) < key:
                gone[i : i + window] = [True] * window
            mine.add(run)
        for run in mine:
            first.setdefault(run, key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[key] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def by_query(frame):
    from pyspark.sql import functions as F

    sha = F.when(F.col("kept").isNull(), F.lower(F.hex("sha"))).otherwise(F.sha2("kept", 256))
    rows = substring_dedup.remove_repeats(frame).select("doc_id", "n_words", "n_removed", sha.alias("s")).collect()
    return {r.doc_id: (r.n_words, r.n_removed, r.s) for r in rows}, len(rows)


def test_repeats_of_the_small_table(spark):
    rows = queries.op5_substring_dedup(spark, SMALL).collect()
    want = brute_repeats([(r.doc_id, r.text) for r in documents(spark).collect()])
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows} == want
    assert any(n for _, n, _ in want.values())


def test_repeats_of_odd_rows(spark, odd, none):
    got, n = by_query(odd)
    want = brute_repeats([(r.doc_id, r.text) for r in odd.where("doc_id IS NOT NULL").collect()])
    assert n == odd.count() and {k: v for k, v in got.items() if k is not None} == want
    assert by_query(none)[1] == 0


def test_repeats_of_shifted_and_nested_passages(spark):
    random = np.random.default_rng(2)
    base = [f"t{i}" for i in random.integers(0, 400, 600)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):  # pieces of one text, of all lengths around a window, at all places
        at, n = int(random.integers(0, 500)), int(random.integers(40, 120))
        rows.append((i, " ".join([f"a{i}", *base[at : at + n], f"b{i}", *base[at + 5 : at + 60]])))
    got, _ = by_query(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got == brute_repeats(rows)


def test_repeats_of_unlike_texts_of_one_id(spark):
    p, q, r = (" ".join(f"{c}{i}" for i in range(60)) for c in "pqr")
    rows = [(1, p), (2, "two words"), (2, f"x {p} y"), (2, q), (2, q), (3, f"{q} z"), (4, p), (4, r), (5, f"{r} z"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(frame).collect())
    assert got == [
        (1, 60, 0), (2, 2, 0), (2, 60, 0), (2, 60, 0), (2, 62, 60), (3, 61, 60), (4, 0, 0), (4, 60, 0), (4, 60, 60), (5, 61, 60)
    ]


def test_windows_and_candidate_texts_move_once(spark, monkeypatch):
    moves, stage = {}, substring_dedup.stage

    def noted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        moves[label] = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
        return stage(df, label)

    monkeypatch.setattr(substring_dedup, "stage", noted)
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # joins as on large tables
    try:
        substring_dedup.remove_repeats(documents(spark))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
    assert len([m for m in moves["passages"] if "high#" in m]) == 1  # and not by digest and shard, then by digest
    assert not [m for m in moves["candidates"] if "sha#" in m]  # equal texts of an id met in the join already
    assert not [m for m in moves["phrases"] if "phrase#" in m]


# ---------------------------------------------------------------- near copies


def brute_classes(rows, width, percent=80):
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        n = min(width, len(words))
        sets[key] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()
    keys, found = sorted(sets), Sets(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                found.join(a, b)
    return {k: (len(sets[k]), found.root(k), found.root(k) == k) for k in keys}


def near(frame, width):
    rows = near_dedup.classes(frame, width).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}, len(rows)


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_of_the_small_table(spark, width):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert near(documents(spark), width)[0] == brute_classes(rows, width)


def test_near_copies_of_odd_rows(spark, odd, none):
    got, n = near(odd, 2)
    want = brute_classes([(r.doc_id, r.text) for r in odd.where("doc_id IS NOT NULL").collect()], 2)
    assert n == odd.count() and {k: v for k, v in got.items() if k is not None} == want
    left = near_dedup.distinct(odd, 2)
    assert left.columns == odd.columns and left.where("doc_id = 2").count() == 0
    assert near(none, 2)[1] == 0


def test_near_copies_in_chains_and_crowds(spark):
    random = np.random.default_rng(4)
    base, rows = [f"c{i}" for i in range(200)], []
    for i in range(40):  # neighbours are near, ends are not
        base = base.copy()
        for at in random.integers(0, 200, 6):
            base[at] = f"x{i}_{at}"
        rows.append((i, " ".join(base)))
    crowd = [f"d{i}" for i in range(120)]
    for i in range(100, 250):
        own = crowd.copy()
        for at in random.integers(0, 120, 5):
            own[at] = f"y{i}_{at}"
        rows.append((i, " ".join(own)))
    got, _ = near(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 2)
    assert got == brute_classes(rows, 2)


@pytest.mark.parametrize("seed", range(4))
def test_components_of_random_graphs(spark, seed):
    random = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in random.integers(0, 120, (90 + 40 * seed, 2))]
    links += [(i, i + 1) for i in range(200, 260)] + [(300, i) for i in range(301, 360)]
    found = Sets({x for link in links for x in link})
    for a, b in links:
        found.join(a, b)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    inner = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: found.root(x) for x in inner}


# ---------------------------------------------------------------- vectors


def test_unlike_texts_of_one_id_keep_their_own_links(spark):
    words = [f"w{i}" for i in range(100)]
    first, second = " ".join(words), " ".join(f"x{i}" for i in range(100))
    near_second = " ".join([f"x{i}" for i in range(98)] + ["other", "end"])
    rows = [(1, first), (1, second), (2, " ".join(words[:98] + ["a", "b"])), (3, near_second), (4, "alone here")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in near_dedup.classes(frame, width=2).collect())
    # both texts of id 1 are in classes of that id; each class has the document that is near to it
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]
    later = spark.createDataFrame([(9 if i == 1 else i, t) for i, t in rows], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_dedup.classes(later, width=2).collect()) == [(2, 2), (3, 3), (4, 4), (9, 2), (9, 3)]


def brute_links(rows, threshold=0.93):
    ids = [r[0] for r in rows]
    links, found = dict.fromkeys(ids, 0), Sets(ids)
    fine = {}
    for key, vector, label in rows:
        if label is not None and vector and all(x is not None and np.isfinite(x) for x in vector) and any(vector):
            fine[key] = (np.array(vector, dtype=float), label)
    for a, (x, la) in fine.items():
        for b, (y, lb) in fine.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
                links[a], links[b] = links[a] + 1, links[b] + 1
                found.join(a, b)
    return {k: (links[k], found.root(k), found.root(k) == k) for k in ids}


def near_vectors(frame):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect()}


VECTORS = "vec_id long, embedding array<float>, label int"


def test_vectors_of_the_small_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op8_embedding_near_dedup(spark, SMALL).collect()}
    assert got == brute_links([tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()])


def test_vectors_of_odd_rows(spark):
    one = [1.0, 0.0, 0.5]
    rows = [
        (1, one, 1), (2, one, 1), (3, [2.0, 0.0, 1.0], 1), (4, one, 2), (5, one, None), (6, None, 1), (7, [], 1), (8, [0.0, 0.0, 0.0], 1),
        (9, [1.0, None, 0.5], 1), (10, [float("nan"), 0.0, 1.0], 1), (11, [float("inf"), 0.0, 1.0], 1), (12, [1.0, 0.0], 1),
        (13, [1e-30, 0.0, 5e-31], 1), (14, [-1.0, 0.0, -0.5], 1), (15, [1.0, -0.0, 0.5], 1), (16, one, None), (17, [0.0, 0.0, 0.0], 1),
    ]
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    assert near_vectors(frame) == brute_links(rows)
    assert near_vectors(frame.where("false")) == {}


def test_unlike_rows_of_one_id_count_by_their_own_vectors(spark):
    from pyspark.sql import functions as F

    one, two, far = [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]
    rows = [(1, one, 1), (1, two, 1), (1, one, None), (2, one, 1), (3, two, 1), (4, far, 1), (4, None, 1), (None, one, 1), (5, far, 2)]
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("other") for c in ("digest", "raw", "rep", "node", "group", "links", "copies")})
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(frame.repartition(3)).collect()), key=str)
    assert got == sorted(
        [(1, 1, 1), (1, 1, 1), (1, 0, 1), (2, 1, 1), (3, 1, 1), (4, 0, 4), (4, 0, 4), (None, 0, None), (5, 0, 5)], key=str
    )


def test_huge_and_tiny_components_link(spark):
    double = "vec_id long, embedding array<double>, label int"
    rows = [(i, [s * x for x in v], 1) for i, (s, v) in enumerate(
        (s, v) for s in (1e200, 1e-200, 1.0, 1e-310) for v in ([1.0, 0.5, 0.25], [1.0, 0.5001, 0.25], [-1.0, 0.5, 0.25]))]
    got = near_vectors(spark.createDataFrame(rows, double))
    assert all(got[i][0] == (3 if i % 3 == 2 else 7) for i, _, _ in rows)
    assert {got[i][1] for i, _, _ in rows} == {0, 2}


def test_dense_groups_and_several_blocks(spark, monkeypatch):
    random = np.random.default_rng(6)
    rows = []
    for i in range(600):
        centre = random.normal(size=16) if i % 40 == 0 else centre  # noqa: F821
        rows.append((i, [float(np.float32(x)) for x in centre + random.normal(size=16) * random.choice([0.05, 0.3, 0.6])], i % 2))
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 64)
    assert near_vectors(spark.createDataFrame(rows, VECTORS).repartition(4)) == brute_links(rows)


def test_quantised_bounds_hold():
    random = np.random.default_rng(7)
    unit = random.normal(size=(200, 24))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    codes, scale, error, held = vectors.quantised(unit)
    estimate = (codes.astype(float) @ codes.T.astype(float)) * scale[:, None] * scale[None, :]
    bound = error[:, None] * held[None, :] + held[:, None] * error[None, :] + error[:, None] * error[None, :]
    assert (np.abs(estimate - unit @ unit.T) <= bound + 1e-12).all()
