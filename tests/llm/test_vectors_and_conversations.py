"""Embedding operators and conversation repair against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from prflow.llm import conversations, near_vectors, whitening
from prflow.llm.queries import damaged

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int"


# -- near-duplicate vectors -------------------------------------------------


def near(rng, vector, cosine):
    noise = rng.standard_normal(len(vector))
    vector = np.array(vector)
    noise -= noise @ vector / (vector @ vector) * vector
    noise *= np.linalg.norm(vector) / np.linalg.norm(noise)
    return cosine * vector + np.sqrt(1 - cosine**2) * noise


def vector_rows(seed=3, dimension=64):
    rng = np.random.default_rng(seed)
    rows, n = [], 0

    def add(vector, label):
        nonlocal n
        rows.append((n, [float(np.float32(c)) for c in vector], label))
        n += 1

    for label in range(4):
        for _ in range(120):
            add(rng.standard_normal(dimension), label)
    for _ in range(40):  # chains near the threshold
        start = rng.standard_normal(dimension)
        for cosine in (0.9815, 0.985, 0.975, 0.9801):
            add(start, 1)
            start = near(rng, start, cosine)
    hot = rng.standard_normal(dimension)
    for _ in range(150):  # a large group of near copies, others of one vector
        add(near(rng, hot, 0.997), 2)
    for _ in range(60):
        add(hot, 2)
    add(2.5 * hot, 2)
    add(hot, 3)
    add(hot, None)
    return rows


def brute_vectors(rows, similar=0.98):
    """vec_id -> (links, component, kept) with ids that are all different."""
    links, parent = defaultdict(int), {r[0]: r[0] for r in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    groups = defaultdict(list)
    for r in rows:
        ok = r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])
        if ok:
            groups[r[2], len(r[1])].append(r)
    for members in groups.values():
        x = np.array([m[1] for m in members])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= similar, 1))):
            a, b = members[i][0], members[j][0]
            links[a], links[b] = links[a] + 1, links[b] + 1
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {r[0]: (links[r[0]], find(r[0]), find(r[0]) == r[0]) for r in rows}


@pytest.mark.parametrize("block", [16, 1024])
def test_near_vectors_equal_brute_force(spark, block):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS).withColumn("row", F.lit("clashes")).withColumn("h1", F.lit(1))
    found = near_vectors.near_vectors(frame, recall=0.99999, block=block).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert len(found) == len(rows) and got == brute_vectors(rows)


def test_near_vectors_define_odd_rows(spark):
    a, b = [1.0, 2.0, 0.0], [1.0, 2.0, 0.01]
    rows = [
        (1, a, 1), (1, a, 1), (2, b, 1), (None, a, 1), (None, [0.0, 0.0, 1.0], 1), (3, [0.0, -0.0, 0.0], 1),
        (4, [0.0, 0.0, 0.0], 1), (5, None, 1), (6, [], 1), (7, [1.0, None, 0.0], 1), (8, [1.0, NAN, 0.0], 1),
        (9, [1.0, INF, 0.0], 1), (10, a, None), (11, a, None), (12, a, 2), (13, [1.0, 2.0], 1), (14, [1.0, 2.0], 1),
        (15, [1e-30, 2e-30, 0.0], 1), (16, [1e38, 2e38, 0.0], 1),
    ]
    found = near_vectors.near_vectors(spark.createDataFrame(rows, VECTORS), recall=0.99999).collect()
    got = sorted((r.vec_id is None, r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in found)
    linked = [(False, 1, 5, 1, True)] * 2 + [(False, 2, 5, 1, False)]
    alone = [(False, i, 0, i, True) for i in range(3, 13)]
    short = [(False, 13, 1, 13, True), (False, 14, 1, 13, False)]
    scaled = [(False, 15, 5, 1, False), (False, 16, 5, 1, False)]
    assert got[:17] == sorted(linked + alone + short + scaled)
    assert sorted(got[17:], key=str) == sorted([(True, 0, 5, 1, False), (True, 0, 0, None, True)], key=str)
    empty = near_vectors.near_vectors(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns == ["vec_id", "label", "n_links", "component_id", "kept"]


def test_hashing_reaches_its_recall_at_the_threshold():
    rng = np.random.default_rng(9)
    for largest, dimension in ((1_000, 64), (10**7, 64), (10**5, 300)):
        hashing = near_vectors.plan_hashing(largest, dimension, 0.98)
        a = near_vectors._unit(rng.standard_normal((1500, dimension)))
        b = near_vectors._unit(np.array([near(rng, x, 0.98) for x in a]))
        met = np.zeros(len(a), bool)
        for place in range(hashing.tables):
            x, y = near_vectors.codes(a, place, hashing), near_vectors.codes(b, place, hashing)
            met |= (x[:, :1] == y).any(1) | (y[:, :1] == x).any(1)
        assert met.mean() >= 0.99


# -- whitening ------------------------------------------------------------------


def brute_white(rows, k=8):
    x = np.floor(1024 * np.array(rows, float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    return ((n * x - sums) ** 2).sum(1), centred @ vectors / np.sqrt(values), values / np.trace(covariance)


def test_whitening_equals_eigenvectors(spark):
    rng = np.random.default_rng(5)
    mixed = rng.standard_normal((700, 24)) @ rng.standard_normal((24, 24)) + 3
    rows = [(i, [float(np.float32(c)) for c in x], 0) for i, x in enumerate(mixed)]
    odd = [(900, None, 0), (901, [], 0), (902, [1.0] * 5, 0), (903, [NAN] * 24, 0), (904, [1.0] * 23 + [None], 0), (905, [1e30] * 24, 0)]
    repeated = [(None, rows[3][1], 0), rows[4]]
    counted = rows + repeated
    frame = spark.createDataFrame(counted + odd, VECTORS).withColumn("vector", F.lit("clashes"))
    found = whitening.whiten(frame).collect()
    far, white, explained = brute_white([r[1] for r in counted])
    assert len(found) == 8 * len(counted)
    by_id = defaultdict(dict)
    for r in found:
        by_id[r.vec_id][r.component] = r
    for i in range(len(rows)):
        mine = by_id[i]
        assert sorted(mine) == list(range(1, 9)) and int(mine[1].deviation) == far[i]
        for j in range(8):
            sign = np.sign(by_id[0][j + 1].whitened * white[0, j])
            assert mine[j + 1].whitened == pytest.approx(sign * white[i, j], abs=1e-9)
            assert mine[j + 1].explained == pytest.approx(explained[j], rel=1e-9)
    assert {r.n for r in found} == {len(counted)} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-9


def test_whitening_of_few_or_equal_vectors(spark):
    def rows(vectors):
        return whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], VECTORS)).collect()

    assert rows([]) == [] and rows([[1.0, 2.0]]) == [] and rows([[1.0, 2.0]] * 9) == []
    line = rows([[float(i), 2.0 * i] for i in range(10)])
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)
    large = rows([[2e6 * (i % 7), 0.1 * i, 5.0] for i in range(60)])
    assert {r.component for r in large} == {1, 2} and large[0].identity_error < 1e-6


def test_inertia_counts_and_slicing():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 30):
        for _ in range(20):
            a = rng.integers(-3, 4, (n, n)).astype(float)
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for shift in (-4.3, -0.5, 0.013, 2.71):
                assert whitening.eigenvalues_above(a, shift) == (values > shift).sum()
    turned, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    values = np.array([9, 9, 9, 5, 5 - 1e-9, 5 - 2e-9, 2, 1, 1, 0.5, 0, 0])
    basis = whitening.leading(turned @ np.diag(values) @ turned.T, 12)
    assert basis.values == pytest.approx(values[:10], abs=1e-12)
    assert np.abs(basis.vectors.T @ basis.vectors - np.eye(10)).max() < 1e-12


# -- conversations --------------------------------------------------------------


def cheapest(rows):
    """rows of (role, text, fault): the cheapest script by a search over
    (row, state) that orders whole scripts, and the repaired lines."""
    heap, best = [(0, "", 0, "", ())], set()
    while heap:
        cost, script, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, script, lines
        if (at, state) in best:
            continue
        best.add((at, state))
        follow = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[follow]
        heapq.heappush(heap, (cost + 3, script + "I", at, follow, (*lines, name + ":")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, script + "D", at + 1, state, lines))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + 3 + more, script + "R", at + 1, follow, (*lines, f"{name}:{text}")))
                if role[:1] == follow or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, script + "K", at + 1, role[:1], (*lines, f"{role}:{text}")))


def brute_repair(rows):
    """rows of one conversation: (turn, role, text) after damage."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faulty, counts = set(), [], defaultdict(int)
    for _, role, text in rows:
        rest = text.rstrip(conversations.BLANKS)
        fault = "blank" if not rest else "duplicate" if (role, text) in seen else "truncated" if rest[-1] not in ".!?" else ""
        seen.add((role, text))
        counts[fault] += 1
        faulty.append((role, text, fault))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    turns = [r[0] for r in rows if r[0] is not None]
    cost, script, lines = cheapest(faulty)
    return {
        "n_turns": len(rows), "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "blank": counts["blank"], "duplicate": counts["duplicate"], "truncated": counts["truncated"],
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "cost": cost, "audit": script,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), "lines": list(lines),
    }


def made_conversations(n=400, seed=4):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "s", "umpire"]
    texts = ["One.", "Two!", "Three", "", " \n\t", None, "Fünf? ", "Six.\n", "a:b\nuser:c.", "."]
    rows = []
    for conv in range(n):
        for at in range(rng.randint(1, 9)):
            turn = rng.choice([at, at, at, at + 2, None, 2])
            rows.append((conv, turn, rng.choice(roles[: rng.choice([3, 10])]), rng.choice(texts)))
    return rows + [(None, 0, "user", "Lone."), (None, 1, "assistant", "Yes.")]


CONV = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("packed", [8, 1 << 20])
def test_repair_equals_brute_force(spark, monkeypatch, packed):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = made_conversations()
        frame = spark.createDataFrame(rows, CONV).withColumn("fault", F.lit("clashes")).withColumn("present", F.lit(0))
        monkeypatch.setattr(conversations, "PACKED", packed)
        found = {r.conv_id: r.asDict() for r in conversations.repair(frame).collect()}
        turned = defaultdict(list)
        for r in conversations.repaired_turns(frame).orderBy("conv_id", "step").collect():
            turned[r.conv_id].append(r)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by_conv = defaultdict(list)
    for conv, *row in rows:
        by_conv[conv].append(row)
    assert set(found) == set(by_conv)
    for conv, mine in by_conv.items():
        expected = brute_repair(mine)
        lines = expected.pop("lines")
        roles = found[conv].pop("roles")
        assert {**expected, "conv_id": conv} == found[conv]
        assert [f"{r.role}:{r.text}" for r in turned[conv]] == lines
        assert "".join(r.role[:1] for r in turned[conv]) == roles


def test_long_conversations_match_brute_force_in_packed_blocks():
    rng = random.Random(6)
    for size in (50, 3000):
        rows = [(rng.choice(["user", "assistant", "system"]), f"{i}.", rng.choice(["", "", "truncated", "blank", "duplicate"])) for i in range(size)]
        kinds = {"": conversations.FINE, "truncated": conversations.CUT, "blank": conversations.BLANK, "duplicate": conversations.DUPLICATE}
        carried = conversations._Conversation()
        conversations.PACKED, before = 64, conversations.PACKED
        try:
            for at, (role, text, fault) in enumerate(rows):
                carried.turn(at, role, text, kinds[fault])
            got = carried.result()
        finally:
            conversations.PACKED = before
        cost, script, lines = cheapest(rows)
        assert (got[6], got[7], got[9]) == (cost, script, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def test_damage_and_conversations_without_rows(spark):
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Text {t}. Why?") for i in range(60) for t in range(4)] + [(None, None, None, None)]
    found = {r.conv_id: r.asDict() for r in conversations.repair(damaged(spark.createDataFrame(rows, CONV)), F.col("present")).collect()}
    lone = next(i for i in range(10**6) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kinds = defaultdict(int)
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        kinds[kind] += 1
        text = {1: "", 2: (text or " ").translate({46: None, 33: None, 63: None})}.get(kind, text)
        by_conv[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    assert all(kinds[k] for k in range(5))
    for conv, mine in by_conv.items():
        expected = brute_repair(mine)
        assert all(found[conv][c] == v for c, v in expected.items() if c != "lines")
    gone = conversations.repair(damaged(spark.createDataFrame([(lone, 0, "user", "Hi.")], CONV)), F.col("present")).first()
    assert gone.asDict() == {
        "conv_id": lone, "n_turns": 0, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0,
        "audit": "", "roles": "", "repaired_sha256": hashlib.sha256(b"").hexdigest(),
    }
    empty = spark.createDataFrame([], CONV)
    assert conversations.repair(empty).collect() == [] and conversations.repaired_turns(empty).collect() == []


def test_repair_takes_very_long_texts(spark):
    rows = [(1, 0, "user", "x" * 3_000_000 + "." * 1000 + " " * 50_000), (1, 1, "assistant", "y" * 2_000_000)]
    done = conversations.repair(spark.createDataFrame(rows, CONV)).first()
    assert (done.audit, done.truncated, done.cost) == ("KK", 1, 3)
