"""Deduplication operators against brute force, with odd rows."""

from __future__ import annotations

import hashlib
import os
import random
import re
import time
from itertools import combinations
from urllib.parse import urlparse

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from prflow.llm import decontaminate, lines, paragraphs, simhash, substrings
from prflow.llm.common import written
from prflow.llm.components import components

ODD = [(5000, None), (5001, ""), (5002, " \n\t "), (None, "one two three four"), (None, None)]


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def roots_of(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = sorted((find(a), find(b)))
        parent[rb] = ra
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1200)] + [(2000, i) for i in range(2001, 2100)] + [(7, 7), edges[0]]
    got = components(frame(spark, edges + [(None, 4)], "a long, b long")).collect()
    used = {n for e in edges for n in e if e[0] != e[1]}
    assert {r["node"]: r["root"] for r in got} == roots_of(used, [e for e in edges if e[0] != e[1]])
    assert components(frame(spark, [], "a long, b long")).count() == 0


def test_a_work_table_leaves_no_shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffle_files():
        files = blocks.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name for name in names if name.startswith("shuffle_")}

    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before = shuffle_files()
    table = written(rows, "counts")
    deadline = time.monotonic() + 10
    while (left := shuffle_files() - before) and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not left and table.count() == 10
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(9)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(3000)]


def brute_print(text, n=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_equals_brute_force(spark, vocabulary):
    rng = random.Random(3)
    rows = list(ODD) + [(6000, "ONE two\x0bthree"), (6001, "one Two three"), (6002, "É a b"), (6003, "é a b"), (6001, "one Two three")]
    for i in range(60):
        words = prose(rng, 220, vocabulary).split()
        rows.append((i * 10, " ".join(words)))
        for j in range(1, rng.randint(1, 5)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i * 10 + j, " ".join(words)))
    got = simhash.near_duplicates(frame(spark, rows), 3, 2)
    prints = {(d, t): brute_print(t) for d, t in rows}
    distinct = sorted(set(prints.values()))
    linked = [(a, b) for a, b in combinations(distinct, 2) if (a ^ b).bit_count() <= 2]
    assert linked
    root = roots_of(distinct, linked)
    first = {}
    for (d, _), p in prints.items():
        if d is not None:
            first[root[p]] = min(d, first.get(root[p], d))
    want = sorted((str(d), prints[d, t], first.get(root[prints[d, t]])) for d, t in rows)
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), r["component_id"]) for r in got.collect()) == want
    assert simhash.near_duplicates(frame(spark, []), 3, 2).count() == 0


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_simhash_links_in_large_postings_connect_the_same(spark, bits, monkeypatch):
    rng = random.Random(bits)
    centre = [rng.getrandbits(64) for _ in range(4)]
    prints = {c ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(64)) for c in centre for _ in range(120)} | set(centre)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    nodes = [p for p, in signed]
    close = [(a, b) for a, b in combinations(nodes, 2) if ((a ^ b) % (1 << 64)).bit_count() <= bits]
    want = roots_of(nodes, close)
    for paired in (64, 2):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        got = [tuple(r) for r in simhash.links(frame(spark, signed, "fp long"), bits).collect()]
        assert all(((a ^ b) % (1 << 64)).bit_count() <= bits for a, b in got)
        assert roots_of(nodes, got) == want


def test_simhash_keeps_one_of_each_group_with_its_columns(spark):
    rows = [(3, "a b c d", 1), (1, "a b c d", 2), (None, "a b c d", 3), (9, None, 4), (8, "", 5)]
    docs = frame(spark, rows, "doc_id long, text string, component_id int")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([rows[1], rows[2], rows[4]], key=str)


def brute_lines(rows):
    """Components over all pairs of different lines within 3 bits and the edit bound."""
    import re

    def normal(x):
        return re.sub(r"[\W_]+", " ", x.lower()).strip()

    def fp(x):
        words = set(x.split(" "))
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(words))

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row[0] = row[:], i
            for j, y in enumerate(b, 1):
                row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
        return row[-1]

    spots = [
        ((d is None, d or 0, n), normal(x)) for d, t in rows for n, x in enumerate((t or "").split("\n")) if normal(x)
    ]
    distinct = sorted({x for _, x in spots})
    prints = {x: fp(x) for x in distinct}
    edges = [
        (a, b) for a, b in combinations(distinct, 2)
        if (prints[a] ^ prints[b]).bit_count() <= 3 and distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)
    ]
    root = roots_of(distinct, edges)
    first = {}
    for spot, x in spots:
        first[root[x]] = min(spot, first.get(root[x], spot))
    return {(spot[1], spot[2]) for spot, x in spots if first[root[x]] != spot}, len(edges)


def test_lines_equal_brute_force(spark, vocabulary):
    rng = random.Random(6)
    base = [prose(rng, 120, vocabulary) for _ in range(12)]
    rows = []
    for i in range(60):
        chosen = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(base).split()
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            chosen.append(rng.choice([" ".join(words), " ".join(words).upper() + "!", "", "***", prose(rng, 9, vocabulary)]))
        rows.append((i, "\n".join(chosen)))
    want, n_edges = brute_lines(rows)
    assert n_edges > 10
    got = lines.dropped_lines(frame(spark, rows + ODD[:3]))
    found = {(r["doc_id"], n) for r in got.collect() for n in r["dropped"]}
    assert found == want
    assert {r["doc_id"]: r["n_lines"] for r in got.collect()} == {d: (t or "").count("\n") + 1 for d, t in rows + ODD[:3]}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_word_edits_are_never_less_than_the_edit_distance(spark):
    rng = random.Random(12)
    pairs = [("a b c", "a b c"), ("a", "b c d"), ("a b c d", "d"), ("x" * 200, "y" * 150), ("one two", "one " + "two " * 9 + "two")]
    for _ in range(150):
        a = [rng.choice(["an", "bee", "sea", "deep", "é"]) for _ in range(rng.randint(1, 25))]
        b = [w for w in a if rng.random() < 0.9] or ["z"]
        for _ in range(rng.randint(0, 3)):
            b.insert(rng.randint(0, len(b)), rng.choice(["an", "new", "word"]))
        pairs.append((" ".join(a), " ".join(b)))
    got = frame(spark, pairs, "x string, y string").select("x", "y", lines._word_edits("x", "y")).collect()
    assert len(got) == len(pairs)
    assert all(edits >= levenshtein(x, y) for x, y, edits in got)
    assert sum(edits == levenshtein(x, y) for x, y, edits in got) > 0.6 * len(got)
    single = frame(spark, [("one two three four", "one two tree four"), ("one two", "one new two"), ("one new two", "one two")], "x string, y string")
    assert [r[0] for r in single.select(lines._word_edits("x", "y")).collect()] == [1, 4, 4]


def test_long_similar_lines_are_linked_without_comparing_all_characters(spark, vocabulary):
    rng = random.Random(13)
    words = prose(rng, 16_000, vocabulary).split()
    x = " ".join(words)
    y = " ".join(w for i, w in enumerate(words) if i % 1000 != 7)
    bodies = frame(spark, [(1, x), (2, y)], "line long, body string")
    pairs = frame(spark, [(1, 2)], "a long, b long")
    since = time.time()
    assert [tuple(r) for r in lines._verified(pairs, bodies, 0.8).collect()] == [(1, 2)]
    assert time.time() - since < 8  # length x bound took half a minute


def test_large_blocks_keep_the_same_line_groups(spark, vocabulary, monkeypatch):
    rng = random.Random(8)
    words = prose(rng, 200, vocabulary).split()
    rows = []
    for i in range(90):
        some = list(words)
        some[rng.randrange(len(some))] = rng.choice(vocabulary)
        rows.append((i, " ".join(some)))
    docs = frame(spark, rows)
    whole = {(r["doc_id"], tuple(r["dropped"])) for r in lines.dropped_lines(docs).collect()}
    monkeypatch.setattr(lines, "PAIRED", 4)
    assert {(r["doc_id"], tuple(r["dropped"])) for r in lines.dropped_lines(docs).collect()} == whole
    assert sum(bool(d) for _, d in whole) > 40


def test_lines_with_more_words_than_a_lane(spark, monkeypatch):
    monkeypatch.setattr(lines, "LANE", 5)
    rows = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "one two three")]
    read = lines._ids(frame(spark, rows), "text", "doc_id")
    got = {r["doc_id"]: r["fp"] % (1 << 64) for r in lines.fingerprinted(read).collect()}
    for d, t in rows:
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in t.split()]
        assert got[d] == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_lines_are_summed_by_seven_hashes_and_blocks_sorted_by_one_number(spark, vocabulary):
    rng = random.Random(14)
    texts = [prose(rng, n, vocabulary[:40]) for n in (1, 2, 6, 7, 8, 13, 14, 15, 21, 22, 90)]
    texts += ["É é Ünï-çødé, 12½ x", "ΑΣ α\U00010400b", " -- ", "a", "  A  b,\ta!"]
    read = lines._ids(frame(spark, [(1, "\n".join(texts))]), "text", "doc_id")
    assert dict(lines._lines(read).dtypes)["hashes"] == "array<bigint>"  # no words are carried
    want = {}
    for i, words in enumerate(re.findall(r"[^\W_]+", t.lower()) for t in texts):
        hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(words)]
        if hashes:
            body = " ".join(words).encode()
            want[i] = xxhash.xxh64_intdigest(body, 42), sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    prints = lines.fingerprinted(read)
    assert {r["line_no"]: (r["h1"] % (1 << 64), r["fp"] % (1 << 64)) for r in prints.collect()} == want

    some = [rng.getrandbits(64) for _ in range(6)]
    some += [x ^ (1 << rng.randrange(64)) for x in some]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in some]
    index = lines._index(frame(spark, signed, "fp long"), 3, 2)
    assert sorted(index.columns) == ["block", "first", "fp", "n"]
    masks = [sum((1 << 64 * (b + 1) // 5) - (1 << 64 * b // 5) for b in two) for two in combinations(range(5), 2)]
    groups = {}
    for i, m in enumerate(masks):
        for x, in signed:
            groups.setdefault((i, x % (1 << 64) & m), []).append(x)
    several = [(x, len(g), min(g)) for g in groups.values() if len(g) > 1 for x in g]
    assert several and sorted(map(tuple, index.select("fp", "n", "first").collect())) == sorted(several)


def test_dropping_lines_keeps_columns_rows_and_blank_lines(spark):
    rows = [(2, "same line here\n\nown", 9, "x"), (1, "first\nSame line, here", 9, "y"), (3, None, 0, "z"), (None, "first", 5, "w")]
    docs = frame(spark, rows, "doc_id long, text string, n_chars int, gone string")
    out = lines.drop_repeated_lines(docs)
    assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(2, "\nown", 4, "x"), rows[1], rows[2], (None, "", 0, "w")], key=str
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0


def brute_bytes(rows, width=50):
    least = {}
    for i, t in rows:
        b, order = (t or "").encode(), 1 << 63 if i is None else i
        for p in range(len(b) - width + 1):
            least[b[p : p + width]] = min(order, least.get(b[p : p + width], order))
    out = []
    for i, t in rows:
        b, order = (t or "").encode(), 1 << 63 if i is None else i
        covered = bytearray(len(b))
        for p in range(len(b) - width + 1):
            if least[b[p : p + width]] < order:
                covered[p : p + width] = b"\1" * width
        runs = len([x for x in bytes(covered).split(b"\0") if x])
        kept = bytes(x for x, c in zip(b, covered) if not c)
        out.append((str(i), len(b), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("gathered", [20_000, 3])
def test_substrings_equal_brute_force(spark, gathered):
    rng = random.Random(3)
    passages = ["".join(rng.choice("abcé ") for _ in range(rng.randint(40, 200))) for _ in range(8)]

    def part():
        return rng.choice([
            rng.choice(passages)[rng.randint(0, 20) :],
            "".join(rng.choice("abcdé xyz") for _ in range(rng.randint(5, 90))), "a" * rng.randint(1, 120),
        ])

    rows = [(i if i % 17 else None, "".join(part() for _ in range(rng.randint(0, 5)))) for i in range(90)]
    rows += ODD + [rows[3], (4, "another text of the same id " * 4), (9000, "a" * 3000)]
    rows += [(600 - i, rows[i][1]) for i in range(1, 12)] + [(None, rows[i][1]) for i in (5, 6, 6)] + [(-1, rows[8][1])]
    got = substrings.remove_repeats(frame(spark, rows).repartition(3), gathered=gathered).select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (a, s) -> a + s.end - s.start)"), F.size("spans"), F.sha2("kept", 256)
    )
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_bytes(rows)
    assert substrings.remove_repeats(frame(spark, [])).count() == 0


def test_contexts_are_made_once(spark, monkeypatch):
    plans = {}

    def watched(frame, purpose):
        plans[purpose] = frame._jdf.queryExecution().executedPlan().toString()
        return written(frame, purpose)

    monkeypatch.setattr(substrings, "written", watched)
    rows = [(i, "some passage that is found in each of the texts of this table " * 2 + str(i)) for i in range(9)]
    assert substrings.remove_repeats(frame(spark, rows)).count() == 9
    # sampling the splitters runs all that is below the range exchange once more
    assert "rangepartitioning" in plans["covered"] and plans["covered"].count("MapInArrow") == 1
    assert "rangepartitioning" not in plans["contexts"]


def test_multikey_order_sorts_rows_and_groups_equal_ones():
    import numpy as np

    words = np.random.default_rng(0).integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = substrings.multikey_order(words)
    rows = [tuple(w) for w in words[order]]
    assert rows == sorted(map(tuple, words))
    assert all((rows[i] == rows[i + 1]) == (group[i] == group[i + 1]) for i in range(499))


def test_long_texts_are_hashed_in_overlapping_blocks(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5000)).encode()
    whole = substrings._runs([text], 50)[0]
    monkeypatch.setattr(substrings, "BLOCK", 700)
    parts = substrings._runs([text, b"", text], 50)
    for runs in (parts[0], parts[2]):
        starts = lambda r: [(f + i, p) for f, c, p in zip(*(x.tolist() for x in r[:3])) for i in range(c)]
        assert starts(runs) == starts(whole)


def test_paragraphs_find_shared_passages_and_leave_others(spark, vocabulary):
    rng = random.Random(5)
    passage = prose(rng, 52, vocabulary)
    edited = passage.split()
    long_passage = prose(rng, 200, vocabulary).split()
    near = list(long_passage)
    near[100] = "changed"
    rows = [(i, prose(rng, 150, vocabulary)) for i in range(60)]
    for i in range(60, 100):
        rows.append((i, " ".join([prose(rng, rng.randint(0, 60), vocabulary), passage, prose(rng, 30, vocabulary)])))
    rows += [(200, " ".join(long_passage)), (201, " ".join(near)), (202, None), (203, ""), (204, " ".join(edited[:16]))]
    rows += [(None, rows[0][1]), rows[5]]
    got = paragraphs.repeated_paragraphs(frame(spark, rows)).collect()
    flagged = {r["doc_id"] for r in got}
    assert flagged == set(range(60, 100)) | {0, 200, 201, None}
    texts = {d: decontaminate.hashed(t).tolist() for d, t in rows}
    for r in got:
        assert r["end"] - r["start"] >= paragraphs.LEAST
        if not r["removed"]:
            assert (r["doc_id"], r["start"]) == (r["class_doc_id"], r["class_start"])
        elif r["doc_id"] not in (201, None):
            # near the ends of a passage, paragraphs may take in other words
            own, first = texts[r["doc_id"]][r["start"] : r["end"]], texts[r["class_doc_id"]][r["class_start"] :]
            assert len(set(own) & set(first[: 2 * len(own)])) >= 0.6 * len(set(own))
    kept = {r["doc_id"] for r in got if not r["removed"]}
    assert kept <= {60, 200, 0} and {60, 200, 0} <= kept
    assert paragraphs.repeated_paragraphs(frame(spark, [])).count() == 0


def test_dense_bands_connect_all_similar_sets(spark, monkeypatch):
    rng = random.Random(4)
    base = list(range(40))
    sets = []
    for i in range(60):
        own = set(base) - set(rng.sample(base, rng.randint(0, 8))) | {1000 + i * 10 + j for j in range(rng.randint(0, 4))}
        sets.append((bytes([i]), sorted(own)))
    monkeypatch.setattr(paragraphs, "PAIRED", 5)
    known = frame(spark, sets, "content binary, shingles array<long>")
    hits = known.select(F.lit(1).cast("long").alias("band"), F.lit(0).alias("doc_id"), F.lit(0).alias("key"),
                        F.lit(0).alias("start"), F.lit(0).alias("length"), "content")
    bands = paragraphs._contested(paragraphs._by_band(hits))
    known = paragraphs.sketched(known)
    got = {(bytes(r["a"]), bytes(r["b"])) for r in paragraphs._links(bands, known, 0.8).collect()}
    want = {
        (a, b) for (a, x), (b, y) in combinations(sets, 2) if len(set(x) & set(y)) >= 0.8 * len(set(x) | set(y))
    }
    assert want and got <= want
    nodes = [c for c, _ in sets]
    assert roots_of(nodes, got) == roots_of(nodes, want)
    assert len(set(roots_of(nodes, want).values())) > 1


def brute_paragraphs(texts):
    """Paragraphs (start, end) of each text by their definition, and the set of shingles of each."""
    out = []
    for words in texts:
        n = len(words)
        pair = paragraphs._mixed(np.r_[np.uint64(0), words[:-1]].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + words, 0x51)
        high = [int(p) >> 24 for p in pair]
        starts = {0} if n else set()
        starts |= {i for i in range(1, n) if int(pair[i]) < (1 << 64) // paragraphs.RARE}
        for a in range(1, n - paragraphs.CUT + 1):
            starts.add(min(range(a, a + paragraphs.CUT), key=lambda i: (high[i], i)))
        found = []
        for s in sorted(starts):
            end = min(n, s + paragraphs.LENGTH)
            if end - s >= (5 if s == 0 else paragraphs.LEAST):
                found.append((s, end, frozenset(tuple(words[i : i + 5]) for i in range(s, end - 4))))
        out.append(found)
    return out


def test_paragraphs_of_parts_are_those_of_the_whole(vocabulary, monkeypatch):
    rng = random.Random(12)
    texts = [decontaminate.hashed(prose(rng, n, vocabulary)).astype(np.uint64) for n in (0, 3, 5, 16, 24, 25, 60, 700)]
    want = [[(a, b) for a, b, _ in found] for found in brute_paragraphs(texts)]
    for part in (1 << 22, 40):
        monkeypatch.setattr(paragraphs, "PART", part)
        parts = [(i, at, p) for i, t in enumerate(texts) for at, p in paragraphs._parts(t)]
        _, _, starts, ends, bounds = paragraphs._paragraphs([p for _, _, p in parts])
        got = [[] for _ in texts]
        first = 0
        for (i, at, p), a, b in zip(parts, bounds, bounds[1:]):
            got[i] += [(int(s) - first + at, int(e) - first + at) for s, e in zip(starts[a:b], ends[a:b])]
            first += len(p[0])
        assert got == want


def test_paragraph_classes_have_the_recall_of_the_brute_force(spark, vocabulary):
    rng = random.Random(13)
    base = [prose(rng, 90, vocabulary).split() for _ in range(15)]
    rows = []
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(prose(rng, rng.randint(0, 30), vocabulary).split() + words)))
    rows += [(200, "a short text of seven words here"), (201, "A short text, of seven words here"), (202, "only four words here")]
    hashes = [decontaminate.hashed(t).astype(np.uint64) for _, t in rows]
    units = [(d, s, grams) for (d, _), found in zip(rows, brute_paragraphs(hashes)) for s, _, grams in found]
    near = [
        (a, b) for a, b in combinations(range(len(units)), 2)
        if len(units[a][2] & units[b][2]) >= 0.8 * len(units[a][2] | units[b][2])
    ]
    group = roots_of(range(len(units)), near)
    members = {}
    for u, root in group.items():
        members.setdefault(root, []).append(u)
    want = {units[u][:2] for us in members.values() if len({units[u][0] for u in us}) > 1 for u in us}
    got = {(r["doc_id"], r["start"]) for r in paragraphs.repeated_paragraphs(frame(spark, rows)).collect()}
    assert {(200, 0), (201, 0)} <= got <= want
    assert len(got) >= 0.98 * len(want)


def test_a_run_of_paragraphs_deals_each_band_once(vocabulary):
    import pyarrow as pa
    import zstandard

    rng = random.Random(14)
    texts = [prose(rng, n, vocabulary) for n in (400, 0, 4, 7, 250)] + ["one two " * 60]
    ids, keys = pa.array(range(len(texts)), pa.int64()), pa.array(range(50, 50 + len(texts)), pa.int64())
    rows = pa.RecordBatch.from_arrays([ids, keys, pa.array(texts)], ["doc_id", "key", "text"])
    found = [x for x in paragraphs._found(texts)]
    want = {(int(b), int(r)) for row, _, _, _, bands in found for band in bands for b, r in zip(band, row)}
    got = [(x["band"], x["doc_id"]) for batch in paragraphs._emit_bands([rows]) for x in batch.to_pylist()]
    assert set(got) == want and len(got) == len(set(got))
    n = sum(len(row) for row, *_ in found)
    assert len(got) < 0.6 * paragraphs.BANDS * n  # before, one row for each paragraph and band

    asked = [[b for b, r in sorted(want) if r == i][::3] for i in range(len(texts))]
    packed = [zstandard.ZstdCompressor().compress(t.encode()) for t in texts]
    batch = pa.RecordBatch.from_arrays(
        [ids, keys, pa.array(packed, pa.binary()), pa.array(asked, pa.list_(pa.int64()))], ["doc_id", "key", "packed", "asked"]
    )
    hits = [x for out in paragraphs._emit_hits([batch]) for x in out.to_pylist()]
    every = {b for bands in asked for b in bands}
    whole = {
        (int(r), int(s)): {int(b) for b in of} & every
        for row, start, _, _, bands in found for r, s, of in zip(row, start, zip(*bands))
    }
    assert {(x["doc_id"], x["start"]): set(x["band"]) for x in hits} == {k: v for k, v in whole.items() if v}
    assert all(x["key"] == x["doc_id"] + 50 for x in hits)


def test_sets_of_windows_are_their_distinct_shingles(vocabulary):
    rng = random.Random(15)
    words = decontaminate.hashed(prose(rng, 200, vocabulary) + " one two" * 30).astype(np.uint64)
    starts = np.array([0, 3, 100, 190, 195, 210, 235])
    lengths = np.array([25, 25, 17, 25, 20, 25, 5])
    values, ends = paragraphs._sets(words, starts, lengths)
    for i, (s, n) in enumerate(zip(starts, lengths)):
        got = values[ends[i] : ends[i + 1]].tolist()
        assert set(got) == set(paragraphs._shingles(words[s : s + n]).view(np.int64).tolist()) and len(got) == len(set(got))


def test_sets_go_as_words_and_are_compared_as_their_shingles(vocabulary):
    import pyarrow as pa
    import zstandard

    rng = random.Random(16)
    texts = [prose(rng, n, vocabulary[:40]).split() for n in (60, 90)] + ["one two".split() * 20]
    asked = [[(s, n, 100 * t + s + n) for s, n in ((0, 25), (3, 25), (8, 17), (12, 25), (0, 5))] for t in range(3)]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int32()), ("content", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(3)), pa.array(range(3)),
        pa.array([zstandard.ZstdCompressor().compress(" ".join(t).encode()) for t in texts], pa.binary()),
        pa.array([[dict(zip(("start", "length", "content"), a)) for a in own] for own in asked], kind),
    ], ["doc_id", "key", "packed", "asked"])
    [made] = paragraphs._emit_shingles([batch])
    sets = {}
    for (t, s, n, c) in ((t, *a) for t in range(3) for a in asked[t]):
        sets[c] = {tuple(texts[t][i : i + 5]) for i in range(s, s + n - 4)}
    names, size = made.column(0).to_pylist(), made.column(2).to_pylist()
    assert dict(zip(names, size)) == {c: len(x) for c, x in sets.items()}
    # before, a shingle was eight bytes and a paragraph has nearly as many as words
    assert made.column(1).nbytes <= sum(4 * n + 4 for own in asked for _, n, _ in own) + 4

    a, b = (pa.array(x) for x in zip(*[(i, j) for i in range(len(names)) for j in range(len(names))]))
    rows = pa.RecordBatch.from_arrays(
        [made.column(0).take(a), made.column(0).take(b), made.column(1).take(a), made.column(1).take(b)], ["a", "b", "x", "y"]
    )
    for similar in (0.8, 0.3):
        got = {(r["a"], r["b"]) for out in paragraphs._verified([rows], similar) for r in out.to_pylist()}
        assert got == {(i, j) for i in names for j in names if len(sets[i] & sets[j]) >= similar * len(sets[i] | sets[j])}
    lists = paragraphs._members(pa.array([[5, 6, 7], [], [9]], pa.list_(pa.int64())))
    others = paragraphs._members(pa.array([[7, 8, 5, 1], [0], [9]], pa.list_(pa.int64())))
    assert paragraphs._shared(lists, others).tolist() == [2, 0, 1]


def test_paragraphs_leave_no_work_tables_that_nothing_reads(spark, vocabulary, monkeypatch):
    rng = random.Random(17)
    base = [prose(rng, 60, vocabulary).split() for _ in range(3)]
    rows = []
    for i in range(40):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    tables = {}

    def kept(table, purpose):
        table = written(table, purpose)
        tables.setdefault(purpose, []).append((os.path.dirname(urlparse(table.inputFiles()[0]).path), table.count()))
        return table

    monkeypatch.setattr(paragraphs, "PAIRED", 3)
    monkeypatch.setattr(paragraphs, "written", kept)
    found = paragraphs.repeated_paragraphs(frame(spark, rows))
    got = sorted(map(tuple, found.collect()), key=str)
    assert got and got == sorted(map(tuple, found.collect()), key=str)  # read again
    left = {purpose for purpose, of in tables.items() if any(os.path.exists(folder) for folder, _ in of)}
    made = {"collisions", "sets", "bands", "near", "own", "open", "keys"}
    assert made <= set(tables) and not made & left and {"hits", "contents", "named"} <= left
    # a shingle of a dense set is a row once, and not for each size of its partners
    own, keys = (tables[purpose][0][1] for purpose in ("own", "keys"))
    assert own and keys <= 5 * own


def test_decontamination_finds_leaks_and_paraphrases(spark, vocabulary):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randint(15, 60), vocabulary).capitalize() + ". " + prose(rng, 5, vocabulary)) for i in range(30)]
    items += [(100, None), (101, "too short"), (102, prose(rng, 230, vocabulary)), (None, "no id " * 10)]
    rows = [(i, prose(rng, 300, vocabulary)) for i in range(80)]
    want = set()
    for i in range(80, 140):
        item = rng.choice(items[:30])
        words = item[1].split()
        if i % 3 == 0 and len(words) > 25:  # lose every ninth word before the answer
            words = [w for n, w in enumerate(words) if n % 9 or n > len(words) - 6]
        rows.append((i, " ".join([prose(rng, rng.randint(0, 90), vocabulary), *words, prose(rng, 40, vocabulary)]).upper()))
        want.add((i, item[0]))
    rows += [(200, "x " + items[32][1]), (None, "pre " + items[0][1]), *ODD[:3], rows[90]]
    want |= {(200, 102), (None, 0)}
    docs, benchmark = frame(spark, rows), frame(spark, items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()}
    assert got == want
    clean = decontaminate.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in {x for x, _ in want})
    assert decontaminate.leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0


def test_decontamination_of_long_items_short_items_and_long_texts(spark, vocabulary, monkeypatch):
    rng = random.Random(11)
    lengths = {1: 9, 2: 94, 3: 102, 4: 400}
    items = {i: prose(rng, n - 5, vocabulary) + ". " + prose(rng, 5, vocabulary) for i, n in lengths.items()}
    items |= {5: "seven rare words xqa xqb xqc xqd", 6: "xqe xqf", 7: "", 8: "..."}
    rows = [(i, prose(rng, 400, vocabulary)) for i in range(40)]
    want = set()
    for i in (1, 2, 3, 4):
        words = items[i].split()
        lost = [w for n, w in enumerate(words) if n % 4 or n >= len(words) - 5]
        rows.append((100 + i, " ".join([prose(rng, 50, vocabulary), *words, prose(rng, 20, vocabulary)])))
        want.add((100 + i, i))
        if i > 1:  # paraphrases: with the answer, and without it
            rows.append((110 + i, " ".join([prose(rng, 50, vocabulary), *lost, prose(rng, 20, vocabulary)])))
            want.add((110 + i, i))
            rows.append((120 + i, " ".join([*lost[:-5], prose(rng, 20, vocabulary)])))
    rows.append((130, " ".join([prose(rng, 60, vocabulary), *items[4].split()[:150]])))  # a third of an item
    rows.append((140, "some " + items[5].upper() + ", then"))
    rows.append((141, "seven rare words xqa xqb xqc so xqd"))
    rows.append((142, "Xqe, xqf!"))
    rows.append((143, "not alone: xqe xqf"))
    want |= {(140, 5), (142, 6)}
    docs = frame(spark, rows, "doc_id long, text string")
    benchmark = frame(spark, list(items.items()), "item_id long, text string")

    def found(docs):
        return {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, benchmark).collect()}

    assert found(docs) == want
    # a text of a million words, each item somewhere, the last ones over the ends of its parts
    filler = [prose(rng, 5_000, vocabulary)] * 200
    for place, i in ((40, 1), (77, 2), (120, 3)):
        filler[place] = filler[place] + " " + items[i]
    edge = decontaminate.GROUP * 2 - 200
    whole = " ".join(filler).split()
    whole[edge:edge] = items[4].split()
    assert found(frame(spark, [(1, " ".join(whole)), (2, None)], "doc_id long, text string")) == {(1, i) for i in range(1, 5)}


def test_block_sums_are_those_of_reduceat_in_less_time():
    rng = np.random.default_rng(4)
    space = rng.standard_normal((decontaminate.TERMS, decontaminate.RANK)).astype(np.float32)
    sizes = np.r_[rng.integers(1, 900, 200), 1, 12, 24]
    first = np.cumsum(sizes) - sizes
    terms = rng.integers(0, decontaminate.TERMS, sizes.sum()).astype(np.uint32)
    n_blocks = -(-sizes // decontaminate.STEP)
    owner = np.repeat(np.arange(len(sizes)), n_blocks)
    edge = first[owner] + (np.arange(len(owner)) - (np.cumsum(n_blocks) - n_blocks)[owner]) * decontaminate.STEP

    def clocked(make):
        took = []
        for _ in range(3):
            since = time.process_time()
            made = make()
            took.append(time.process_time() - since)
        return made, min(took)

    want, before = clocked(lambda: np.add.reduceat(space[terms], edge, axis=0))
    got, now = clocked(lambda: decontaminate._block_sums(terms, edge, (first + sizes)[owner], space))
    assert got.dtype == want.dtype and np.allclose(got, want, atol=1e-4)
    assert now < 0.8 * before


def test_bit_arithmetic_gives_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(0, 40))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            old = row[:]
            for j, y in enumerate(b, 1):
                row[j] = old[j - 1] + 1 if x == y else max(old[j], row[j - 1])
        places = {}
        for j, x in enumerate(a):
            places[x] = places.get(x, 0) | 1 << j
        assert decontaminate.common_subsequence(places, len(a), b) == row[-1]


def test_written_tables_keep_names_and_types(spark):
    table = frame(spark, ODD)
    assert written(table, "t").schema.simpleString() == table.schema.simpleString()
