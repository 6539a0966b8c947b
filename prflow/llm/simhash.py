"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at
most k bits share at least 8 - k positional bytes, so of k + 2 groups of byte
positions they share at least two whole groups. The index posts each
fingerprint under every pair of groups; pairs of a posting tally their shared
positional bytes, those that reach 8 - k are verified bit by bit.

A posting with more than PAIRED fingerprints does not form pairs: there,
fingerprints within k bits are linked through common neighbours of k / 2 bits,
which finds the same links with rows in proportion to the posting.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import boxed, written
from prflow.llm.components import components

PAIRED = 64
SEED = 42


def _fingerprint(text: bytes | None, shingle: int) -> int:
    import numpy as np
    from xxhash import xxh64_intdigest

    found = (text or b"").lower().split()  # ASCII only: A-Z and \x20 \x09-\x0D
    if not found:
        return 0
    body = b" ".join(found)
    n = max(1, len(found) - shingle + 1)
    width = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(width + 1) - 1
    starts = (ends - width).tolist()
    ends = ends.tolist()[min(shingle, len(found)) - 1 :]
    hashes = np.fromiter((xxh64_intdigest(body[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, fp)`` of every row: majority bits of the XXH64 (seed 42) of
    all word shingles. Fewer words than a shingle count as one; no words, also
    a null text, give 0."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            fps = [_fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def _groups(bits: int) -> list[list[int]]:
    """The eight byte positions in bits + 2 groups."""
    n = min(8, bits + 2)
    return [list(range(8 * i // n, 8 * (i + 1) // n)) for i in range(n)]


def _mask(positions: list[int]) -> int:
    value = sum(0xFF << 8 * p for p in positions)
    return value - (1 << 64) if value >> 63 else value


def shared_bytes(a: Column, b: Column) -> Column:
    differing = a.bitwiseXOR(b)
    return sum(
        F.when(F.shiftrightunsigned(differing, 8 * i).bitwiseAND(F.lit(0xFF)) == 0, 1).otherwise(0) for i in range(8)
    )


def links(prints: DataFrame, bits: int) -> DataFrame:
    """``(a, b)``: enough links between distinct fingerprints (column fp) to
    connect all that are linked by ``bits`` (0-2) or fewer differing bits;
    every link given is one."""
    if bits not in (0, 1, 2):
        raise ValueError("bits must be 0, 1 or 2")
    postings = list(combinations(_groups(bits), 2))
    masks = [_mask(x + y) for x, y in postings]
    posts = F.array(*[
        F.struct(F.lit(i).alias("place"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)
    ])
    index = prints.select("fp", F.inline(posts))
    sizes = index.groupBy("place", "bytes").agg(F.count("*").alias("n")).filter("n > 1")
    index = written(index.join(sizes, ["place", "bytes"]), "postings")

    few = index.filter(F.col("n") <= PAIRED)
    pairs = few.alias("x").join(few.alias("y"), ["place", "bytes"]).filter("x.fp < y.fp")
    pairs = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    tallied = pairs.filter(shared_bytes(F.col("a"), F.col("b")) >= 8 - bits)
    found = tallied.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits).distinct()

    # many: bits of the bytes outside the posting may still differ
    many = index.filter(F.col("n") > PAIRED)
    free = F.element_at(
        F.array(*[F.array(*[F.lit(i) for i in range(64) if not (m >> i) & 1]) for m in masks]), F.col("place") + 1
    )
    flip = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    if bits == 2:  # both within one bit of "near", so within two of each other
        near = F.transform(free, lambda i: F.struct(F.lit(-1).alias("bit"), F.col("fp").bitwiseXOR(flip(i)).alias("near")))
    else:  # equal but for one bit
        near = F.transform(free, lambda i: F.struct(i.alias("bit"), F.col("fp").bitwiseAND(F.bitwise_not(flip(i))).alias("near")))
    own = F.array(F.struct(F.lit(-1).alias("bit"), F.col("fp").alias("near")))
    around = many.select("place", "fp", F.inline(F.concat(own, near) if bits else own))
    centre = around.groupBy("place", "bit", "near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1")
    hubs = around.join(centre.drop("n"), ["place", "bit", "near"]).filter("fp <> b")
    return found.unionByName(hubs.select(F.col("fp").alias("a"), "b").distinct())


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row: documents whose fingerprints
    differ in at most ``bits`` bits are linked, and a component is named by its
    smallest doc_id.

    Copies share a fingerprint and are one node, however many they are. Null
    texts have the fingerprint 0 like texts without words and are linked like
    any other. A row without an id takes part, but names a component only if
    nobody else can (then the name is null). Repeated rows get repeated
    results; an empty table gives an empty result; other columns are not
    looked at.
    """
    prints = written(fingerprints(docs, shingle, text, doc_id), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(nodes.select("fp"), bits))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = written(rooted.join(named, "root").select(F.col("fp").alias("f"), "component_id"), "named")
    return prints.join(named, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """One document of each component, the one with the smallest id, columns
    untouched. Rows that repeat the kept id are kept too; components without
    any id lose nothing: rows without an id are kept."""
    kept = near_duplicates(docs, shingle, bits).filter("doc_id = component_id").select("component_id").distinct()
    rows = boxed(docs)
    first = rows.filter("row.doc_id is not null").join(kept, F.col("row.doc_id") == F.col("component_id"), "left_semi")
    return first.unionByName(rows.filter("row.doc_id is null")).select("row.*")
