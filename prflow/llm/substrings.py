"""Exact substring removal by a partitioned, sparse suffix array over bytes.

A string of ``width`` bytes is the prefix of a suffix. Suffixes are grouped by
their anchor: the 16-byte token with the smallest hash among those that start
in the first bytes of the string. Equal strings have equal anchors, so

1. anchors found in one text only are dropped (one narrow shuffle); a text that
   a smaller document has as a whole is covered, and goes no further,
2. the suffixes at the other anchors are cut out with their context, neighbours
   with one anchor together, written, and range-partitioned by the anchor's
   bytes with splitters that Spark samples from what is written,
3. each bucket sorts its suffixes by multikey quicksort and compares
   neighbours; equal anchors never lie on both sides of a boundary,
4. what a string of a smaller document covers is removed.

An anchor with more than ``gathered`` different contexts is not sorted in one
bucket: its strings are counted as keys of a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import text_key, written

TOKEN = 16  # bytes of an anchor
GATHERED = 20_000  # contexts of one anchor that a task sorts in memory
BLOCK = 1 << 18  # bytes hashed at once
NO_ID = (1 << 63) - 1
ID = "doc_id long, key long"


def _anchors(buffer, width: int):
    """Anchor position and hash for each string start of the buffer."""
    import numpy as np

    mixed = np.frombuffer(buffer, np.uint8).astype(np.uint64) + np.uint64(1)
    factor, size = 0x9E3779B97F4A7C15, 1
    while size < TOKEN:
        mixed = mixed[:-size] * np.uint64(factor) + mixed[size:]
        factor, size = factor * factor % (1 << 64), 2 * size
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    # the low bits carry the place, so the first of equal minima wins
    place = np.uint64((1 << 20) - 1)
    least = (mixed & ~place) | np.arange(len(mixed), dtype=np.uint64)
    span, done = width - TOKEN + 1, 1
    while done * 2 <= span:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if span > done:
        least = np.minimum(least[: len(least) - (span - done)], least[span - done :])
    return (least & place).astype(np.int64), mixed


def _runs(texts: list[bytes], width: int):
    """Per text: (first string start, number of strings, anchor place, anchor
    hash) of each run of neighbouring strings with one anchor, as arrays. Texts
    are hashed together in blocks; a long text is a block of overlapping parts."""
    import numpy as np

    out: list[list] = [[] for _ in texts]
    pending, total = [], 0

    def flush():
        nonlocal pending, total
        if total >= width:
            anchor, mixed = _anchors(b"".join(part for _, _, part in pending), width)
            start = 0
            for text, offset, part in pending:
                n = len(part) - width + 1
                if n > 0:
                    mine = anchor[start : start + n]
                    first = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
                    count = np.diff(np.r_[first, n])
                    out[text].append((first + offset, count, mine[first] - start + offset, mixed[mine[first]]))
                start += len(part)
        pending, total = [], 0

    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - width + 1), BLOCK):
            part = text[offset : offset + BLOCK + width - 1]
            if total + len(part) > BLOCK + width:
                flush()
            pending.append((i, offset, part))
            total += len(part)
    flush()
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return [tuple(map(np.concatenate, zip(*parts))) if parts else none for parts in out]


def _named(hashes):
    """48 bits name an anchor well enough: a clash only lets both pass on."""
    import numpy as np

    return (hashes >> np.uint64(16)).view(np.int64)


def _emit_anchors(batches, width: int):
    """Distinct anchors of each text."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        keys = batch.column(0).to_numpy()
        found = [np.unique(_named(r[3])) for r in _runs(batch.column(1).to_pylist(), width)]
        names = np.concatenate(found) if found else np.zeros(0, np.int64)
        owners = np.repeat(keys, [len(f) for f in found])
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(owners)], ["anchor", "key"])


def _repeated(batches):
    """Rows come sorted by anchor and text: pass on, once, those whose anchor
    has several texts. Of a group only the first text waits."""
    import numpy as np
    import pyarrow as pa

    waiting, passed = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy() for i in range(2)]
        if waiting is not None:
            columns = [np.concatenate(pair) for pair in zip(waiting, columns)]
        anchor, key = columns
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (key[1:] != key[:-1])]
        if passed is not None and passed == (anchor[0], key[0]):
            new[0] = False
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        last = np.r_[first[1:], len(anchor)] - 1
        several = key[first] != key[last]
        if passed is not None and passed[0] == anchor[0]:
            several[0] = True
        keep = np.repeat(several, last - first + 1) & new
        if several[-1]:
            waiting, passed = None, (anchor[-1], key[-1])
        else:
            waiting, passed = [c[-1:] for c in columns], None
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], ["anchor", "key"])


def _emit_contexts(batches, width: int):
    """Suffixes at repeated anchors: neighbouring strings with one anchor as
    one context, led by the anchor's bytes. A context that a smaller document
    of the batch has is covered already, and goes on without its bytes."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    names = ["lead", "context", "doc_id", "key", "first", "count"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        unpack = zstandard.ZstdDecompressor().decompress
        rows = sorted(zip(*(batch.column(i).to_pylist() for i in range(3)), range(batch.num_rows)))
        texts = [unpack(r[2]) for r in rows]
        out: list[tuple] = []
        least: dict = {}
        for (doc, key, _, i), text, (first, count, place, anchor) in zip(rows, texts, _runs(texts, width)):
            keep = np.isin(_named(anchor), batch.column(3)[i].values.to_numpy())
            spread = key.to_bytes(8, "big", signed=True)
            for f, c, p in zip(first[keep].tolist(), count[keep].tolist(), place[keep].tolist()):
                context = text[f : f + c + width - 1]
                if least.setdefault(context, doc) < doc:
                    out.append((spread, None, doc, key, f, c))
                else:
                    out.append((text[p : p + TOKEN], context, doc, key, f, c))
        for at in range(0, max(1, len(out)), 50_000):
            part = out[at : at + 50_000]
            columns = zip(*part) if part else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def multikey_order(words):
    """Order of rows by their columns, left to right: a column sorts only the
    rows that all columns before left equal. Returns (order, group of each)."""
    import numpy as np

    n = len(words)
    order = np.argsort(words[:, 0], kind="quicksort")
    group = np.zeros(n, np.int64)
    column = words[order, 0]
    group[1:] = np.cumsum(column[1:] != column[:-1])
    for c in range(1, words.shape[1]):
        sizes = np.bincount(group, minlength=n)
        tied = np.flatnonzero(sizes[group] > 1)
        if not len(tied):
            break
        value = words[order[tied], c]
        again = np.lexsort((value, group[tied]))
        order[tied] = order[tied][again]
        value, old = value[again], group[tied]
        new = np.zeros(n, bool)
        new[tied[1:]] = (value[1:] != value[:-1]) & (old[1:] == old[:-1])
        edge = np.r_[False, group[1:] != group[:-1]] | new
        group = np.cumsum(edge)
    return order, group


def _had_before(batch):
    """Which rows are covered as a whole: those without a context, and those
    whose context a smaller document of the batch has. Rows come in the order of
    documents among equal contexts."""
    import numpy as np

    code = batch.column(1).dictionary_encode().indices.fill_null(-1).to_numpy()
    doc = batch.column(2).to_numpy()
    first = np.zeros(code.max(initial=-1) + 2, np.int64)
    first[code[::-1]] = np.arange(len(code))[::-1]
    return (code < 0) | (doc > doc[first[code]])


def _sorted_bucket(batches, width: int, gathered: int):
    """Rows come sorted by anchor bytes and document. Gives the covered runs of
    string starts, and the contexts of anchors that are too many for a task."""
    import numpy as np
    import pyarrow as pa

    names = ["doc_id", "key", "first", "count", "context"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    out: list[tuple] = []
    ready: list[tuple] = []  # (context, its places in the smallest document)
    n_ready = 0

    def batch_of(rows):
        columns = zip(*rows) if rows else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def compare():
        """Sort the strings of all ready contexts and mark later documents'."""
        nonlocal ready, n_ready
        if not ready:
            return
        body = np.frombuffer(b"".join(c for c, _ in ready), np.uint8)
        sizes = np.array([len(c) for c, _ in ready])
        counts = sizes - width + 1
        owner = np.repeat(np.arange(len(ready)), counts)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        starts = np.repeat(np.cumsum(sizes) - sizes, counts) + inside
        padded = np.zeros((len(starts), -(-width // 8) * 8), np.uint8)
        padded[:, :width] = np.lib.stride_tricks.sliding_window_view(body, width)[starts]
        order, group = multikey_order(padded.view(">u8").astype(np.uint64))
        doc = np.array([places[0][0] for _, places in ready])[owner[order]]
        least = np.minimum.reduceat(doc, np.flatnonzero(np.r_[True, group[1:] != group[:-1]]))
        covered = np.zeros(len(starts), bool)
        covered[order] = doc > least[group]
        change = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0]) | np.r_[0, (owner[1:] != owner[:-1]), 0])
        for a, b in zip(change[:-1].tolist(), change[1:].tolist()):
            if covered[a]:
                for d, k, f in ready[owner[a]][1]:
                    out.append((d, k, f + int(inside[a]), b - a, None))
        ready, n_ready = [], 0

    lead, contexts, too_many = None, {}, False
    for batch in batches:
        # what an earlier row of the batch has is covered, and needs no step of its own
        sure = _had_before(batch)
        late = batch.filter(pa.array(sure))
        yield pa.RecordBatch.from_arrays([*late.columns[2:], pa.nulls(late.num_rows, pa.binary())], names)
        batch = batch.filter(pa.array(~sure))
        columns = [batch.column(i).to_pylist() for i in range(6)]
        for now, context, doc, key, first, count in zip(*columns):
            if now != lead:
                if len(contexts) > 1:
                    ready += contexts.items()
                    n_ready += sum(len(c) - width + 1 for c in contexts)
                    if n_ready > 150_000:
                        compare()
                lead, contexts, too_many = now, {}, False
            if too_many:
                out.append((doc, key, first, 0, context))
                continue
            places = contexts.get(context)
            if places is None:
                contexts[context] = [(doc, key, first)]
                if len(contexts) > gathered:
                    out += [(*p, 0, c) for c, ps in contexts.items() for p in ps]
                    contexts, too_many = {}, True
            elif doc > places[0][0]:
                out.append((doc, key, first, count, None))
            else:
                places.append((doc, key, first))
        yield batch_of(out)
        out = []
    if len(contexts) > 1:
        ready += contexts.items()
    compare()
    yield batch_of(out)


def _emit_strings(batches, width: int):
    """Every string of the contexts that were too many."""
    import pyarrow as pa

    for batch in batches:
        for doc, key, first, context in zip(*(batch.column(i).to_pylist() for i in range(4))):
            n = len(context) - width + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([context[i : i + width] for i in range(n)], pa.binary()), pa.array([doc] * n, pa.int64()),
                pa.array([key] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()),
            ], ["string", "doc_id", "key", "first"])


def _pack(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        pack = zstandard.ZstdCompressor(level=1).compress
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([pack(t) for t in batch.column(2).to_pylist()], pa.binary())],
            ["doc_id", "key", "packed"],
        )


def _cut(batches, width: int):
    """Remove the covered bytes: spans are unions of overlapping strings."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
    for batch in batches:
        unpack = zstandard.ZstdDecompressor().decompress
        out: list[list] = [[], [], [], []]
        for doc, packed, covered in zip(*(batch.column(i).to_pylist() for i in range(3))):
            text = unpack(packed)
            spans: list[dict] = []
            for run in sorted(covered or [], key=lambda r: r["first"]):
                start, end = run["first"], run["first"] + run["count"] + width - 1
                if spans and start <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], end)
                else:
                    spans.append({"start": start, "end": end})
            edges = [0, *(x for s in spans for x in (s["start"], s["end"])), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            for column, value in zip(out, (doc, len(text), spans, kept)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "n_bytes", "spans", "kept"])


def covered_starts(rows: DataFrame, packed: DataFrame, width: int, gathered: int = GATHERED) -> DataFrame:
    """``(doc_id, key, first, count)``: runs of string starts to remove.

    The key, 64 bits of the text, stands for the text where anchors are counted:
    an anchor would be lost only if exactly the two texts that share it had one
    key. Whole texts are equal if 128 bits and the length are."""
    found = rows.select("key", "text").mapInArrow(lambda it: _emit_anchors(it, width), "anchor long, key long")
    repeated = found.repartition("anchor").sortWithinPartitions("anchor", "key").mapInArrow(
        _repeated, "anchor long, key long"
    )
    # each text is looked at in the smallest document that has it
    texts = written(
        rows.filter(F.octet_length("text") >= width).select(
            "doc_id", "key", F.xxhash64(F.lit(1), "text").alias("key2"),
            (F.octet_length("text") - width + 1).cast("long").alias("count"),
        ), "texts",
    )
    firsts = texts.groupBy("key", "key2", "count").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last"))
    several = firsts.filter("least < last").drop("last")
    copies = texts.join(several, ["key", "key2", "count"]).filter("doc_id > least").select(
        "doc_id", "key", F.lit(0).cast("long").alias("first"), "count"
    )
    # dealt again by text as plain rows: lists would be built twice
    anchors = repeated.repartition("key").groupBy("key").agg(F.collect_list("anchor").alias("anchors"))
    wanted = written(
        anchors.join(firsts.select(F.col("key").alias("k"), F.col("least").alias("doc_id")), F.col("key") == F.col("k"))
        .select("doc_id", "key", "anchors"), "anchors",
    )
    # written, as Spark samples the splitters in a pass of its own
    contexts = written(
        packed.join(wanted, ["doc_id", "key"]).select("doc_id", "key", "packed", "anchors").mapInArrow(
            lambda it: _emit_contexts(it, width), f"lead binary, context binary, {ID}, first long, count long"
        ), "contexts",
    )
    ranges = contexts.repartitionByRange("lead").sortWithinPartitions("lead", "doc_id")
    sorted_out = written(
        ranges.mapInArrow(lambda it: _sorted_bucket(it, width, gathered), f"{ID}, first long, count long, context binary"),
        "covered",
    )
    many = sorted_out.filter("context is not null").select("doc_id", "key", "first", "context").mapInArrow(
        lambda it: _emit_strings(it, width), f"string binary, {ID}, first long"
    )
    least = many.groupBy("string").agg(F.min("doc_id").alias("least"))
    late = many.join(least, "string").filter("doc_id > least").select("doc_id", "key", "first", F.lit(1).cast("long").alias("count"))
    alone = sorted_out.filter("context is null").select("doc_id", "key", "first", "count")
    return alone.unionByName(late).unionByName(copies)


def remove_repeats(
    docs: DataFrame, width: int = 50, text: str = "text", doc_id: str = "doc_id",
    gathered: int = GATHERED,
) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row: the maximal runs of
    bytes covered by a string of ``width`` bytes that also starts in a document
    with a smaller doc_id, and the UTF-8 bytes that remain.

    Strings are judged on the input; matches never cross documents. A null text
    is empty; texts shorter than ``width`` lose nothing. Rows without an id come
    after all others: they lose what those have, and take nothing from each
    other, as rows that share an id. Rows equal in id and text get the same
    result. An empty table gives an empty result; other columns are not looked
    at. Texts are never cut; a text is held by one task at a time.
    """
    if width < 2 * TOKEN:
        raise ValueError(f"width must be {2 * TOKEN} or more")
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), text_key(F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    packed = rows.mapInArrow(_pack, f"{ID}, packed binary")
    covered = covered_starts(rows, packed, width, gathered)
    per_doc = covered.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("first", "count")).alias("covered")
    ).select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "covered")
    joined = packed.join(per_doc, (F.col("doc_id") == F.col("d")) & (F.col("key") == F.col("k")), "left")
    done = joined.select("doc_id", "packed", "covered").mapInArrow(
        lambda it: _cut(it, width),
        "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary",
    )
    return done.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
