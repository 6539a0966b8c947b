"""Substring deduplication by MinHash banding of paragraphs.

Repeated passages rarely start where a line starts, so paragraphs are cut by
content: each of LENGTH words, at the word pairs whose hash is among the lowest
1 / RARE, and at the lowest pair of CUT neighbours that hold none of these. A
rare pair starts a paragraph whatever is around it, so copies of a passage hold
the same paragraphs. Any run of CUT + LENGTH words that two documents share holds
one paragraph in both. Texts also start one at their first word, so that whole
copies go from their start on, short ones too.

Each paragraph has BANDS minima of its five-word shingles; a band of one row
already tells prose apart, and BANDS of them find a similarity of 0.8 with a
probability of 0.99. Paragraphs that collide across documents are verified by
exact Jaccard similarity and clustered by connected components; the first
occurrence of a cluster stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import discard, text_key, written
from prflow.llm.components import components
from prflow.llm.decontaminate import hashed

SHINGLE = 5
CUT = 16
RARE = 8
LENGTH = 25
LEAST = 17  # at the end of a text; at its start one shingle is enough
BANDS = 3
SIMILAR = 0.8
PAIRED = 64  # contents of a band that form pairs at once
STARS = 2  # centres a larger band gets one after the other
SETS = 1 << 14  # sets that are made at once
PART = 1 << 22  # words of a text that are looked at together
NO_ID = (1 << 63) - 1
ID = "doc_id long, key long"


def _mixed(x, salt: int):
    import numpy as np

    x = (x ^ np.uint64(salt)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def _shingles(words):
    import numpy as np

    n = len(words)
    out = words[: n - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : n - SHINGLE + 1 + i]
    return _mixed(out, 0x77)


def _lowest(values, width: int):
    """The least of each ``width`` neighbours."""
    import numpy as np

    done = 1
    while done < width and len(values):
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:])
        done += step
    return values


def _paragraphs(parts: list[tuple]):
    """For word hashes of several parts of texts, each with the range of places
    where its paragraphs may start: all words, their shingles, and per part the
    range of its paragraphs (start and end, counted in all words)."""
    import numpy as np

    lengths = np.array([len(words) for words, _, _ in parts], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    words = np.concatenate([words for words, _, _ in parts]).astype(np.uint64) if parts else np.zeros(0, np.uint64)
    n = len(words)
    if n < SHINGLE:
        none = np.zeros(0, np.int64)
        return words, words, none, none, np.zeros(len(parts) + 1, np.int64)
    owner = np.repeat(np.arange(len(parts)), lengths)
    pair = _mixed(np.r_[np.uint64(0), words[:-1]] * np.uint64(0x9E3779B97F4A7C15) + words, 0x51)
    place = np.uint64((1 << 24) - 1)
    least = _lowest((pair & ~place) | np.arange(n, dtype=np.uint64), CUT)
    at = np.arange(len(least))
    inside = (at + CUT <= ends[owner[: len(least)]]) & (at > begins[owner[: len(least)]])
    texts = begins[(lengths > 0) & np.array([low == 0 for _, low, _ in parts])]
    rare = np.flatnonzero((pair < np.uint64((1 << 64) // RARE)) & (np.arange(n) > begins[owner]))
    # of windows that hold a rare pair the lowest is rare itself
    starts = np.unique(np.r_[rare, (least[inside] & place).astype(np.int64), texts])
    ending = np.minimum(starts + LENGTH, ends[owner[starts]])
    own = starts - begins[owner[starts]]
    low, high = (np.array([p[i] for p in parts], np.int64)[owner[starts]] for i in (1, 2))
    enough = ending - starts >= np.where((own == 0) & (low == 0), SHINGLE, LEAST)
    keep = enough & (own >= low) & (own < high)
    starts, ending = starts[keep], ending[keep]
    bounds = np.searchsorted(starts, np.r_[0, ends])
    return words, _shingles(words), starts, ending, bounds


def _contents(words, starts, ending):
    """A 64-bit name of each paragraph's words."""
    import numpy as np

    names = np.zeros(len(starts), np.uint64)
    for i in range(LENGTH):
        at = starts + i
        word = words[np.minimum(at, len(words) - 1)]
        names = np.where(at < ending, _mixed(names * np.uint64(0x9E3779B97F4A7C15) + word, 0x2D + i), names)
    return names.view(np.int64)


def _grouped(texts, most: int = 1 << 20):
    """Documents in groups whose words fit the place bits."""
    group, n = [], 0
    for i, t in enumerate(texts):
        if group and n + len(t) > most:
            yield group
            group, n = [], 0
        group.append(i)
        n += len(t)
    if group:
        yield group


def _parts(words):
    """A text with more words than the place bits is cut into parts that also
    see their neighbours' words: (offset, (part, first place, end of places)).
    All parts together have the paragraphs of the whole."""
    for a in range(0, max(1, len(words)), PART):
        since = max(0, a - CUT)
        yield since, (words[since : a + PART + CUT + LENGTH], a - since, a - since + PART)


def _found(texts):
    """Groups of paragraphs of the texts: (row, start, length, content, bands),
    ``row`` being the text's place and ``bands`` one array for each band."""
    import numpy as np

    parts = [(i, at, part) for i, t in enumerate(texts) for at, part in _parts(hashed(t))]
    for group in _grouped([p[0] for _, _, p in parts]):
        words, shingles, starts, ending, bounds = _paragraphs([parts[g][2] for g in group])
        if not len(starts):
            continue
        counts = np.diff(bounds)
        row = np.repeat([parts[g][0] for g in group], counts)
        first = np.cumsum([0, *(len(parts[g][2][0]) for g in group)])[:-1]
        local = starts - np.repeat(first, counts) + np.repeat([parts[g][1] for g in group], counts)
        cuts = np.empty(2 * len(starts), np.int64)
        cuts[::2], cuts[1::2] = starts, ending - SHINGLE + 1
        bands = []
        for b in range(BANDS):
            value = np.append(_mixed(shingles, 0x9E3779B97F4A7C15 * (b + 1) % (1 << 64)), np.uint64(0))
            bands.append(_mixed(np.minimum.reduceat(value, np.minimum(cuts, len(value) - 1))[::2], b).view(np.int64))
        yield row, local, (ending - starts).astype(np.int32), lambda: _contents(words, starts, ending), bands


def _emit_bands(batches):
    """The bands of each document. Neighbouring paragraphs overlap and mostly
    have the same minimum: a band is a row once for a run of them."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row, _, _, _, bands in _found(batch.column(2).to_pylist()):
            other = row[1:] != row[:-1]
            new = [np.r_[True, other | (band[1:] != band[:-1])] for band in bands]
            rows = np.concatenate([row[n] for n in new])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([b[n] for b, n in zip(bands, new)])), pa.array(ids[rows]), pa.array(keys[rows])],
                ["band", "doc_id", "key"],
            )


def _emit_hits(batches):
    """The paragraphs of documents that have one of the asked bands, with those
    of their bands that are asked. Each document that has a band asks for it, so
    a batch can be looked at as a whole."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    for batch in batches:
        unpack = zstandard.ZstdDecompressor().decompress
        ids, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        asked = np.unique(batch.column(3).flatten().to_numpy())
        for row, start, length, contents, bands in _found([unpack(t).decode() for t in batch.column(2).to_pylist()]):
            hit = np.stack([np.isin(band, asked) for band in bands], axis=1)
            keep = hit.any(axis=1)
            hit = hit[keep]
            ends = np.cumsum(np.r_[0, hit.sum(axis=1)]).astype(np.int32)
            own = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.stack(bands, axis=1)[keep][hit]))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids[row[keep]]), pa.array(keys[row[keep]]), pa.array(start[keep]), pa.array(length[keep]),
                pa.array(contents()[keep]), own,
            ], ["doc_id", "key", "start", "length", "content", "band"])


def _colliding(batches):
    """Rows come sorted by band and document: pass on bands of several
    documents. Only rows of a band's first document wait."""
    import numpy as np
    import pyarrow as pa

    waiting, open_band = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy() for c in batch.columns]
        if waiting is not None:
            columns = [np.concatenate(pair) for pair in zip(waiting, columns)]
        band, doc, key = columns[:3]
        first = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
        last = np.r_[first[1:], len(band)] - 1
        several = (doc[first] != doc[last]) | (key[first] != key[last])
        if open_band is not None and open_band == band[0]:
            several[0] = True
        keep = np.repeat(several, last - first + 1)
        if several[-1]:
            waiting, open_band = None, band[-1]
        else:
            waiting, open_band = [c[first[-1] :] for c in columns], None
        yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], batch.schema.names)


def _sets(words, starts, lengths):
    """The distinct shingles of each window of ``words``, one after the other in
    the order of the text, and where each window's end."""
    import numpy as np

    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(1, np.int32)
    shingles = _shingles(words)
    places = np.arange(lengths.max() - SHINGLE + 1)
    inside = places < (lengths - SHINGLE + 1)[:, None]
    values = shingles[np.minimum(starts[:, None] + places, len(shingles) - 1)]
    again = np.sort(np.where(inside, values, values[:, :1]), axis=1)
    spare = inside.shape[1] - inside.sum(axis=1)  # places that hold the first shingle once more
    for i in np.flatnonzero((again[:, 1:] == again[:, :-1]).sum(axis=1) > spare):
        first = np.unique(values[i][inside[i]], return_index=True)[1]
        inside[i] = False
        inside[i, first] = True
    return values[inside].view(np.int64), np.cumsum(np.r_[0, inside.sum(axis=1)]).astype(np.int32)


def _windows(words, starts, lengths):
    """The words of each window as bytes, four for a word."""
    import numpy as np
    import pyarrow as pa

    places = np.arange(lengths.max(initial=0))
    inside = places < lengths[:, None]
    own = words[np.minimum(starts[:, None] + places, len(words) - 1)][inside].astype("<u4")
    ends = np.cumsum(np.r_[0, 4 * lengths]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(own)])


def _members(column):
    """The sets of a column, one after the other, and where each ends: lists are
    sets, bytes are the words of a window whose shingles are the set. Words are
    half the size of their shingles, which are made where they are compared."""
    import numpy as np
    import pyarrow as pa

    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(), np.cumsum(np.r_[0, column.value_lengths().to_numpy()])
    texts = column.to_pylist()
    lengths = np.array([len(t) // 4 for t in texts], np.int64)
    words = np.frombuffer(b"".join(texts), "<u4").astype(np.uint64)
    return _sets(words, np.cumsum(lengths) - lengths, lengths)


def _emit_members(batches):
    """A row for each member of a set, with what the set's row names."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        values, ends = _members(batch.column(1))
        owner = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(ends)))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(owner), pa.array(values)], [batch.schema.names[0], "shingle"])


def _shared(a, b):
    """How many members the sets of each row share. ``a`` and ``b`` are sets as
    ``_members`` gives them."""
    import numpy as np

    (x, x_ends), (y, y_ends) = a, b
    n, m = np.diff(x_ends), np.diff(y_ends)
    row = np.arange(len(n))
    both = np.empty((len(n), (n + m).max(initial=0)), np.int64)
    both[:] = np.r_[x, 0][x_ends[:-1], None]  # places that are left hold the first member once more
    both[np.repeat(row, n), np.arange(len(x)) - np.repeat(x_ends[:-1], n)] = x
    both[np.repeat(row, m), np.arange(len(y)) - np.repeat(y_ends[:-1] - n, m)] = y
    both.sort(axis=1)
    return np.where(n > 0, (both[:, 1:] == both[:, :-1]).sum(axis=1) - (both.shape[1] - n - m), 0)


def _verified(batches, similar: float):
    """The pairs ``(a, b)`` whose sets are similar."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        a, b = _members(batch.column(2)), _members(batch.column(3))
        both = _shared(a, b)
        keep = pa.array(both / (np.diff(a[1]) + np.diff(b[1]) - both) >= similar)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in range(2)], ["a", "b"])


def _emit_shingles(batches):
    """The words of each asked paragraph, with a sketch of its shingles."""
    import numpy as np
    import pyarrow as pa
    import zstandard

    for batch in batches:
        unpack = zstandard.ZstdDecompressor().decompress
        texts = [hashed(unpack(t).decode()) for t in batch.column(2).to_pylist()]
        asked = batch.column(3).flatten()
        start, length = (asked.field(n).to_numpy().astype(np.int64) for n in ("start", "length"))
        contents = asked.field("content").to_numpy()
        counts = batch.column(3).value_lengths().to_numpy()
        first = np.cumsum([0, *map(len, texts)])[:-1]
        words = np.concatenate(texts).astype(np.uint64) if texts else np.zeros(0, np.uint64)
        start = start + np.repeat(first, counts)
        for at in range(0, len(start), SETS):
            values, ends = _sets(words, start[at : at + SETS], length[at : at + SETS])
            bits = np.bitwise_or.reduceat(np.int64(1) << (values & 63), ends[:-1])
            yield pa.RecordBatch.from_arrays([
                pa.array(contents[at : at + SETS]), _windows(words, start[at : at + SETS], length[at : at + SETS]),
                pa.array(np.diff(ends)), pa.array(bits),
            ], ["content", "shingles", "size", "bits"])


def _pack(batches):
    import pyarrow as pa
    import zstandard

    for batch in batches:
        pack = zstandard.ZstdCompressor(level=1).compress
        packed = [pack((t or "").encode()) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "key", "packed"]
        )


def _by_band(hits: DataFrame) -> DataFrame:
    """``(band, content, at, last, copies)``: the first place of each content,
    its last document and the number of its places. ``band`` is one of its bands
    or the array of all of them, as the places have it."""
    return written(hits.groupBy("band", "content").agg(
        F.min(F.struct("doc_id", "key", "start", "length")).alias("at"), F.max(F.struct("doc_id", "key")).alias("last"),
        F.count("*").alias("copies"),
    ), "contents")


def _contested(contents: DataFrame) -> DataFrame:
    """``(band, content, copies, n, centre)`` of bands of several contents,
    with their number and the one with the most places."""
    bands = contents.groupBy("band").agg(F.count("*").alias("n"), F.max(F.struct("copies", "content")).alias("most"))
    return written(contents.select("band", "content", "copies").join(bands.filter("n > 1"), "band").select(
        "band", "content", "copies", "n", F.col("most.content").alias("centre")
    ), "bands")


def sketched(sets: DataFrame) -> DataFrame:
    """Sets with their size and a 64-bit map: the bit of each member is set."""
    bit = F.expr("aggregate(shingles, 0L, (bits, x) -> bits | shiftleft(1L, cast(pmod(x, 64) as int)))")
    return sets.withColumns({"size": F.size("shingles"), "bits": bit})


def _may_be_similar(size_a: str, bits_a: str, size_b: str, bits_b: str, similar: float) -> Column:
    own = F.floor((F.col(size_a) + F.col(size_b)) * ((1 - similar) / (1 + similar)) + F.lit(1e-9))
    return F.bit_count(F.col(bits_a).bitwiseXOR(F.col(bits_b))) <= own


def _side(sets: DataFrame, name: str, *columns: str) -> DataFrame:
    return sets.select(F.col("content").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])


def _near(pairs: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs ``(a, b)`` of contents that their maps do not tell apart. Members
    that only one of two similar sets has are at most ``(1 - similar) / (1 +
    similar)`` of both sizes, and the maps differ in no more bits: who differs in
    more is dropped before the sets are read."""
    maps = pairs.join(_side(sets, "a", "size", "bits"), "a").join(_side(sets, "b", "size", "bits"), "b")
    return maps.filter(_may_be_similar("size_a", "bits_a", "size_b", "bits_b", similar)).select("a", "b")


def _similar(near: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """The pairs ``(a, b)`` of contents whose shingles are similar."""
    near = written(near.distinct(), "near")  # the pairs' shuffle files go before the sets are dealt
    checked = near.join(_side(sets, "a", "shingles"), "a").join(_side(sets, "b", "shingles"), "b")
    checked = checked.select("a", "b", "shingles_a", "shingles_b")
    kind = dict(near.dtypes)["a"]
    links = written(checked.mapInArrow(lambda it: _verified(it, similar), f"a {kind}, b {kind}"), "links")
    discard(near)
    return links


def _either(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _links(bands: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Verified links ``(a, b)`` that connect all similar contents of a band.

    Bands with up to PAIRED contents form all pairs. Larger ones are compared
    with their centre; those that are not similar to it get a centre of their
    own, STARS times. Two contents that are connected by then need no comparison.
    Of the others, those are compared that share one of their rarest shingles
    (prefix filter: of two sets of n and m shingles that are similar, more than
    ``similar / (1 + similar) * (n + m)`` are the same, so already the rarest
    few have one in common). Before the rarest come those that only connected
    sets hold: these need no rows."""
    # the maps come along, so that pairs they tell apart are never dealt
    mapped = bands.join(sets.select("content", "size", "bits"), "content")
    few, many = mapped.filter(F.col("n") <= PAIRED), mapped.filter(F.col("n") > PAIRED)
    may_be = _may_be_similar("x.size", "x.bits", "y.size", "y.bits", similar)
    x, y = (few.select("band", "content", "size", "bits").alias(name) for name in ("x", "y"))
    found = x.join(y, "band").filter("x.content < y.content").filter(may_be).select(
        F.col("x.content").alias("a"), F.col("y.content").alias("b")
    )
    y = many.filter("content = centre").select("band", "content", "size", "bits").alias("y")
    stars = many.alias("x").join(y, "band").filter("x.content <> y.content").filter(may_be)
    stars = stars.select(*_either("x.content", "y.content"))
    links = _similar(found.unionByName(stars), sets, similar)
    many = bands.filter(F.col("n") > PAIRED)
    far = many.select("band", "content", "copies", "centre").filter("content <> centre")
    all_links = links
    for turn in range(STARS):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        far = written(far.join(
            both, (F.col("content") == F.col("a")) & (F.col("centre") == F.col("b")), "left_anti"
        ).select("band", "content", "copies"), "far")
        if turn == 0:
            first_far = far
        if turn + 1 == STARS or far.isEmpty():
            break
        centres = far.groupBy("band").agg(F.max(F.struct("copies", "content")).alias("most")).select(
            "band", F.col("most.content").alias("centre")
        )
        far = far.join(centres, "band").filter("content <> centre")
        links = _similar(_near(far.select(*_either("content", "centre")), sets, similar), sets, similar)
        all_links = all_links.unionByName(links)
    if first_far.isEmpty():
        return all_links

    dense = many.join(first_far.select("band").distinct(), "band", "left_semi").select("band", "content")
    dense = written(dense, "dense")
    inside = dense.select("content").distinct()
    near = all_links.join(inside, F.col("a") == F.col("content"), "left_semi").join(
        inside, F.col("b") == F.col("content"), "left_semi"
    )
    # a content of several dense bands is looked at once; that pairs share a band is asked of the similar ones
    rooted = inside.join(components(near), F.col("content") == F.col("node"), "left").select(
        "content", F.coalesce("root", "content").alias("root")
    )
    own = written(rooted.join(sets, "content").select("content", "root", F.col("size").alias("n"), "bits", "shingles"), "own")
    kind = dict(own.dtypes)["content"]

    def members(of: str) -> DataFrame:
        return own.select(of, "shingles").mapInArrow(_emit_members, f"{of} {kind}, shingle long")

    # what only connected sets hold brings no new link
    held = members("root").groupBy("shingle").agg(F.count("*").alias("f"), F.min("root").alias("r"), F.max("root").alias("s"))
    opened = written(held.filter("r < s").select("shingle", "f"), "open")
    # dealt as plain rows: lists would be built twice
    ranked = members("content").join(opened, "shingle").repartition("content").groupBy("content").agg(
        F.sort_array(F.collect_list(F.struct("f", "shingle"))).alias("s")  # one paragraph's shingles
    )
    exact = F.lit(1e-9)

    def least(n: Column) -> Column:
        return F.ceil(n * similar - exact)

    def same(n: Column, m: Column) -> Column:
        return F.ceil((n + m) * (similar / (1 + similar)) - exact).cast("int")

    # the prefix for the smallest partner holds those for all others; who has
    # which place in it is asked when two meet, so a shingle is a row once
    alone = F.col("n") - F.size("s")  # shingles of connected sets only come first
    longest = F.col("n") - same(F.col("n"), least(F.col("n"))) + 1
    keys = written(ranked.join(own.drop("shingles"), "content").select(
        "content", "root", "n", "bits", alone.alias("alone"),
        F.posexplode(F.slice("s", 1, F.greatest(longest - alone, F.lit(0)))),
    ).select("col.shingle", "content", "root", "n", "bits", (F.col("alone") + F.col("pos")).alias("place")), "keys")
    discard(own, opened)
    x, y = keys.alias("x"), keys.alias("y")
    n, m = F.col("x.n"), F.col("y.n")
    rest = x.join(y, "shingle").filter("x.root < y.root").filter((m >= least(n)) & (n >= least(m))).filter(
        (F.col("x.place") <= n - same(n, m)) & (F.col("y.place") <= m - same(n, m))
    ).filter(_may_be_similar("x.n", "x.bits", "y.n", "y.bits", similar)).select(*_either("x.content", "y.content"))
    found = _similar(rest, sets, similar)
    discard(keys)
    a, b = (dense.select(F.col("content").alias(name), "band") for name in ("a", "b"))
    return all_links.unionByName(found.join(a, "a").join(b, ["b", "band"]).select("a", "b"))


def repeated_paragraphs(
    docs: DataFrame, similar: float = SIMILAR, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``(doc_id, key, start, end, class_doc_id, class_key, class_start,
    removed)`` of each paragraph that repeats across documents: its words, from
    0, the first occurrence of its class (smallest doc_id, null last) and
    whether it goes, as all but the first do. ``key`` tells rows with one id
    apart. Paragraphs of one document may overlap; spans to remove are unions.

    Words are compared in lower case, without ASCII punctuation. Null texts,
    empty ones and those with fewer than SHINGLE words have no paragraph. Rows
    equal in id and text are one document. Equal words are told by a 64-bit
    hash. Ties go to the earlier paragraph. An
    empty table gives an empty result; other columns are not looked at. Texts
    are read whole, whatever their length.
    """
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("doc_id"), text_key(F.col(text)).alias("key"),
        F.col(text).alias("text"),
    )
    found = f"band long, {ID}"
    collisions = written(
        rows.mapInArrow(_emit_bands, found).repartition("band").sortWithinPartitions("band", "doc_id", "key").mapInArrow(
            _colliding, found
        ), "collisions",
    )
    packed = rows.mapInArrow(_pack, f"{ID}, packed binary")
    name = ["doc_id", "key"]

    def texts(asked: DataFrame) -> DataFrame:
        return packed.join(asked, name).dropDuplicates(name)

    own = texts(collisions.groupBy(*name).agg(F.collect_list("band").alias("asked")))
    hits = written(own.mapInArrow(_emit_hits, f"{ID}, start long, length int, content long, band array<long>"), "hits")
    discard(collisions)
    # exact copies have one content and need no shingles
    contents = _by_band(hits)
    bands = _contested(contents.withColumn("band", F.explode("band")))
    # each contested content is read at one of its places
    spots = contents.join(bands.select("content").distinct(), "content", "left_semi")
    asked = spots.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.key").alias("key")).agg(
        F.sort_array(F.collect_list(F.struct("at.start", "at.length", "content"))).alias("asked")  # neighbours share shingles
    )
    known = written(texts(asked).mapInArrow(_emit_shingles, "content long, shingles binary, size int, bits long"), "sets")
    units = hits.select("doc_id", "key", "start", (F.col("start") + F.col("length")).alias("end"), "content")
    roots = components(_links(bands, known, similar))
    discard(bands, known)
    spot = F.struct("doc_id", "key", "start")
    places = units.select(spot.alias("spot"), "end", "content")
    first = F.struct("at.doc_id", "at.key", "at.start")
    firsts = contents.select("content", first.alias("first"), "last").join(
        roots, F.col("content") == F.col("node"), "left"
    ).withColumn("class", F.coalesce("root", "content"))
    classes = firsts.groupBy(F.col("class").alias("c")).agg(F.min("first").alias("class_first"), F.max("last").alias("class_last"))
    several = (F.col("class_first.doc_id") != F.col("class_last.doc_id")) | (F.col("class_first.key") != F.col("class_last.key"))
    named = firsts.join(classes.filter(several), F.col("class") == F.col("c")).select(F.col("content").alias("n"), "class_first")
    named = written(named, "named")
    out = places.join(named, F.col("content") == F.col("n"))

    def real(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c))

    return out.select(
        real("spot.doc_id").alias("doc_id"), F.col("spot.key").alias("key"), F.col("spot.start").alias("start"), "end",
        real("class_first.doc_id").alias("class_doc_id"), F.col("class_first.key").alias("class_key"),
        F.col("class_first.start").alias("class_start"), (F.col("spot") != F.col("class_first")).alias("removed"),
    )
