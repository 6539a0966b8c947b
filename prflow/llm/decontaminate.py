"""Benchmark decontamination by latent semantic retrieval.

1. Words of all documents become 32-bit hashes, written once per document.
2. Passages of PASSAGE words form the TF-IDF matrix A (words by their low bits).
   One pass sums A'A times a random test matrix over all passages; the Nystrom
   form of the randomised SVD gives the right singular vectors from that sum.
3. Benchmark items are projected into the latent space, and windows of all
   documents, in steps of STEP words, are searched for cosines of NEAR or more.
4. Candidates are verified by the longest common subsequence of whole items
   with the words around the window. A text that keeps most of an item in order
   is a leak; one that keeps part of it is a paraphrase if the item's answer,
   its last sentence, is there too. Long items are searched in parts, and what
   is kept of the parts is added up for the item.
5. Short items, which say too little for a cosine, are found word for word.

Sums have the size of the vocabulary and of the latent space, whatever the
number of documents. Items are the stated query set, searched in blocks.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prflow.llm.common import boxed, same_document, text_key, written

TERMS = 8_192  # columns of the TF-IDF matrix; words share them by hash
RANK = 64
PASSAGE = 48
STEP = 12
LONGEST = 96  # words of one search window; longer items are searched in parts
GROUP = 1 << 16  # words searched at once: short texts together, long ones in overlapping parts
WINDOWS = 4_096  # windows multiplied with the items at once
NEAR = 0.55
VERBATIM = 0.8  # share of an item's words kept in order: a leak
PARAPHRASED = 0.6  # with the answer present
ANSWERED = 0.8
ITEMS = 2_000  # items of one block of the query set
SHORTEST = 8  # items with fewer words are found word for word only
ALONE = 4  # and with fewer than these, which any text may hold, as a whole text
FEATURES = "doc_id long, key long, words binary"
PLAIN = bytes(b for b in range(33, 127) if not chr(b).isalnum())


def hashed(text: str | None):
    """Hashes of the words, lower case, without ASCII punctuation."""
    import numpy as np

    found = (text or "").lower().encode().translate(None, PLAIN).split()
    return np.fromiter(map(crc32, found), np.uint32, len(found))


def features(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(F.col(text)).alias("key"), F.col(text).alias("text"))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            words = [hashed(t).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.binary())], FIELDS)

    return rows.mapInArrow(run, FEATURES)


FIELDS = ["doc_id", "key", "words"]


def _passages(batches):
    """Whole passages of the documents, stacked; what is left of a document is
    filled up with its own last words, so no text is skipped."""
    import numpy as np

    stack, n = [], 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            words = np.frombuffer(raw, np.uint32) & (TERMS - 1)
            whole = len(words) // PASSAGE * PASSAGE
            if whole:
                stack.append(words[:whole].reshape(-1, PASSAGE))
            if whole < len(words):
                stack.append(np.resize(words[-PASSAGE:], (1, PASSAGE)))
            n += -(-len(words) // PASSAGE)
            if n >= 4096:
                yield np.concatenate(stack)
                stack, n = [], 0
    if stack:
        yield np.concatenate(stack)


def _term_counts(batches):
    """How many passages of the task hold each term."""
    import numpy as np
    import pyarrow as pa

    counts, n = np.zeros(TERMS, np.int64), 0
    for passages in _passages(batches):
        ordered = np.sort(passages, axis=1)
        first = np.ones(ordered.shape, bool)
        first[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        counts += np.bincount(ordered[first], minlength=TERMS)
        n += len(passages)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(-1, TERMS), pa.int64()), pa.array(np.r_[n, counts], pa.int64())], ["term", "n"]
    )


def _projected_sums(batches, idf, seed: int):
    """The task's share of A'A times the test matrix, a vector per term."""
    import numpy as np
    import pyarrow as pa

    test = np.random.default_rng(seed).standard_normal((TERMS, RANK)).astype(np.float32) * idf[:, None]
    total = np.zeros((RANK, TERMS))
    for passages in _passages(batches):
        size = (idf[passages] ** 2).sum(axis=1, keepdims=True)
        seen = np.ascontiguousarray((test[passages].sum(axis=1) / size).T, np.float64)
        flat = passages.ravel().astype(np.int64)
        for j in range(RANK):
            total[j] += np.bincount(flat, np.repeat(seen[j], PASSAGE), TERMS)
    total = np.ascontiguousarray((total * idf).T)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(TERMS), pa.int64()), pa.array([v.tobytes() for v in total], pa.binary())], ["term", "sum"]
    )


def _added(batches):
    """Vectors of the terms of this partition, added up as they come."""
    import numpy as np
    import pyarrow as pa

    total: dict = {}
    for batch in batches:
        for term, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            vector = np.frombuffer(raw)
            total[term] = total[term] + vector if term in total else vector
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int64()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["term", "sum"]
    )


def latent_space(found: DataFrame, seed: int = 7):
    """TERMS x RANK weights that take term counts into the latent space: IDF
    times right singular vectors, each scaled by its singular value, so that
    the words of a language do not outweigh those of a topic. The driver gets
    TERMS numbers and TERMS vectors of RANK numbers, no more."""
    import numpy as np

    words = found.select("words")
    counts = words.mapInArrow(_term_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(TERMS + 1)
    for row in counts:
        df[row["term"]] = row["n"]
    idf = np.log((df[TERMS] + 1) / (df[:TERMS] + 1)).astype(np.float32)
    idf = np.maximum(idf, np.float32(0.05))
    sums = words.mapInArrow(lambda it: _projected_sums(it, idf, seed), "term long, sum binary")
    sums = sums.repartition("term").mapInArrow(_added, "term long, sum binary").collect()
    sketch = np.zeros((TERMS, RANK))
    for row in sums:
        sketch[row["term"]] = np.frombuffer(row["sum"])
    test = np.random.default_rng(seed).standard_normal((TERMS, RANK)).astype(np.float32).astype(float)
    core = test.T @ sketch
    core = (core + core.T) / 2
    shift = 1e-9 * max(np.trace(core), 1e-9)
    factor = np.linalg.cholesky(core + shift * np.eye(RANK)) if df[TERMS] else np.eye(RANK)
    left, values, _ = np.linalg.svd(np.linalg.solve(factor, sketch.T).T, full_matrices=False)
    return (left / np.maximum(values, 1e-6) * idf[:, None]).astype(np.float32)


class Pieces:
    """Items in parts of at most LONGEST words, ready to be searched."""

    def __init__(self, items: list[tuple], space) -> None:
        import numpy as np

        self.ids, self.total, self.answer = [], [], []  # of each item
        self.of, self.words, need = [], [], []  # of each part
        self.short: dict = {}  # number of words: [(words, item)]
        for item_id, text in items:
            words = hashed(text)
            if not len(words):
                continue
            sentences = [s for s in text.replace("\n", ". ").split(". ") if s.strip()]
            item = len(self.ids)
            self.ids.append(item_id)
            self.total.append(len(words))
            self.answer.append(set(hashed(sentences[-1]).tolist()))
            if len(words) < STEP:
                self.short.setdefault(len(words), []).append((words, item))
            if len(words) < SHORTEST:
                continue
            parts = np.array_split(words, -(-len(words) // LONGEST))
            for part in parts:
                self.of.append(item)
                self.words.append(part)
                # a part may keep less than its item
                need.append(len(part) * PARAPHRASED / (1 if len(parts) == 1 else 2))
        self.need = np.array(need)
        # parts searched by windows of so many steps; a short one also by two,
        # so that it lies whole in some window
        steps = np.array([max(1, round(len(w) / STEP)) for w in self.words], np.int64)
        self.by_steps = {int(n): np.flatnonzero(steps == n) for n in np.unique(steps)}
        if 1 in self.by_steps:
            self.by_steps[2] = np.flatnonzero(steps <= 2)
        self.has = np.zeros((len(self.words), TERMS), bool)
        for i, w in enumerate(self.words):
            self.has[i, w & (TERMS - 1)] = True
        self.vectors = np.stack([_unit(space[w & (TERMS - 1)].sum(axis=0)) for w in self.words]) if self.words else None
        self.bits = []
        for w in self.words:
            places: dict = {}
            for j, word in enumerate(w.tolist()):
                places[word] = places.get(word, 0) | 1 << j
            self.bits.append(places)

    def overlap(self) -> int:
        """Words that two parts of a long text share, so that one of them has
        each window with the words around it."""
        return (max(self.by_steps, default=1) + 3) * STEP


def _unit(v):
    import numpy as np

    return v / np.maximum(np.linalg.norm(v, axis=-1, keepdims=True), 1e-9)


def common_subsequence(places: dict, length: int, words: list) -> int:
    """Length of the longest common subsequence; ``places`` has the bit set of
    an item's positions of each word. One step of bit arithmetic per word."""
    full = (1 << length) - 1
    state = full
    for word in words:
        match = places.get(word)
        if match:
            both = state & match
            state = (state + both | state - both) & full
    return length - state.bit_count()


def _block_sums(terms, edge, end, space):
    """Sums of the vectors of the STEP terms from each edge on, or up to the end
    of its text. The terms of all blocks are added column by column, in order;
    a text's last block is filled up with a term of no weight."""
    import numpy as np

    place = edge[:, None] + np.arange(STEP)
    term = np.where(place < end[:, None], terms[np.minimum(place, len(terms) - 1)], len(space))
    weights = np.concatenate([space, np.zeros((1, space.shape[1]), space.dtype)])
    sums = weights[term[:, 0]]
    for column in term.T[1:]:
        sums += weights[column]
    return sums


def _candidates(words, first, sizes, pieces: Pieces, space):
    """(text, part, start, stop) of windows near a part of an item that share
    enough words with it; texts lie in ``words`` one after the other."""
    import numpy as np

    n_blocks = -(-sizes // STEP)
    owner = np.repeat(np.arange(len(sizes)), n_blocks)
    inside = np.arange(len(owner)) - (np.cumsum(n_blocks) - n_blocks)[owner]
    edge = first[owner] + inside * STEP
    terms = words & (TERMS - 1)
    block = _block_sums(terms, edge, (first + sizes)[owner], space)
    run = np.concatenate([np.zeros((1, block.shape[1])), np.cumsum(block, axis=0, dtype=np.float64)])
    for size, mine in pieces.by_steps.items():
        span = np.minimum(size, n_blocks)
        places = np.flatnonzero(inside <= (n_blocks - span)[owner])
        width = (size + 2) * STEP
        for low in range(0, len(places), WINDOWS):
            at = places[low : low + WINDOWS]
            window = _unit((run[at + span[owner[at]]] - run[at]).astype(np.float32))
            row, part = np.nonzero(window @ pieces.vectors[mine].T >= NEAR)
            at, part = at[row], mine[part]
            for a in range(0, len(at), GROUP):
                block_no, p = at[a : a + GROUP], part[a : a + GROUP]
                text = owner[block_no]
                start = np.maximum(edge[block_no] - STEP, first[text])
                stop = np.minimum(start + (span[text] + 2) * STEP, first[text] + sizes[text])
                # an item's words around the window bound what can be common
                reach = start[:, None] + np.arange(width)
                in_window = reach < stop[:, None]
                reach = np.minimum(reach, len(terms) - 1)
                shared = (pieces.has[p[:, None], terms[reach]] & in_window).sum(axis=1)
                good = np.flatnonzero(shared >= pieces.need[p])
                yield from zip(*(x[good].tolist() for x in (text, p, start, stop)))


def _word_for_word(words, first, sizes, wholes, pieces: Pieces):
    """(text, item, start) of the short items; ``wholes`` tells texts that are
    not parts of longer ones."""
    import numpy as np

    for n, asked in pieces.short.items():
        if len(words) < n:
            continue
        mixed = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i]
        for item_words, item in asked:
            name = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in item_words:
                    name = name * np.uint64(0x9E3779B97F4A7C15) + np.uint64(w)
            for at in np.flatnonzero(mixed == name).tolist():
                text = int(np.searchsorted(first, at, "right")) - 1
                if at + n > first[text] + sizes[text] or (words[at : at + n] != item_words).any():
                    continue
                if n >= ALONE or wholes[text] and sizes[text] == n:
                    yield text, item, at


def _search(slices: list[tuple], pieces: Pieces, space) -> dict:
    """Of (text, offset, words, whether it is the whole text): the best
    (words kept, words of the answer, start) of each (text, part of an item)
    and, with part None, of each (text, short item)."""
    import numpy as np

    sizes = np.array([len(w) for _, _, w, _ in slices], np.int64)
    first = np.cumsum(sizes) - sizes
    words = np.concatenate([w for _, _, w, _ in slices])
    best: dict = {}
    for i, item, at in _word_for_word(words, first, sizes, [s[3] for s in slices], pieces):
        text, offset = slices[i][:2]
        best.setdefault((text, item, None), (pieces.total[item], pieces.answer[item], int(at - first[i]) + offset))
    for i, p, start, stop in _candidates(words, first, sizes, pieces, space) if pieces.words else ():
        around = words[start:stop].tolist()
        length = len(pieces.words[p])
        kept = common_subsequence(pieces.bits[p], length, around)
        item = pieces.of[p]
        if kept >= pieces.need[p]:
            text, offset = slices[i][:2]
            answer = pieces.answer[item].intersection(around)
            old = best.get((text, item, p))
            if old is None or (kept, len(answer)) > (old[0], len(old[1])):
                best[text, item, p] = (kept, answer, int(start - first[i]) + offset)
    return best


def _judged(best: dict, pieces: Pieces):
    """(text, item, kept share, answered share, start): parts added up by item."""
    items: dict = {}
    for (text, item, _), (kept, answer, start) in best.items():
        old = items.get((text, item), (0, frozenset(), start))
        items[text, item] = (old[0] + kept, old[1] | answer, min(old[2], start))
    for (text, item), (kept, answer, start) in items.items():
        kept = min(1.0, kept / pieces.total[item])
        answered = len(answer) / len(pieces.answer[item]) if pieces.answer[item] else 0.0
        if kept >= VERBATIM or kept >= PARAPHRASED and answered >= ANSWERED:
            yield text, pieces.ids[item], kept, answered, start


def _found(batches, items: list[tuple], space):
    import numpy as np
    import pyarrow as pa

    pieces = Pieces(items, space)
    overlap = pieces.overlap()
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
    for batch in batches:
        docs, keys, raws = (batch.column(i).to_pylist() for i in range(3))
        best: dict = {}
        slices, n = [], 0

        def searched():
            nonlocal slices, n
            for name, found in (_search(slices, pieces, space) if slices else {}).items():
                if name not in best or found[0] > best[name][0]:
                    best[name] = found
            slices, n = [], 0

        for i, raw in enumerate(raws if pieces.ids else ()):
            words = np.frombuffer(raw, np.uint32)
            for offset in range(0, len(words), GROUP):
                part = words[offset : offset + GROUP + overlap]
                slices.append((i, offset, part, len(part) == len(words)))
                n += len(part)
                if n >= GROUP:
                    searched()
        searched()
        rows = [(docs[i], keys[i], *found) for i, *found in _judged(best, pieces)]
        columns = zip(*rows) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], FOUND)


FOUND = ["doc_id", "key", "item_id", "kept", "answered", "start"]


def leaks(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, key, item_id, kept, answered, start)``: documents that hold a
    benchmark item, the share of the item's words kept in order, the share of
    its answer's words, and the word where the first window starts. ``key``
    tells rows with one id apart.

    Null and empty texts hold nothing. Items of more than LONGEST words are
    searched in parts, each where the text keeps most of it; the parts' words
    add up. Items with fewer than STEP words are also looked for word for word;
    with fewer than SHORTEST only so, and with fewer than ALONE they have to be
    the whole text. Items without a word are in no text. Rows equal in id and text are one document; equal items are
    each found. Empty tables give an empty result. Whole texts are searched,
    with no limit on candidates. Other columns are not looked at.
    """
    spark: SparkSession = docs.sparkSession
    found = written(features(docs, text, doc_id), "words")
    space = latent_space(found)
    asked = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    asked = asked.filter("item_id is not null and text is not null").distinct()
    n = -(-asked.count() // ITEMS)
    out = spark.createDataFrame([], "doc_id long, key long, item_id long, kept double, answered double, start long")
    for block in range(n):
        # about ITEMS rows of the query set, whatever its size
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        items = [(r["item_id"], r["text"]) for r in mine.collect()]
        searched = found.mapInArrow(lambda it, items=items: _found(it, items, space), out.schema)
        out = out.unionByName(searched) if block else searched
    best = F.max(F.struct("kept", "answered", (-F.col("start")).alias("start"))).alias("best")
    return out.groupBy("doc_id", "key", "item_id").agg(best).select(
        "doc_id", "key", "item_id", "best.kept", "best.answered", (-F.col("best.start")).alias("start")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, columns untouched."""
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct()
    return boxed(docs).join(bad, same_document("d", "k"), "left_anti").select("row.*")
