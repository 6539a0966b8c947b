"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity.

Built-in functions only. Lines are compared in a normal form (lower case,
letters and digits). A line's SimHash is the majority of the hashes of its
different words; the counters of 64 bits are summed in 16 numbers of four
lanes. Fingerprints that differ in at most BITS bits agree on SHARED of
BITS + SHARED blocks, so they meet under the key of these; pairs that meet are
verified by the edit similarity of the whole lines. Of each connected group the
first occurrence stays.

A large block does not form pairs. Its members are verified against its first
one; only who fails is tried with the others within BITS bits. Two members that
are both similar to the first are connected through it, so all links between
different lines within BITS bits count, with rows in proportion to the block
and to its outsiders.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prflow.llm.common import boxed, let, same_document, text_key, written
from prflow.llm.components import components

BITS = 3
SHARED = 2  # more make longer and more keys: 2 give 10 keys of 25 bits, 3 give 20 of 32
SIMILAR = 0.8
PAIRED = 8  # members of a block that form all pairs
LOOSE = 16  # differing bits up to which a block's first member is tried
AHEAD = 8  # words that are looked at where two lines differ
LONG_WORD = 64  # characters; a longer word that differs counts as a whole
SEVEN = 7  # words counted at once: three bits hold their number
LANE = 16_383  # words of one count: lanes of 16 bits keep two bits free
LANES = [f"lane{i}" for i in range(16)]
MASK = 0x0001_0001_0001_0001


def normal(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _ids(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("key"), body.alias("text"))


def _lines(rows: DataFrame) -> DataFrame:
    """Lines: two hashes that together name the normal form, the hashes of its
    different words and their number ``n``. The words are read off the line in
    one walk and joined, which is the normal form without replacing anything; only
    hashes are made distinct and carried on."""
    each = rows.select("doc_id", "key", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    place = ["doc_id", "key", "line_no"]
    found = each.select(*place, F.regexp_extract_all(F.lower("line"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words"))
    named = found.select(
        *place, F.array_join("words", " ").alias("body"),
        F.array_distinct(F.transform("words", lambda w: F.xxhash64(w))).alias("hashes"),
    )
    return named.select(
        *place, F.xxhash64("body").alias("h1"), F.xxhash64(F.lit(1), "body").alias("h2"), "hashes", F.size("hashes").alias("n")
    )


def _planes(some: list[Column]) -> tuple[Column, Column, Column]:
    """Bits 1, 2 and 4 of how many of seven numbers have each bit set."""

    def added(x: Column, y: Column, z: Column) -> tuple[Column, Column]:
        either = x.bitwiseXOR(y)
        return either.bitwiseXOR(z), x.bitwiseAND(y).bitwiseOR(either.bitwiseAND(z))

    one, two_a = added(*some[:3])
    one, two_b = added(one, *some[3:5])
    one, two_c = added(one, *some[5:])
    return one, *added(two_a, two_b, two_c)


def fingerprinted(rows: DataFrame) -> DataFrame:
    """``(doc_id, key, line_no, h1, h2, fp)`` of lines with a word; h1 and h2
    are two independent hashes that together name the normal form.

    Seven words are one row to sum: how many of them have a bit is three numbers."""
    place = ["doc_id", "key", "line_no", "h1", "h2", "n"]
    ats = F.when(F.col("n") > 0, F.sequence(F.lit(0), F.col("n") - 1, F.lit(SEVEN)))
    sevens = _lines(rows).select(*place, "hashes", F.explode(ats).alias("at"))
    words = [F.coalesce(F.get("hashes", F.col("at") + i), F.lit(0).cast("long")) for i in range(SEVEN)]
    part = F.when(F.col("n") > LANE, (F.col("at") / LANE).cast("int")).otherwise(0)
    planes = sevens.select(*place, part.alias("part"), *[x.alias(f"word{i}") for i, x in enumerate(words)]).select(
        *place, "part", *[x.alias(c) for c, x in zip(("one", "two", "four"), _planes([F.col(f"word{i}") for i in range(SEVEN)]))]
    )

    def lane(i: int) -> Column:
        one, two, four = (F.shiftrightunsigned(c, i).bitwiseAND(F.lit(MASK)) for c in ("one", "two", "four"))
        return one + F.shiftleft(two, 1) + F.shiftleft(four, 2)

    summed = planes.groupBy(*place, "part").agg(*[F.sum(lane(i)).alias(x) for i, x in enumerate(LANES)])

    def counter(bit: int) -> Column:
        return F.shiftrightunsigned(F.get("lanes", F.lit(bit % 16)), bit // 16 * 16).bitwiseAND(F.lit(0xFFFF))

    def one(bit: int) -> int:
        return 1 << bit if bit < 63 else -(1 << 63)

    # bit 14 of a lane, set to 0x4000 + counter - least majority, is the vote
    least = F.floor(F.col("n") / 2).cast("long") + 1
    voted = F.lit(0).cast("long")
    for i, x in enumerate(LANES):
        votes = F.shiftrightunsigned(F.col(x) + F.lit(0x4000 * MASK) - least * F.lit(MASK), 14)
        voted = voted.bitwiseOR(F.shiftleft(votes.bitwiseAND(F.lit(MASK)), i))
    usual = F.col("n") <= LANE
    found = written(summed.select(
        *place, F.when(usual, voted).alias("fp"), F.when(~usual, F.array(*LANES)).alias("lanes")
    ), "lines")
    place.remove("n")
    # the parts of a line with more different words add up their counters
    bits = F.inline(F.array(*[F.struct(F.lit(one(b)).cast("long").alias("one"), counter(b).alias("c")) for b in range(64)]))
    long = found.filter(~usual).select(*place, "n", bits)
    long = long.groupBy(*place, "n", "one").agg(F.sum("c").alias("c"))
    long = long.groupBy(*place, "n").agg(F.bit_or(F.when(2 * F.col("c") > F.col("n"), F.col("one")).otherwise(0)).alias("fp"))
    return found.filter(usual).select(*place, "fp").unionByName(long.select(*place, "fp"))


def _blocks(bits: int, shared: int) -> list[Column]:
    """The keys, numbers of the column fp: any ``shared`` of bits + shared blocks
    side by side, above them which blocks these are."""
    n = bits + shared
    cuts = [64 * i // n for i in range(n + 1)]
    chosen = list(combinations(zip(cuts, cuts[1:]), shared))
    room = 64 - (len(chosen) - 1).bit_length()
    keys = []
    for i, blocks in enumerate(chosen):
        key, width = F.lit(0).cast("long"), 0
        for a, b in blocks:
            value = F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long"))
            key, width = key.bitwiseOR(F.shiftleft(value, width)), width + b - a
        if width > room:
            raise ValueError("blocks are too wide for a key")
        keys.append(key.bitwiseOR(F.shiftleft(F.lit(i).cast("long"), room)) if i else key)
    return keys


def _differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _index(prints: DataFrame, bits: int, shared: int) -> DataFrame:
    """``(block, fp, n, first)`` of blocks with several fingerprints."""
    index = prints.select("fp", F.explode(F.array(*_blocks(bits, shared))).alias("block"))
    same = Window.partitionBy("block")  # one number, which Spark sorts by its digits
    index = index.withColumn("n", F.count("*").over(same)).withColumn("first", F.min("fp").over(same))
    return written(index.filter("n > 1"), "blocks")


def _word_edits(x: str, y: str) -> Column:
    """Characters changed by turning the words of ``x`` into those of ``y`` from
    left to right: never less than the edit distance, and found in one pass
    where that takes length x bound. Where words differ, the next AHEAD words
    tell whether one was put in or left out; else one stands for the other."""

    def walked(both: Column) -> Column:
        a, b = both["a"], both["b"]

        def ahead(words: Column, at: Column, word: Column) -> Column:
            return F.array_position(F.slice(words, at + 2, F.lit(AHEAD)), word)

        def characters(words: Column, at: Column, n) -> Column:
            """Of ``n`` words from ``at`` on, each with its space."""
            return F.aggregate(F.slice(words, at + 1, n), F.lit(0), lambda sum_, w: sum_ + F.length(w) + 1)

        def instead(word: Column, other: Column) -> Column:
            longer = F.greatest(F.length(word), F.length(other))
            return F.when(longer <= LONG_WORD, F.levenshtein(word, other)).otherwise(longer)

        def step(state: Column, word: Column) -> Column:
            i, j, cost = state["i"], state["j"], state["cost"]
            other = F.get(b, j)

            def to(j: Column, cost: Column) -> Column:
                return F.struct((i + 1).alias("i"), j.cast("int").alias("j"), cost.cast("int").alias("cost"))

            def differing(found: Column) -> Column:
                put_in, left_out = found["put_in"].cast("int"), found["left_out"].cast("int")
                return F.when(
                    (put_in > 0) & ((left_out == 0) | (put_in <= left_out)), to(j + put_in + 1, cost + characters(b, j, put_in))
                ).when(left_out > 0, to(j, cost + F.length(word) + 1)).otherwise(to(j + 1, cost + instead(word, other)))

            found = F.struct(ahead(b, j, word).alias("put_in"), ahead(a, i, other).alias("left_out"))
            return F.when(word == other, to(j + 1, cost)).when(
                other.isNull(), to(j, cost + F.length(word) + 1)
            ).otherwise(let(found, differing))

        start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("cost"))
        return F.aggregate(a, start, step, lambda end: end["cost"] + characters(b, end["j"], F.size(b)))

    return let(F.struct(F.split(x, " ").alias("a"), F.split(y, " ").alias("b")), walked)


def _verified(pairs: DataFrame, bodies: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of lines whose edit similarity is high enough. Their
    words are compared first, which most similar lines pass; then a small bound
    is tried, and the whole one for those that are left."""
    checked = pairs.join(bodies.select(F.col("line").alias("a"), F.col("body").alias("x")), "a").join(
        bodies.select(F.col("line").alias("b"), F.col("body").alias("y")), "b"
    ).withColumn("bound", similarity_bound("x", "y", similar))
    close = checked.filter(F.abs(F.length("x") - F.length("y")) <= F.col("bound"))
    same = F.when(_word_edits("x", "y") <= F.col("bound"), True).otherwise(F.expr(
        "CASE WHEN levenshtein(x, y, least(bound, 16)) >= 0 THEN true ELSE levenshtein(x, y, bound) >= 0 END"
    ))
    return close.filter(same).select("a", "b")


def _edges(lines: DataFrame, read, bits: int, shared: int, similar: float) -> DataFrame:
    """Verified links (a, b) between different lines (line, fp), enough to
    connect all that are similar and within ``bits`` bits. ``read`` gives the
    bodies of the lines of a frame."""
    heads = lines.groupBy("fp").agg(F.min("line").alias("head"), F.count("*").alias("lines"))
    heads = written(heads, "heads")
    index = _index(heads.select("fp"), bits, shared)
    few, many = index.filter(F.col("n") <= PAIRED), index.filter(F.col("n") > PAIRED)
    x, y = few.alias("x"), few.alias("y")
    pairs = x.join(y, "block").filter("x.fp < y.fp").select(F.col("x.fp").alias("p"), F.col("y.fp").alias("q"))
    pairs = pairs.filter(_differing("p", "q") <= bits)
    stars = many.filter("first < fp").select(F.col("first").alias("p"), F.col("fp").alias("q")).filter(
        _differing("p", "q") <= LOOSE
    )
    tried = written(pairs.unionByName(stars).distinct(), "tried")
    several = lines.join(heads.filter("lines > 1"), "fp").select("fp", "line", "head")
    by_p = heads.select(F.col("fp").alias("p"), F.col("head").alias("a"))
    by_q = heads.select(F.col("fp").alias("q"), F.col("head").alias("b"))
    first = tried.join(by_p, "p").join(by_q, "q").select("a", "b").unionByName(
        several.filter("line <> head").select(F.col("head").alias("a"), F.col("line").alias("b"))
    )
    first = written(first.distinct(), "first")
    members = many.select("fp").union(tried.select("p")).union(tried.select("q")).distinct()
    asked = lines.join(members, "fp", "left_semi").select("line").union(several.select("line")).distinct()
    bodies = read(asked)
    found = written(_verified(first, bodies, similar), "links")

    # second round: fingerprints that are not similar to the first of a block,
    # and lines that are not similar to the head of their fingerprint
    linked = found.join(heads.select(F.col("head").alias("a"), F.col("fp").alias("p")), "a").join(
        heads.select(F.col("head").alias("b"), F.col("fp").alias("q")), "b"
    ).select("p", "q")
    far = many.filter("first < fp").join(
        linked, (F.col("first") == F.col("p")) & (F.col("fp") == F.col("q")), "left_anti"
    ).select("block", F.col("fp").alias("other"))
    again = many.join(far, "block").filter("fp <> other").select(
        F.least("fp", "other").alias("p"), F.greatest("fp", "other").alias("q")
    ).filter(_differing("p", "q") <= bits)
    # heads failed, but other lines of the two fingerprints may be similar
    heads_failed = tried.filter(_differing("p", "q") <= bits).join(linked, ["p", "q"], "left_anti")
    wide = heads.filter("lines > 1").select("fp")
    heads_failed = heads_failed.join(wide, F.col("p") == F.col("fp"), "left_semi").union(
        heads_failed.join(wide, F.col("q") == F.col("fp"), "left_semi")
    )
    lines_p = lines.select(F.col("fp").alias("p"), F.col("line").alias("a"))
    lines_q = lines.select(F.col("fp").alias("q"), F.col("line").alias("b"))
    more = again.union(heads_failed).distinct().join(lines_p, "p").join(lines_q, "q").select("a", "b")
    alone = several.filter("line <> head").join(
        found, (F.col("head") == F.col("a")) & (F.col("line") == F.col("b")), "left_anti"
    ).select("fp", F.col("line").alias("other"))
    inside = several.join(alone, "fp").filter("line <> other and line <> head").select(
        F.least("line", "other").alias("a"), F.greatest("line", "other").alias("b")
    )
    second = more.unionByName(inside).distinct().join(found, ["a", "b"], "left_anti")
    return found.unionByName(written(_verified(second, bodies, similar), "links"))


def similarity_bound(a: str, b: str, similar: float) -> Column:
    """Edit distance of two columns that still counts as similar."""
    return F.floor(F.greatest(F.length(a), F.length(b)) * F.lit(1 - similar) + F.lit(1e-9)).cast("int")


def _same_line(name: str) -> Column:
    return (F.col("line.h1") == F.col(f"{name}.h1")) & (F.col("line.h2") == F.col(f"{name}.h2"))


def line_classes(
    docs: DataFrame, bits: int = BITS, similar: float = SIMILAR, text: str = "text", doc_id: str = "doc_id",
    shared: int = SHARED,
) -> DataFrame:
    """``(doc_id, key, line_no, class_doc_id, class_line_no)`` of each repeated
    line, ``key`` telling rows with one id apart. A line's class is named by the
    first occurrence in the group: smallest doc_id (null last), then key, then
    line. Rows that are not their class's name are the ones to drop.

    Lines without a letter or digit belong to no class; null and empty texts
    have none. Rows equal in id and text count as one document. Equal lines
    need no edit check. An empty table gives an empty result; other columns are
    not looked at. Lines and texts are read whole, whatever their length.
    """
    rows = _ids(docs, text, doc_id)
    spots = fingerprinted(rows).withColumn("line", F.struct("h1", "h2")).drop("h1", "h2")
    spot = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "key", "line_no")
    # by the two numbers, as rows are sorted faster by these than by a struct
    lines = written(
        spots.groupBy(F.col("line.h1").alias("h1"), F.col("line.h2").alias("h2")).agg(
            F.max("fp").alias("fp"), F.min(spot).alias("first"), F.count("*").alias("n")
        ).select(F.struct("h1", "h2").alias("line"), "fp", "first", "n"), "distinct"
    )

    def read(asked: DataFrame) -> DataFrame:
        """Bodies of the lines, each read at its first occurrence."""
        where = lines.join(asked.select(F.col("line").alias("l")), _same_line("l")).select("line", "first.doc_id", "first.key", "first.line_no")
        per_doc = where.groupBy("doc_id", "key").agg(F.collect_list(F.struct("line_no", "line")).alias("asked"))
        per_doc = per_doc.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "asked")
        found = rows.join(per_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).select(
            F.split("text", "\n", -1).alias("parts"), F.explode("asked").alias("ask")
        ).select(F.col("ask.line").alias("line"), normal(F.get("parts", F.col("ask.line_no"))).alias("body"))
        return written(found.dropDuplicates(["line"]), "bodies")

    edges = _edges(lines.select("line", "fp"), read, bits, shared, similar)
    roots = components(edges)
    classed = lines.join(roots, _same_line("node"), "left").withColumn("class", F.coalesce("root", "line"))
    linked = classed.filter("root is not null").groupBy("class").agg(F.min("first").alias("class_first"))
    several = classed.filter("root is not null or n > 1").join(linked.withColumnRenamed("class", "c"), F.col("class") == F.col("c"), "left")
    several = several.select(F.col("line").alias("l"), F.coalesce("class_first", "first").alias("class_first"))
    return spots.join(several, _same_line("l")).select(
        "doc_id", "key", "line_no",
        F.col("class_first.doc_id").alias("class_doc_id"), F.col("class_first.key").alias("class_key"),
        F.col("class_first.line_no").alias("class_line_no"),
    )


def _dropped(classes: DataFrame) -> DataFrame:
    """``(d, k, gone)``: line numbers to drop per document, in order."""
    stays = (
        F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("key") == F.col("class_key"))
        & (F.col("line_no") == F.col("class_line_no"))
    )
    return classes.filter(~stays).groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.sort_array(F.collect_set("line_no")).alias("gone")
    )


def dropped_lines(docs: DataFrame, bits: int = BITS, similar: float = SIMILAR) -> DataFrame:
    """``(doc_id, n_lines, dropped)`` of every row: numbers of the lines (from
    0) that an earlier line repeats."""
    rows = _ids(docs, "text", "doc_id").select("doc_id", "key", F.size(F.split("text", "\n", -1)).alias("n_lines"))
    gone = _dropped(line_classes(docs, bits, similar))
    joined = rows.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left")
    return joined.select("doc_id", "n_lines", F.coalesce("gone", F.array().cast("array<int>")).alias("dropped"))


def drop_repeated_lines(docs: DataFrame, bits: int = BITS, similar: float = SIMILAR) -> DataFrame:
    """The input with repeated lines taken out of ``text``; ``n_chars``, where
    there is such a column, is the new length. Other columns are untouched, and
    texts without repeated lines stay as they are."""
    gone = _dropped(line_classes(docs, bits, similar))
    joined = boxed(docs).join(gone, same_document("d", "k"), "left")
    text = F.col("row.text")
    kept = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains(F.col("gone"), i)), "\n"
    )
    new = F.when(F.col("gone").isNull(), text).otherwise(kept)
    changed = joined.select("row", new.alias("new"), F.col("gone").isNotNull().alias("is_new"))
    out = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name == "text":
            column = F.col("new")
        elif name == "n_chars":
            kind = docs.schema["n_chars"].dataType
            column = F.when(F.col("is_new"), F.length("new")).otherwise(column).cast(kind)
        out.append(column.alias(name))
    return changed.select(*out)
