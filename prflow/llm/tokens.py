"""Token counts by compiled transducers and composable chunk maps.

A tokenizer file is compiled into a deterministic automaton over bytes (the
vocabulary as a trie with failure links). Reading a byte moves to one state;
the transition is annotated with the tokens of the text read so far: the last
token is the longest vocabulary suffix that may follow the token before it, so
the count is that of the shorter prefix plus one. Time is linear in the piece.

Texts are read in chunks. Between a character that is no white space and white
space there is always a token boundary, whatever the state before, so a chunk
is a map (head, inner, tail): text before its first such boundary, tokens
between the first and the last one, text after the last. The map takes a state
(pending text) to the next state and the emitted tokens. Maps are composed
associatively, in runs and then runs of runs: a prefix scan over the chunks.
"""

from __future__ import annotations

import json

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prflow.llm.common import text_key

CHUNK = 16_384  # code points of a chunk
RUN = 256  # maps composed in one step of the scan
CACHE = 1 << 20  # remembered pieces of a worker; others are counted again

# Fixed value: how the byte-level vocabulary cuts text before merging.
PIECE = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
BOUNDARY = regex.compile(r"(?<=\S)(?=\s)")
MAP = "doc_id long, key long, chunk int, n_bytes long, head string, inner long, tail string"


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in a byte-level vocabulary: printable ones
    stand for themselves, the others for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """A byte-level vocabulary file compiled for counting."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        spelled = lambda s: bytes(letters[c] for c in s)
        self.rank = {}
        for i, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[spelled(left), spelled(right)] = i
        special = [t["content"] for t in spec.get("added_tokens", [])]
        vocabulary = [spelled(t) for t in spec["model"]["vocab"] if t not in special]
        special.sort(key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self._compile(vocabulary)
        self.follows: dict[int, bool] = {}
        self.known: dict[str, int] = {}

    def _compile(self, vocabulary: list[bytes]) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.token: list[bytes | None] = [None]
        for word in vocabulary:
            at = 0
            for byte in word:
                if byte not in self.step[at]:
                    self.step[at][byte] = len(self.step)
                    self.step.append({})
                    self.token.append(None)
                at = self.step[at][byte]
            self.token[at] = word
        self.width = [len(t or b"") for t in self.token]
        self.fail = [0] * len(self.step)
        self.shorter = [0] * len(self.step)  # next shorter vocabulary suffix
        queue = list(self.step[0].values())
        for at in queue:
            back = self.fail[at]
            self.shorter[at] = back if self.token[back] is not None else self.shorter[back]
            for byte, to in self.step[at].items():
                queue.append(to)
                self.fail[to] = self._move(back, byte)
        self.longest = [n if self.token[n] is not None else s for n, s in enumerate(self.shorter)]

    def _move(self, at: int, byte: int) -> int:
        while True:
            to = self.step[at].get(byte)
            if to is not None:
                return to
            if not at:
                return 0
            at = self.fail[at]

    def _may_follow(self, pair: int) -> bool:
        """Whether merging the bytes of two tokens gives these two tokens."""
        left, right = self.token[pair >> 32], self.token[pair & 0xFFFFFFFF]
        parts = [bytes([b]) for b in left + right]
        while len(parts) > 1:
            ranks = [self.rank.get(two, 1 << 60) for two in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(self.follows) >= 4 * CACHE:
            self.follows.clear()
        self.follows[pair] = found = parts == [left, right]
        return found

    def _piece(self, piece: str) -> int:
        step, fail, longest, width, shorter = self.step, self.fail, self.longest, self.width, self.shorter
        follows = self.follows
        at, i, last, counts = 0, 0, [0], [0]
        for byte in piece.encode("utf-8"):
            i += 1
            while byte not in step[at]:
                at = fail[at]  # every single byte is a token, so the root has it
            at = step[at][byte]
            node = longest[at]
            while True:
                start = i - width[node]
                if not start:
                    break
                pair = last[start] << 32 | node
                if follows[pair] if pair in follows else self._may_follow(pair):
                    break
                node = shorter[node]
            last.append(node)
            counts.append(counts[start] + 1)
        return counts[i]

    def _plain(self, text: str) -> int:
        known, total = self.known, 0
        for piece in PIECE.findall(text):
            n = known.get(piece)
            if n is None:
                n = self._piece(piece)
                if len(known) < CACHE and len(piece) < 200:
                    known[piece] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        parts = self.special.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1

    def chunk_map(self, text: str) -> tuple[str, int, str | None]:
        first = BOUNDARY.search(text)
        if first is None:
            return text, 0, None
        at = first.start()
        to = max(self._last_boundary(text), at)
        return text[:at], self.count(text[at:to]), text[to:]

    @staticmethod
    def _last_boundary(text: str) -> int:
        found = regex.search(r"(?r)(?<=\S)(?=\s)", text)
        return found.start() if found else 0

    def compose(self, maps) -> tuple[str, int, str | None]:
        """The map of consecutive chunks."""
        head, inner, pending = [], 0, None
        for h, n, t in maps:
            if pending is None:
                head.append(h)
            else:
                pending.append(h)
            if t is not None:
                if pending is not None:
                    inner += self.count("".join(pending))
                inner += n
                pending = [t]
        return "".join(head), inner, None if pending is None else "".join(pending)

    def finish(self, head: str, inner: int, tail: str | None) -> int:
        """Tokens of a whole text: its map applied to the empty state."""
        return self.count(head) + inner + (self.count(tail) if tail is not None else 0)


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """Compiled once in each worker."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def _batches(frame, path, rows_of):
    import pyarrow as pa

    machine = transducer(path)
    for batch in frame:
        rows = list(rows_of(machine, batch.to_pylist()))
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, getattr(pa, t)()) for n, t in COLUMNS[rows_of]]))


def _whole(machine, rows):
    for r in rows:
        yield {"doc_id": r["doc_id"], "n_bytes": len(r["text"].encode()), "n_tokens": machine.count(r["text"])}


def _maps(machine, rows):
    for r in rows:
        head, inner, tail = machine.chunk_map(r["part"])
        yield {**r, "n_bytes": len(r["part"].encode()), "head": head, "inner": inner, "tail": tail}


def _composed(machine, r):
    head, inner, tail = machine.compose((m["head"], m["inner"], m["tail"]) for m in r["maps"])
    return {**r, "n_bytes": sum(m["n_bytes"] for m in r["maps"]), "head": head, "inner": inner, "tail": tail}


def _runs(machine, rows):
    for r in rows:
        yield _composed(machine, r) | {"chunk": r["run"]}


def _ended(machine, rows):
    for r in rows:
        whole = _composed(machine, r)
        yield whole | {"n_tokens": machine.finish(whole["head"], whole["inner"], whole["tail"])}


_MAP = [("doc_id", "int64"), ("key", "int64"), ("chunk", "int32"), ("n_bytes", "int64"),
        ("head", "string"), ("inner", "int64"), ("tail", "string")]
_COUNT = [("doc_id", "int64"), ("n_bytes", "int64"), ("n_tokens", "int64")]
COLUMNS = {_whole: _COUNT, _maps: _MAP, _runs: [*_MAP, ("copies", "int32")], _ended: [*_COUNT, ("copies", "int32")]}


def count_tokens(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row's whole text.

    ``path`` is a byte-level BPE file (tokenizers .json) that workers can read.
    Special strings inside a text count as one token, as the library has it.
    Null is read as empty: no bytes, no tokens. A text of any length is read in
    chunks that different tasks take; no text is cut off. Repeated rows give
    repeated rows. Null ids stay null. Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    length = F.length("text")
    short = rows.filter(length <= CHUNK).mapInArrow(
        lambda it: _batches(it, path, _whole), "doc_id long, n_bytes long, n_tokens long"
    )
    long = rows.filter(length > CHUNK).select("*", text_key(F.col("text")).alias("key"))
    # cut in one walk over the text, and dealt to tasks
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))
    parts = long.select("doc_id", "key", F.posexplode(cut).alias("chunk", "part"))
    maps = parts.repartition("doc_id", "key", "chunk").mapInArrow(lambda it: _batches(it, path, _maps), MAP)
    one = F.struct("chunk", "n_bytes", "head", "inner", "tail")
    runs = maps.groupBy("doc_id", "key", (F.col("chunk") / RUN).cast("int").alias("run")).agg(
        F.sort_array(F.collect_set(one)).alias("maps"), F.count("*").alias("n")
    ).select("doc_id", "key", "run", "maps", (F.col("n") / F.size("maps")).cast("int").alias("copies"))
    composed = runs.mapInArrow(lambda it: _batches(it, path, _runs), MAP + ", copies int")
    chain = F.struct("chunk", "n_bytes", "head", "inner", "tail")
    whole = composed.groupBy("doc_id", "key", "copies").agg(F.sort_array(F.collect_list(chain)).alias("maps"))
    ended = whole.mapInArrow(lambda it: _batches(it, path, _ended), "doc_id long, n_bytes long, n_tokens long, copies int")
    repeated = ended.select("doc_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("i"))
    return short.unionByName(repeated.drop("i"))
