"""Packing documents into training sequences by linear grouping and best fit (operator 10).

Documents are tokenised and cut where they are longer than a sequence. Only the number of pieces
of each length, at most ``capacity`` numbers, goes to the driver, which plans all sequences from
it:

1. lengths above ``capacity * large`` are sorted and dealt into groups of equal cardinality, and
   each is rounded up to the longest of its group;
2. the few rounded sizes are packed by the best configurations (column generation over the
   cutting-stock programme), each used a whole number of times;
3. the actual pieces take the places of the rounded ones, which leaves some room;
4. the large pieces left over and all small ones fill the remaining room by best fit, longest
   first.

Runs of equal sequences are planned together, so the plan grows with ``capacity`` and not with
the corpus. It is a table of runs: the pieces of one length with ranks ``r .. r+n`` go to
sequences ``s .. s+n`` at one offset. Spark then looks up each piece by its length and its rank
among the pieces of that length.

Defined cases: a null or empty text is one piece with the end id alone. A null ``doc_id`` stays
null; repeated rows are packed as often as they occur. No rows give no rows. Further columns are
ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, insort
from collections import ChainMap, defaultdict
from functools import lru_cache
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import query, store, table

CAPACITY = 4096
END_ID = 1
CACHE_BYTES = 48 << 20  # known words of a task
ENTRY_BYTES = 200  # of a known word besides its text and ids
CACHED_BYTES = 64  # longer words are encoded each time
PORTION_BYTES = 1 << 20  # text encoded at once
OTHERS = re.compile("[^\0-\u024f]")  # beyond Latin
# fixed values: how the vocabulary that is encoded word by word folds and splits text, and marks the end of a word
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
FOLDING = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
SPLITTING = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}
WORD_END = "</w>"
SPLIT = regex.compile(PATTERN)
WHITE = re.compile(rb"[ \t-\r]")
END, GAP = "\x01", "\x02"  # end of a part, border of words; texts that hold one are encoded whole


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode(path: str, text: str) -> bytes:
    return np.array(_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def _byte_symbols() -> dict[int, str]:
    """The printable character by which a byte-level vocabulary writes each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def _merges(path: str):
    """The vocabulary's merges for folded and split parts, ids by rank, and the border's rank.

    A part ends in ``END``, which merges with the byte before it first of all, as the mark of
    a word's end stands in the vocabulary. None if the vocabulary folds or splits text in another way.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    if (spec["normalizer"], spec["pre_tokenizer"], model.get("end_of_word_suffix")) != (FOLDING, SPLITTING, WORD_END):
        return None
    symbols = _byte_symbols()
    bytes_of = {s: b for b, s in symbols.items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    tokens = [*symbols.values(), *[s + WORD_END for b, s in symbols.items() if b != ord(END)], *["".join(m) for m in pairs]]
    ranks = {}
    for token in tokens:
        inner = bytes(bytes_of[c] for c in token.removesuffix(WORD_END))
        ranks[inner + END.encode() if token.endswith(WORD_END) else inner] = len(ranks)
    if len(ranks) != len(tokens):
        return None
    merges = tiktoken.Encoding("parts", pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})
    return merges, np.array([model["vocab"][t] for t in tokens], "<u4"), ranks[(GAP + END).encode()]


class Encoder:
    """Ids of UTF-8 texts as little-endian 32-bit numbers, without special tokens.

    The vocabulary folds case and takes white space as a border only, so words between ASCII white
    space are encoded once and looked up from then on. Latin words are folded and split here;
    any others go through the whole tokenizer, as do texts that hold a mark or may spell a
    special token, and all texts if the vocabulary works in another way. Known words are bounded in
    bytes and belong to one task.
    """

    def __init__(self, path: str):
        self.path, self.known, self.size = path, {}, 0

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        merges, ids_of, border = _merges(self.path)
        lines, learnt = (f" {GAP} ".encode()).join(words).decode(), {}
        if not lines.isascii():
            if OTHERS.search(lines):
                learnt = {w: _encode(self.path, text) for w in words if OTHERS.search(text := w.decode())}
                words = [w for w in words if w not in learnt]
                lines = (f" {GAP} ".encode()).join(words).decode()
            lines = normalize("NFC", lines).lower()
        if words:
            ranks = merges.encode_to_numpy((END + " ").join([*SPLIT.findall(lines), ""]))
            borders = np.flatnonzero(ranks == border)
            ids = ids_of[ranks]
            starts, ends = [0, *(borders + 1).tolist()], [*borders.tolist(), len(ids)]
            learnt |= {w: ids[a:b].tobytes() for w, a, b in zip(words, starts, ends, strict=True)}
        return learnt

    def _portion(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of texts without marks."""
        split = [p.lower().split() for p in pieces]
        if self.size > CACHE_BYTES:
            self.known, self.size = {}, 0
        ids = self.known
        if missing := set().union(*split).difference(ids):
            fresh = self._learn(list(missing))
            kept = {w: v for w, v in fresh.items() if len(w) <= CACHED_BYTES}
            self.size += sum(len(w) + len(v) + ENTRY_BYTES for w, v in kept.items())
            ids.update(kept)
            if len(kept) < len(fresh):
                ids = ChainMap(fresh, ids)
        return [b"".join(map(ids.__getitem__, words)) for words in split]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Equal texts are encoded once; long ones in pieces that end at white space."""
        out: dict[bytes, list[bytes]] = {t: [] for t in texts}
        portion: list[tuple[bytes, bytes]] = []
        size = 0

        def flush():
            for (text, _), ids in zip(portion, self._portion([p for _, p in portion]), strict=True):
                out[text].append(ids)
            portion.clear()

        for text in out:
            if END.encode() in text or GAP.encode() in text or b"<|" in text or _merges(self.path) is None:
                out[text].append(_encode(self.path, text.decode()))
                continue
            at = 0
            while at < len(text):
                border = WHITE.search(text, at + PORTION_BYTES) if at + PORTION_BYTES < len(text) else None
                end = border.start() if border else len(text)
                portion.append((text, text[at:end]))
                size, at = size + end - at, max(end, at + 1)
                if size >= PORTION_BYTES:
                    flush()
                    size = 0
        flush()
        joined = {t: ids[0] if len(ids) == 1 else b"".join(ids) for t, ids in out.items()}
        return [joined[t] for t in texts]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, place long"


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise whole texts and cut them; ``place`` counts equal lengths within a task."""
    end = np.array([END_ID], np.uint32).tobytes()

    def run(batches):
        task, place = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encoder = Encoder(tokenizer)
        for batch in batches:
            doc_ids, texts, at = batch.column(0).to_pylist(), batch.column(1), 0
            while at < batch.num_rows:
                group, size = [], 0
                while at + len(group) < batch.num_rows and (not group or size < PORTION_BYTES):
                    group.append(texts[at + len(group)].as_py() or b"")
                    size += len(group[-1])
                out = []
                for doc_id, ids in zip(doc_ids[at:], encoder.encode(group), strict=False):
                    ids += end
                    for i, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        length = len(part) // 4
                        out.append((doc_id, i, start // 4, length, zlib.crc32(part), task, int(place[length])))
                        place[length] += 1
                at += len(group)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64())
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return source.mapInArrow(run, PIECES)


def _best_pattern(sizes: list[int], value: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack: the configuration of greatest value that fits."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    useful = [(s, v, i) for i, (s, v) in enumerate(zip(sizes, value, strict=True)) if v > 1e-12]
    # every configuration is built up from its smallest size to its largest
    for size, worth, i in sorted(useful):
        for at in range(size, capacity + 1, size):  # blocks of one size: what stands before is final
            end = min(at + size, capacity + 1)
            gain = best[at - size : end - size] + worth
            better = gain > best[at:end] + 1e-12
            best[at:end][better] = gain[better]
            last[at:end][better] = i
    pattern, room = np.zeros(len(sizes)), int(np.argmax(best))
    while room > 0 and last[room] >= 0:
        pattern[last[room]] += 1
        room -= sizes[last[room]]
    return float(best.max()), pattern


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, rounds: int = 300):
    """Patterns and how often to use each, by column generation on the cutting-stock programme."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    for _ in range(rounds):
        price = np.linalg.solve(basis.T, np.ones(k))
        value, pattern = _best_pattern(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        use, step = np.linalg.solve(basis, demand), np.linalg.solve(basis, pattern)
        ratio = np.where(step > 1e-9, np.maximum(use, 0) / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(np.argmin(ratio))] = pattern
    return basis, np.maximum(np.linalg.solve(basis, demand), 0)


class _Plan:
    """Open sequences in runs of equal room, and the runs of pieces placed so far."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.left, self.rank = capacity, counts.copy(), np.zeros_like(counts)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, rank, n, sequence, offset
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> (first, n)
        self.rooms: list[int] = []

    def new(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def put(self, length: int, n: int, first: int, offset: int) -> None:
        self.rows.append((length, int(self.rank[length]), n, first, offset))
        self.rank[length] += n
        self.left[length] -= n

    def keep(self, first: int, n: int, used: int) -> None:
        room = self.capacity - used
        if n and room:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((first, n))

    def fill(self, length: int) -> None:
        """Best fit: each piece goes where least room is left."""
        while self.left[length]:
            at = bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                first, n = self.open[room].pop()
                if not self.open[room]:
                    self.rooms.pop(at)
            else:
                room, n = self.capacity, -(-int(self.left[length]) // (self.capacity // length))
                first = self.new(n)
            each, used = room // length, self.capacity - room
            full = min(n, int(self.left[length]) // each)
            for i in range(each if full else 0):
                self.put(length, full, first, used + i * length)
            self.keep(first, full, used + each * length)
            if full < n:
                rest = min(int(self.left[length]), each)
                for i in range(rest):
                    self.put(length, 1, first + full, used + i * length)
                self.keep(first + full, 1, used + rest * length)
                self.keep(first + full + 1, n - full - 1, used)


def plan_sequences(counts: np.ndarray, capacity: int, large: float, groups: int) -> _Plan:
    """Plan from ``counts[length]``; ``large`` is the share of a sequence from which lengths are grouped."""
    plan = _Plan(counts.astype(np.int64), capacity)
    if n := int(plan.left[capacity]):
        plan.put(capacity, n, plan.new(n), 0)
    lengths = [s for s in range(capacity - 1, 0, -1) if s > capacity * large and plan.left[s]]
    total = int(sum(plan.left[s] for s in lengths))
    if total:
        quota, runs, sizes, filled = -(-total // groups), [], [], 0
        for s in lengths:  # longest first; a group ends when it has its quota
            n = int(plan.left[s])
            while n:
                if not sizes or filled == quota:
                    if sizes and sizes[-1] == s:  # the same size again: one group with a greater demand
                        quota += total
                    else:
                        quota = -(-total // groups)
                        sizes.append(s)
                        runs.append([])
                        filled = 0
                take = min(n, quota - filled)
                runs[-1].append([s, take])
                n, filled = n - take, filled + take
        demand = np.array([float(sum(n for _, n in r)) for r in runs])
        patterns, use = configurations(sizes, demand, capacity)
        for column in np.argsort(-use):
            n = int(use[column] + 1e-6)
            slots = [g for g in range(len(sizes)) for _ in range(round(patterns[g, column]))]
            n = min([n, *(sum(c for _, c in runs[g]) // slots.count(g) for g in set(slots))]) if slots else 0
            if not n:
                continue
            segments = [(plan.new(n), n, 0)]
            for g in slots:
                after = []
                for first, many, used in segments:
                    while many:
                        s, have = runs[g][0]
                        part = min(many, have)
                        plan.put(s, part, first, used)
                        after.append((first, part, used + s))
                        first, many = first + part, many - part
                        runs[g][0][1] -= part
                        if not runs[g][0][1]:
                            runs[g].pop(0)
                segments = after
            for first, many, used in segments:
                plan.keep(first, many, used)
    for s in range(capacity - 1, 0, -1):
        if plan.left[s]:
            plan.fill(s)
    return plan


def best_plan(counts: np.ndarray, capacity: int) -> _Plan:
    """The plan with the fewest sequences over a few choices of grouping."""
    bound = -(-int((counts * np.arange(len(counts))).sum()) // capacity)
    best = None
    for large, groups in ((1 / 8, 24), (1 / 4, 24), (1 / 3, 40), (1 / 2, 60)):
        plan = plan_sequences(counts, capacity, large, groups)
        if best is None or plan.sequences < best.sequences:
            best = plan
        if best.sequences <= bound:
            break
    return best


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    pieces = store(cut_pieces(docs, tokenizer, capacity), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = best_plan(counts, capacity)
    runs = np.array(sorted(plan.rows), np.int64).reshape(-1, 5)
    # length and rank in one sorted number; ranks stay below 2^50
    starts = (runs[:, 0] << 50) + runs[:, 1]
    shift, offsets = runs[:, 3] - runs[:, 1], runs[:, 4]

    def placed(batches):
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(starts, (batch.column("length").to_numpy().astype(np.int64) << 50) + rank, "right") - 1
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            kept[3] = kept[3].cast(pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rank + shift[at]), pa.array(offsets[at])], names)

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(first, ["task", "length"]).withColumn("rank", F.col("first") + F.col("place"))
    out = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(placed, out)


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizer())
