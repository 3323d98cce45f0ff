"""Language-model scores by online logistic context mixing (operator 9).

The model predicts the bytes of a text, bit by bit along a Huffman tree of byte counts, and then
its end. Four contexts (the last two, three and five bytes, and the word so far) are hashed to
the rows of tables with fixed size; a row has one bit predictor for each node of the tree, from
counts over the training texts, shrunk towards the predictor without a context. The predictions
are mixed in the logistic domain: gates (place in the word, depth in the tree) choose among sets
of weights, and each text refines the weights as it goes, by the gradient of the bits of each
block of ``BLOCK`` bytes after they are coded. So a score is the log probability of a proper
distribution over texts, and depends on the text and the model alone.

Counting is a shuffled sum: tasks send the cells they have seen, in pieces of fixed size, and
these are summed in two steps, so no task gathers more than a part of them. The tables that reach
all tasks have fixed size. All training texts are counted in the tables, and all of them fit the
gates' weights: each lies in one of two folds, equal texts in the same one, and is predicted from
the tables of the other fold. One scan sums the gradients and curvatures of these predictions, of
fixed size, and the weights take one Newton step from ``WEIGHTS``.

Words have exact counts. The most frequent, at most ``FREQUENT`` of them, are looked up in the task
that scores a text; the others go through a join.

Texts have ASCII letters lower-cased first. Defined cases: a null text is empty: one token, its
end. Null ids count as training ids. Repeated rows count as often as they occur. Without training
texts all counts are 0 and the base score is that of an empty vocabulary. No rows give no rows.
Further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import crc_mod, query, store, table, text_or_empty

END = 255  # never a byte of UTF-8
GAP = 8  # zero bytes before each text, which stand for the context before its start
ROWS = (1 << 13, 1 << 14, 1 << 15, 1 << 15)  # last 2, 3, 5 bytes, word so far
FIRST = np.concatenate(([0], np.cumsum(ROWS)))
CELLS = int(FIRST[-1]) * 256
PIECE = 1 << 16  # cells
TASKS_SUMMED = 256
STRENGTH = 0.4  # pseudo-count of the prediction without a context
SCALE = 12.0  # of logits in one byte
BLOCK = 256
PLACES = 1 << 11  # whose predictions are made at once
ABREAST = 16  # texts that are refined side by side
SEGMENT = 1 << 19  # places whose predictions are kept at once, of a longer text; a multiple of ``BLOCK``
SPAN = 1 << 14  # places of one node that go through the model at once
CHUNK_BYTES = 1_000_000
HASHED_BYTES = 32_000  # whose context rows are computed at once, in the processor's cache
ROWS_AT_ONCE = 5000
BYTES_AT_ONCE = 4_000_000
FOLDS = 2
RATE = 6e-4  # of the weights that a text refines as it goes
GATES = 8
WEIGHTS = np.array([[0.3]] * len(ROWS) + [[0.0], [0.0]], np.float32)  # before training, of all gates
FIELDS = 4  # numbers of four bytes that are kept of a bit
ONE, LIMIT = np.array(1, np.float32), np.array(14, np.float32)  # of a mixed logit
SHARES = (np.array([SCALE] * len(ROWS) + [1, 1]) ** -2).astype(np.float32)  # of a refinement, by the inputs' scales
RIDGE = 30.0  # bits' worth of pull towards them
FREQUENT = 1 << 18
FREQUENT_BYTES = 64
COUNTED_WORDS = 400_000
IS_WHITE = bytes(c in (0, 9, 10, 11, 12, 13, 32) for c in range(256))
NOT_WHITE = bytes(1 - c for c in IS_WHITE)
# a place in one number, from its highest bit: inside a word (by the byte before), leaf of the symbol, last five
# bytes, row of the word so far
LEAF, LAST, WORD = (np.uint64(n) for n in (55, 15, ROWS[3] - 1))
SYMBOLS = np.arange(256)  # as leaves
PLACE_BITS = 20  # of a place among those that are grouped at once
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[list[int]]:
    """Runs of texts with about ``size`` bytes, ends included, by place."""
    run, total = [], 0
    for i, t in enumerate(texts):
        if run and total + len(t) + 1 > size:
            yield run
            run, total = [], 0
        run.append(i)
        total += len(t) + 1
    if run:
        yield run


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``ROWS_AT_ONCE`` rows and about ``BYTES_AT_ONCE`` bytes of text."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + BYTES_AT_ONCE, "right")))
            end = min(end, start + ROWS_AT_ONCE)
            yield batch.slice(start, end - start)
            start = end


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of texts with gaps and ends, and where each text's coded bytes begin and end."""
    gap, end = bytes(GAP), bytes([END])
    data = np.frombuffer(b"".join(x for t in texts for x in (gap, t, end)), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(lengths + GAP)
    return data, ends - lengths, ends


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = [np.full(n + 1, factor, np.uint64) for factor in (FACTOR, INVERSE)]
    for steps in out:
        steps[0] = 1
        np.multiply.accumulate(steps, out=steps)
    return out[0], out[1]


def last_bytes(data: np.ndarray) -> np.ndarray:
    """The five bytes before each place in one number, the nearest lowest; zeros before the first."""
    padded = np.concatenate((np.zeros(8, np.uint8), data))
    return np.ndarray(len(data), ">u8", padded, 0, (1,)).astype(np.uint64) & np.uint64((1 << 40) - 1)


def last_rows(last: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of the contexts of the last two, three and five bytes."""
    for first, size, k in zip(FIRST, ROWS, (2, 3, 5)):
        cut = last & np.uint64((1 << 8 * k) - 1)
        cut *= np.uint64(k * FACTOR % (1 << 64))
        cut >>= np.uint64(64 - size.bit_length() + 1)
        yield cut.astype(np.int64) + first


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Row of the word so far at each place, in its own table."""
    n = len(data)
    wide = data.astype(np.uint64)
    power, inverse = (p[: n + 1] for p in _powers(1 << max(18, n.bit_length())))
    total = np.zeros(n + 1, np.uint64)
    wide += np.uint64(1)
    wide *= power[:-1]
    np.cumsum(wide, out=total[1:])
    white = np.frombuffer(data[:-1].tobytes().translate(IS_WHITE), bool)
    start = np.concatenate(([0], np.flatnonzero(white) + 1))
    lengths = np.diff(start, append=n)
    word = np.repeat(total.take(start), lengths)
    np.subtract(total[:-1], word, out=word)
    word *= np.repeat(inverse.take(start), lengths)
    word ^= np.right_shift(word, np.uint64(29), out=wide)
    word *= np.uint64(FACTOR)
    word >>= np.uint64(64 - ROWS[3].bit_length() + 1)
    return word


def context_rows(data: np.ndarray) -> np.ndarray:
    """Row of each context at each place, numbered over all tables."""
    return np.stack([*last_rows(last_bytes(data)), word_hashes(data).astype(np.int64) + FIRST[3]])


def place_numbers(texts: list[bytes], leaves: np.ndarray) -> np.ndarray:
    """Number of each coded place of texts; all that the model looks at there can be told from it."""
    leaf, out = leaves.astype(np.uint8).tobytes(), []
    for run in chunks(texts, HASHED_BYTES):
        data, starts, ends = laid_out([texts[i] for i in run])
        plain = data.tobytes()
        top = np.frombuffer(plain.translate(leaf), np.uint8).astype(np.uint64)
        top[1:] |= np.frombuffer(plain[:-1].translate(NOT_WHITE), np.uint8).astype(np.uint64) << np.uint64(8)
        top <<= LEAF
        number = last_bytes(data)
        number <<= LAST
        number |= word_hashes(data)
        number |= top
        out += [number[a:z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
    return np.concatenate(out)


def distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers in order, and how often each occurs."""
    own = np.sort(numbers)
    last = np.append(np.flatnonzero(own[1:] != own[:-1]), len(own) - 1)
    return own.take(last), np.diff(last, prepend=-1)


def grouped(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in an order by leaf, in which equal ones mostly follow each other, with repeats in a row left out; and
    where each of ``numbers`` is among them."""
    place = np.uint64((1 << PLACE_BITS) - 1)
    key = numbers * np.uint64(FACTOR)  # sorted with the place behind a hash, cheaper than argsort
    key >>= np.uint64(64 - int(LEAF) + PLACE_BITS)
    key <<= np.uint64(PLACE_BITS)
    key |= numbers >> LEAF << LEAF
    key |= np.arange(len(numbers), dtype=np.uint64)
    key.sort()
    key &= place
    order = key.astype(np.int64)
    own = numbers.take(order)
    new = np.ones(len(own), bool)
    np.not_equal(own[1:], own[:-1], out=new[1:])
    where = np.empty(len(own), np.int64)
    where[order] = np.cumsum(new) - 1
    return own[new], where


def rows_of(numbers: np.ndarray) -> np.ndarray:
    """Context rows of places, by their numbers."""
    return np.stack([*last_rows(numbers >> LAST), (numbers & WORD).astype(np.int64) + FIRST[3]])


def _runs(first: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Numbers that go up by one from each of ``first``, for as long as ``bounds`` says; none is empty."""
    out = np.ones(int(bounds[-1]), np.int64)
    out[bounds[:-1]] = np.diff(first, prepend=1) - np.diff(bounds[:-1], prepend=0) + 1
    out[:1] = first[:1]
    return np.cumsum(out, out=out)


def _coded(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _runs(starts, np.concatenate(([0], np.cumsum(ends - starts))))


def count_cells(texts: list[bytes], counts: np.ndarray) -> None:
    """Add (context row, byte) counts of texts."""
    for run in chunks(texts, 2 * CHUNK_BYTES):
        own, n = distinct(place_numbers([texts[i] for i in run], SYMBOLS))
        symbols = (own >> LEAF).astype(np.int64) & 255
        for rows in rows_of(own):
            np.add.at(counts, (rows << 8) + symbols, n.astype(np.uint32))


def huffman(counts: np.ndarray) -> tuple[list[list[tuple[int, int]]], np.ndarray]:
    """The path (node, bit) of each symbol, and of each node the symbols below its two sides."""
    heap = [(int(c) + 1, i, (i,)) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    sides = np.zeros((2, len(counts) - 1, len(counts)), np.float32)
    for node in range(len(counts) - 2, -1, -1):  # the root is node 0
        (a, i, left), (b, _, right) = heapq.heappop(heap), heapq.heappop(heap)
        sides[0, node, list(left)] = sides[1, node, list(right)] = 1
        heapq.heappush(heap, (a + b, i, left + right))
    paths: list[list[tuple[int, int]]] = [[] for _ in counts]
    for node in range(len(counts) - 1):
        for bit in (0, 1):
            for symbol in np.flatnonzero(sides[bit, node]):
                paths[symbol].append((node, bit))
    return paths, sides


def predictors(counts: np.ndarray, sides: np.ndarray, plain: np.ndarray) -> np.ndarray:
    """Logits, as scaled bytes, of each node for rows of symbol counts."""
    zero, one = counts.astype(np.float32) @ sides[0].T, counts.astype(np.float32) @ sides[1].T
    p = (one + STRENGTH * plain) / (zero + one + STRENGTH)
    p = np.clip(p, 1e-6, 1 - 1e-6)
    out = np.zeros(counts.shape, np.int8)
    out[:, : len(sides[0])] = np.clip(np.rint(np.log(p / (1 - p)) * SCALE), -127, 127)
    return out


class Model:
    """Tables, tree and weights; ``tables`` is flat: row * 256 + node.

    Places that agree in all that the model looks at are predicted once for many texts. They are in the
    order of the tree's leaves, so those that pass a node are a run, in which table column, gate and plain
    prediction are the same. What a text has taught the weights is added place by place, in its own order.
    """

    def __init__(self, symbols: np.ndarray, tables: np.ndarray | None = None):
        self.paths, self.sides = huffman(symbols)
        total = symbols + 1.0
        zero, one = self.sides[0] @ total, self.sides[1] @ total
        self.plain = (one / (zero + one)).astype(np.float32)
        self.logit = np.log(self.plain / (1 - self.plain)).astype(np.float32)
        lengths = np.array([len(p) for p in self.paths])
        self.length, self.first = lengths, np.cumsum(lengths) - lengths
        self.nodes = np.array([n for p in self.paths for n, _ in p])
        leaves = sorted(range(len(self.paths)), key=lambda s: [b for _, b in self.paths[s]])
        self.rank, self.symbols = np.argsort(leaves), np.array(leaves)
        below = self.sides.sum(2).astype(int)  # leaves on either side of a node, which follow each other
        first = [int(self.rank[self.sides[:, n].any(0)].min()) for n in range(len(below[0]))]
        self.leaves = np.stack([first, first + below[0], first + below.sum(0)], 1)
        self.depth = np.zeros(len(first), int)
        for path in self.paths:
            self.depth[[n for n, _ in path]] = np.arange(len(path))
        self.weights = np.tile(WEIGHTS, GATES)
        self.rate = RATE
        self.tables = tables

    @property
    def tables(self) -> np.ndarray | None:
        return None if self.columns is None else self.columns.T.reshape(-1)

    @tables.setter
    def tables(self, tables: np.ndarray | None) -> None:
        """Kept by node: one column is small enough for the processor's cache."""
        self.columns = None if tables is None else np.ascontiguousarray(tables.reshape(-1, 256).T)

    def runs(self, numbers: np.ndarray) -> list:
        """Of places in order: node, inside a word or not, begin, first place with bit 1, end."""
        bounds = np.searchsorted(numbers >> LEAF, np.arange(513, dtype=np.uint64))
        out = []
        for inside in (0, 1):
            cuts = bounds[self.leaves + (inside << 8)].tolist()
            out += [(node, inside, begin, middle, end) for node, (begin, middle, end) in enumerate(cuts) if begin < end]
        return out

    def spans(self, runs: list):
        """Runs cut to ``SPAN`` places, with the gate."""
        for node, inside, begin, middle, end in runs:
            gate = inside * (GATES // 2) + min(int(self.depth[node]), GATES // 2 - 1)
            for a in range(begin, end, SPAN):
                b = min(end, a + SPAN)
                yield node, gate, a, min(max(middle, a), b), b

    def near(self, node: int, rows: np.ndarray, out: np.ndarray) -> np.ndarray:
        """The contexts' scaled logits of a node."""
        for own, into in zip(rows, out, strict=True):
            self.columns[node].take(own, None, into, "clip")
        return out

    def run(self, texts: list[bytes]) -> np.ndarray:
        """log2 probability of each text."""
        out = np.zeros(len(texts))
        for run in chunks(texts):
            numbers = place_numbers([texts[i] for i in run], self.rank)
            edges = np.cumsum([0] + [len(texts[i]) + 1 for i in run])
            refined = np.zeros((len(run), len(WEIGHTS)), np.float32)
            if len(run) > 1:
                out[run] = self.code(numbers, edges, refined)
            else:
                parts = [numbers[a : a + SEGMENT] for a in range(0, len(numbers), SEGMENT)]
                out[run] = sum(self.code(part, np.array([0, len(part)]), refined) for part in parts)
        return out

    def code(self, numbers: np.ndarray, edges: np.ndarray, refined: np.ndarray) -> np.ndarray:
        """log2 probability of texts by the numbers of their places; ``refined`` follows each, block after block, and
        texts of about one length go side by side."""
        own, where = grouped(numbers)
        inputs, begin, lengths = self.inputs(own)
        where = ((begin << 8) + lengths).take(where)
        lengths = where & 255
        where >>= 8
        bits = np.concatenate(([0], np.cumsum(lengths)))
        steps = _runs(where, bits)
        rates = self.rate * SHARES
        out, sizes = np.zeros(len(refined)), np.diff(edges)
        order = np.argsort(-sizes, kind="stable")
        laid = np.empty((0, FIELDS), np.float32)
        for group in np.split(order, range(ABREAST, len(order), ABREAST)):
            now = refined[group]
            for done in range(0, int(sizes[group[0]]), BLOCK):
                group = group[: int(np.count_nonzero(sizes[group] > done))]
                first = edges[group] + done
                first, last = bits.take(first), bits.take(np.minimum(first + BLOCK, edges[group + 1]))
                cuts = np.cumsum(last - first)
                n = int(cuts[-1])
                if n > len(laid):
                    laid, buffer = np.empty((2 * n, FIELDS), np.float32), np.empty((len(WEIGHTS) + 2, 2 * n), np.float32)
                x, wrong, odd, cut = buffer[:-2, :n], buffer[-2, :n], buffer[-1, :n], [0, *cuts.tolist()]
                for a, z, b in zip(first.tolist(), last.tolist(), cut):
                    inputs.take(steps[a:z], 0, laid[b : b + z - a], "clip")
                x[: len(ROWS)], x[len(ROWS) :] = laid[:n].view(np.int8)[:, : len(ROWS)].T, laid[:n, 2:].T
                spans = [slice(a, z) for a, z in zip(cut[:-1], cut[1:])]
                for span, weights in zip(spans, now):
                    np.matmul(weights, x[:, span], out=wrong[span])
                wrong += laid[:n, 1]
                np.minimum(wrong, LIMIT, out=wrong)
                np.maximum(wrong, -LIMIT, out=wrong)
                np.exp(wrong, out=wrong)
                np.add(wrong, ONE, out=odd)
                wrong /= odd
                for span, weights in zip(spans, now):
                    weights -= rates * (x[:, span] @ wrong[span])
                out[group] -= np.add.reduceat(np.log(odd, out=odd), cuts - (last - first), dtype=np.float64)
            refined[group] = now[: len(group)]
        return out / math.log(2)

    def inputs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the bits of places by leaf, with the sign of the bit that did not come: the contexts' scaled logits (four
        bytes), the logit mixed from all, the plain one, one; the first bit of each place and how many it has."""
        rows, bounds = rows_of(numbers), np.searchsorted(numbers >> LEAF, np.arange(513, dtype=np.uint64))
        lengths = np.repeat(np.tile(self.length.take(self.symbols), 2), np.diff(bounds))
        bits = np.concatenate(([0], np.cumsum(lengths)))
        out = np.empty((int(bits[-1]), FIELDS), np.float32)
        tables, size = self.columns.reshape(-1), self.columns.shape[1]
        for leaf in np.flatnonzero(np.diff(bounds)).tolist():
            path = self.paths[self.symbols[leaf & 255]]
            nodes, wrong = np.array([n for n, _ in path])[:, None], np.array([[1 - 2 * b] for _, b in path], np.int8)
            gates = np.minimum(np.arange(len(path)), GATES // 2 - 1) + (leaf >> 8) * (GATES // 2)
            weights, plain = self.weights[:, gates, None], self.logit[nodes]
            constant = (plain * weights[-2] + weights[-1]) * wrong
            for a in range(int(bounds[leaf]), int(bounds[leaf + 1]), PLACES):
                z = min(a + PLACES, int(bounds[leaf + 1]))
                own = out[bits[a] : bits[z]].reshape(z - a, len(path), FIELDS)
                contexts, x, mixed = own.view(np.int8).T, own.T, constant
                for j in range(len(ROWS)):
                    near = tables.take(rows[j, a:z] + nodes * size, None, None, "clip")
                    near *= wrong
                    contexts[j] = near
                    mixed = mixed + near * (weights[j] / np.float32(SCALE))
                x[1], x[2], x[3] = mixed, plain * wrong, wrong
        return out, bits[:-1], lengths

    def slopes(self, texts: list[bytes]) -> np.ndarray:
        """Per gate: curvature matrix and, in the last column, gradient of the texts' log probability."""
        k = len(WEIGHTS)
        out = np.zeros((GATES, k, k + 1))
        spread = np.zeros((k, len(ROWS) + 1), np.float32)  # from the tables' bytes and one to the inputs
        spread[: len(ROWS), :-1] = np.eye(len(ROWS)) / SCALE
        spread[-1, -1] = 1
        for run in chunks(texts, 2 * CHUNK_BYTES):
            own, times = distinct(place_numbers([texts[i] for i in run], self.rank))
            rows, times = rows_of(own), times.astype(np.float32)
            for node, gate, begin, middle, end in self.spans(self.runs(own)):
                spread[-2, -1] = self.logit[node]
                x = np.ones((len(ROWS) + 1, end - begin), np.float32)
                x[:-1] = self.near(node, rows[:, begin:end], np.empty((len(ROWS), end - begin), np.int8))
                margin = (self.weights[:, gate] @ spread) @ x
                np.negative(margin[: middle - begin], out=margin[: middle - begin])
                np.clip(margin, -LIMIT, LIMIT, out=margin)
                wrong = 1 / (1 + np.exp(margin))  # probability of the bit that did not come
                curve = wrong * (1 - wrong) * times[begin:end]
                wrong *= times[begin:end]
                np.negative(wrong[: middle - begin], out=wrong[: middle - begin])
                out[gate, :, k] += spread @ (x @ wrong)
                out[gate, :, :k] += spread @ ((x * curve) @ x.T) @ spread.T
        return out

    def fit(self, slopes: np.ndarray) -> None:
        """One Newton step of the gates' weights; rounded, so the order of sums does not show."""
        pull = RIDGE * np.eye(len(WEIGHTS))
        for g in range(GATES):
            step = np.linalg.solve(slopes[g, :, :-1] + pull, slopes[g, :, -1])
            self.weights[:, g] = np.round(self.weights[:, g] + step, 4)

    def tune(self, texts: list[bytes]) -> None:
        """Fit the gates' weights on texts that the tables have not seen."""
        self.fit(self.slopes(texts))


COUNTED = "kind int, fold int, piece int, task int, word binary, n long, data binary"


def _binary(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, text_or_empty().cast("binary").alias("text"))


def count_training(train: DataFrame) -> DataFrame:
    """Counts of words (kind 0), of cells in pieces (1) and of bytes (2, one piece), fold by fold.

    A task counts texts of one fold, so it holds one table.
    """
    return reduce(DataFrame.union, [count_fold(train.filter(F.col("fold") == fold), fold) for fold in range(FOLDS)])


def count_fold(train: DataFrame, fold: int) -> DataFrame:
    def rows(kind: int, pieces, words, n, data) -> pa.RecordBatch:
        size, task = max(len(pieces), len(words)), TaskContext.get().partitionId() // TASKS_SUMMED
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * size, pa.int32()), pa.array([fold] * size, pa.int32()),
             pa.array(pieces or [0] * size, pa.int32()), pa.array([task] * size, pa.int32()),
             pa.array(words or [None] * size, pa.binary()), pa.array(n or [0] * size, pa.int64()), pa.array(data or [None] * size, pa.binary())],
            [c.split()[0] for c in COUNTED.split(", ")],
        )

    def of_words(words: Counter) -> Iterator[pa.RecordBatch]:
        items = list(words.items())
        for i in range(0, len(items), 10_000):
            part = items[i : i + 10_000]
            yield rows(0, [], [w for w, _ in part], [n for _, n in part], [])

    def run(batches):
        words, cells, symbols = Counter(), np.zeros(CELLS, np.uint32), np.zeros(256, np.int64)
        for batch in parts(batches):
            texts = [t.lower() for t in batch.column("text").to_pylist()]
            for t in texts:
                words.update(t.split())
                if len(words) > COUNTED_WORDS:
                    yield from of_words(words)
                    words = Counter()
            count_cells(texts, cells)
            for t in texts:
                symbols += np.bincount(np.frombuffer(t, np.uint8), minlength=256)
            symbols[END] += len(texts)
        yield from of_words(words)
        for piece in range(CELLS // PIECE):
            own = cells[piece * PIECE : (piece + 1) * PIECE]
            if len(seen := np.flatnonzero(own)):
                yield rows(1, [piece], [], [len(seen)], [seen.astype(np.uint16).tobytes() + own[seen].tobytes()])
        yield rows(2, [0], [], [0], [symbols.tobytes()])

    return _binary(train).mapInArrow(run, COUNTED)


def _dense(n: int, data: bytes) -> np.ndarray:
    out = np.zeros(PIECE, np.int64)
    out[np.frombuffer(data, np.uint16, n)] = np.frombuffer(data, np.uint32, n, 2 * n)
    return out


def sum_pieces(pieces: DataFrame) -> DataFrame:
    """piece and its summed counts as 64-bit numbers, one fold after the other; first over groups of
    tasks, then over groups."""

    def sparse(group: pa.Table) -> pa.Table:
        total = sum(_dense(n.as_py(), d.as_py()) for n, d in zip(group.column("n"), group.column("data"), strict=True))
        return pa.table({"fold": group.column("fold")[:1], "piece": group.column("piece")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    def dense(group: pa.Table) -> pa.Table:
        total = np.zeros((FOLDS, PIECE), np.int64)
        for fold, d in zip(group.column("fold"), group.column("data"), strict=True):
            total[fold.as_py()] += np.frombuffer(d.as_py(), np.int64)
        return pa.table({"piece": group.column("piece")[:1], "data": pa.array([total.tobytes()], pa.binary())})

    by_task = pieces.groupBy("fold", "piece", "task").applyInArrow(sparse, "fold int, piece int, data binary")
    return by_task.groupBy("piece").applyInArrow(dense, "piece int, data binary")


def build_model(counted: DataFrame, train: DataFrame) -> Model:
    """Tables of fixed size from the counts of all texts, weights from the same texts fold by fold."""
    symbols = np.zeros(256, np.int64)
    whole = counted.filter("kind = 2").groupBy("task").applyInArrow(
        lambda g: pa.table({"data": pa.array([sum(np.frombuffer(d.as_py(), np.int64) for d in g.column("data")).tobytes()], pa.binary())}),
        "data binary",
    )
    for row in whole.toLocalIterator():
        symbols += np.frombuffer(row.data, np.int64)
    model = Model(symbols)
    sides, plain = model.sides, model.plain

    def convert(batches):
        for batch in batches:
            made = []
            for d in batch.column("data"):
                folds = np.frombuffer(d.as_py(), np.int64).reshape(FOLDS, -1, 256)
                total = folds.sum(0)
                # of all texts, then of all but those of each fold
                made.append(b"".join(predictors(c, sides, plain).tobytes() for c in (total, *(total - folds))))
            yield pa.RecordBatch.from_arrays([batch.column("piece"), pa.array(made, pa.binary())], ["piece", "data"])

    unseen = predictors(np.zeros((1, 256)), sides, plain)
    tables = np.tile(unseen, (1 + FOLDS, int(FIRST[-1]), 1)).reshape(1 + FOLDS, -1)
    summed = sum_pieces(counted.filter("kind = 1").select("fold", "piece", "task", "n", "data"))
    for row in summed.mapInArrow(convert, "piece int, data binary").toLocalIterator():  # of fixed size in all
        tables[:, row.piece * PIECE : (row.piece + 1) * PIECE] = np.frombuffer(row.data, np.int8).reshape(1 + FOLDS, -1)
    model.fit(sum_slopes(train, [Model(symbols, own) for own in tables[1:]]))
    model.tables = tables[0]
    return model


def sum_slopes(train: DataFrame, models: list[Model]) -> np.ndarray:
    """``Model.slopes`` of all training texts, each by the model of its fold, whose tables it is not in."""
    shared = train.sparkSession.sparkContext.broadcast(models)  # of fixed size

    def run(batches):
        models = shared.value
        total = np.zeros((GATES, len(WEIGHTS), len(WEIGHTS) + 1))
        for batch in parts(batches):
            texts, folds = batch.column("text").to_pylist(), batch.column("fold").to_pylist()
            for fold in range(FOLDS):
                total += models[fold].slopes([t.lower() for t, f in zip(texts, folds, strict=True) if f == fold])
        cells = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([cells, pa.array(total.reshape(-1))], ["cell", "value"])

    out = np.zeros((GATES, len(WEIGHTS), len(WEIGHTS) + 1))
    sums = _binary(train, "fold").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    for row in sums.collect():  # a row per weight and input
        out.reshape(-1)[row.cell] = row.value
    shared.destroy()
    return out


SCORED = (
    "number long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_bytes long, "
    "rare array<struct<word:binary,n:int>>"
)


def score_texts(docs: DataFrame, model: Model, frequent: dict[bytes, float]) -> DataFrame:
    """Scores of whole texts; words that are not ``frequent`` are left in ``rare``."""
    shared = docs.sparkSession.sparkContext.broadcast((model, frequent))  # of fixed size
    word = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))

    def run(batches):
        number = TaskContext.get().partitionId() << 40
        model, frequent = shared.value
        for batch in parts(batches):
            texts = [t.lower() for t in batch.column("text").to_pylist()]
            logs = model.run(texts)
            tokens, known, base, rare = [], [], [], []
            for t in texts:
                words = t.split()
                found = list(map(frequent.get, words))
                values = [v for v in found if v is not None]
                others = Counter(w for w, v in zip(words, found, strict=True) if v is None) if len(values) < len(words) else {}
                tokens.append(len(words) + 1)
                known.append(len(values))
                base.append(math.fsum(values))
                rare.append([{"word": w, "n": n} for w, n in others.items()])
            sizes = [len(t) for t in texts]
            numbers = range(number, number + len(texts))
            number += len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), batch.column("doc_id"), batch.column("held_out"), pa.array(tokens, pa.int64()),
                 pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(logs * math.log10(2), pa.float64()),
                 pa.array(sizes, pa.int64()), pa.array(rare, word)],
                [c for c in ("number", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "n_bytes", "rare")],
            )

    source = _binary(docs, F.col("doc_id").cast("long").alias("doc_id"), "held_out")
    return source.mapInArrow(run, SCORED)


def score_documents(docs: DataFrame) -> DataFrame:
    """Scores of ``docs`` (doc_id, text, held_out), learnt from those that are not held out."""
    # equal texts lie in one fold, or copies would make the tables look better than they are
    fold = F.pmod(F.xxhash64(text_or_empty()), F.lit(FOLDS)).cast("int")
    train = docs.filter(~F.col("held_out")).withColumn("fold", fold)
    counted = store(count_training(train), "counted")
    model = build_model(counted, train)
    words = store(
        counted.filter("kind = 0").select("word", "n").groupBy("word").agg(F.sum("n").alias("n")), "words"
    )
    ends = train.count()
    total, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)) + ends, F.count(F.lit(1)) + int(ends > 0)).first()
    floor = total + vocabulary + 1
    # the least power of two above which at most FREQUENT words lie
    sizes = words.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("words")).collect()
    power, left = 64, FREQUENT
    for row in sorted(sizes, key=lambda r: -r.power):
        if row.words > left:
            break
        power, left = row.power, left - row.words
    is_frequent = (F.floor(F.log2("n")) >= power) & (F.octet_length("word") <= FREQUENT_BYTES)
    frequent = {
        bytes(r.word): math.log10((r.n + 1) / floor) for r in words.filter(is_frequent).toLocalIterator()
    }
    scored = store(score_texts(docs, model, frequent), "scored")
    rare = scored.select("number", F.explode("rare").alias("r")).select("number", "r.word", F.col("r.n").alias("times"))
    found = rare.join(words.filter(~is_frequent), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = found.groupBy("number").agg(
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(float(floor)))).alias("rare_base"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    end = math.log10((ends + 1) / floor)
    joined = scored.join(sums, "number", "left")
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) + end).alias("base_score"), "score",
        (-F.col("score") / math.log10(2) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


@query("op9_context_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod("doc_id", 7) == 2).alias("held_out"))
    return score_documents(docs)
