"""Ranked lexical search by a hybrid of term-at-a-time and document-at-a-time (operator 11).

Terms, weights and scores are whole numbers, so every way of adding them gives the same result.

1. One scan counts the terms of each whole text and keeps the counts of the terms that some item
   asks for. It is written; corpus figures (documents, terms, documents per term) come from it.
2. Each task turns its documents into posting lists, block by block. For an item, the short lists
   of the block are summed term at a time into accumulators. These become one iterator whose
   bound is the greatest sum. With the long lists, each bounded by its greatest score, it goes
   through the block document at a time: only iterators that can still lift a document to the
   threshold give candidates, and the others are looked up for candidates that need them.
   The threshold is the k-th best score of the task so far and carries over to its next blocks.
3. The best of all tasks are ranked per item.

Items are dealt to blocks of bounded number and size, each searched in its own pass, so the
vocabulary that tasks hold is bounded. No posting list of the corpus is ever gathered.

Defined cases: null or empty texts have no terms and are neither counted nor found; an item
without terms gives no rows. A null ``doc_id`` is an ordinary document and comes last among equal
scores. Repeated documents are separate documents; rows that agree in item and text are one item,
and an id with several texts is several items. Texts are split in pieces of bounded size at the
borders of terms, so long ones need no more memory. No rows give no rows. Further columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.llm.common import in_batches, query, store, table

K = 20
ITEM_BLOCK = 4096  # items searched in one pass
ITEM_BYTES = 16 << 20  # and their texts, together
PIECE = 4 << 20  # bytes of a text split at once
BLOCK_POSTINGS = 1 << 20
BLOCK_DOCUMENTS = 16_384
SHORT = 1 / 16  # lists with at most this share of a block's documents are summed first
WINDOW = 2048  # documents between two looks at the threshold

# bytes of a term stay, ASCII letters lower-cased; all others part terms
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists of bounded size."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = at + PIECE
        if end < len(folded):
            end = folded.find(b" ", end)
            end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = max(end, at + 1)


def count_terms(text: bytes) -> Counter:
    counts: Counter = Counter()
    for piece in terms_of(text):
        counts.update(piece)
    return counts


def matched_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, and numbers and counts of the vocabulary's terms, for documents with a term."""

    def run(batch: pa.RecordBatch):
        ids, texts = batch.column(0), batch.column(1)
        taken, lengths, terms, counts, ends = [], [], [], [], [0]
        for i in range(batch.num_rows):
            found = count_terms(texts[i].as_py())
            if not found:
                continue
            for term in found.keys() & vocabulary.keys():
                terms.append(vocabulary[term])
                counts.append(found[term])
            taken.append(i)
            lengths.append(found.total())
            ends.append(len(terms))
        at = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(taken, pa.int64())),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(at, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(at, pa.array(counts, pa.int64())),
            ],
            ["doc_id", "n", "terms", "counts"],
        )

    source = docs.filter(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    return source.mapInArrow(in_batches(run), "doc_id long, n long, terms array<int>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Postings:
    """The posting lists of one block of documents; documents are known by their place in it."""

    def __init__(self, documents: int, terms: np.ndarray, counts: np.ndarray, document: np.ndarray, measure: np.ndarray,
                 n_terms: int):
        order = np.argsort(terms, kind="stable")
        self.documents = documents
        self.document = document[order]
        self.impact = ((1_000_000_000 * counts) // (1000 * counts + 12 * measure[document]))[order]
        self.starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.peak = np.zeros(n_terms, np.int64)
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            self.peak[filled] = np.maximum.reduceat(self.impact, self.starts[filled])

    def length(self, terms: np.ndarray) -> np.ndarray:
        return self.starts[terms + 1] - self.starts[terms]

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.starts[term], self.starts[term + 1])
        return self.document[part], self.impact[part]


class Best:
    """The k best documents of an item so far: score, then id, null ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def threshold(self) -> int:
        """The least score that may still enter."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score = np.concatenate((self.score, score))
        ids, null = np.concatenate((self.ids, ids)), np.concatenate((self.null, null))
        if len(score) > 4 * self.k:
            kept = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids, null = score[kept], ids[kept], null[kept]
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.ids, self.null = score[order], ids[order], null[order]


def search_block(lists: Postings, terms: np.ndarray, factors: np.ndarray, best: Best, ids: np.ndarray, null: np.ndarray):
    """Take the block's best documents for one item into ``best``."""
    lengths = lists.length(terms)
    present = np.flatnonzero(lengths)
    short = lengths[present] <= lists.documents * SHORT
    iterators = []  # bound, documents, scores
    if short.any():
        sums = np.zeros(lists.documents, np.int64)
        for i in present[short]:
            document, impact = lists.of(terms[i])
            sums[document] += factors[i] * impact  # a document is in a list once
        document = np.flatnonzero(sums)
        if len(document):
            iterators.append((int(sums[document].max()), document, sums[document]))
    for i in present[~short]:
        document, impact = lists.of(terms[i])
        iterators.append((int(factors[i] * lists.peak[terms[i]]), document, factors[i] * impact))
    iterators.sort(key=lambda entry: entry[0])
    reach = np.cumsum([bound for bound, _, _ in iterators])  # what the first iterators can add up to
    for low in range(0, lists.documents, WINDOW):
        threshold = best.threshold
        first = int(np.searchsorted(reach, threshold))  # those before it can't reach the threshold together
        if first == len(iterators):
            return
        parts = [np.searchsorted(document, (low, low + WINDOW)) for _, document, _ in iterators]
        window = np.zeros(WINDOW, np.int64)
        for (a, b), (_, document, score) in zip(parts[first:], iterators[first:], strict=True):
            window[document[a:b] - low] += score[a:b]
        found = np.flatnonzero(window)
        total = window[found]
        for i in range(first - 1, -1, -1):
            able = total + reach[i] >= threshold
            found, total = found[able], total[able]
            if not len(found):
                break
            (a, b), (_, document, score) = parts[i], iterators[i]
            if a < b:
                at = np.minimum(a + np.searchsorted(document[a:b], found + low), b - 1)
                total = total + np.where(document[at] == found + low, score[at], 0)
        able = total >= threshold
        if able.any():
            place = found[able] + low
            best.add(total[able], ids[place], null[place])


def search(stored: DataFrame, items: list[tuple], n_terms: int, documents: int, length: int, k: int = K) -> DataFrame:
    """The best documents of each task for each item: item (its number), doc_id, score."""

    def blocks(batch: pa.RecordBatch):
        lists, counts = batch.column("terms"), batch.column("counts")
        offsets, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy()
        offsets = offsets - offsets[0]
        tf, n = counts.flatten().to_numpy(), batch.column("n").to_numpy()
        null = np.array(batch.column("doc_id").is_null())
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        measure = 100 - 25 + (25 * n * documents) // length
        a = 0
        while a < len(n):
            b = int(np.searchsorted(offsets, offsets[a] + BLOCK_POSTINGS, "right")) - 1
            b = min(len(n), a + BLOCK_DOCUMENTS, max(b, a + 1))
            part = slice(offsets[a], offsets[b])
            document = np.repeat(np.arange(b - a), np.diff(offsets[a : b + 1]))
            yield Postings(b - a, flat[part], tf[part], document, measure[a:b], n_terms), ids[a:b], null[a:b]
            a = b

    def run(batches):
        best = [Best(k) for _ in items]
        for batch in batches:
            if batch.num_rows:
                for lists, ids, null in blocks(batch):
                    for (terms, factors), own in zip(items, best, strict=True):
                        search_block(lists, terms, factors, own, ids, null)
        sizes = [len(b.score) for b in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()),
                    pa.array(np.concatenate([b.ids for b in best]), pa.int64(), mask=np.concatenate([b.null for b in best])),
                    pa.array(np.concatenate([b.score for b in best]), pa.int64()),
                ],
                ["item", "doc_id", "score"],
            )

    return stored.mapInArrow(run, "item int, doc_id long, score long")


def _search_items(docs: DataFrame, items: list, k: int) -> DataFrame:
    """Rank the documents for one block of items."""
    spark = docs.sparkSession
    asked = [count_terms(i.text.encode()) for i in items]
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*asked)))}
    stored = store(matched_terms(docs, vocabulary), "terms")
    documents, length = stored.agg(F.count(F.lit(1)), F.sum("n")).first()
    held = stored.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # the vocabulary at most
    weights = np.zeros(len(vocabulary), np.int64)
    for row in held:
        weights[row.term] = weight(documents, row["count"])
    wanted = []
    for counts in asked:
        terms = np.array([vocabulary[t] for t in counts], np.int64)
        factors = np.array(list(counts.values()), np.int64) * weights[terms]
        wanted.append((terms[factors > 0], factors[factors > 0]))
    found = search(stored, wanted, len(vocabulary), documents or 0, length or 1, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    numbers = spark.createDataFrame([(n, i.item_id) for n, i in enumerate(items)], "item int, item_id long")
    return ranked.join(F.broadcast(numbers), "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    asked = store(
        items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text").distinct(), "items"
    )
    n, size = asked.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-n // ITEM_BLOCK), -(-(size or 0) // ITEM_BYTES))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = asked.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in range(blocks):
        some = dealt.filter(F.col("block") == block).collect()  # bounded in number and size
        if some:
            found = found.unionByName(store(_search_items(docs, some, k), "ranked"))
    return found


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

OP11_SQL = f"""WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS place, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT place, doc_id, len(terms) AS n FROM texts WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
counts AS MATERIALIZED (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(terms) AS term FROM texts) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term),
items AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, terms
  FROM (SELECT DISTINCT item_id, text, {_TERMS} AS terms FROM benchmark WHERE text IS NOT NULL)),
wanted AS (SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY ALL),
scores AS (
  SELECT item, place, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total)))))
         AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (place), totals GROUP BY ALL),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores JOIN items USING (item) JOIN lengths USING (place) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {K}"""


@query("op11_hybrid_search", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
