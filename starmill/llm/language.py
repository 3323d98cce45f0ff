"""Language of words, spans and texts (operator 2).

The model counts hashed character n-grams (one to three characters around each letter) of all
training words per language, in a table of fixed size, and which scripts a language uses. The
script of a word, from ranges of code points, narrows its languages to those that use the script;
each of these scores the word by its n-grams. Viterbi then labels the words of a text with the
best sequence of languages, in which every switch costs a penalty, so short intrusions stay with
their surroundings and longer ones become spans. Many texts go through the same step of the
recursion together. The language of a text is the one with most letters.

Word counts per language are shuffled sums; the model that reaches the driver has a fixed number
of rows and one column per language.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and no spans, and so
is every text if no training text has both a language and a letter. Null ids count as training
ids. Repeated rows count as often as they occur. More than ``MAX_LANGUAGES`` languages raise an
error. No rows give no rows. Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.llm.common import crc_mod, hash64, in_batches, query, table, text_or_empty

SLOTS = 1 << 16
MAX_LANGUAGES = 512
SWITCH = 8.0  # nats
ALIEN = -30.0  # score of a word in a language that doesn't use its script
LEAST_SHARE = 0.002  # of a language's letters, for it to use a script
SMOOTHING = 0.5
CACHED_WORDS = 400_000
BATCH_WORDS = 500_000
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")

# First code points of ranges of scripts
RANGES = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "other"), (0x1E00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "other"), (0x2C60, "Latin"), (0x2C80, "other"), (0x3040, "Kana"), (0x3100, "other"),
    (0x3130, "Hangul"), (0x3190, "other"), (0x31F0, "Kana"), (0x3200, "other"), (0x3400, "Han"),
    (0xA000, "other"), (0xA720, "Latin"), (0xA800, "other"), (0xAC00, "Hangul"), (0xD7B0, "other"),
    (0xF900, "Han"), (0xFB00, "other"), (0xFB50, "Arabic"), (0xFE00, "other"), (0xFF66, "Kana"),
    (0xFFA0, "Hangul"), (0xFFDD, "other"), (0x20000, "Han"), (0x32000, "other"),
]
STARTS = np.array([start for start, _ in RANGES])
NAMES = sorted({name for _, name in RANGES})
SCRIPT = np.array([NAMES.index(name) for _, name in RANGES])


def script_of(points: np.ndarray) -> np.ndarray:
    return SCRIPT[np.searchsorted(STARTS, points, "right") - 1]


def _grams(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots (3 per letter), the word of each letter and its code point; words have no spaces."""
    points = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    letters = np.flatnonzero(points != 32)
    word = np.cumsum(points == 32)[letters] - 1
    here, left, right = points[letters], points[letters - 1], points[letters + 1]
    shifts = (np.uint64(21), np.uint64(42))
    keys = np.stack([here, (left << shifts[0]) | here | np.uint64(1 << 63), (left << shifts[1]) | (here << shifts[0]) | right])
    return (hash64(keys + np.uint64(7)) % np.uint64(SLOTS)).astype(np.int64), word, here.astype(np.int64)


def _gram_counts(words: DataFrame, languages: list[str]) -> DataFrame:
    """Sums per language and slot, and per language and script (slots from SLOTS on)."""
    place = {lang: i for i, lang in enumerate(languages)}

    def run(batches):
        width = SLOTS + len(NAMES)
        counts = np.zeros((len(languages), width))
        for batch in batches:
            for lang in set(batch.column("lang").to_pylist()):
                mine = [i for i, x in enumerate(batch.column("lang").to_pylist()) if x == lang]
                found = batch.column("word").take(pa.array(mine)).to_pylist()
                n = batch.column("n").take(pa.array(mine)).to_numpy()
                slots, word, points = _grams(found)
                for order in range(3):
                    counts[place[lang]] += np.bincount(slots[order], n[word], width)
                counts[place[lang]] += np.bincount(SLOTS + script_of(points), n[word], width)
        lang, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[lang, slot])],
            ["lang", "slot", "n"],
        )

    return words.mapInArrow(run, "lang int, slot int, n double").groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def learn(train: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, scores (slot, language) and allowed (script, language) from text and lang."""
    words = (
        train.filter(F.col("lang").isNotNull())
        .select("lang", F.explode(F.regexp_extract_all(F.lower(text_or_empty()), F.lit(r"\p{L}[\p{L}\p{M}]*"), F.lit(0))).alias("word"))
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    found = train.filter(F.col("lang").isNotNull()).select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r.lang for r in found)
    counts = np.zeros((len(languages), SLOTS + len(NAMES)))
    if languages:
        for row in _gram_counts(words, languages).collect():  # a fixed number of rows per language
            counts[row.lang, row.slot] = row.n
    known = counts.sum(1) > 0
    languages, counts = [x for x, k in zip(languages, known, strict=True) if k], counts[known]
    grams, scripts = counts[:, :SLOTS] + SMOOTHING, counts[:, SLOTS:]
    scores = np.log(grams / grams.sum(1, keepdims=True)).T / 3
    allowed = (scripts / np.maximum(scripts.sum(1, keepdims=True), 1) >= LEAST_SHARE).T
    return languages, np.ascontiguousarray(scores, np.float32), allowed


def score_words(words: list[str], scores: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Log likelihood of each word in each language, less that in the best one."""
    slots, word, points = _grams([w.lower() for w in words])
    first = np.searchsorted(word, np.arange(len(words)))
    total = np.add.reduceat(scores[slots].sum(0), first)
    may = allowed[script_of(points[first])]
    total = np.where(may | ~may.any(1, keepdims=True), total, total.max(1, keepdims=True) + ALIEN)
    return total - total.max(1, keepdims=True)


def viterbi(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word of texts in a row; texts are in descending order of length."""
    n = scores.shape[1]
    came = np.empty(scores.shape, np.uint8 if n <= 255 else np.uint16)  # from which label
    value = np.zeros((len(lengths), n))
    active = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
    own = np.arange(n)
    for step, a in enumerate(active):
        now, at = value[:a], starts[:a] + step
        best = now.argmax(1)
        switched = now[np.arange(a), best][:, None] - penalty
        stays = now >= switched
        came[at] = np.where(stays, own, best[:, None])
        value[:a] = np.where(stays, now, switched) + scores[at]
    labels = np.empty(len(scores), came.dtype)
    label = value.argmax(1)
    for step in range(len(active) - 1, -1, -1):
        a = active[step]
        at = starts[:a] + step
        labels[at] = label[:a]
        label[:a] = came[at, label[:a]]
    return labels


_cache: dict = {}


def _label(texts: list[str], model: tuple) -> list[tuple]:
    """(language, score, spans) of each text; spans are (first word, last word, language)."""
    languages, scores, allowed = model
    key = id(scores)
    if _cache.get("model") != key or len(_cache["place"]) > CACHED_WORDS:
        _cache.update(model=key, place={}, score=np.zeros((0, len(languages)), np.float32))
    place = _cache["place"]
    found = [WORD.findall(t) for t in texts]
    if fresh := list(set().union(*found).difference(place)):
        place.update(zip(fresh, range(len(place), len(place) + len(fresh)), strict=True))
        _cache["score"] = np.concatenate((_cache["score"], score_words(fresh, scores, allowed)))
    order = sorted(range(len(texts)), key=lambda i: -len(found[i]))
    lengths = np.array([len(found[i]) for i in order], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    total = int(lengths.sum())
    words = np.fromiter((place[w] for i in order for w in found[i]), np.int64, total)
    letters = np.fromiter((len(w) for i in order for w in found[i]), np.int64, total)
    labels = viterbi(_cache["score"][words], starts, lengths, SWITCH)
    out: list = [("und", 0.0, [])] * len(texts)
    for i, a, b in zip(order, starts, ends, strict=True):
        if a < b:
            mine = labels[a:b]
            share = np.bincount(mine, letters[a:b], len(languages))
            best = int(share.argmax())
            cuts = np.concatenate(([0], np.flatnonzero(mine[1:] != mine[:-1]) + 1, [b - a]))
            spans = [(int(x), int(y) - 1, languages[mine[x]]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            out[i] = (languages[best], float(share[best] / share.sum()), spans)
    return out


LABELLED = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<first_word:int,last_word:int,lang:string>>"


def identify(docs: DataFrame, model: tuple) -> DataFrame:
    """Language, score and spans of each of ``docs`` (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    span = pa.list_(pa.struct([("first_word", pa.int32()), ("last_word", pa.int32()), ("lang", pa.string())]))

    def run(batch: pa.RecordBatch):
        texts, at = batch.column("text"), 0
        while at < batch.num_rows:
            group, size = [], 0
            while at + len(group) < batch.num_rows and (not group or size < 6 * BATCH_WORDS):
                group.append(texts[at + len(group)].as_py() or "")
                size += len(group[-1])
            found = _label(group, shared.value) if shared.value[0] else [("und", 0.0, [])] * len(group)
            lang, score, spans = zip(*found, strict=True)
            spans = [[dict(zip(("first_word", "last_word", "lang"), s, strict=True)) for s in x] for x in spans]
            end = at + len(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[at:end], batch.column("held_out")[at:end], pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(spans, span)],
                ["doc_id", "held_out", "lang_pred", "score", "spans"],
            )
            at = end

    return docs.mapInArrow(in_batches(run), LABELLED)


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", crc_mod("doc_id", 4) == 2)
    model = learn(docs.filter(~F.col("held_out")).select("text", "lang"))
    out = identify(docs.select(F.col("doc_id").cast("long"), "held_out", "text"), model)
    return out.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))
