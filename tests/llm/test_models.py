"""Language, quality, private data, mixing, scores and packing."""

import ipaddress
import math
import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starmill.llm import context_mixing, language, mixing, packing, pii, quality

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, row string, own double, n int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 1.0, 2) for i, t, lang, s in rows], SCHEMA)


# --- language ---


def test_held_out_language_and_spans(spark):
    out = language.op2(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.9
    train = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.learn(train)
    en, de = "the and that thing with this " * 6, "der die und nicht keit schung auch eine " * 6
    rows = [(1, en + de, None, ""), (2, "12 .. 3", None, ""), (3, None, None, ""), (4, "", None, ""), (5, en * 400, None, "")]
    docs = documents(spark, rows).withColumn("held_out", F.lit(False)).select("doc_id", "held_out", "text")
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de"] and got[5].lang_pred == "en"
    assert [got[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3 and got[3].score == 0
    nothing = language.learn(train.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_viterbi_is_the_best_sequence():
    rng = np.random.default_rng(0)
    lengths, penalty = np.array([6, 4, 4, 1]), 0.7
    starts = np.cumsum(lengths) - lengths
    scores = rng.normal(size=(lengths.sum(), 3))
    labels = language.viterbi(scores, starts, lengths, penalty)

    def value(a, seq):
        return sum(scores[a + i, s] for i, s in enumerate(seq)) - penalty * sum(x != y for x, y in zip(seq, seq[1:]))

    for a, n in zip(starts, lengths):
        best = max((tuple(int(d) for d in np.base_repr(c, 3).zfill(n)) for c in range(3**n)), key=lambda s: value(a, s))
        assert value(a, labels[a : a + n].tolist()) == pytest.approx(value(a, best))


# --- quality ---


def test_quality_rejects_bad_texts_and_shrinks_sparse_sites(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        vocabulary = ["junk", "spam", "***"] if bad else ["calm", "true", "kind"]
        rows.append((i, " ".join(rng.choice(vocabulary + ["and", "the"]) for _ in range(30)), "en", "big" if i else "tiny"))
        labels.append((i, int(not bad)))
    rows += [(400, None, None, None), (401, "", "en", "big"), (401, "", "en", "big")]
    docs = documents(spark, rows)
    marked = spark.createDataFrame(labels[:200] + [(None, 1), (3, None)], "doc_id long, good int")
    out = quality.assess(docs, marked, F.col("source"), F.col("lang")).collect()
    assert len(out) == 403
    held = [r for r in out if 200 <= r.row.doc_id < 400]
    assert sum(r.keep == (r.row.doc_id % 4 != 0) for r in held) / len(held) > 0.98
    big = next(r for r in out if r.host == "big")
    tiny = next(r for r in out if r.host == "tiny")
    assert abs(tiny.site - big.site) < 0.3  # one bad document doesn't condemn its site
    assert quality.assess(docs.limit(0), marked, F.col("source"), F.col("lang")).count() == 0
    assert quality.assess(docs, marked.limit(0), F.col("source"), F.col("lang")).filter("own = 0.5").count() == 403


# --- private data ---


def test_surrogates_keep_type_layout_and_coreference(spark):
    texts = [
        "write to Jo.Doe@mail.example.com or call +1 (499) 555-6503, card 4041894974608795 from 42.144.35.254",
        "JO.DOE@MAIL.EXAMPLE.COM called +1 499 555 6503. password=b7db7aa4a5fcc78305 Mr. John Smith met Mrs. Anna Smith",
        'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" and 4041 8949 7460 8795 господин Иван Петров', "nothing here, version 2.0", "", None,
    ]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    out = {r.row.doc_id: r for r in pii.replace_private(docs).collect()}
    new = [out[i].new_text for i in range(6)]
    for secret in ("Doe", "DOE", "499", "4041", "42.144", "b7db7", "1eb9c", "Smith", "John", "Anna", "Иван"):
        assert not any(secret in t for t in new[:3]), secret
    assert new[3:] == texts[3:] and [out[i].n_replaced for i in (3, 4, 5)] == [0, 0, 0]
    email = new[0].split()[2]
    assert email.upper() in new[1] and email.endswith(".com")  # the same address in capitals
    card = new[0].split("card ")[1][:16]
    assert card.isdigit() and card in new[2].replace(" ", "")
    smith = [w for w in new[1].replace(".", "").split()]
    assert smith[smith.index("Mr") + 2] == smith[smith.index("Mrs") + 2]
    assert all("а" <= c.lower() <= "я" for c in new[2].split("господин ")[1].replace(" ", ""))
    assert new[1].split("password=")[1].split()[0].isalnum()
    assert [r.new_text for r in pii.replace_private(docs, key="another").filter("row.doc_id = 0").collect()] != [new[0]]
    assert pii.without_private(docs).columns == docs.columns and pii.without_private(docs.limit(0)).count() == 0


def test_names_are_followed_and_check_digits_fit(spark):
    texts = [
        "Mr. John Smith came. Smith left, and John waved; Johnson's and Smithy stay. Mrs. Smith's O'Neill? SMITH",
        "Smith and John without a title", "Frau Anne-Marie O'Neill: Anne stays, Anne-Marie and O'Neill's go",
        "cards 4539 1488 0343 6467 and 4539148803436467 and 4539148803436461, bank DE89 3704 0044 0532 0130 00",
        "GB82WEST12345698765432 2001:0db8:85a3:0000:0000:8a2e:0370:7334 and 2001:DB8::FF00:42:8329 or 2001:db8::ff00:42:8329",
        "std::vec a::b 12:30:45 C::D::E and fe::cafe",
    ]
    out = {r.row.doc_id: r for r in pii.replace_private(documents(spark, [(i, t, "en", "") for i, t in enumerate(texts)])).collect()}
    new = [out[i].new_text for i in range(len(texts))]
    john, smith = new[0].removeprefix("Mr. ").split(" came")[0].split(" ")
    assert new[0] == texts[0].replace("John Smith", f"{john} {smith}").replace("Smith left, and John w", f"{smith} left, and {john} w").replace("Mrs. Smith", f"Mrs. {smith}")
    assert {john, smith}.isdisjoint({"John", "Smith"}) and new[1] == texts[1] and new[5] == texts[5]
    assert out[0].n_replaced == 4
    anne, neill = new[2].removeprefix("Frau ").split(":")[0].split(" ")
    assert new[2] == f"Frau {anne} {neill}: Anne stays, {anne} and {neill}'s go"

    def luhn(number):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(number))) % 10 == 0

    spaced, plain, unfit = regex.findall(r"[0-9]{4}(?: ?[0-9]{4}){3}", new[3].split(", bank")[0])
    assert spaced.replace(" ", "") == plain != unfit and luhn(plain) and plain not in texts[3] and unfit not in texts[3]
    for bank in (new[3].split("bank ")[1], new[4].split(" ")[0]):
        number = bank.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1 and bank not in "".join(texts)
    six = new[4].split(" ")[1::2]
    assert ipaddress.ip_address(six[0]) != ipaddress.ip_address(texts[4].split(" ")[1])
    assert six[1].lower() == six[2] != texts[4].split(" ")[-1] and six[1] == six[1].upper() and ipaddress.ip_address(six[2])


def test_private_data_against_brute_force(spark):
    rng = random.Random(4)
    shapes = ["Mr. {} {}", "{}", "so {}, then", "jo{}@{}.com", "Herr {}", "123-45-678{}", "10.0.{}.1", "and", "+49 30 1234 56{}", "password=x{}"]
    names = ["John", "Smith", "Иван", "O'Neill", "Anne-Marie", "7", "9", "Will"]
    texts = [" ¦ ".join(rng.choice(shapes).format(rng.choice(names), rng.choice(names)) for _ in range(rng.randrange(0, 40))) for _ in range(120)]
    texts += texts[:5] + ["x " * 30_000 + "¦ Mr. John Smith" + " ¦ John ¦ a@b.com" * 2000]
    out = {r.row.doc_id: r for r in pii.replace_private(documents(spark, [(i, t, "en", "") for i, t in enumerate(texts)]), "k").collect()}
    assert len(out) == len(texts)
    made, any_ = {}, regex.compile(pii.ANY)
    for i, text in enumerate(texts):
        alone = {w for m in any_.findall(text) if regex.fullmatch(pii.PERSON, m) for w in m.split(" ")[1:]}
        words = "|".join(sorted(alone, key=lambda w: (len(w), w), reverse=True))
        own = regex.compile(pii.ANY + (rf"|(?<!\p{{L}})(?=\p{{Lu}})(?:{words})(?!\p{{L}})" if alone else ""))
        assert out[i].n_replaced == len(own.findall(text))
        old, new = text.split(" ¦ "), out[i].new_text.split(" ¦ ")
        assert len(old) == len(new)
        for a, b in zip(old, new, strict=True):
            found = own.findall(a)
            if len(found) != 1:
                assert found or a == b
                continue
            before, after = own.split(a)
            assert b.startswith(before) and b.endswith(after) and a != b
            one = b[len(before) : len(b) - len(after)]
            parts = zip(found[0].split(" "), one.split(" "), strict=True) if regex.fullmatch(pii.PERSON, found[0]) else [(found[0], one)]
            for x, y in parts:
                made.setdefault(x.lower() if "@" in x else x, set()).add(y)
    titles = {"Mr.", "Herr"}
    assert all(len(v) == 1 for k, v in made.items() if k not in ("John", "Smith", "Will", "Anne-Marie", "O'Neill", "Иван"))
    assert all(len(v) <= 2 for v in made.values())  # a word as given and as family name
    assert all(made[t] == {t} for t in titles) and len(made) > 20
    assert sum(len(v) for v in made.values()) == len(set().union(*made.values()))


def test_secrets_are_replaced_whole(spark):
    token = "eyJ" + "aB3_x-9.Q" * 120
    values = [token, "P@ssw0rd2024", "correcthorse", "hunter2!x", "+9" + "z7" * 600, "xq1", "пароль٣!k"]
    texts = [f"a password={v} b" for v in values] + ["say token: {, or secret=*** b", 'x "api_key": "Xy&7#q", y']
    out = pii.replace_private(documents(spark, [(i, t, "en", "") for i, t in enumerate(texts)])).collect()
    new = {r.row.doc_id: r.new_text for r in out}
    for i, v in enumerate(values):
        made = new[i].removeprefix("a password=").removesuffix(" b")
        assert len(made) == len(v) and made[:2] != v[:2], v
        kept = [c == d for c, d in zip(v, made, strict=True) if c.isalnum()]
        assert sum(kept[-20:]) <= len(kept[-20:]) / 2 and sum(kept) <= len(kept) / 2, v
        assert [c for c in made if not c.isalnum()] == [c for c in v if not c.isalnum()], v
    assert new[7] == texts[7] and new[8] != texts[8] and new[8].endswith('", y')


def test_colliding_surrogates_draw_again(spark):
    forms = spark.createDataFrame([("ssn", f"{i:02d}") for i in range(30)], "kind string, form string")
    made = {r.form: r.made for r in pii.surrogates(forms, "k").collect()}
    assert len(made) == 30 == len(set(made.values())) and not set(made) & set(made.values())


def test_short_forms_never_run_out(spark):
    forms = [("ssn", f"{i:02d}") for i in range(90)] + [("email", f"{a}@{b}.io") for a in "abcdefgh" for b in "abcdefghijklmnopqrstuvwxyz"]
    forms += [("email", f"{a}@{b}.io") for a in "ijklmnopqrst" for b in "abcdefghijklmnopqrstuvwxyz"]
    made = {(r.kind, r.form): r.made for r in pii.surrogates(spark.createDataFrame(forms, "kind string, form string"), "k").collect()}
    new = {(k, m) for (k, _), m in made.items()}
    assert set(made) == set(forms) and len(new) == len(forms) and not new & set(forms)
    longer = spark.createDataFrame([("ssn", "1-2", "12", "345")], "kind string, own string, form string, made string")
    assert longer.select(pii._poured(F.col("own"), F.col("form"), F.col("made"))).first()[0] == "3-45"


# --- mixing ---


def test_exponent_meets_entropy_or_repeats():
    tokens = {"a": 9000, "b": 900, "c": 100, None: 0}
    flat = mixing.weights_at(tokens, 0.0)
    target = 0.9 * mixing.entropy({k: v for k, v in flat.items() if tokens[k]})
    found = mixing.weights_at(tokens, mixing.fit_exponent(tokens, target_entropy=target))
    assert mixing.entropy(found) <= target + 1e-6
    exponent = mixing.fit_exponent(tokens, max_repeats=3.0)
    repeats = mixing.repeats_at(tokens, exponent)
    assert max(repeats.values()) == pytest.approx(3.0) and min(repeats.values()) == pytest.approx(1.0)


def test_passes_are_whole_and_the_last_keeps_its_budget(spark):
    rows = [(i, "w " * (1 + i % 7), None, "a" if i < 600 else "b" if i < 900 else None) for i in range(1000)] + [(5, "", None, "z")]
    docs = documents(spark, rows)
    out = mixing.mix(docs, max_repeats=1.7, block_tokens=50).select("row.*", "pass", "block", "place").collect()
    times = Counter(r.doc_id for r in out if r.source != "z")
    assert set(times) == set(range(1000)) and max(times.values()) <= 2
    tokens, taken = Counter(), Counter()
    for i, t, _, s in rows:
        tokens[s] += len(t.split())
    for r in out:
        taken[r.source] += len(r.text.split())
    want = mixing.repeats_at(tokens, mixing.fit_exponent(tokens, max_repeats=1.7))
    for s, n in tokens.items():
        assert abs(taken[s] - n * want.get(s, 0)) <= 8, s
    assert sum(r.source == "z" for r in out) == 1 and all(0 <= r.place <= 2 for r in out)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_equal_rows_keep_to_the_budget(spark):
    """A source of one repeated row, and one of which a part repeats; tokens taken are those asked for."""
    rows = [(1, "w " * 15, None, "a")] * 2000 + [(i, "v " * 5, None, "b") for i in range(3000)] + [(9, "u " * 9, None, "b")] * 500
    rows += [(i, "x", None, "c") for i in range(40)]
    docs = documents(spark, rows).repartition(6)
    out = mixing.mix(docs, max_repeats=1.3).select("row.*", "pass").collect()
    tokens, taken = Counter(), Counter()
    for _, t, _, s in rows:
        tokens[s] += len(t.split())
    for r in out:
        taken[r.source] += len(r.text.split())
    want = mixing.repeats_at(tokens, mixing.fit_exponent(tokens, max_repeats=1.3))
    for s, n in tokens.items():
        assert abs(taken[s] - n * want[s]) <= 15, s
    first = Counter((r.source, r.doc_id) for r in out if r["pass"] == 0)
    assert first == Counter((s, i) for i, _, _, s in rows)


# --- scores ---


def test_base_scores_and_a_proper_distribution(spark):
    rows = [(i, t, None, "") for i, t in enumerate(["A b a", "b c", None, "", "zz a\tb", "a b c d"] * 5)]
    docs = documents(spark, rows).select("doc_id", "text", (F.col("doc_id") % 5 == 4).alias("held_out"))
    out = {r.doc_id: r for r in context_mixing.score_documents(docs).collect()}
    tokens = {i: (t or "").lower().split() + ["$end"] for i, t, _, _ in rows}
    counts = Counter(w for i, ws in tokens.items() if i % 5 != 4 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in tokens.items():
        r = out[i]
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.score < 0
    assert context_mixing.score_documents(docs.limit(0)).count() == 0
    model = context_mixing.Model(np.full(256, 3.0))
    cells = np.zeros(context_mixing.CELLS, np.uint32)
    context_mixing.count_cells([b"abracadabra"] * 20, cells)
    model.tables = context_mixing.predictors(cells.reshape(-1, 256), model.sides, model.plain).reshape(-1)
    model.tune([b"abracadabra"] * 3)
    one = [bytes([c]) for c in range(255)]
    total = 2.0 ** model.run([b""])[0] + sum(2.0**x for x in model.run(one))
    assert total < 1 and model.run([b"abracadabra"])[0] > model.run([b"dxbgacaqqqa"])[0]


def test_all_training_texts_are_counted_and_fit_the_weights(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["mill", "star", "sun", "a"]) for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    texts += [texts[0], "", None]
    docs = documents(spark, [(i, t, None, "") for i, t in enumerate(texts)]).select("doc_id", "text")
    train = docs.withColumn("fold", (F.col("doc_id") % 2).cast("int")).repartition(3)
    counted = context_mixing.count_training(train).cache()
    plain = [(t or "").encode() for t in texts]
    symbols = sum(np.frombuffer(r.data, np.int64) for r in counted.filter("kind = 2").collect())
    assert symbols.sum() == sum(len(t) + 1 for t in plain) and symbols[context_mixing.END] == len(texts)
    model = context_mixing.build_model(counted, train)
    tables, sums = [], 0
    for texts_of in (plain, plain[1::2], plain[::2]):  # all, then without a fold
        cells = np.zeros(context_mixing.CELLS, np.uint32)
        context_mixing.count_cells(texts_of, cells)
        tables.append(context_mixing.predictors(cells.reshape(-1, 256), model.sides, model.plain).reshape(-1))
    assert (model.tables == tables[0]).all()
    by_hand = context_mixing.Model(symbols)
    for fold in range(2):
        by_hand.tables = tables[1 + fold]
        sums = sums + by_hand.slopes(plain[fold::2])
    by_hand.fit(sums)
    assert np.allclose(by_hand.weights, model.weights, atol=2e-3)
    assert not np.allclose(model.weights, context_mixing.WEIGHTS, atol=0.05)


def test_scores_and_slopes_are_those_of_a_plain_loop_over_the_bits():
    rng = random.Random(9)
    words = [b"mill", b"star", b"a", b"\xc3\xa9t\xc3\xa9", b"7.5", b"\n"]
    texts = [b" ".join(rng.choice(words) for _ in range(n)) for n in (0, 1, 40, 63, 64, 65, 700)] + [b" ", b"\xff\x00 "]
    symbols = sum(np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts)
    cells = np.zeros(context_mixing.CELLS, np.uint32)
    context_mixing.count_cells(texts, cells)
    model = context_mixing.Model(symbols)
    tables = context_mixing.predictors(cells.reshape(-1, 256), model.sides, model.plain)
    model.tables = tables.reshape(-1)
    assert (model.tables == tables.reshape(-1)).all()
    model.weights = np.random.default_rng(9).normal(0.3, 0.2, model.weights.shape).astype(np.float32)
    model.rate = 0.01  # so that what a text has taught shows in its score
    k, whole = len(context_mixing.WEIGHTS), np.zeros(context_mixing.CELLS, np.uint32)
    want, slopes = [], np.zeros((context_mixing.GATES, k, k + 1))
    for t in texts:
        data, (start,), (end,) = context_mixing.laid_out([t])
        rows = context_mixing.context_rows(data)
        refined, step, score = np.zeros(k), np.zeros(k), 0.0
        for at in range(start, end):
            if (at - start) % context_mixing.BLOCK == 0:
                refined, step = refined + model.rate * step, np.zeros(k)
            for row in rows[:, at]:
                whole[row * 256 + data[at]] += 1
            for depth, (node, bit) in enumerate(model.paths[data[at]]):
                gate = min(depth, 3) + (0 if data[at - 1] in b"\0 \t\n\v\f\r" else context_mixing.GATES // 2)
                x = np.array([*(tables[rows[:, at], node] / context_mixing.SCALE), model.logit[node], 1.0])
                sign = 2 * bit - 1
                margin = min(14, max(-14, sign * float((model.weights[:, gate] + refined) @ x)))
                score -= math.log2(1 + math.exp(-margin))
                step += sign * x / (1 + math.exp(margin))
                wrong = 1 / (1 + math.exp(sign * float(model.weights[:, gate] @ x)))
                slopes[gate, :, k] += wrong * sign * x
                slopes[gate, :, :k] += wrong * (1 - wrong) * np.outer(x, x)
        want.append(score)
    assert (whole == cells).all()
    assert np.allclose(model.run(texts), want, rtol=1e-5)
    assert np.allclose(model.run(texts[::-1])[::-1], model.run(texts), rtol=0, atol=0)
    assert np.allclose(model.slopes(texts), slopes, rtol=1e-4, atol=1e-2)


def test_places_that_agree_are_predicted_once_and_long_texts_in_parts(monkeypatch):
    rng = random.Random(12)
    words = [b"mill", b"star", b"sun", b"\xc3\xa9t\xc3\xa9", b"", b"a"]
    texts = [b" ".join(rng.choice(words) for _ in range(n)) for n in (3000, 0, 700, 1, 2000)]
    numbers = context_mixing.place_numbers(texts, context_mixing.SYMBOLS)
    own, n = context_mixing.distinct(numbers)
    assert n.sum() == len(numbers) == sum(len(t) + 1 for t in texts) and set(own.tolist()) == set(numbers.tolist())
    data, starts, ends = context_mixing.laid_out(texts)
    rows = np.concatenate([context_mixing.context_rows(data)[:, a:z] for a, z in zip(starts, ends)], 1)
    assert (context_mixing.rows_of(numbers) == rows).all()
    first, where = context_mixing.grouped(numbers)
    assert (first[where] == numbers).all() and (np.diff((first >> context_mixing.LEAF).astype(int)) >= 0).all()
    cells = np.zeros(context_mixing.CELLS, np.uint32)
    context_mixing.count_cells(texts, cells)
    model = context_mixing.Model(sum(np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts))
    model.tables = context_mixing.predictors(cells.reshape(-1, 256), model.sides, model.plain).reshape(-1)
    made, inputs = [], model.inputs
    monkeypatch.setattr(model, "inputs", lambda places: made.append(len(places)) or inputs(places))
    whole = model.run(texts)
    assert sum(made) == len(own) < len(numbers) / 10
    monkeypatch.setattr(context_mixing, "SEGMENT", 2 * context_mixing.BLOCK)
    assert np.allclose([model.run([t])[0] for t in texts], whole, rtol=1e-9)


# --- packing ---


def test_pieces_are_exact_and_sequences_gapless(spark):
    path = packing.public_tokenizer()
    rng = random.Random(2)
    texts = [" ".join(f"word{rng.randrange(500)}" for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    texts += ["", None, "é日本 <|endoftext|> x\x01y", "long " * 900, texts[0]]
    rows = [(i, t, None, "") for i, t in enumerate(texts)] + [(None, "null id", None, ""), (0, texts[0], None, "")]
    out = packing.pack(documents(spark, rows), path, capacity=256).collect()
    tokenizer = Tokenizer.from_file(path)
    lengths = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t, _, _ in rows if i != 0}
    found, places = Counter(), {}
    for r in out:
        found[r.doc_id] += r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(found[i] == n for i, n in lengths.items())
    for pieces in places.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 256
    assert len(places) <= -(-sum(found.values()) // 256) + 2
    assert packing.pack(documents(spark, []).limit(0), path).count() == 0


def whole_ids(text):
    tokenizer = Tokenizer.from_file(packing.public_tokenizer())
    return np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()


def test_tokens_equal_those_of_the_whole_tokenizer(monkeypatch):
    encoder = packing.Encoder(packing.public_tokenizer())
    texts = ["", " ", "Çá va? I'd they'LL 12ab x y İstanbul ΣΑΣ", "a\x01b <|endoftext|> c", "a\x02b \x00c", "\t\nx\x85y", "½ ² 한국어", "École"]
    rng = random.Random(6)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZäöüßéèñŽ0123456789'.,;:!?()-_/\\#@$%&*+=[]{}\"\u00a0—’"
    for _ in range(300):
        texts.append(" ".join("".join(rng.choices(letters, k=rng.randrange(1, 14))) for _ in range(20)))
    texts += ["the quick brown fox " * 30, "x" * 5000, "ab" * 100]
    want = [whole_ids(t) for t in texts]
    assert encoder.encode([t.encode() for t in texts]) == want
    monkeypatch.setattr(packing, "PORTION_BYTES", 40)  # pieces, and words forgotten in between
    monkeypatch.setattr(packing, "CACHE_BYTES", 2000)
    small = packing.Encoder(packing.public_tokenizer())
    assert small.encode([t.encode() for t in texts + texts[:5]]) == want + want[:5]


def test_known_words_stay_within_their_bound(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_BYTES", 100_000)
    monkeypatch.setattr(packing, "PORTION_BYTES", 2000)
    encoder = packing.Encoder(packing.public_tokenizer())
    for i in range(60):
        encoder.encode([" ".join(f"w{i}x{j}" for j in range(300)).encode()])
        assert encoder.size < 250_000 and len(encoder.known) * packing.ENTRY_BYTES < 250_000


def test_other_vocabularies_are_encoded_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Hello  World, it's\nÉté"
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert packing._merges(path) is None
    assert packing.Encoder(path).encode([text.encode()]) == [np.array(ids, np.uint32).tobytes()]


def test_plans_place_every_length_once():
    rng = np.random.default_rng(4)
    counts = np.zeros(257, np.int64)
    counts[1:] = rng.integers(0, 40, 256)
    plan = packing.best_plan(counts, 256)
    placed = np.zeros(257, np.int64)
    for length, _, n, _, offset in plan.rows:
        placed[length] += n
        assert offset + length <= 256
    assert np.array_equal(placed, counts)
    assert plan.sequences <= 1.01 * (counts * np.arange(257)).sum() / 256


# --- pipeline ---


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = corpus_pipeline.store(out, "stage")
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality classifier":
            good = [i for i in before if labels.get(i) == (1, 0)]
            assert sum(i in after for i in good) / len(good) > 0.95
        elif name != "n-gram Jaccard join":
            assert before == after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == after
