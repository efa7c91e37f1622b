"""Operators on single texts, each against a plain version."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from usagelens.llm import bpe, decontaminate, licences, lm, quality_model, quality_rules, secrets, url_filter
from usagelens.llm.common import count_floor, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"
ODD = [None, "", " \n\t", "one", "a b c", "a b c a b c", "\u00a0x\u2003y", "ab\x0bcd\x1cef", "x" * 100_000, "the cat " * 5_000]


def frame(spark, texts, extra=False):
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:  # columns that clash with what the operators add
        df = df.selectExpr("*", "1 AS score", "'x' AS n_words", "2 AS spans", "3 AS runs", "4 AS kept", "5 AS ids")
    return df


def by_text(df, *columns):
    return {r["text"]: tuple(r[c] for c in columns) for r in df.collect()}


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    triples = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {p for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(hit))


def test_quality_measures(spark):
    random.seed(3)
    texts = ODD + ["a|b <c> #*$%&\na|b <c> #*$%&\n \nx\nx", "é\u0301 \U0001f600 b"] + [
        "".join(random.choice("ab \n") for _ in range(random.randrange(300))) for _ in range(60)]
    got = by_text(quality_rules.judge(frame(spark, texts, extra=True)), "n_words", "word_chars", "n_symbols",
                  "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for t in texts:
        want = plain_measures(t)
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert got[t][:6] == (*want, failed), t
        assert not (failed and got[t][6])
    assert quality_rules.judge(frame(spark, []).limit(0)).count() == 0


def test_clean_prose_is_kept_and_junk_is_not(spark):
    random.seed(5)
    words = [f"{a}{b}" for a in ("stone", "river", "cloud", "grass", "lamp") for b in ("s", "ed", "ing", "er", "ly")]
    prose = " ".join(random.choice(["the", "of", "and", "to"]) if i % 3 == 0 else random.choice(words) for i in range(200))
    table = " | ".join(random.sample(words * 6, 100))
    shout = " ".join(w.upper() + "!!" for w in prose.split())
    got = by_text(quality_rules.judge(frame(spark, [prose, table, shout])), "kept")
    assert got == {prose: (True,), table: (False,), shout: (False,)}


def test_words(spark):
    got = by_text(frame(spark, ODD).select("text", words_of(F.col("text")).alias("w")), "w")
    for t in ODD:
        assert got[t][0] == WORD.findall(t or "")


def test_url_parts_and_rules(spark):
    urls = {
        "https://WWW.Example.com/en/1?x#y": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/fr/9": ("x.net", "/fr/9", "net/fr/", "block"),
        "http://x.net/en/": ("x.net", "/en/", None, None), "http://com": ("com", "", None, None),
        "nothing": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
        "a://b://c/d": ("b:", "//c/d", None, None), "s://h#f/": ("h", "", None, None),
        "s://H\u00c9.com/p\nq?z": ("h\u00c9.com", "/p\nq", "com/", "allow"), "x://" + "h" * 20_000: ("h" * 20_000, "", None, None),
    }
    rows = [(i, u, 1) for i, u in enumerate(urls)] * 2
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, score int")).collect()
    assert len(out) == len(rows)
    for r in out:
        host, path, rule, verdict = urls[r["url"]]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_model_is_the_smoothed_one(spark):
    rows = [("aab", True, 3), ("abb", True, 2), ("bab", False, 4)]
    model = url_filter.train(spark.createDataFrame(rows, "key string, accepted boolean, n int"), 3, 2.0, min_count=1)
    keys = ["aab", "bbb", "zab", ""]
    got = {r["key"]: r["score"] for r in url_filter.score(spark.createDataFrame([(k,) for k in keys], "key string"), model, 3).collect()}
    counts = {True: Counter(), False: Counter()}
    for key, side, n in rows:
        s = f"^{key}$"
        for i in range(len(s)):
            for k in range(1, 4):
                if i - k + 1 >= 0:
                    counts[side][s[i - k + 1:i + 1]] += n

    def p(side, gram):
        if not gram:
            return 1 / 256
        context = sum(n for g, n in counts[side].items() if len(g) == len(gram) and g[:-1] == gram[:-1])
        return (counts[side][gram] + 2.0 * p(side, gram[1:])) / (context + 2.0)

    for key in keys:
        s = f"^{key}$"
        total = sum(math.log(p(True, s[max(0, i - 2):i + 1]) / p(False, s[max(0, i - 2):i + 1])) for i in range(len(s)))
        assert got[key] == pytest.approx(total / (len(key) + 1), abs=1e-9)


def test_url_model_tells_the_sides_apart(spark):
    random.seed(2)
    good = [f"news{random.randrange(99)}.org/story/{random.randrange(999)}" for _ in range(300)]
    bad = [f"cheap-pills{random.randrange(99)}.biz/buy?now" for _ in range(300)]
    rows = [(u, True, 1) for u in good[:200]] + [(u, False, 1) for u in bad[:200]]
    model = url_filter.train(spark.createDataFrame(rows, "key string, accepted boolean, n int"), max_grams=2_000)
    assert model.count() <= 2_000 + 4
    keys = spark.createDataFrame([(u,) for u in {*good[200:], *bad[200:]}], "key string")
    for r in url_filter.score(keys, model).collect():
        assert (r["score"] > 0) == r["key"].startswith("news")


@pytest.fixture(scope="module")
def licence_model(spark):
    return licences.train(spark)


def test_licences(spark, licence_model):
    texts = ["Some text here.\nReleased under the MIT License.\nMore text.", "Licensed under CC BY-NC 4.0.",
             "This work is licensed under the GNU General Public License, version 3.",
             "The driver showed a license at the border.", *ODD]
    df = frame(spark, texts)
    out = licences.scan(df.union(df.limit(2)), model=licence_model)
    got = Counter((r["doc_id"], r["paragraph"], r["family"], r["confirmed"]) for r in out.collect())
    assert got == {(0, 1, "mit", True): 2, (1, 0, "cc-by-nc", True): 2, (2, 0, "gpl", True): 1}
    assert licences.scan(df.limit(0), model=licence_model).count() == 0


def test_every_template_is_recognised(spark, licence_model):
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(licences.TEMPLATES)], SCHEMA)
    got = {r["doc_id"]: r["family"] for r in licences.scan(df, model=licence_model).collect()}
    right = sum(got.get(i) == f for i, (f, _) in enumerate(licences.TEMPLATES))
    assert right >= 0.9 * len(licences.TEMPLATES)


@pytest.fixture(scope="module")
def vocabulary():
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    return path, bpe.read_vocabulary(path), pytest.importorskip("tokenizers").Tokenizer.from_file(path)


SPECIAL = ["a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext", "\u03a3 \u039f\u0394\u039f\u03a3", "\u0130I'S we'll", "e\u0301 a\u0338 \u00c5"]


def test_encoding_equals_the_library(spark, vocabulary):
    path, _, library = vocabulary
    texts = ODD + SPECIAL
    rows = by_text(bpe.encode(frame(spark, texts, extra=True), path), "n_tokens", "ids", "decoded")
    sums = by_text(bpe.digests(frame(spark, texts), path), "n_tokens", "ids_sha256", "decoded_sha256")
    for t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed, text = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        assert (rows[t][0], bytes(rows[t][1]), rows[t][2]) == (len(ids), packed, text)
        assert sums[t] == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert bpe.encode(frame(spark, []).limit(0), path).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", categories=("L", "N", "P", "S", "Z")), max_size=30), max_size=4))
def test_encoder_equals_the_library(vocabulary, texts):
    _, own, library = vocabulary
    encoder = bpe.Encoder(own, limit=5)
    for _ in range(2):
        got = encoder.encode(texts)
        assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_segment_tree_merges_the_leftmost_lowest_pair(vocabulary):
    _, own, _ = vocabulary
    random.seed(1)
    words = ["".join(random.choice("aeint") for _ in range(random.randrange(1, 40))).encode() for _ in range(300)]
    flat, sizes = bpe.merge_words(words, own, budget=64)
    rank = {(k >> 32, k & 0xFFFFFFFF): (r, own.merged[r]) for k, r in zip(own.pairs.tolist(), own.ranks.tolist())}
    for word, got in zip(words, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        ids = [int(own.first[b]) for b in word[:-1]] + [int(own.last[word[-1]])]
        while pairs := [(rank[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]:
            _, i = min(pairs)
            ids[i:i + 2] = [int(rank[(ids[i], ids[i + 1])][1])]
        assert got.tolist() == ids


def plain_spans(text):
    found = []
    for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[1]) >= 6 and m[0].isascii():
            found.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f for *_, f in sorted(found))


SECRETS = ["secret: token: abcdefgh", "\U0001f600 Api_Key = 'abc123/=+' x", "token=\"" + "0123456789abcdef" * 3 + "\"",
           "AKIA" + "A1" * 8 + " AKIA" + "B" * 15, "pa\u017f\u017fword=abcdefgh", "TOKEN:abcde passwd  = a.b-c_d", "f" * 23 + " " + "f" * 24]


def test_base_spans(spark):
    texts = ODD + SECRETS
    out = secrets.find_spans(frame(spark, texts, extra=True), [])
    for r in out.collect():
        got = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in r["base"])
        assert got == plain_spans(r["text"] or "") and r["spans"] == r["base"]


def credentials(n, seed):
    rng = random.Random(seed)
    return ["sk-" + "".join(rng.choice("0123456789ABCDEFGHJKMNPQRSTVWXYZ") for _ in range(26)) for _ in range(n)]


def test_automata_find_the_same_format_elsewhere(spark):
    known, unknown = credentials(200, 1), credentials(40, 2)
    rows = [f'api_key = "{c}"' for c in known] + [f"please use {c} for now" for c in unknown] + [
        "internationalisation2024 of configurations", "see chapter-12-section-7-of-book3", "2024-01-01T00:00:00-2024"]
    docs = frame(spark, rows)
    automata = secrets.train(docs)
    assert [a.kind for a in automata] == ["assign"]
    got = by_text(secrets.find_spans(docs, automata), "spans")
    hit = sum(any(s["kind"] == "format" for s in got[t][0]) for t in rows[200:240])
    assert hit >= 36
    assert not any(s["kind"] == "format" for t in rows[:200] + rows[240:] for s in got[t][0])
    clean = by_text(secrets.redact(docs, automata), "doc_id")
    assert '[SECRET]"' in clean and "please use [SECRET] for now" in clean
    assert not any("api_key" in t for t in clean)


def test_automata_learn_from_every_credential(spark):
    # The 400 credentials of lowest hash have one format, three times as many others another.
    rng = random.Random(9)
    lower = ["x" + "".join(rng.choice("qwertzuiop12") for _ in range(26)) for _ in range(900)]
    ranked = {r["v"]: r["h"] for r in spark.createDataFrame(
        [(c,) for c in lower + credentials(4000, 5)], "v string").select("v", F.xxhash64("v").alias("h")).collect()}
    first = sorted(lower, key=ranked.get)[:400]
    border = max(ranked[c] for c in first)
    other = [c for c in credentials(4000, 5) if ranked[c] > border][:1200]
    unknown = credentials(40, 6)
    docs = frame(spark, [f'api_key = "{c}"' for c in first + other] + [f"please use {c} for now" for c in unknown])
    automata = secrets.train(docs)
    got = by_text(secrets.find_spans(docs, automata), "spans")
    assert sum(any(s["kind"] == "format" for s in got[f"please use {c} for now"][0]) for c in unknown) >= 36


def test_distributed_counts_are_those_of_all_credentials(spark):
    values = credentials(300, 7) + ["aa", "ab", "b" * 200, "b" * 199 + "c"]
    stored = spark.createDataFrame([("assign", v) for v in values], "kind string, value string").repartition(5)
    ((moves, stop),) = secrets.infer_all(stored, ["assign"]).values()
    visits = [Counter() for _ in moves]
    for v in values:
        state = 0
        for symbol in v:
            visits[state][symbol] += 1
            state = moves[state][symbol][1]
        visits[state][""] += 1
    for state, seen in enumerate(visits):
        total = sum(seen.values())
        assert stop[state] == pytest.approx(seen[""] / total)
        assert {s: p for s, (p, _) in moves[state].items()} == pytest.approx(
            {s: n / total for s, n in seen.items() if s})


def test_an_automaton_is_a_distribution():
    moves, stop = secrets.infer([c for c in credentials(150, 3)])
    for state, move in enumerate(moves):
        assert stop[state] + sum(p for p, _ in move.values()) == pytest.approx(1)
    assert len(moves) < 60


def test_redaction_keeps_other_texts(spark):
    df = frame(spark, ODD)
    assert sorted(map(str, secrets.redact(df, secrets.train(df)).collect())) == sorted(map(str, df.collect()))


def test_index_search_equals_brute_force():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    items = {i: " ".join(rng.choices(vocabulary, k=rng.randrange(1, 25))) for i in range(80)}
    index = decontaminate.Index(items, share=0.4, block=4)
    for _ in range(200):
        terms = {w.encode() for w in rng.sample(vocabulary, rng.randrange(0, 40))}
        want = Counter()
        for t in terms:
            for item, impact in index.postings.get(t, ()):
                want[item] += impact
        want = {i: s for i, s in want.items() if s >= 1 - 1e-9}
        assert dict(index.search(terms)) == pytest.approx(want)


def test_leaks(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(800)]
    items = [" ".join(rng.choices(words, k=rng.randrange(6, 90))) + ". " + " ".join(rng.choices(words, k=8)) + "." for _ in range(30)]
    texts, planted = [], set()
    for d in range(60):
        body = rng.choices(words, k=rng.randrange(0, 700))
        if d % 3 == 0:
            i = rng.randrange(30)
            at = rng.randrange(len(body) + 1)
            body[at:at] = items[i].upper().split() if d % 2 else items[i].split()
            planted.add((d if d != 3 else None, i))
        texts.append(" ".join(body))
    docs = frame(spark, texts + ODD)
    bench = spark.createDataFrame([*enumerate(items), (None, "x y"), (77, None), (78, ""), (5, items[5])], "item_id long, text string")
    for shard in (20_000, 7):
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench, shard_items=shard).collect()}
        assert got == planted
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(texts) + len(ODD) - len(planted)
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def labelled(spark, n=160):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randrange(2, 8))) for _ in range(300)]
    rows = []
    for i in range(n):
        body = rng.choices(words, k=rng.randrange(20, 120))
        quality = int(i % 4 > 0)
        rows.append((i, " ".join(body if quality else [w + "###" for w in body]), quality))
    return (spark.createDataFrame([r[:2] for r in rows], SCHEMA),
            spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int"))


def test_quality_model_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(None, None), (None, 1), (5, None), (1, 0), (1, 1)], "doc_id long, quality int")
    model = quality_model.train(docs, labels.where("doc_id % 3 > 0").union(odd))
    scored = {r["doc_id"]: r["score"] for r in quality_model.classify(docs, model).collect()}
    want = {r["doc_id"]: r["quality"] for r in labels.where("doc_id % 3 = 0").collect()}
    assert sum((scored[i] >= 0.5) == bool(q) for i, q in want.items()) >= 0.97 * len(want)


def test_quality_model_learns_from_every_labelled_row(spark):
    # The rows of lowest hash tell nothing; with twenty a class they are all that a sample would hold.
    docs, labels = labelled(spark, 400)
    order = [r["doc_id"] for r in labels.orderBy(F.xxhash64("doc_id")).collect()]
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    blank = [i for q in (0, 1) for i in [j for j in order if quality[j] == q][:20]]
    known = docs.withColumn("text", F.when(F.col("doc_id").isin(blank), "same").otherwise(F.col("text")))
    learned = labels.where((F.col("doc_id") % 3 > 0) | F.col("doc_id").isin(blank))
    model = quality_model.train(known, learned, per_class=20)
    scored = {r["doc_id"]: r["score"] for r in quality_model.classify(docs, model).collect()}
    rest = [i for i in scored if i % 3 == 0 and i not in blank]
    assert sum((scored[i] >= 0.5) == bool(quality[i]) for i in rest) >= 0.9 * len(rest)


def test_quality_scores_equal_the_plain_model(spark):
    shape = quality_model.Features(bits=8)
    rng = np.random.default_rng(1)
    model = quality_model.Model(rng.normal(size=256).astype(np.float32), 0.3, shape)
    df = quality_model.classify(frame(spark, ODD + ["a a a b", "A a"], extra=True), model)
    for r in df.collect():
        place, share = quality_model.document_features(r["text"], shape)
        z = sum(s * float(model.scores[p]) for p, s in zip(place, share)) + 0.3
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-6)


def plain_fit(labels, features, size, dims=8, epochs=12, rate=0.5, seed=7):
    """The descent of quality_model.fit with the vectors read and written as rows of numbers."""
    places, shares = [f[0] for f in features], [f[1] for f in features]
    weight = len(labels) / (2 * np.bincount(labels, minlength=2))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dims, 1 / dims, (size, dims))
    output, bias = np.zeros((dims, 2)), np.zeros(2)
    rows = sorted(range(len(labels)), key=lambda i: (labels[i], len(places[i]), places[i].tobytes()))
    for epoch in range(epochs):
        for k, i in enumerate(rng.permutation(rows)):
            done = (epoch * len(rows) + k) / (epochs * len(rows))
            pace = rate * (1 - done) * min(weight[labels[i]], 8.0)
            mean = shares[i] @ vectors[places[i]]
            z = mean @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            step = output @ p
            output -= pace * np.outer(mean, p)
            bias -= 0.1 * pace * p
            vectors[places[i]] -= (pace * 20) * shares[i][:, None] * step
    return vectors @ (output[:, 1] - output[:, 0]), bias[1] - bias[0]


def test_quality_fit_equals_the_plain_descent_in_less_time():
    shape = quality_model.Features(bits=14)
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefgh" if i % 3 else "efghijkl", k=6)) for _ in range(400)) for i in range(60)]
    texts += [None, "", "one", "ab\ufffd \ud800"]
    labels = np.array([int(i % 3 > 0) for i in range(len(texts))])
    made = [quality_model.document_features(t, shape) for t in texts]
    sample = pd.DataFrame({"label": labels, "place": [p.tobytes() for p, _ in made], "share": [s.tobytes() for _, s in made]})
    took = {"plain": [], "fit": []}
    for _ in range(3):
        for name, run in (("plain", lambda: plain_fit(labels, made, 1 << shape.bits)),
                          ("fit", lambda: quality_model.fit(sample, shape)[:2])):
            began = time.thread_time()
            scores, bias = run()
            took[name].append(time.thread_time() - began)
            if name == "plain":
                want = scores, bias
    assert np.allclose(scores, want[0], rtol=1e-5, atol=1e-7) and bias == pytest.approx(want[1], rel=1e-9)
    assert min(took["fit"]) < 0.8 * min(took["plain"])


def test_quality_features_hash_a_word_once(monkeypatch):
    # Words are decoded together, which may change nothing: odd bytes at the ends of words, and framing signs.
    text = "ab <> > \ud800x x\udfff \ufffd é\u0301 \U0001f600\U0001f600 a\x0bb ab ab"
    shape, hashed = quality_model.Features(bits=12), []
    digest = quality_model.xxhash.xxh64_intdigest
    monkeypatch.setattr(quality_model.xxhash, "xxh64_intdigest", lambda w: hashed.append(w) or digest(w))
    place, share = quality_model.document_features(text, shape)
    words = [w.encode("utf-8", "surrogatepass") for w in re.split("[ \x0b]", text)]
    assert hashed == words
    counts, number = Counter(), [digest(w) for w in words]
    for w, h in zip(words, number):
        keys, framed = [h], [ord(c) for c in "<" + w.decode("utf-8", "replace") + ">"]
        for n in (3, 4):
            for at in range(len(framed) - n + 1):
                key = n
                for c in framed[at:at + n]:
                    key = key * 0x100000001B3 % 2**64 ^ c
                keys.append(key ^ key >> 29)
        counts.update(max(k * 0x9E3779B97F4A7C15 % 2**64 >> 52, 1) for k in keys)
    for a, b in zip(number, number[1:]):
        mixed = (a * 0xC2B2AE3D27D4EB4F % 2**64 ^ b) * 0x9E3779B97F4A7C15 % 2**64
        counts[0 if a == b else max(mixed >> 52, 1)] += 1
    assert dict(zip(place.tolist(), share.tolist())) == {
        k: float(np.float32(n / counts.total())) for k, n in counts.items()}


def test_quality_model_without_labels(spark):
    docs, labels = labelled(spark, 8)
    for none in (labels.limit(0), labels.where("quality = 1")):
        scores = {r["score"] for r in quality_model.classify(docs, quality_model.train(docs, none)).collect()}
        assert scores == {0.5}


def plain_counts(texts):
    counts = Counter()
    for t in texts:
        counts.update([*[w.lower() if w.isascii() else w for w in WORD.findall(t or "")], ""])
    return counts


@pytest.mark.parametrize("frequent", [3, 200_000])
def test_lm_base_score_and_normalisation(spark, frequent):
    texts = ODD + ["The cat THE dog", "a b", "unseen words here"]
    docs = frame(spark, texts)
    learned = docs.where("text <> 'unseen words here' or text is null")
    counts = lm.count_tokens(learned, max_frequent=frequent, flush=4)
    want = plain_counts(texts[:-1])
    assert (counts.total, counts.distinct) == (sum(want.values()), len(want))
    assert {r["token"]: r["n"] for r in counts.table.collect()} == want
    model = lm.train(learned, counts, classes=5, dims=4)
    out = lm.score(docs.union(docs.limit(2)), model, counts)
    assert out.count() == len(texts) + 2
    n, v = counts.total, counts.distinct
    for r in lm.score(docs.selectExpr("*", "text AS body"), model, counts).collect():
        tokens = plain_counts([r["body"]])
        assert (r["n_tokens"], r["n_known"]) == (sum(tokens.values()), sum(c for w, c in tokens.items() if want[w]))
        assert r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(sum(c * math.log10((want[w] + 1) / (n + v + 1)) for w, c in tokens.items()))
        assert r["score"] < 0
    scorer = lm.Scorer(model)
    for one, two in ((0, 1), (2, len(model.bias)), (len(model.bias), len(model.bias))):
        k = len(model.bias)
        p = 10 ** scorer.score(np.arange(k), np.full(k, one), np.full(k, two))
        assert p.sum() == pytest.approx(1, abs=1e-4)


def test_lm_learns_word_order(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["one two three", "red green blue"]) for _ in range(60)) for _ in range(300)]
    docs = frame(spark, texts)
    counts = lm.count_tokens(docs)
    sums = lm.score(docs, lm.train(docs, counts), counts).agg({"score": "sum", "base_score": "sum"}).first()
    assert sums["sum(score)"] > 0.75 * sums["sum(base_score)"]


def test_lm_without_training_texts(spark):
    docs = frame(spark, ODD)
    counts = lm.count_tokens(docs.limit(0))
    rows = lm.score(docs, lm.train(docs.limit(0), counts), counts).collect()
    assert len(rows) == len(ODD) and all(r["n_known"] == 0 and r["base_score"] == 0 for r in rows)
    assert lm.score(docs.limit(0), lm.train(docs, lm.count_tokens(docs)), lm.count_tokens(docs)).count() == 0


def test_count_floor(spark):
    df = spark.createDataFrame([(n,) for n in (1, 1, 1, 2, 2, 50, 900)], "n long")
    assert [count_floor(df, "n", k) for k in (7, 6, 4, 2, 1, 0)] == [1, 2, 2, 50, 900, None]
