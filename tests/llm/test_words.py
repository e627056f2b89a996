"""Source audit, phrase mining and language identification against brute force, their SQL and held-out rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from recspark.llm import arrow_terms, collocations, divergence, language_id, registry
from recspark.llm.packed import pack, unpack
from recspark.llm.phrase_index import pairs, phrases

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COMMON = ["the", "of", "and", "New", "York", "city", "Été", "naïve", "x1", "日本"]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def some_docs(seed, n=240):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = rng.choices(COMMON, k=rng.randrange(0, 60)) + [f"w{rng.randrange(80)}" for _ in range(rng.randrange(20))]
        if rng.random() < 0.5:
            words[len(words) // 2 : len(words) // 2] = ["in", "New", "York", "City", "now"] * rng.randrange(1, 4)
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "  ", "\x0b", "; "]) for w in words)
        out.append((i, rng.choice([text] * 12 + [None, "", " . ,"]), rng.choice(["en", "en", "fr", None, ""]), rng.choice(["a", "a", "b", "é", None, ""]), 0))
    out += [out[3], out[3], (n, "solo", "zz", "a", 0), (n + 1, None, "yy", "a", 0), (n + 2, "z" * 30000 + " the of", "en", "b", 0), (n + 3, "the of and " * 9000, "fr", "a", 0)]
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(some_docs(5, 500), DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def by_sql(folder, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    got = con.sql(registry.SQL[name])
    return got.columns, sorted(got.fetchall())


@pytest.mark.parametrize("name", ["op11_divergence", "op12_collocations"])
def test_registered_queries_equal_their_sql(spark, folder, name):
    columns, want = by_sql(folder, name)
    df = registry.QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want
    assert len(want) > 5


# ---- source audit


def brute_audit(rows, min_docs, top):
    count, docs, groups = defaultdict(Counter), Counter(), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text)))
        count[lang, source].update(terms)
        docs.update((lang, t) for t in terms)
    kept = defaultdict(list)
    for (lang, t), n in docs.items():
        if n >= min_docs:
            kept[lang].append(t)
    out = []
    for lang, source in groups:
        terms, own = kept[lang], count[lang, source]
        total = Counter()
        for g, s in groups:
            if g == lang:
                total.update(count[g, s])

        def share(c, t, terms=terms):
            return 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in terms) + 2 * len(terms))

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        pair = [(o, sum(gap(share(own, t), share(count[lang, o], t)) for t in terms)) for g, o in groups if g == lang and o != source]
        term = [(t, gap(share(own, t), share(total, t))) for t in terms if own[t] and share(own, t) > share(total, t)]
        for part, got, most in (("pair", pair, 10**9), ("term", term, top)):
            got.sort(key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, r) for r, (item, value) in enumerate(got[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize(("min_docs", "top"), [(10, 10), (1, 3), (10**6, 10)])
def test_audit_equals_brute_force(spark, monkeypatch, min_docs, top):
    rows = some_docs(min_docs)
    monkeypatch.setattr(divergence, "CHUNK_TERMS", 7)
    df = spark.createDataFrame(rows, DOCS)
    assert sorted(map(tuple, divergence.audit(df, min_docs, top).collect())) == brute_audit(rows, min_docs, top)


def test_audit_of_no_rows_and_of_other_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert divergence.audit(empty).collect() == []
    rows = some_docs(2, 40)
    extra = [(*r, "x", 1, "y") for r in rows]
    df = spark.createDataFrame(extra, DOCS + ", term string, n long, chunk string")
    assert sorted(map(tuple, divergence.audit(df, 2).collect())) == brute_audit(rows, 2, 10)


def test_partial_counts_are_merged_in_bounded_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "HELD_ROWS", 5)
    monkeypatch.setattr(arrow_terms, "SLICE_BYTES", 8)
    batch = pa.record_batch({"lang": ["en"] * 6, "source": ["a", "b"] * 3, "text": ["one two one", "two", "three one", "", "four five six", "one"]})
    got = Counter()
    for b in divergence.partial_counts(iter([batch, batch])):
        for r in b.to_pylist():
            got[r["source"], r["term"]] += np.array([r["n"], r["docs"]])
    assert {k: tuple(v) for k, v in got.items()}["a", "one"] == (6, 4)
    assert {k: tuple(v) for k, v in got.items()}["b", "one"] == (2, 2)


def test_shares_are_exact_beyond_64_bit_products():
    counts, totals = np.array([10**13, 7, 0, 10**12 + 1]), np.array([10**15, 11, 3, 10**12 + 3])
    assert divergence.shares(counts, totals).tolist() == [1 + 10**9 * (int(c) + 2) // int(t) for c, t in zip(counts, totals, strict=True)]


# ---- phrase mining


def brute_phrases(rows, least, first):
    f, n = Counter(), Counter()
    for _, text, lang, _, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, 6):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    inner = Counter()
    for (lang, w), a in cand.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                inner[lang, w[i : i + m]] = max(inner[lang, w[i : i + m]], a)
    out, per = [], defaultdict(list)
    for (lang, w), a in cand.items():
        if inner[lang, w] < a:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
            score, _, l, r = min(cuts)
            per[lang].append((-score, -a, " ".join(w).encode(), l, r))
    for lang, got in per.items():
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(got)[:first], 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "first", "shard_words", "bucket_words"), [(20, 2000, 50, 40), (3, 9, 400, 10**6), (1, 50, 10**6, 1000)])
def test_phrases_equal_brute_force(spark, least, first, shard_words, bucket_words):
    rows = some_docs(least, 60 if least == 1 else 240)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = collocations.mine(df, least, first, shard_words=shard_words, bucket_words=bucket_words)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, least, first)


def test_phrases_of_no_rows_and_of_other_columns(spark):
    assert collocations.mine(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.mine(spark.createDataFrame([(1, None, None, None, 0), (2, " ,. ", "en", None, 0)], DOCS)).collect() == []
    rows = some_docs(8, 50)
    df = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], DOCS + ", word string, shard long, phrase string")
    assert sorted(map(tuple, collocations.mine(df, 5).collect())) == brute_phrases(rows, 5, 2000)


def test_index_equals_counting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        runs = [rng.integers(1, rng.integers(2, 5), rng.integers(1, 12)).tolist() for _ in range(rng.integers(1, 8))]
        seq = np.array([0, *[x for r in runs for x in (*r, 0)]])
        count = Counter(tuple(r[i : i + m]) for r in runs for m in range(1, 7) for i in range(len(r) - m + 1))
        got = {}
        for ids, n, left, right in phrases(seq, 1, 5):
            got |= {tuple(i): x for i, *x in zip(ids.tolist(), n.tolist(), left.tolist(), right.tolist(), strict=True)}
        assert {k: v[0] for k, v in got.items()} == {k: v for k, v in count.items() if len(k) < 6}
        for k, (n, left, right) in got.items():
            assert left == next((w for w in range(1, 6) if count.get((w, *k)) == n), 0)
            assert right == next((w for w in range(1, 6) if count.get((*k, w)) == n), 0)
        assert {(a, b): n for a, b, n in zip(*(x.tolist() for x in pairs(seq)), strict=True)} == {k: v for k, v in count.items() if len(k) == 2}


def test_packed_columns_come_back():
    columns = [np.array([0, 1, 2**62]), np.array([5, 5, 300])]
    assert [c.tolist() for c in unpack(pack(*columns))] == [c.tolist() for c in columns]
    assert [len(c) for c in unpack(pack(np.zeros(0, np.int64)))] == [0]


# ---- language identification

SYLLABLES = {"aa": "ka lo mi sen tor", "bb": "ei sch ung ver ich", "cc": "日 本 語 学 校"}


def speech(rng, lang):
    return " ".join("".join(rng.choices(SYLLABLES[lang].split(), k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 40))).capitalize() + "."


def lang_docs(n=300, seed=4):
    rng = random.Random(seed)
    langs = [rng.choice(["aa", "aa", "aa", "bb", "cc"]) for _ in range(n)]
    return [(i, speech(rng, x), x, "s", 0) for i, x in enumerate(langs)]


def test_registered_query_names_languages_of_held_out_rows(spark, tmp_path):
    odd = [(900, None, "aa", "s", 0), (901, "", None, "s", 0), (902, "12 34 !?", "bb", "s", 0), (903, "kalo " * 40000, None, "s", 0), (904, "語" * 30000, "cc", "s", 0)]
    rows = lang_docs() + odd
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in registry.QUERIES["op13_language"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, _, lang, _, _ in rows[:300]:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["lang_pred"] == lang
        assert 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (900, 901, 902, 903, 904)] == ["und", "und", "und", "aa", "cc"]
    assert [got[i]["score"] for i in (900, 901, 902)] == [0.0] * 3
    assert not any(got[i]["accepted"] for i in (900, 901, 902))


def test_prediction_ignores_ids_and_labels(spark):
    docs = spark.createDataFrame(lang_docs(), DOCS)
    model = language_id.fit(docs)
    text = "Kalomi sen torka"
    rows = spark.createDataFrame([(1, text, "bb", "x", 0), (None, text, None, None, 0), (1, text, "cc", "y", 9)], DOCS)
    got = language_id.identify(rows, model, ["doc_id", "lang"]).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("aa", got[0]["score"])}
    with pytest.raises(ValueError, match="score"):
        language_id.identify(rows.withColumnRenamed("lang", "score"), model, ["score"])


def test_scores_equal_the_formula_and_do_not_depend_on_batches():
    rng = np.random.default_rng(2)
    model = language_id.Model(["a", "b"], rng.normal(size=(language_id.BUCKETS, 2)).astype(np.float32), np.array([0.1, -0.2]), 1.7, 0.6)
    texts = ["One two, one TWO three", "éÉ x", "solo", None, "5"]
    _, score, accepted = language_id.predict(pa.array(texts), model)
    for i, t in enumerate(texts[:3]):
        terms = re.findall(r"[^\W\d_]+", t.lower())
        buckets = np.concatenate([language_id.term_features(pa.array([w]))[0] for w in terms])
        logits = (model.value[buckets].astype(float).mean(axis=0) + model.bias) * 1.7
        p = np.exp(logits) / np.exp(logits).sum()
        assert score[i] == pytest.approx(p.max())
        assert accepted[i] == (p.max() >= 0.6)
        assert language_id.predict(pa.array([t]), model)[1][0] == pytest.approx(score[i])
    n = [len(language_id.term_features(pa.array([w]))[0]) for w in ("a", "abc")]
    assert n == [1 + 2 + 1, 1 + 4 + 3 + 2]


def test_rejection_keeps_to_the_wanted_error():
    rng = np.random.default_rng(3)
    model = language_id.Model(["a", "b"], np.zeros((language_id.BUCKETS, 2), np.float32), np.zeros(2))
    model.value[0], model.value[1] = (3, 0), (0, 3)
    rows = [(lang, np.array([0, 1]), np.array([x, 1 - x], np.float32)) for x in rng.random(400) for lang in ("ab"[int(x + rng.normal() * 0.15 < 0.5)],)]
    language_id.calibrate(model, rows, 0.02)
    p = model.probabilities(np.array([w @ model.value[at] + model.bias for _, at, w in rows]))
    keep = p.max(axis=1) >= model.least
    wrong = np.array([model.langs[i] for i in p.argmax(axis=1)]) != np.array([r[0] for r in rows])
    assert 0 < keep.sum() < 400
    assert wrong[keep].mean() <= 0.02 < wrong.mean()


def test_language_model_without_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    model = language_id.fit(empty)
    assert language_id.identify(empty, model, ["doc_id"]).collect() == []
    rows = spark.createDataFrame([(1, "some words", None, None, 0)], DOCS)
    assert [r["lang_pred"] for r in language_id.identify(rows, model, ["doc_id"]).collect()] == ["und"]
    assert language_id.fit(rows).langs == ["und"]
