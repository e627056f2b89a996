import hashlib
import random
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.llm import archives, components, jaccard_join, packing, pieces, quality_model, weighted_sampling

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text))


# ---- n-gram Jaccard join


def test_rounds_of_few_links_shuffle_nothing_and_many_links_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    links = [(i + 1, i) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (300, 300)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    least = {x: x for p in links for x in p}
    for _ in links:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    df, plans, kept = spark.createDataFrame(links, "a long, b long").repartition(5), [], components.written

    def watched(rows, name):
        plans.append((name, rows._jdf.queryExecution().executedPlan().toString()))
        return kept(rows, name)

    monkeypatch.setattr(components, "written", watched)
    for few, shuffled in ((components.FEW_LINKS, False), (0, True)):
        monkeypatch.setattr(components, "FEW_LINKS", few)
        plans.clear()
        assert dict(map(tuple, components.components(df).collect())) == least
        assert {"Exchange hashpartitioning" in plan for name, plan in plans if name == "stars"} == {shuffled}


def brute_groups(texts, n, percent):
    sets = []
    for t in texts:
        w = words_of(t)
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set()))
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for q in s for j in inverted[q])
        for j, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for q in s:
            inverted[q].append(i)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def family(rng, size, length, edits, vocabulary=400):
    base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_join_against_brute_force(spark, n, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", 10)
    rng = random.Random(n)
    texts = [None, "", "  ", "One", "one ", "a b", "b a", "A B", "a b c d e f g h i j k l", "a b c d e f g h i j k l m"]
    texts += family(rng, 60, 120, 3) + family(rng, 60, 60, 6) + family(rng, 40, 200, 30) + ["same copy of a text that is here often enough"] * 50
    line = " ".join(f"common{i}" for i in range(60))
    texts += [line + " " + " ".join(f"r{rng.randrange(10**6)}" for _ in range(rng.randrange(40))) for _ in range(80)]
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 30, 3)]
    rng.shuffle(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs_of(spark, texts), n, percent).collect()}
    assert got == dict(enumerate(brute_groups(texts, n, percent)))


def test_join_edges(spark):
    assert jaccard_join.join_groups(docs_of(spark, ["a"]).limit(0), 3, 90).count() == 0
    rows = [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (2, "A b c d"), (None, None), (5, ""), (None, "p q r"), (None, "p q r")]
    rows = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component_id int")
    got = sorted((tuple(r) for r in jaccard_join.join_groups(rows, 3, 90).collect()), key=str)
    assert got == sorted([(None, 2, 2), (4, 2, 2), (4, 2, 2), (2, 2, 2), (None, 0, None), (5, 0, 5), (None, 1, None), (None, 1, None)], key=str)


def test_join_of_ids_with_several_texts(spark):
    rng = random.Random(8)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(3)]
    near = [" ".join([*b[:-1], "other"]) for b in base]
    texts = [" ".join(b) for b in base]
    rows = [(7, texts[0]), (7, texts[1]), (7, texts[1]), (3, near[0]), (None, near[1]), (None, texts[2]), (None, near[2])]
    rows = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard_join.join_groups(rows, 3, 90).collect()), key=str)
    assert got == sorted([(7, 58, 3), (3, 58, 3), (7, 58, 7), (7, 58, 7), (None, 58, 7), (None, 58, None), (None, 58, None)], key=str)


def test_candidates_of_a_large_near_group(spark, monkeypatch):
    rng, made, own = random.Random(2), {}, jaccard_join.counted

    def counted(df, name):
        out, made[name] = own(df, name)
        return out, made[name]

    monkeypatch.setattr(jaccard_join, "counted", counted)
    texts = []
    for _ in range(400):
        w = [f"b{i}" for i in range(150)]
        for _ in range(rng.randrange(6)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs_of(spark, texts), 5, 80).collect()}
    assert got == dict(enumerate(brute_groups(texts, 5, 80)))
    # with one pivot for all lists of the group 3908 pairs were left
    assert made["likely"] <= len(texts)


@pytest.mark.parametrize("by_shuffle", [False, True])
def test_join_of_long_and_many_near_sets(spark, monkeypatch, by_shuffle):
    if by_shuffle:
        monkeypatch.setattr(jaccard_join, "BROADCAST_IDS", 0)
        monkeypatch.setattr(jaccard_join, "BLOCK_ENTRIES", 8)
        monkeypatch.setattr(jaccard_join, "HEAD", 1)
    rng = random.Random(9)
    # above WIDE_SIZE shingles, with likenesses on both sides of the bound; one text above two MiB
    texts = family(rng, 24, 1500, 60, 10**6) + family(rng, 60, 400, 22, 10**6)
    giant = " ".join(f"w{rng.randrange(10**7)}" for _ in range(300_000))
    texts += [giant, giant + " tail"]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_groups(docs_of(spark, texts), 5, 80).collect()}
    assert got == dict(enumerate(brute_groups(texts, 5, 80)))


def brute_links(texts, n, percent):
    """Pairs of rows that link, rows of equal sets included."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set() for w in words]
    return {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if x and 100 * len(x & y) >= percent * len(x | y)}


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_pairs_against_brute_force(spark, n, percent):
    rng = random.Random(n)
    texts = [None, "", "One", "one ", "a b", "A B"] + family(rng, 40, 120, 3) + family(rng, 30, 200, 30) + ["same copy of a text that is here often enough"] * 5
    chain = [f"c{i}" for i in range(300)]
    texts += [" ".join(chain[i : i + 100]) for i in range(0, 30, 3)]
    rng.shuffle(texts)
    pairs, members = jaccard_join.join_pairs(docs_of(spark, texts), n, percent)
    rep = {r.doc_id: r.node for r in members.collect()}
    linked = [tuple(r) for r in pairs.collect()]
    assert len(rep) == len(texts) and len(linked) == len(set(linked)) and all(a < b for a, b in linked)
    linked = set(linked)
    got = {(i, j) for i in rep for j in range(i) if rep[i] is not None and rep[j] is not None and (rep[i] == rep[j] or tuple(sorted((rep[i], rep[j]))) in linked)}
    assert got == brute_links(texts, n, percent)


# ---- fingerprints


def test_fingerprints_estimate_generalised_jaccard(spark):
    rng = random.Random(6)
    texts = [None, "", "a", "a a a b", "A a A B"] + family(rng, 150, 80, 40, 60)
    got = {r.doc_id: r for r in weighted_sampling.compare_with_edits(docs_of(spark, texts), 11).collect()}
    errors = []
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)] or ""
        edited = weighted_sampling.edited(t or "", following)
        assert got[i].n_chars == len(t or "") and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, got[i].near_edited), (following, got[i].near_next)):
            a, b = Counter(words_of(t)), Counter(words_of(other))
            union = sum((a | b).values())
            errors.append(near - (sum((a & b).values()) / union if union else 1.0))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08
    assert got[3].fingerprint == got[4].fingerprint and len(got[0].fingerprint) == 4 * weighted_sampling.SAMPLES
    one = weighted_sampling.with_fingerprint(docs_of(spark, texts).withColumn("fingerprint", F.lit(1)))
    assert {r.doc_id: r.fingerprint for r in one.collect()} == {i: r.fingerprint for i, r in got.items()}
    assert weighted_sampling.compare_with_edits(docs_of(spark, ["x"]).limit(0)).count() == 0
    assert [r.near_next for r in weighted_sampling.compare_with_edits(docs_of(spark, ["x y"])).collect()] == [1.0]


def test_ranges_of_many_cuts_are_found_by_a_small_expression(spark):
    """The expression grew threefold with each step, and held the cuts each time: 250 buckets took more than the driver's memory."""
    cuts = [3 * i - 500 for i in range(63)]
    assert len(str(weighted_sampling._range_of(F.col("v"), cuts))) < 2000
    for cuts in ([], [7], [3 * i - 500 for i in range(8191)]):
        got = spark.range(-600, 25_000, 97).select("id", weighted_sampling._range_of(F.col("id"), cuts).alias("at")).collect()
        assert [r["at"] for r in got] == [bisect_left(cuts, r["id"]) for r in got]
    nulls = spark.range(1).select(weighted_sampling._range_of(F.lit(None).cast("long"), [-1, 5]).alias("at")).first()
    assert nulls["at"] == 0


# ---- classifier


def test_fingerprints_of_many_words_and_repeats(spark):
    rng = np.random.default_rng(7)
    for n, trials in ((200, 60), (20_000, 6)):
        off = []
        for _ in range(trials):
            w = rng.integers(0, 2**63, 3 * n // 2, dtype=np.uint64)
            a, b = w[:n], np.append(w[n // 2 :], w[n // 2 : n])  # a third of the words of ``b`` occur twice
            x, y = (dict(zip(*np.unique(k, return_counts=True), strict=True)) for k in (a, b))
            true = sum(min(x.get(k, 0), y.get(k, 0)) for k in x | y) / sum(max(x.get(k, 0), y.get(k, 0)) for k in x | y)
            off.append(weighted_sampling.likeness(weighted_sampling.samples(a), weighted_sampling.samples(b)) - true)
        assert abs(np.mean(off)) < 4 * 0.06 / trials**0.5
    monkey = [(None, "a b"), (None, "a b"), (None, None), (5, "x"), (5, "x"), (7, "q " * 5000)]
    got = weighted_sampling.compare_with_edits(spark.createDataFrame([(*r, 1) for r in monkey], "doc_id long, text string, bucket int"), 2).collect()
    assert sorted(r.n_chars for r in got) == [0, 1, 1, 3, 3, 10_000] and len({r.fingerprint for r in got if r.doc_id == 5}) == 1


def test_classifier_on_held_out_rows(spark):
    rng = random.Random(1)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "reads", "well"]) + rng.choice(["s", "ing", ""]) for _ in range(40)) for _ in range(200)]
    bad = [" ".join(rng.choice(["ALPHA!!", "BETA!!", "wins||", "$$$"]) for _ in range(40)) for _ in range(40)] + ["spam " * 50] * 20
    texts = good + bad
    docs = docs_of(spark, texts + [None, "", "é" * 70000])
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(260)] + [(3, None)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels, where=F.col("doc_id") % 5 != 0)
    got = {r.doc_id: r.score for r in quality_model.scored(docs, model).collect()}
    held = [i for i in range(260) if i % 5 == 0]
    assert all((got[i] >= 0.3) == (i < 200) for i in held) and all(0 <= s <= 1 for s in got.values())
    assert got[260] == got[261]
    again = {r.doc_id: r.score for r in quality_model.score(docs.withColumn("score", F.lit("x")), quality_model.fit(docs, labels, where=F.col("doc_id") % 5 != 0)).collect()}
    assert again == pytest.approx(got)
    flat = quality_model.fit(docs, labels.where("quality = 1"))
    assert quality_model.scored(docs, flat).where("score < 0.5").count() == 0
    assert quality_model.scored(docs.limit(0), model).count() == 0


def test_classifier_with_repeats_and_long_texts(spark):
    rows = [(i % 40, "good words here" if i % 2 else "BAD!! $$$") for i in range(80)] + [(41, "worse lines " * 9000), (42, "worse lines"), (1, "zz later text"), (None, "good words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(41, 0), (3, 0), (None, 0)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels)
    got = quality_model.score(docs, model).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.text == "good words here"}) == 1
    assert max(r.score for r in got if "BAD" in r.text or r.doc_id in (41, 42)) < 0.3 < min(r.score for r in got if "good" in r.text)
    assert len(quality_model.scored(docs, model).collect()) == len(rows)


def test_score_is_the_mean_over_features():
    model = quality_model.Model(np.random.default_rng(1).normal(size=quality_model.BUCKETS), 0.3)
    text = "the cat the the Hut\nhut a"
    at, share = quality_model.document_features(text)
    want = 1 / (1 + np.exp(-(share @ model.value[at] + 0.3)))
    assert quality_model.Scorer(model).scores([text])[0] == pytest.approx(want, abs=1e-5)


# ---- packing


def test_best_fit_decreasing_against_brute_force():
    rng = random.Random(2)
    for _ in range(100):
        lengths, bins = [rng.randint(1, 50) for _ in range(rng.randint(0, 60))], []
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            fits = [b for b in bins if 50 - sum(lengths[j] for j in b) >= lengths[i]]
            (min(fits, key=lambda b: 50 - sum(lengths[j] for j in b)) if fits else bins.append([]) or bins[-1]).append(i)
        got = packing.best_fit_decreasing(lengths, 50)
        assert sorted(sum(got, [])) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in b) for b in got) == sorted(sum(lengths[i] for i in b) for b in bins)


def test_packing_roundtrip(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", "a", "two  spaces\n\tand é 一", "long " * 500] + [" ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 90))) for _ in range(200)]
    packs = packing.write_packs(docs_of(spark, texts), str(tmp_path / "p"), length=128)
    back = {r.doc_id: r.text for r in packing.detokenized(spark, packs).collect()}
    assert back == {i: t for i, t in enumerate(texts) if t}
    same = [(1, "alpha beta gamma delta"), (1, "one two three four"), (1, "one two three four"), (None, "p q r"), (None, "x y z"), (None, None)]
    again = packing.pack(spark.createDataFrame([(*r, "x", 1) for r in same], "doc_id long, text string, ids string, rows int"), 3, window=4)
    assert sorted((tuple(r) for r in packing.detokenized(spark, again).collect()), key=str) == sorted([r for r in same if r[1]], key=str)
    for r in packs.collect():
        ids, places, ends = np.frombuffer(r.ids, np.uint16), np.frombuffer(r.positions, np.uint16), r.cu_seqlens
        assert len(ids) == len(places) == 128 and ends[0] == 0 and ends[-1] <= 128 and len(ends) == len(r.doc_ids) + 1 == len(r.parts) + 1
        assert (ids[ends[-1] :] == packing.PAD).all() and (ids[: ends[-1]] != packing.PAD).all()
    seg = packing.segments(packs).collect()
    assert all(s.positions_reset for s in seg)
    fill = packs.agg(F.avg(F.element_at("cu_seqlens", -1))).first()[0] / 128
    assert fill > 0.95
    lengths = defaultdict(int)
    for s in seg:
        lengths[s.doc_id] += s.n_tokens
    enc = packing.encoding(packing.TOKENIZER)
    assert dict(lengths) == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(texts) if t}
    assert packing.pack(docs_of(spark, ["x"]).limit(0)).count() == 0


# ---- pieces


def brute_paths(e, text):
    c, voc = (" " + text).replace(" ", pieces.SPACE), e.voc
    longest = max(map(len, voc.pieces))
    out = []

    def go(i, score, ids):
        if i == len(c):
            out.append((score, ids))
            return
        for j in range(i + 1, min(len(c), i + longest) + 1):
            if c[i:j] in voc.pieces:
                k, s = voc.pieces[c[i:j]]
                go(j, score + s, [*ids, k])
        if c[i] not in voc.pieces:
            b = c[i].encode()
            go(i + 1, score + voc.unknown * len(b), ids + [voc.bytes_at[x] for x in b])

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_against_brute_force():
    e, rng = pieces.Encoder(), random.Random(3)
    for _ in range(200):
        t = "".join(rng.choice("thean 一é\n") for _ in range(rng.randint(1, 9)))
        got, want = e.n_best(t, 6), brute_paths(e, t)[:6]
        assert [s for s, _ in got] == pytest.approx([s for s, _ in want])
        assert len({tuple(i) for _, i in got}) == len(got) and all(e.decode(i) == t for _, i in got)


def test_long_words_without_spaces():
    import tracemalloc

    e, rng = pieces.Encoder(), random.Random(4)
    tracemalloc.start()
    for t in ["thean" * 4000, "".join(rng.choice("abcdefghijXYZ0189") for _ in range(20_000)), "a" * 20_000, "日本" * 5000]:
        (best, _), *others = got = e.n_best(t, 4)
        assert all(s <= best + 1e-6 for s, _ in others) and len({tuple(i) for _, i in got}) == len(got) and all(e.decode(i) == t for _, i in got)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    # what a chunk shares with the one before is kept, and gives what a new search gives
    words = sorted("".join(rng.choice("thean") for _ in range(rng.randrange(1, 12))) for _ in range(300))
    assert [p for p, _ in zip(e.batch([" ".join(words)]), [0], strict=True)][0][1] == [pieces.Encoder()._chunk(pieces.SPACE + w) for w in words]


def test_pieces_decode_like_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = [None, "", " ", "Hello  world\nline\ttab ", "一\U0001f600é", "x" * 3000, "of the and"]
    rows = pieces.encode(docs_of(spark, texts).withColumn("pieces", F.lit(1)), 3).collect()
    for r in rows:
        assert len(r.pieces) >= 1 and [p.score for p in r.pieces] == sorted((p.score for p in r.pieces), reverse=True)
        for p in r.pieces:
            assert (model.decode(list(p.ids)) if p.ids else "") == (texts[r.doc_id] or "")
    ids = spark.createDataFrame([(r.doc_id, list(r.pieces[0].ids)) for r in rows] + [(99, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in pieces.decode(ids).collect()} == {i: t or "" for i, t in enumerate(texts)} | {99: None}
    both = {r.doc_id: r for r in pieces.encode_and_decode(docs_of(spark, texts)).collect()}
    short = {r.doc_id: r for r in pieces.digests(docs_of(spark, texts)).collect()}
    for r in rows:
        best = both[r.doc_id]
        assert list(best.ids) == list(r.pieces[0].ids) and best.text == (texts[r.doc_id] or "")
        assert short[r.doc_id].decodes and short[r.doc_id].n_pieces == len(best.ids)
        assert short[r.doc_id].ids_crc32 == zlib.crc32(np.array(best.ids, np.uint16).tobytes())
    assert pieces.digests(docs_of(spark, ["x"]).limit(0)).count() == 0


# ---- archives


def test_archives(spark):
    big = "<p>" + "ab " * 50 + "</p>"
    rows = [(5, "http://a b/é", big), (3, None, big), (None, "x", big), (7, "u", None), (8, "u", ""), (9, "v", "<é>"), (10, "v", "<é>"), (5, "http://a b/é", big), (11, "q", "\r\n\r\nWARC/1.1\r\n" + "y" * 100), (12, "q", "\r\n\r\nWARC/1.1\r\n" + "y" * 100)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    got = sorted((tuple(r[:5]) for r in archives.archived_pages(pages).collect()), key=str)

    def row(page, html, first):
        data = (html or "").encode()
        seen = len(data) >= 100 and page != first
        return page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if seen else "response", first if seen else None

    firsts = {big: 3, rows[8][2]: 11}
    assert got == sorted((row(p, h, firsts.get(h)) for p, _, h in rows), key=str)
    assert archives.archived_pages(pages.limit(0)).count() == 0


def test_arc_versions_and_lengths():
    body = b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\nline\nfiledesc://x 1 2 3\n"
    for version, extra in ((1, ""), (2, "200 - - 0 f ")):
        text = f"{version} 0 o\n{archives.ARC_FIELDS[version]}\n\n"
        head = f"filedesc://f 0.0.0.0 20200101000000 text/plain {extra}{len(text)}\n{text}\n".encode()
        record = f"http://h/ 1.2.3.4 20200102030405 text/html {extra}{len(body)}\n".encode() + body + b"\n"
        for data in (head + record + record, archives._member(head) + archives._member(record) + archives._member(record) + b"\n"):
            got = list(archives.parse_arc(data))
            assert [(r["url"], r["ip"], r["date"], r["block"]) for r in got] == [("http://h/", "1.2.3.4", "20200102030405", body)] * 2
    with pytest.raises(ValueError):
        list(archives.parse_arc(b"http://h/ 1.2.3.4 20200102030405 text/html 0\n\n"))
    fields, block = next(archives.parse_warc(archives._warc("response", [("WARC-Date", "d")], b"a\r\n\r\nb")))
    assert fields["warc-type"] == "response" and block == b"a\r\n\r\nb"
