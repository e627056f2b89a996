import random

import corpus_pipeline
from recspark.llm import registry

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_are_ordered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "n-gram Jaccard join", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    assert sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0])) == list(registry.QUERIES) and len(registry.QUERIES) == 13


def test_pipeline_end_to_end(spark, tmp_path):
    rng = random.Random(5)
    clean = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(120)]
    junk = [" | ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(40)]
    near = [clean[0] + " tail", clean[0], clean[1] + " end"]
    texts = clean + junk + near + [None, "", "too short"]
    docs = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], DOCS)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 120), 0) for i in range(160)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept, sizes = docs, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        sizes.append({r.doc_id for r in kept.select("doc_id").collect()})
    assert sizes[1] == set(range(120)) | {160, 161, 162} and sizes[2] == set(range(120))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= set(range(120)) and all(r.text == texts[r.doc_id] and len(r.ids) for r in out)
    words = sum(len(r.text.split()) for r in out)
    assert abs(words - 1.5 * 120 * 60) <= 3 * 60


def test_near_duplicates_keep_one_row_of_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(6)]
    rows = [
        (None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[1] + " end"),  # alone; copies among null ids
        (7, texts[2]), (7, texts[2]), (7, texts[2]),  # one row repeated
        (None, texts[3] + " end"), (9, texts[3]), (8, texts[3]), (8, texts[3]),  # null and repeated ids in one group
        (5, texts[4]), (5, texts[5]),  # one id, two texts
        (None, None), (None, ""), (3, ""), (3, ""),  # without words, each alone
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    out = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = [(r.doc_id, texts.index(t[: t.rindex(" end")] if t.endswith(" end") else t) if (t := r.text) else t) for r in out.collect()]
    want = [(None, 0), (None, 1), (7, 2), (8, 3), (5, 4), (5, 5), (None, None), (None, ""), (3, ""), (3, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stages_keep_other_columns_and_take_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(50)) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 2}", 0) for i, t in enumerate(texts)]
    rows += [(None, texts[0] + " w1", None, None, 0), (None, texts[1], "en", "s1", 0), (2, texts[2], "en", "s0", 0), (2, texts[3], "en", "s0", 0), (99, None, None, None, None), (98, "", "", "", 0)]
    rows += [(100 + i, " | ".join(t.split()), "en", "s0", 0) for i, t in enumerate(texts[:30])]
    names = ["row", "_row", "__row", "score", "__score", "__at", "least", "named_id", "component_id", "nth", "kept"]
    schema = DOCS + "".join(f", `{n}` string" for n in names)
    docs = spark.createDataFrame([(*r, *[f"{n}{i}" for n in names]) for i, r in enumerate(rows)], schema)
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(i < 60), 0) for i in [*range(60), *range(100, 130)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    mine = {r["row"]: tuple(r) for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        got = [tuple(r) for r in out.collect()]
        assert got and all(mine[r[5]] == r for r in got)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    last = corpus_pipeline.encoded(spark, docs.drop("score"), str(tmp_path)).collect()
    assert len(last) == len(rows) and all(r["__row"][:5] == "__row" and (r["text"] or "") == (mine[r["row"]][1] or "") for r in last)
