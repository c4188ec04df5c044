"""The pipeline's decisions by row, with null and repeated ids."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from quaymark.llm import pii, simhash

RNG = np.random.default_rng(11)
TEXTS = [" ".join(RNG.choice([f"w{i}" for i in range(60)], 60)) for _ in range(8)]
SCHEMA = "doc_id long, text string, source string"


def test_one_row_of_each_component_stays(spark):
    a, b, c, d = TEXTS[:4]
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (None, a, "s"), (7, c, "s"), (7, c, "s"), (None, d, "s"), (None, d, "s"),
        (8, a.upper(), "s")]
    rows += [(9, t, "s") for t in TEXTS[4:]] + [(9, TEXTS[4], "s")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    fp = {r.doc_id: r.fp for r in simhash.fingerprints(spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows)],
        "doc_id long, text string"), "doc_id", "text", 3, 42).collect()}
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if ((fp[i] ^ fp[j]) & (2**64 - 1)).bit_count() <= 2:
                part = [part[j] if p == part[i] else p for p in part]
    want = {}
    for i, r in enumerate(rows):
        want.setdefault(part[i], []).append(r)
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert len(got) == len(want)
    for same in want.values():
        least = min((r[0] is None, r[0] or 0) for r in same)
        assert sum(r in same and (r[0] is None, r[0] or 0) == least for r in got) >= 1
    assert (3, a, "s") in got and (5, b, "s") in got and got.count((7, c, "s")) == got.count((None, d, "s")) == 1


def test_contaminated_rows_go_alone(spark, tmp_path):
    bad, *clean = TEXTS
    spark.createDataFrame([(1, bad)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(None, bad, "s"), (None, clean[0], "s"), (5, bad, "s"), (5, bad, "s"), (5, clean[1], "s"), (5, clean[1], "s"),
        (6, clean[2], "s"), (7, None, "s"), (None, None, "s")]
    got = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), str(tmp_path)).collect()
    assert Counter(tuple(r) for r in got) == Counter(r for r in rows if r[1] != bad)


def test_the_mix_keeps_columns_of_documents(spark):
    rows = [(i, TEXTS[i % 8], f"s{i % 2}", 100 + i, "t") for i in range(20)] + [(None, None, None, 7, "t"), (5, TEXTS[5], "s1", 9, "t"),
        (5, TEXTS[5], "s1", 9, "t")]
    docs = spark.createDataFrame(rows, SCHEMA + ", size int, Copies string").repartition(3)
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "source", "size", "Copies", "mix_size", "source_size", "target", "taken",
        "mix_copies"}
    assert all(r.mix_size == 60 and r.taken == r.mix_copies * 60 for r in got)
    left = Counter(rows)
    for r in got:
        left[r.doc_id, r.text, r.source, r["size"], r.Copies] -= 1
    assert min(left.values()) >= 0 and sum(r.taken for r in got) <= 22 * 60 and left[rows[20]] == 1
    assert corpus_pipeline.mix_sources(spark, docs.limit(0), "").collect() == []


def test_toxic_rows_go_alone(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        t = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(40)]
        if i % 4 == 0:
            t[:4] = ["worthless", "pathetic", "moron", "idiot"]
        rows.append((i, " ".join(t), "s"))
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)],
        "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    extra = [(None, None, "s"), (None, "", None), (3, rows[0][1], "s"), (3, rows[0][1], "s"), (3, rows[1][1], "s")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows + extra], SCHEMA + ", score double").repartition(3)
    got = Counter(tuple(r) for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect())
    assert got[None, None, "s", 0.5] == got[None, "", None, 0.5] == got[3, rows[1][1], "s", 0.5] == 1
    assert (3, rows[0][1], "s", 0.5) not in got
    kept = {k[0] for k in got if k[1]}
    assert sum(i in kept for i in range(400) if i % 4) >= 290 and sum(i in kept for i in range(4, 400, 4)) <= 10
    assert corpus_pipeline.drop_toxic(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_masked_texts_keep_no_character_of_a_span(spark):
    rng = np.random.default_rng(8)
    parts = ["10.0.0.4", "111 1111 1111 1111", "4111 1111 1111 1111", "a@b.co", "+1 (743) 555-3824", "x", " ", "12", "@x.com", "-", "é",
        "123-45-6789"]
    rows = [(i, " ".join(rng.choice(parts, int(rng.integers(0, 9)))), "s") for i in range(300)]
    rows += [(None, None, "s"), (1, "", None), (1, "pay 10.0.0.4 111 1111 1111 1111 now", "s"), (2, "word " * 20_000 + "a@b.co", "s")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], SCHEMA + ", n_chars long").repartition(3)
    named = docs.withColumn("n", F.monotonically_increasing_id()).persist()
    spans = {r.doc_id: r.spans for r in pii.report(named, id_col="n").collect()}
    masked = [tuple(r) for r in corpus_pipeline.mask_personal_data(spark, docs, "").collect()]
    want = []
    for r in named.collect():
        text, out, at = r.text, "", 0
        found = sorted((int(a), pii.NAMES.index(k), int(z)) for k, a, z in (x.split(":") for x in spans[r.n].split(",") if x))
        for a, kind, z in found:
            if a >= at:
                out += text[at:a] + f"[{pii.NAMES[kind].upper()}]"
            at = max(at, z)
        want.append((r.doc_id, None if text is None else out + text[at:], r.source, 5 if text is None else len(out + text[at:])))
    assert Counter(masked) == Counter(want)
    assert any("1111" in (r.text or "") for r in named.collect()) and not any("1111 1111 1111 now" in (t or "") for _, t, *_ in masked)
    assert corpus_pipeline.mask_personal_data(spark, docs.limit(0), "").collect() == []


def test_rows_of_files_are_named_by_their_place(spark, tmp_path):
    rows = [(i % 3, TEXTS[i % 8], "s") for i in range(30)] + [(None, None, "s")] * 3
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    named, row = corpus_pipeline._numbered(docs)
    first = {r[row]: tuple(r)[:3] for r in named.collect()}
    again = {r[row]: r.doc_id for r in named.select(row, "doc_id").repartition(7).collect()}
    assert len(first) == 33 and {k: v[0] for k, v in first.items()} == again
    got = Counter(tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert got == Counter({(0, t, "s"): 1 for t in TEXTS} | {(None, None, "s"): 1})
    odd, name = corpus_pipeline._numbered(docs.withColumn("_metadata", F.lit(1)).withColumn("_ROW", F.lit(2)))
    assert name.lower() not in ("_row", "_metadata") and odd.select(name).distinct().count() == 33


def test_the_whole_pipeline(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert got and len({r.doc_id for r in got}) == len(got) and all(r.taken % r["size"] == 0 for r in got)
