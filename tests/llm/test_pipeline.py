"""The pipeline's stages on the smallest tables, each on what the one before kept."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
from geoledger.llm import pieces, queries
from geoledger.scratch import written
from tests.llm.test_operators import plain_fingerprint


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {r["doc_id"] for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = written(stage(spark, before, sf_dir), name.replace(" ", "-"))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert ids and set(ids) <= seen
        if k < 3:
            assert len(ids) == len(set(ids))
        if k == 4:
            assert docs.count() == before.count() and docs.where("not decoded_ok").count() == 0
        seen = set(ids)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "substring dedup", "mixing", "pieces"]


def plain_pieces(text):
    return None if text is None else len(pieces.segmenter(queries.piece_model()).encode(text)[0])


def test_stages_against_plain_ones(spark, tmp_path):
    """Null ids, null and empty texts, repeated rows and further columns through all stages."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(20, 80))) for _ in range(240)]
    passage = " ".join(rng.choices(words, k=60))
    texts[3], texts[4] = f"{texts[3]} {passage}", f"{passage} {texts[4]}"
    texts += [passage, None, "", "  ", texts[0], texts[1] + " you scumbag idiot", texts[2].upper()]
    toxic = [f"{t} you scumbag idiot" for t in texts[5:65]]
    rows = [(None if k == 7 else k, t, "en", None if k % 5 == 0 else f"s{k % 3}", len(t or ""), "clash") for k, t in enumerate(texts + toxic)]
    rows += [rows[9], rows[9], rows[7]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(k, 1, int("scumbag" in (t or ""))) for k, t, *_ in rows if k is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stage = [written(s(spark, docs, str(tmp_path)), "x") for _, s in corpus_pipeline.STAGES[:1]]
    got = Counter(map(tuple, stage[0].collect()))
    assert got == Counter(r for r in rows if "scumbag" not in (r[1] or ""))

    second = written(corpus_pipeline.drop_near_duplicates(spark, stage[0], str(tmp_path)), "x")
    fps = {r: plain_fingerprint(r[1]) for r in got}
    kept = set()
    left = list(got)
    while left:
        group, todo = [], [left[0]]
        left.pop(0)
        while todo:
            r = todo.pop()
            group.append(r)
            near = [x for x in left if (fps[x] ^ fps[r]).bit_count() <= 4]
            left = [x for x in left if x not in near]
            todo += near
        kept.add(min(group, key=lambda r: (r[0] is None, r[0] or 0)))
    assert Counter(map(tuple, second.collect())) == Counter(kept)

    third = written(corpus_pipeline.drop_repeats(spark, second, str(tmp_path)), "x")
    split = {r: (r[1] or "").split() for r in kept}
    seen = Counter(tuple(w[k : k + 35]) for w in split.values() for k in range(len(w) - 34))
    want = Counter()
    for r, w in split.items():
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        text = " ".join(x for k, x in enumerate(w) if k not in gone)
        if gone:
            if text:
                want[(r[0], text, r[2], r[3], len(text), r[5])] += 1
        else:
            want[r] += 1
    assert Counter(map(tuple, third.collect())) == want and any(r not in kept for r in want)

    fourth = written(corpus_pipeline.mix_sources(spark, third, str(tmp_path)), "x")
    times = Counter(map(tuple, fourth.collect()))
    assert fourth.columns == docs.columns and set(times) <= set(want) and max(times.values()) <= 2
    assert {r for r in want if not (r[1] or "").split()} <= set(times)
    rows_out = corpus_pipeline.encode_pieces(spark, fourth, str(tmp_path)).collect()
    assert Counter((r["doc_id"], r["lang"], r["source"], r["n_pieces"]) for r in rows_out) == Counter((r[0], r[2], r[3], plain_pieces(r[1]) or 0) for r in times.elements())
    assert all(r["decoded_ok"] for r in rows_out)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.count() == fourth.count()
