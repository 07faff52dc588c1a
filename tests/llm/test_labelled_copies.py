"""Which labelled texts count when the lexicon is learned."""

from __future__ import annotations

import random

import pyarrow as pa

from geoledger.llm import toxicity


def counted(texts: list[tuple[int, str]], rows: int = 7) -> list[str]:
    keyed = sorted((toxic, toxicity.sketch(t.encode())[0], t) for toxic, t in texts)
    columns = {"t": [t.encode() for _, _, t in keyed], "toxic": [y for y, _, _ in keyed], "key": [k for _, k, _ in keyed], "sketch": [toxicity.sketch(t.encode())[1].tobytes() for _, _, t in keyed]}
    batches = pa.table(columns).to_batches(max_chunksize=rows)
    return [t.decode() for b in toxicity.first_of_copies(iter(batches)) for t in b.column(0).to_pylist()]


def test_texts_that_share_a_passage_all_count():
    rng = random.Random(1)
    licence = " ".join(f"licence{k}" for k in range(40))
    texts = [" ".join(rng.choices([f"w{k}" for k in range(5000)], k=60)) + " " + licence for _ in range(1000)]
    assert sorted(counted([(0, t) for t in texts])) == sorted(texts)


def test_copies_count_once():
    rng = random.Random(2)
    base = [" ".join(rng.choices([f"w{k}" for k in range(5000)], k=200)) for _ in range(50)]
    near = [t.replace(t.split()[100], "other", 1) for t in base]
    left = counted([(0, t) for t in base + base + near])
    assert len(set(left)) == len(left) and 50 <= len(left) <= 65
    # Toxic and clean copies are not set against each other; empty texts are one.
    assert len(counted([(1, base[0]), (0, base[0]), (0, ""), (0, "  "), (0, "a")])) == 4


def test_labels_of_texts_with_a_common_line(spark):
    """Distinct toxic texts that end in the same line teach all their words."""
    rng = random.Random(3)
    line = " ".join(f"common{k}" for k in range(30))
    words = [f"{a}{b}{c}ing" for a in "bcdfg" for b in "aeiou" for c in "klmnp"]
    rows, labels = [], []
    for k in range(600):
        toxic = k % 2
        text = rng.choices(words, k=25) + (rng.sample(["grumblewort", "snarlfen"], 1) if toxic else [])
        rows.append((k, " ".join(text) + " " + line))
        labels.append((k, toxic))
    lexicon = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {w[:4] for w in lexicon.weights} == {"grum", "snar"}
