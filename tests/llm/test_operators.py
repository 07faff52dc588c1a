"""Operators against brute force on small inputs, with nulls, empty and repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from geoledger.llm import embeddings, hmm, html, mixing, pieces, quality, queries, simhash, substrings, toxicity, urls

DOCS = "doc_id long, text string, source string, fp long, k string"
MODEL = queries.piece_model()


def docs(spark, texts, sources=None):
    """Rows with columns that clash with names used inside."""
    return spark.createDataFrame([(i, t, sources[i] if sources else "s", 7, "x") for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    out = [" ".join(rng.choices(words, k=rng.randrange(1, 160))) for _ in range(60)]
    passage = " ".join(rng.choices(words, k=45))
    out += [f"{out[k]} {passage}\n{out[k + 1]}" for k in range(6)]
    long_ = " ".join(rng.choices(words, k=400))
    out += [long_, long_ + " end", long_.replace(" w1 ", " W1 "), "", None, "a", "a b c", "A b C", " \t\n", "rep " * 90, out[0], out[0]]
    return out


def component_ids(ids, linked):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if linked(a, b):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    bits = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams))


def test_simhash(spark, texts):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, texts)).collect()}
    fps = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    assert {i: r["fingerprint"] for i, r in found.items()} == {i: f"{f:016x}" for i, f in fps.items()}
    want = component_ids(list(fps), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 4)
    assert {i: r["component_id"] for i, r in found.items()} == want
    kept = [r["doc_id"] for r in simhash.representatives(docs(spark, texts)).collect()]
    assert sorted(kept) == sorted(set(want.values()))


def test_trie_join_finds_all_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [np.uint64(b) ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, int(rng.integers(1, 6)), replace=False))) for b in base for _ in range(5)]
    keys = np.unique(np.concatenate((base, np.array(near, np.uint64))))
    for small in (1, 96):
        forest = simhash._Forest(len(keys))
        turned = np.sort((keys << np.uint64(32)) | (keys >> np.uint64(32)))
        simhash.trie_join(keys, (0, len(keys)), (0, len(keys)), 0, 0, 4, forest, small=small)
        other = simhash._Forest(len(keys))
        simhash.trie_join(turned, (0, len(keys)), (0, len(keys)), 0, 0, 4, other, small=small)
        back = np.searchsorted(keys, (turned << np.uint64(32)) | (turned >> np.uint64(32)))
        forest.join(back, back[other.roots(np.arange(len(keys)))])
        want = component_ids(range(len(keys)), lambda a, b: int(keys[a] ^ keys[b]).bit_count() <= 4)
        roots = forest.roots(np.arange(len(keys)))
        assert len(set(zip(roots.tolist(), want.values(), strict=True))) == len(set(want.values())) == len(set(roots.tolist()))


def test_substrings(spark, texts):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[k : k + 35]) for w in words for k in range(len(w) - 34))
    want = {}
    for i, w in enumerate(words):
        gone = {k + j for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for j in range(35)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        want[i] = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
    found = substrings.remove_repeats(docs(spark, texts)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == want
    left = substrings.without_repeats(docs(spark, texts).withColumn("n_chars", F.lit(1))).collect()
    assert {r["doc_id"] for r in left} == {i for i, (n, gone, _) in want.items() if gone < n or n == 0}
    for r in left:
        if want[r["doc_id"]][1]:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]][2] and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == texts[r["doc_id"]]


def test_mixing(spark, texts):
    sources = [None if k % 7 == 0 else f"s{k % 5}" for k in range(len(texts))]
    rows = mixing.mix(docs(spark, texts * 5, sources * 5)).collect()
    again = mixing.mix(docs(spark, texts * 5, sources * 5).repartition(3)).collect()
    assert {r["doc_id"]: r["copies"] for r in rows} == {r["doc_id"]: r["copies"] for r in again}
    size, taken, target, longest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["size"] == len((r["text"] or "").encode().split()) and 0 <= r["copies"] <= 2
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    # Water-filling, source by source.
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    whole, capped = 1.5 * sum(size.values()), set()
    while True:
        level = (whole - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        over = {s for s in order if s not in capped and weight[s] * level > 2 * size[s]}
        if not over:
            break
        capped |= over
    for s in order:
        assert target[s] == pytest.approx(2 * size[s] if s in capped else weight[s] * level)
        assert abs(taken[s] - target[s]) <= max(longest[s], 0.02 * target[s])


def test_quality(spark, texts):
    good = ["The house is by the river and the garden of the house has many trees. " + " ".join(f"name{k}{j}" for j in range(30)) for k in range(40)]
    bad = ["### buy$$$ now&&& " + " ".join(f"x{k}{j}###" for j in range(40)) for k in range(10)]
    rows = {r["doc_id"]: r for r in quality.judge(docs(spark, texts + good + bad)).collect()}
    for i, t in enumerate(texts + good + bad):
        t = t or ""
        w, lines, r = t.encode().split(), [x for x in t.split("\n") if x.encode().split()], rows[i]
        runs = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        repeated = len({k + j for k in range(len(w) - 7) if runs[tuple(w[k : k + 8])] > 1 for j in range(8)})
        want = (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeated)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (len(w) < 20 or 100 * repeated > 30 * len(w))
    n = len(texts)
    assert all(rows[i]["kept"] for i in range(n, n + 40)) and not any(rows[i]["kept"] for i in range(n + 40, n + 50))


def test_pieces(spark):
    s = pieces.segmenter(MODEL)

    def all_of(text):
        full, out = pieces._SPACE + text.replace(pieces._SPACE, pieces._LITERAL).replace(" ", pieces._SPACE), []
        edges = s.edges(full)

        def go(at, score, ids):
            if at == len(full):
                out.append((score, ids))
            else:
                for b, w, i in edges[at]:
                    go(b, score + w, ids + i)

        go(0, 0.0, ())
        return sorted(out, key=lambda x: -x[0])

    rng = random.Random(3)
    for text in ["a", "the cat", " hi  x", "a\nb é", "漢字x", "ab▁c", "end.\nWh", *("".join(rng.choice("thean \n.ré") for _ in range(8)) for _ in range(30))]:
        whole, best = all_of(text), s.nbest(text, 5)
        assert [x for x, _ in best] == [x for x, _ in whole[:5]]
        assert all(s.decode(i) == text for _, i in best) and len({tuple(i) for _, i in best}) == len(best)
    rows = pieces.encode(docs(spark, ["the cat", "", None, "x" * 5000 + " é", "the cat"]), MODEL, nbest=2).orderBy("doc_id").collect()
    assert [r["n_pieces"] > 0 for r in rows] == [True, False, False, True, True] and all(r["decoded_ok"] for r in rows)
    assert rows[2]["ids"] is None and rows[1]["ids"] == [] and rows[0]["ids"] == rows[4]["ids"]
    back = pieces.decode(pieces.encode(docs(spark, ["the cat", None]), MODEL), MODEL).orderBy("doc_id").collect()
    assert [r["text"] for r in back] == ["the cat", None]


def test_url_rules(spark):
    rules = urls.rule_table(spark, queries.URL_RULES)
    cases = {
        "http://A.example.com/en/70?x": ("a.example.com", "/en/70", "example.com/en/7", "allow"), "https://x.com/en/1": ("x.com", "/en/1", "com/en/", "block"), "http://example.net/de/8#a": ("example.net", "/de/8", "example.net/de/8", "block"),
        "http://notexample.net/de/8": ("notexample.net", "/de/8", "net/de/", "allow"), "http://org": ("org", "", None, "allow"), "org/es/": ("", "", None, "allow"), None: ("", "", None, "allow"), "a://b://c/es/": ("b:", "//c/es/", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate([*cases, "https://x.com/en/1"])], "page_id int, url string, rule string")
    found = urls.judge(pages, rules).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in found] == [*cases.values(), cases["https://x.com/en/1"]]
    assert urls.judge(pages, rules.limit(0)).where("verdict = 'block'").count() == 0


def test_toxicity(spark):
    rng = random.Random(2)
    plain = [" ".join(rng.choices([f"word{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(9)], k=40)) for _ in range(240)]
    toxic = [i % 6 == 0 for i in range(240)]
    texts = [p + " you scumbag idiot" if x else p for p, x in zip(plain, toxic, strict=True)]
    labels = spark.createDataFrame([(i, int(x)) for i, x in enumerate(toxic)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    extra = ["You 1D10T", "the іdiоt", "idiotic", "", None, "a vidiot"]
    rows = {r["doc_id"]: r for r in toxicity.score_documents(docs(spark, texts + extra), labels).collect()}
    assert all(rows[i]["predicted"] == toxic[i] for i in range(240))
    assert all(rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert [rows[240 + k]["predicted"] for k in (0, 1, 3, 4, 5)] == [1, 1, 0, 0, 0]
    assert toxicity.score_documents(docs(spark, texts[:3]), labels.limit(0)).where("predicted = 1").count() == 0


def test_hmm_recursions():
    rng = np.random.default_rng(0)
    emits = rng.random((6, 3))
    model = hmm.Model(np.array([0.2, 0.3, 0.5]), rng.dirichlet(np.ones(3), 3), emits / emits.sum(0))
    lists = [rng.integers(0, 6, n) for n in (5, 1, 3, 7, 3)]
    ((part, flat, alive),) = hmm._together(lists)
    score, _ = hmm.forward(model, flat, alive)
    start, moves, seen, _ = hmm.expected(model, flat, alive)
    want = [np.zeros(3), np.zeros((3, 3)), np.zeros((6, 3))]
    for k, i in enumerate(part):
        seq, total, paths = lists[i], 0.0, []
        for path in itertools.product(range(3), repeat=len(seq)):
            p = model.start[path[0]] * np.prod([model.emits[c, s] for c, s in zip(seq, path, strict=True)]) * np.prod([model.moves[a, b] for a, b in itertools.pairwise(path)])
            total += p
            paths.append((path, p))
        assert score[k] == pytest.approx(math.log10(total))
        for path, p in paths:
            want[0][path[0]] += p / total
            for t, s in enumerate(path):
                want[2][seq[t], s] += p / total
                if t:
                    want[1][path[t - 1], s] += p / total
    assert np.allclose(start, want[0]) and np.allclose(moves, want[1]) and np.allclose(seen, want[2])


def test_hmm_scores(spark, texts):
    rows = {r["doc_id"]: r for r in hmm.score_documents(docs(spark, texts)).collect()}
    words = {i: [*(t or "").encode().lower().split(), b"\n"] for i, t in enumerate(texts)}
    counts = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = counts.total(), len(counts)
    for i, ws in words.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in counts for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
        assert r["score"] < 0
    assert hmm.score_documents(docs(spark, texts).limit(0)).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 16))
    x = np.concatenate((x, x[:40] + 0.05 * rng.standard_normal((40, 16)), x[:5]))
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [None] + [1.0] * 15), (904, [])]
    found = {r["vec_id"]: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    want = component_ids(range(len(x)), lambda a, b: bool(near[a, b]))
    assert {i: found[i]["n_links"] for i in range(len(x))} == {i: int(near[i].sum()) - 1 for i in range(len(x))}
    assert {i: found[i]["component_id"] for i in range(len(x))} == want
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in range(900, 905))


def test_main_text(spark):
    page = """<html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><a href=/>Home</a></nav><div class=cookie-notice>We use cookies, yes, really</div>
    <div id="wrap"><div class="content"><h1>Big &amp; small</h1><p>First  paragraph, with commas,<br> and <b>bold</b> text that goes on for a while, as texts do.<p>Second one, also long enough to count &#233;.
    <ul><li>one<li>two</ul><div class="ad">Buy, now</div></div><aside>Related, things</aside></div><form><p>Your name, please</form><div id="comments"><p>I disagree, strongly, with all of it</p></div><footer>(c)</footer><script>var p = "</p>";</script></body></html>"""
    want = "Big & small\nFirst paragraph, with commas, and bold text that goes on for a while, as texts do.\nSecond one, also long enough to count é.\none\ntwo"
    rows = html.extract(spark.createDataFrame([(1, "u", page, "clash"), (2, "v", None, ""), (3, "w", "", ""), (1, "u", page, "clash")], "page_id int, url string, html string, text string")).collect()
    assert sorted((r["page_id"], r["text"], r["n_chars"]) for r in rows) == sorted([(1, want, len(want)), (1, want, len(want)), (2, "", 0), (3, "", 0)])


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_empty_tables(spark, tmp_path, name):
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int"}
    for table, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(str(tmp_path / f"{table}.parquet"))
    assert queries.queries()[name](spark, str(tmp_path)).count() == 0
