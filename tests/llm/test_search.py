import math
import re
import shutil
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from keyscout.llm import hard_negatives, lexical, queries, toxicity

ROWS = "id long, label long, vector array<long>, key string, width string, anchor string"


# ---- hard negatives ---------------------------------------------------------------------

def plain_negatives(rows, is_anchor):
    rows = sorted({(i, c, tuple(v)) for i, c, v, *_ in rows if None not in (i, c, v) and v and all(x is not None and abs(x) < hard_negatives.LARGEST for x in v)})
    out = []
    for a, label, v in rows:
        if not is_anchor(a):
            continue
        scored = sorted(((sum(x * y for x, y in zip(v, w)), -i, c) for i, c, w in rows if i != a and len(w) == len(v)), reverse=True)
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(a, -pid, k, -i, p, s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(out)


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in ((2, 3), (3, 2), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = hard_negatives.hilbert_places(cells, bits)
        assert sorted(place) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def vectors(n, seed=3, width=6):
    rng = np.random.default_rng(seed)
    centres = rng.integers(-60, 60, (8, width))
    return [(i, int(rng.integers(0, 3)), [int(x) for x in centres[rng.integers(0, 8)] + rng.integers(-4, 5, width)], "k", "w", "a") for i in range(n)]


def test_hard_negatives_match_a_plain_version(spark):
    rows = vectors(400)
    rows += rows[:30] + [(20, 1, [9, 9, 9, 9, 9, 9], "", "", ""), (40, 2, rows[40][2], "", "", "")]        # repeats, and other rows of one id
    rows += [(i, 0, [7, 7, 7, 7, 7, 7], None, None, None) for i in range(1000, 1100)]                       # a hot vector, ties
    rows += [(None, 1, [1, 2, 3, 4, 5, 6], "", "", ""), (50, None, [1] * 6, "", "", ""), (60, 1, None, "", "", ""), (70, 1, [], "", "", ""), (80, 1, [1, None, 3], "", "", ""), (90, 1, [1 << 40] * 6, "", "", "")]
    rows += [(2000 + i, i % 2, [i, -i, 3], "", "", "") for i in range(40)]                                   # another width
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, ROWS), F.col("id") % 10 == 0, block_values=96, group_rows=16)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert len(want) > 500 and sorted(map(tuple, got.collect())) == want
    assert hard_negatives.hard_negatives(spark.createDataFrame([], ROWS), F.lit(True)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, ROWS), F.lit(False)).count() == 0


def test_bounds_hold_and_blocks_are_left_out(spark):
    rng = np.random.default_rng(1)
    centres = rng.integers(-100, 100, (40, 12))
    ids = np.arange(4000)
    x = (centres[ids // 100] + rng.integers(-2, 3, (4000, 12))).astype(np.int32)
    folder = tempfile.mkdtemp(prefix="keyscout-test-")
    files = {}
    for label in (0, 1):
        own = ids[ids % 2 == label]
        batch = pa.RecordBatch.from_arrays([pa.array(np.full(len(own), 12), pa.int32()), pa.array(np.full(len(own), label)), pa.array(own), pa.array(x[own].tolist(), pa.list_(pa.int32()))], ["width", "label", "id", "vector"])
        files[label] = pa.Table.from_batches(list(hard_negatives._written(folder, 12 * 50)([batch])))
    for path in files[0].column("path").to_pylist():
        low, high = (np.array(files[0].column(c)[0].as_py()) for c in ("lows", "highs"))
        scores = x[:5].astype(int) @ x[ids % 2 == 0].astype(int).T
        least, most = hard_negatives.bounds(x[:5], low[None], high[None])
        assert pq.ParquetFile(path).num_row_groups == 40 and (scores >= least).all() and (scores <= most).all()
    counts = hard_negatives.Counts()
    anchors = np.array([0, 2, 4])
    found = hard_negatives.mine_group(anchors, x[anchors], [files[0]], [files[1]], 5, 10, 30, 90, counts)
    want = plain_negatives([(int(i), int(i % 2), x[i].tolist()) for i in ids], lambda i: i in (0, 2, 4))
    assert sorted(found) == want
    assert 0 < counts.read < counts.blocks / 2
    shutil.rmtree(folder)


def test_whole_numbers(spark):
    rows = [(1, [0.5, -0.501, 0.0]), (2, [float("nan")]), (3, [float("inf")]), (4, [None, 1.0]), (5, None), (6, [])]
    got = spark.createDataFrame(rows, "id int, v array<float>").select("id", hard_negatives.whole_numbers(F.col("v"), 256).alias("q")).collect()
    assert {r["id"]: r["q"] for r in got} == {1: [128, math.floor(256 * np.float64(np.float32(-0.501))), 0], 2: None, 3: None, 4: None, 5: None, 6: []}


# ---- lexical search ---------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, top):
    docs = [(i, terms(t)) for i, t, *_ in docs]
    n, size = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, own in docs for t in set(own))
    out = []
    for item, text in sorted({(i, t) for i, t, *_ in items if t is not None}):
        scored = []
        for doc, own in docs:
            tf, m = Counter(own), 100 - 50 + (50 * len(own) * n) // max(1, size)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in set(terms(text)) if tf[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        out += [(item, k, None if null else doc, -s) for k, (s, null, doc) in enumerate(sorted(scored)[:top], 1)]
    return out


def documents_and_items():
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(200)] + ["Äpfel", "ñandú", "A1b"]
    share = 1 / np.arange(1, len(vocabulary) + 1)
    draw = lambda n: " ".join(rng.choice(vocabulary, n, p=share / share.sum()))
    docs = [(i, draw(int(rng.integers(1, 60))), "x", 1) for i in range(300)]
    docs += [(1000 + i, docs[7][1], "copy", 1) for i in range(150)] + [docs[3]] * 4
    docs += [(None, draw(20), "", 0), (None, draw(20), "", 0), (2000, None, "", 0), (2001, "", "", 0), (2002, " .,-", "", 0), (2003, draw(30_000), "long", 0)]
    items = [(i, draw(12), 5) for i in range(25)] + [(3, draw(5), 5), (90, None, 5), (91, "", 5), (92, "nowhere", 5), (93, "W1, w1; Äpfel!", 5)]
    items += items[:2]
    return docs, items


@pytest.mark.parametrize("batch_bytes", [4_000_000, 300])
def test_search_matches_a_plain_version(spark, batch_bytes):
    docs, items = documents_and_items()
    d = spark.createDataFrame(docs, "doc_id long, text string, row string, n long").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string, rank int")
    got = lexical.ranked_search(d, i, 20, batch_bytes, shard_docs=64, block_docs=8)
    order = lambda r: (r[0], r[1], r[3], r[2] is None, r[2] or 0)
    assert sorted(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect()), key=order) == sorted(plain_search(docs, items, 20), key=order)


def test_search_of_empty_tables(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked_search(d, i).count() == 0
    assert lexical.ranked_search(spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string"), i).count() == 0
    assert lexical.ranked_search(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), i.limit(0)).count() == 0


def test_summaries_bound_their_documents_and_blocks_are_left_out():
    rng = np.random.default_rng(2)
    n_terms, lists = 300, []
    for i in range(2000):
        topic = (i % 20) * 15
        lists.append(np.unique(np.concatenate([rng.integers(topic, topic + 15, 6), rng.integers(280, 300, 3)])))
    starts = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    own_terms = np.concatenate(lists)
    frequency = np.bincount(own_terms, minlength=n_terms)
    weights = lexical.Weights.of(frequency, 2000, 100_000)
    renumbered = [np.sort(weights.number[x]) for x in lists]
    own_terms, counts = np.concatenate(renumbered), rng.integers(1, 4, len(own_terms))
    ids, lengths = np.arange(2000), np.full(2000, 50)
    asked = [np.unique(weights.number[np.concatenate([rng.integers(t * 15, t * 15 + 15, 4), [290, 295]])]) for t in range(20)]
    shard = lexical.build_shard(ids, np.zeros(2000), ids, lengths, starts, own_terms, counts, weights, lexical._projection(n_terms), lexical.asked_together(asked), 16)
    shares = weights.contributions(own_terms, counts, np.repeat(lengths, np.diff(starts)))
    for q in asked:
        score = np.add.reduceat(np.where(np.isin(own_terms, q), shares, 0), starts[:-1])
        for b in np.flatnonzero(np.isin(shard["block_terms"], q)):
            peaks = slice(shard["peak_starts"][b], shard["peak_starts"][b + 1])
            bound = shard["peaks"][peaks][np.isin(shard["peak_terms"][peaks], q)].sum()
            for d in shard["block_docs"][shard["block_starts"][b] : shard["block_starts"][b + 1]]:
                if min(set(q) & set(renumbered[d])) == shard["block_terms"][b]:
                    assert score[d] <= bound
    counted, best = lexical.Counts(), [lexical.Best.none(10) for _ in asked]
    lexical.search_shard(shard, shares, asked, best, n_terms, counted)
    for q, own in zip(asked, best):
        score = np.add.reduceat(np.where(np.isin(own_terms, q), shares, 0), starts[:-1])
        assert own.found[:, 1].tolist() == sorted(range(2000), key=lambda d: (-score[d], d))[:10]
    assert 0 < counted.opened < counted.blocks / 2


# ---- toxicity ---------------------------------------------------------------------------

def test_composed_table_equals_the_cascade():
    rng = np.random.default_rng(6)
    composed = toxicity.grammar()
    choices = [0, *(1 << i for i in range(6)), toxicity.INSULT | toxicity.QUOTED, toxicity.FAINT | toxicity.QUOTED]
    for _ in range(300):
        clause = [int(x) for x in rng.choice(choices, rng.integers(1, 12))]
        states = [m.start for m in composed.machines]
        for s in clause:
            for k, machine in enumerate(composed.machines):
                states[k], s = machine.step(states[k], s)
        assert composed.run(clause) == tuple(states)


def test_clauses_have_kind_mode_and_direction():
    model = toxicity.Model({"fool*": toxicity.INSULT, "dull": toxicity.FAINT})
    said = {
        "you foolish man": (3, 2, 1, 1), "the fools and foolery": (3, 2, 0, 2), "He is not a fool.": (3, 0, 0, 1), "not in any of my days a fool": (3, 2, 0, 1),
        "he said you fool": (3, 1, 1, 1), 'a "fool" here': (3, 1, 0, 1), "we will kill you": (1, 2, 1, 1), "dull, dull": (2, 2, 0, 2), "dullness": None,
        "nothing here": None, "": None, "DULL" + " and" * 500 + " YOU": (2, 2, 1, 1), "never. fool": (3, 2, 0, 1), "not a fool but a fool": (3, 2, 0, 1),
    }
    found = toxicity.words_of(pa.array([*said, None]))
    got = {text: own for text, *own in model.clauses(found, toxicity.grammar())}
    assert got == {i: list(x) for i, x in enumerate(said.values()) if x}


def test_words_follow_the_text():
    texts = ["Ärger, don't!  no\nMore;x", None, "", "...", "end", "a" * 100_000]
    found = toxicity.words_of(pa.array(texts).slice(0))
    words = [(int(t), found.words[int(c)].as_py()) for t, c in zip(found.text, found.codes)]
    assert words == [(0, "ärger"), (0, "don't"), (0, "no"), (0, "more"), (0, "x"), (4, "end"), (5, "a" * 100_000)]
    assert len(set(found.clause[:5])) == 4 and len(set(found.clause)) == 6


def toxic_corpus():
    rng = np.random.default_rng(9)
    words = [f"{a}{b}" for a in ("mor", "tel", "sun", "qua", "lim") for b in ("an", "eth", "ix", "or", "ul", "es")]
    docs, labels = [], []
    for i in range(400):
        line = list(rng.choice(words, 30))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                line.insert(int(rng.integers(0, 30)), "grob" + str(rng.choice(["ix", "eth", "or"])))
        docs.append((i, " ".join(line), "x"))
        labels.append((i, int(toxic), "y"))
    return docs, labels


def test_stems_are_learned_and_copies_count_once(spark):
    docs, labels = toxic_corpus()
    copy = "zebra yonder walks alone today " * 3
    docs += [(1000 + i, copy, "x") for i in range(200)]
    labels += [(1000 + i, 1, "y") for i in range(200)]
    model = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string, toxic string"), spark.createDataFrame(labels, "doc_id long, toxic int, text string"))
    assert [x for x in model.insults if x.startswith("gro")] and not [x for x in model.insults if not x.startswith("gro")]
    assert model.weights[(3, 2, 0, 3, 1)] > 0.8


def test_scores_of_odd_rows(spark):
    docs, labels = toxic_corpus()
    labels += [(None, 1, ""), (3, None, ""), (0, 0, ""), (9999, 1, "")]
    model = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string, x string"), spark.createDataFrame(labels, "doc_id long, toxic int, x string"))
    rows = [(None, "grobix", 1.0), (5, None, 2.0), (5, "", 2.0), (5, "grobor grobeth grobix", 2.0), (5, "grobor grobeth grobix", 2.0), (6, "calm " * 200_000, 0.0)]
    got = [tuple(r) for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string, score double"), model).select("doc_id", "score", "predicted").collect()]
    assert len(got) == 6 and all(0 <= s <= 1 for _, s, _ in got)
    assert [p for i, s, p in got if i == 5] == [0, 0, 1, 1] and got[1][1] == got[2][1] == got[5][1] == model.nothing
    assert toxicity.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0
    for one, want in (([(1, 1, "")], 1.0), ([(1, 0, "")], 0.0), ([], 0.5)):
        only = toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string, x string"), spark.createDataFrame(one, "doc_id long, toxic int, x string"))
        assert only.nothing == want and not only.insults


def test_held_out_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op13_toxicity(spark, folder)
    judged = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (judged.predicted[judged.toxic == 1] == 1).mean() >= 0.85
    assert (judged.predicted[judged.toxic == 0] == 0).mean() >= 0.98
