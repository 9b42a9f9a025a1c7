import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from keyscout.llm import crosspolytope, links, preferences, warc

TURNS = "conv_id long, turn long, role string, text string, block string, place int, part string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x") for r in rows], TURNS)


def plain_preferences(chosen, rejected):
    def placed(rows):
        out = {}
        for c, t, r, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
            out.setdefault(c, []).append((r or "", x or ""))
        return out

    a, b, out = placed(chosen), placed(rejected), []
    for c in a.keys() | b.keys():
        left, right = a.get(c, []), b.get(c, [])
        n = 0
        while n < min(len(left), len(right)) and left[n] == right[n]:
            n += 1
        for part, own, at in (("prompt", left[:n], 0), ("chosen", left[n:], n), ("rejected", right[n:], n)):
            start = sum(len(f"<|{r}|>\n{x}<|end|>\n") for r, x in left[:n]) if at else 0
            for place, (r, x) in enumerate(own, at):
                text = f"<|{r}|>\n{x}<|end|>\n"
                out.append((c, part, place, r, text, start, int(part != "prompt" and r == "assistant")))
                start += len(text)
    return out


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


@pytest.mark.parametrize("block", [2, 256])
def test_preferences_match_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(preferences, "TURNS_PER_BLOCK", block)
    chosen = [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}é") for i in range(9)]
    rejected = [*chosen[:5], (1, 5, "assistant", "other"), (1, 6, "user", "x")]
    chosen += [(2, 0, "user", "a"), (3, 0, "user", "same"), (None, 0, "user", "n"), (4, None, None, None), (4, 1, "user", ""), (4, 1, "user", ""), (6, 0, "system", "only chosen")]
    rejected += [(2, 0, "assistant", "a"), (3, 0, "user", "same"), (None, 0, "user", "m"), (4, None, None, None), (4, 1, "user", ""), (5, 0, "user", "only rejected")]
    got = preferences.format_preferences(turns(spark, chosen), turns(spark, rejected)).collect()
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, plain_preferences(chosen, rejected)))
    assert preferences.format_preferences(turns(spark, []), turns(spark, [])).count() == 0


def test_preferences_stay_clear_of_python(spark):
    chosen = turns(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")])
    plan = preferences.format_preferences(chosen, preferences.stale_answers(chosen))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_stale_answers(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "first"), (1, 2, "user", "r"), (1, 3, "assistant", "last"), (2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q")]
    got = {(r["conv_id"], r["turn"]): r["text"] for r in preferences.stale_answers(turns(spark, rows)).collect()}
    assert got[1, 3] == "first" and got[1, 1] == "first" and got[2, 1] == "q" and got[3, 0] == "q" and len(got) == 7


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, shard int")


def test_archives_give_back_all_pages(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>" * (40 if i % 2 else 1)) for i in range(200)]
    rows += [(900, None, None), (901, "http://x y", ""), (902, "u", "é" * 60), (903, "u", "é" * 60), (903, "u", "é" * 60), (None, "n", "é" * 60), (None, None, None), (-5, "u", "z" * 100), (10**12, "u", "z" * 99), (10**12, "u", "z" * 99)]
    folders = [str(tmp_path / x) for x in "ab"]
    for folder, parts in zip(folders, (1, 5)):
        manifest = warc.write_archives(pages(spark, rows).repartition(parts), folder, shard_bytes=20_000, file_bytes=3_000).collect()
        assert sum(r["records"] for r in manifest) == len(rows) and len(manifest) > 4
        assert {r["file"]: r["sha256"] for r in manifest} == {f: hashlib.sha256(open(f"{folder}/{f}", "rb").read()).hexdigest() for f in os.listdir(folder) if f.endswith(".gz")}
        assert not [f for f in os.listdir(folder) if f.endswith(".tmp")]
    assert sorted(f for f in os.listdir(folders[0]) if f.endswith(".gz")) == sorted(f for f in os.listdir(folders[1]) if f.endswith(".gz"))
    assert all(open(f"{folders[0]}/{f}", "rb").read() == open(f"{folders[1]}/{f}", "rb").read() for f in os.listdir(folders[0]) if f.endswith(".gz"))
    got = warc.read_archives(spark, folders[0]).collect()
    payload = lambda h: (h or "").encode()
    assert sorted(((r["page_id"] is None, r["page_id"] or 0), r["payload_bytes"], r["payload_digest"]) for r in got) == sorted(((i is None, i or 0), len(payload(h)), hashlib.sha256(payload(h)).hexdigest()) for i, _, h in rows)
    first = {}
    for i, _, h in rows:
        if len(payload(h)) >= 100 and i is not None:
            first[payload(h)] = min(i, first.get(payload(h), i))
    by_digest = {hashlib.sha256(k).hexdigest(): v for k, v in first.items()}
    responses = {}
    for r in got:
        response = by_digest.get(r["payload_digest"])
        if r["record_type"] == "response":
            assert r["refers_to"] is None and (response is None or r["page_id"] == response)
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"]
            responses[r["payload_digest"]] = responses.get(r["payload_digest"], 0) + 1
        else:
            assert r["refers_to"] == response is not None and r["payload"] is None
    assert all(responses[d] == 1 for d in by_digest)


def test_archive_records_are_whole(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "http://a/", "x" * 200), (2, "http://b/", "x" * 200)]), str(tmp_path / "w"))
    (name,) = [f for f in os.listdir(tmp_path / "w") if f.endswith(".gz")]
    one, two = list(warc._members(str(tmp_path / "w" / name)))
    assert one.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and one.endswith(b"x\r\n\r\n") and b"WARC-Target-URI: http://a/" in one
    assert two.startswith(b"WARC/1.1\r\nWARC-Type: revisit\r\n") and b"identical-payload-digest" in two and b"x" * 200 not in two


@pytest.mark.parametrize("id_of", [lambda i: i, lambda i: None, lambda i: 5, lambda i: -i if i % 3 else None])
def test_shards_stay_even_whatever_the_ids(spark, tmp_path, id_of):
    rows = [(id_of(i), f"http://a/{i}", f"{i:05d}" * 100) for i in range(3000)] + [(10**12, "http://stray/", "x" * 500)]
    shards = {}
    for r in warc.write_archives(pages(spark, rows), str(tmp_path / "w"), shard_bytes=80_000).collect():
        shard = r["file"].split("-")[1]
        shards[shard] = shards.get(shard, 0) + r["records"]
    most = 80_000 // 1012  # records of 500 bytes and 512 for the headers
    assert len(shards) == -(-3001 // most) and max(shards.values()) == most and sum(shards.values()) == 3001
    read = warc.read_archives(spark, str(tmp_path / "w"))
    assert sorted(((r["page_id"] is None, r["page_id"] or 0), r["payload_digest"]) for r in read.collect()) == sorted(((i is None, i or 0), hashlib.sha256(h.encode()).hexdigest()) for i, _, h in rows)


def test_ranges_from_few_keys_split_all_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGES", 64)
    digests = spark.range(4000).select(F.col("id").alias("page_id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(488).alias("bytes"))
    edges = warc._shard_edges(digests, 500_000)
    assert 5 <= len(edges) <= 16 and edges == sorted(edges) == warc._shard_edges(digests.repartition(7), 500_000)
    hot = digests.withColumn("digest", F.lit("0" * 64)).withColumn("page_id", F.lit(1).cast("long"))
    assert len(warc._shard_edges(hot, 500_000)) <= 1


def test_blanks_in_addresses_are_encoded(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "http://a/b c\td", "h")]), str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).first()["url"] == "http://a/b%20c%09d"


def test_archives_of_nothing(spark, tmp_path):
    assert warc.write_archives(pages(spark, []), str(tmp_path / "w")).count() == 0
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def plain_near(vectors):
    good = {i: np.array(v, float) for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for i, a in good.items():
        for j, b in good.items():
            if i < j and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95:
                out.append((i, j))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    out = [rng.normal(size=24).tolist() for _ in range(300)]
    for i in range(12):
        out += [(np.array(out[i]) + rng.normal(size=24) * s).tolist() for s in (0.02, 0.05, 0.1, 0.2, 0.25) for _ in range(4)]
    out += [out[0]] * 30 + [(2 * np.array(out[0])).tolist()] + [None, [], [0.0] * 24, [None, *out[1][1:]], [float("nan"), *out[1][1:]], [float("inf"), *out[1][1:]], out[1][:20], out[1][:20], [1.0], [5.0]]
    return out


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_vectors_match_all_pairs(spark, vectors, block_rows):
    rows = spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n int, cid string")
    got = {r["vec_id"]: r for r in crosspolytope.near_vectors(rows, block_rows=block_rows).collect()}
    pairs = plain_near(vectors)
    assert len(got) == len(vectors) and len(pairs) > 600
    counts = np.bincount(np.array(pairs).ravel(), minlength=len(vectors))
    assert all(got[i]["n_links"] <= counts[i] for i in got)
    assert sum(got[i]["n_links"] for i in got) >= 0.97 * counts.sum()
    roots = brute.closure(range(len(vectors)), pairs)
    assert np.mean([got[i]["component_id"] == roots[i] for i in got]) >= 0.97
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert crosspolytope.near_vectors(rows.where("false")).count() == 0


def test_vectors_without_ids(spark):
    rows = spark.createDataFrame([(None, [1.0, 2.0]), (None, [1.0, 2.0]), (5, [1.0, 2.0]), (None, [-1.0, 2.0]), (5, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in crosspolytope.near_vectors(rows).collect())
    assert got == [(0, 0, 0, False), (0, 3, 5, False), (0, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True)]


def test_recall_on_the_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = sum(r["n_links"] for r in crosspolytope.near_vectors(rows).collect())
    x = np.array([r[0] for r in rows.select("embedding").collect()], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = sum(int((x[i : i + 1000] @ x.T >= 0.95).sum()) for i in range(0, len(x), 1000)) - len(x)
    assert 0.97 * want <= got <= want


@pytest.mark.parametrize("hashes", [2, 3, 4])
def test_recall_of_planted_pairs(spark, hashes):
    """Pairs with cosines from 0.95 to 0.99, half of them at 0.95 to 0.96, among random vectors of 64 dimensions."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    a, side = x[:600], rng.normal(size=(600, 64))
    side -= (side * a).sum(axis=1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = np.concatenate([rng.uniform(0.95, 0.96, 300), rng.uniform(0.96, 0.99, 300)])[:, None]
    x = np.concatenate([x, near * a + np.sqrt(1 - near**2) * side])
    want = int((x @ x.T >= 0.95).sum()) - len(x)
    rows = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    got = sum(r["n_links"] for r in crosspolytope.near_vectors(rows, hashes=hashes).collect())
    print(f"hashes {hashes}: {got} of {want} links")
    assert want >= 1200 and 0.97 * want <= got <= want


def test_components_of_long_paths_and_stars(spark):
    rng = np.random.default_rng(2)
    names = rng.permutation(400)
    edges = [(int(names[i]), int(names[i + 1])) for i in range(199)] + [(int(names[200]), int(names[i])) for i in range(200, 300)] + [(int(names[350]), None), (int(names[351]), int(names[351]))]
    got = {r["node"]: r["component"] for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = brute.closure(range(400), [e for e in edges if e[1] is not None])
    assert got == {i: roots[i] for e in edges[:-2] for i in e}


def test_pipeline_stage_by_stage(spark, folder):
    import corpus_pipeline
    from keyscout.llm.common import stored

    docs, counts = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, folder), "test-stage")
        counts[name] = docs.count()
        if name == "quality rules":
            stats = {r["doc_id"]: brute.statistics(r["text"]) for r in before.collect()}
            bad = {i for i, s in stats.items() if s[0] < 50 or 100 * s[4] > 50 * s[0]}
            assert not bad & {r[0] for r in docs.select("doc_id").collect()}
        if name == "simhash near-dedup":
            _, roots = brute.simhash_components([(r["doc_id"], r["text"]) for r in before.collect()])
            assert sorted(r[0] for r in docs.select("doc_id").collect()) == sorted(set(roots.values()))
        if name == "secret scans":
            from keyscout.llm.secrets import base_spans

            assert not [r for r in docs.collect() if base_spans(r["text"])] and all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        if name == "source mixing":
            texts = {r["doc_id"]: r["text"] for r in before.collect()}
            assert all(r["text"] == texts[r["doc_id"]] for r in docs.collect())
        if name == "best-fit packing":
            assert {r[0] for r in docs.select("doc_id").collect()} == {r[0] for r in before.select("doc_id").collect()}
            assert docs.where("piece = 0").count() == before.count()
        else:
            assert docs.columns == columns
    assert list(counts) == [n for n, _ in corpus_pipeline.STAGES] and corpus_pipeline.run(spark, folder).count() == counts["best-fit packing"]


def test_queries_match_their_sql(spark, folder):
    import glob

    import duckdb

    from keyscout.llm.queries import ORACLE, QUERIES

    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11))
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    for name, sql in ORACLE.items():
        got = QUERIES[name](spark, folder)
        want = con.execute(sql)
        assert sorted(got.columns) == sorted(c[0] for c in want.description)
        order = [got.columns.index(c[0]) for c in want.description]
        assert sorted(map(repr, (tuple(tuple(r)[i] for i in order) for r in got.collect()))) == sorted(map(repr, want.fetchall())), name


def test_json_of_manifest(spark, tmp_path):
    warc.write_archives(pages(spark, [(1, "u", "h")]).where(F.col("page_id") > 0), str(tmp_path / "w"))
    lines = [json.loads(x) for f in os.listdir(tmp_path / "w" / "manifest") if f.endswith(".json") for x in open(tmp_path / "w" / "manifest" / f)]
    assert len(lines) == 1 and lines[0]["records"] == 1
