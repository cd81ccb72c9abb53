import os
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pyarrow.parquet as pq

import corpus_pipeline
from tests.llm.test_dedup import brute_fingerprint
from tests.llm.test_text import WANTED, WORD, LOW
from vetline.llm import frames, quality, words
from vetline.session import shared_root

SF = "/root/testdata/sf0.001"


def _files(spark, stage):
    """Data files of a stage's outputs in the shared folder."""
    root = shared_root(spark).removeprefix("file:")
    return [os.path.join(d, f) for d, _, names in os.walk(f"{root}/vetline/pipeline/{stage}") for f in names if f.endswith(".parquet")]


def test_pipeline_matches_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    x = quality.statistics(*words.text_buffer(pa.array([d["text"] for d in docs])))
    train = [k for k, d in enumerate(docs) if d["doc_id"] in labels and zlib.crc32(str(d["doc_id"]).encode()) % 3 != 1]
    y = np.array([labels[docs[k]["doc_id"]] for k in train])
    own = [x[train][y == c] for c in (0, 1)]
    spreads = [np.cov(o.T, bias=True) for o in own]
    pooled = sum(len(o) / len(train) * s for o, s in zip(own, spreads))
    logs = []
    for o, s in zip(own, spreads):
        s = 0.6 * s + 0.4 * pooled
        s = 0.95 * s + 0.05 * (np.trace(s) / x.shape[1] + 1e-6) * np.eye(x.shape[1])
        d = x - o.mean(axis=0)
        logs.append(np.log(len(o) / len(train)) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * (d * np.linalg.solve(s, d.T).T).sum(axis=1))
    kept = [d for d, a, b in zip(docs, *logs) if b >= a]
    kept = list({d["text"]: d for d in sorted(kept, key=lambda d: d["doc_id"])}.values())
    prints = {d["doc_id"]: brute_fingerprint(d["text"]) for d in kept}
    group = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if group[b] < group[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    group[a], changed = group[b], True
    kept = [d for d in kept if group[d["doc_id"]] == d["doc_id"]]
    windows = set()
    for r in pq.read_table(f"{SF}/benchmark.parquet").to_pylist():
        ws = WORD.findall(r["text"].translate(LOW))
        n = min(13, len(ws))
        windows |= {tuple(ws[k:k + n]) for k in range(len(ws) - n + 1)} if n else set()
    clean = []
    for d in kept:
        ws = WORD.findall(d["text"].translate(LOW))
        hit = {p for n in {len(w) for w in windows} for k in range(len(ws) - n + 1) if tuple(ws[k:k + n]) in windows for p in range(k, k + n)}
        if not hit or 20 * len(hit) < len(ws):
            clean.append(d)
    mark = frames.scratch_mark(spark)
    result = corpus_pipeline.run(spark, SF)
    assert frames.scratch_mark(spark) == mark  # nothing is left of the way
    left = [f for k in range(5) for f in _files(spark, k)]
    assert len(left) == len(result.inputFiles()) and all("/pipeline/4/" in f for f in left)
    got = {r.doc_id: r for r in result.collect()}
    assert set(got) == {d["doc_id"] for d in clean} and len(clean) > 50
    for d in clean[:40]:
        assert got[d["doc_id"]].ids == WANTED.encode_ordinary(d["text"])
    assert public_tokenizers.path(corpus_pipeline.VOCABULARY)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(30), SF).columns == docs.columns


ODD = "doc_id long, text string, lang string, source string, n_chars long, digest string, fp long, features double, benchmark_hits int, kept boolean"


def odd_documents(spark):
    long = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [(1, None), (2, ""), (3, "same text of a few words"), (3, "same text of a few words"), (4, "same text of a few words"), (None, "no id at all"),
            (None, None), (5, long), (6, long + " end"), (7, "?!"), (8, "\u3000 \u00e9 \U0001F600")]
    return spark.createDataFrame([(i, t, None, "s", None, "d", 7, 0.5, 1, True) for i, t in rows], ODD)


def test_odd_rows_pass_every_stage(spark):
    docs, judged = odd_documents(spark), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        judged[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
        assert set(judged[name]) <= {(r.doc_id, r.text) for r in docs.collect()}
    exact = [(i, (t or "")[:20]) for i, t in judged["exact dedup"]]
    assert [i for i, t in exact if t.startswith("same")] == [4] and len([1 for _, t in exact if t == ""]) == 1 and (None, "no id at all") in exact
    near = [i for i, t in judged["simhash near-dedup"] if t and len(t) > 1000]
    assert near == [5]
    assert len(judged["benchmark decontamination"]) == 11
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(coded) == 11 and {(r.doc_id, tuple(r.ids)) for r in coded if not r.n_tokens} == {(1, ()), (2, ()), (None, ())}


def test_empty_table_passes_every_stage(spark):
    docs = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
