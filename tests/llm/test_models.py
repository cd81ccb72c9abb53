import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vetline.llm import gru, lm, quality, queries, toxicity, words

SF = "/root/testdata/sf0.01"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")


class TestQuality:
    def test_statistics_of_a_plain_text(self):
        buf, offsets = words.text_buffer(pa.array(["Ab ab ab 12!\nAb ab ab 12!", "", None]))
        x = quality.statistics(buf, offsets)
        f = dict(zip(quality.FEATURES, x[0]))
        assert np.isfinite(x).all() and (x[1] == x[2]).all()
        assert f["log_bytes"] == pytest.approx(math.log1p(25))
        assert f["digit"] == pytest.approx(math.log(4.5 / 21.5)) and f["upper"] == pytest.approx(math.log(2.5 / 23.5))
        assert f["distinct_words"] == pytest.approx(math.log(2.5 / 6.5)) and f["line_repeat"] == pytest.approx(math.log(1.5 / 1.5))

    def test_posterior_is_that_of_the_shrunk_normal_densities(self, spark):
        rng = np.random.default_rng(1)
        k = len(quality.FEATURES)
        xs = np.concatenate([rng.normal(0, 1, (80, k)), rng.normal(0.7, 2, (120, k))])
        ys = [0] * 80 + [1] * 120
        described = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(xs)], "doc_id long, features array<double>")
        labels = spark.createDataFrame([*enumerate(ys), (999, 1), (3, None), (4, 7)], "doc_id long, quality int")
        model = quality.fit(described, labels, to_pooled=0.2, to_round=0.1)
        spreads = [np.cov(xs[[y == c for y in ys]].T, bias=True) for c in (0, 1)]
        pooled = 0.4 * spreads[0] + 0.6 * spreads[1]
        logs = []
        for c in (0, 1):
            s = 0.8 * spreads[c] + 0.2 * pooled
            s = 0.9 * s + 0.1 * (np.trace(s) / k + 1e-6) * np.eye(k)
            d = xs - xs[[y == c for y in ys]].mean(axis=0)
            logs.append(math.log((0.4, 0.6)[c]) - 0.5 * np.linalg.slogdet(s)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d))
        assert model.posterior(xs) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))

    def test_held_out_accuracy(self, spark):
        got = queries.QUERIES["op5_quality_classifier"](spark, SF)
        assert got.columns == ["doc_id", "held_out", "score", "predicted"]
        labels = spark.read.parquet(f"{SF}/labels.parquet")
        rows = got.join(labels, "doc_id").where("held_out").collect()
        good, bad = [r.predicted for r in rows if r.quality], [r.predicted for r in rows if not r.quality]
        assert sum(good) / len(good) > 0.95 and sum(bad) / len(bad) < 0.1
        assert got.count() == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got.collect())

    def test_odd_rows(self, spark):
        docs = documents(spark, [(None, None), (1, ""), (2, "x" * 200_000), (2, "x" * 200_000)])
        labels = spark.createDataFrame([], "doc_id long, quality int")
        model = quality.fit(quality.describe(docs), labels)
        assert model.posterior(np.zeros((2, len(quality.FEATURES)))).tolist() == [0.5, 0.5]
        one = quality.fit(quality.describe(docs), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
        assert quality.keep_good(docs, one).count() == 4 and quality.keep_good(docs, one).columns == docs.columns
        assert quality.describe(docs.limit(0)).count() == 0


class TestToxicity:
    WORDS = [f"w{k}" for k in range(400)]

    def corpus(self, n=400):
        rng = random.Random(4)
        rows, labels = [], []
        for i in range(n):
            toxic = i % 5 == 0
            text = rng.choices(self.WORDS, weights=[1 / (k + 1) for k in range(400)], k=rng.choice((20, 80, 300)))
            for k in range(len(text)):
                if toxic and rng.random() < 0.06:
                    text[k] = rng.choice(("vile", "foul", "rude"))
            rows.append((i, " ".join(text)))
            labels.append((i, int(toxic)))
        return rows, labels

    def test_separates_and_leaves_clean_texts_alone(self, spark):
        rows, labels = self.corpus()
        docs = documents(spark, rows)
        model = toxicity.fit(docs, spark.createDataFrame(labels[:300], "doc_id long, toxic int"))
        got = {r.doc_id: r.s for r in docs.select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()}
        held = labels[300:]
        assert sum(got[i] >= 0.3 for i, y in held if y) >= 0.9 * sum(y for _, y in held)
        assert sum(got[i] >= 0.3 for i, y in held if not y) <= 0.03 * len(held)
        assert {words.hash_word(w) for w in ("vile", "foul", "rude")} <= set(model.words.tolist())

    def test_continuation_counts(self, spark):
        texts = [("a b a c", 1), ("a b d b", 0), ("c b", 0), ("e", 1), ("", 0)]
        rows = spark.createDataFrame(texts, "text string, label long")
        pairs = {(v, w, y) for t, y in texts for v, w in zip(t.split(), t.split()[1:])}
        got = {(r.kind, r.word if r.kind == 1 else r.context): (r.toxic, r.ordinary, r.either) for r in toxicity._tables(rows).where("kind > 0").collect()}
        for kind, own, far in ((1, 1, 0), (2, 0, 1)):
            for w in "abcde":
                seen = [{x[far] for x in pairs if x[own] == w and x[2] in ys} for ys in ((1,), (0,), (0, 1))]
                name = int(np.uint64(words.hash_word(w)).view(np.int64))
                assert got.get((kind, name), (0, 0, 0)) == tuple(map(len, seen))

    def test_phrases_of_ordinary_words(self, spark):
        rng, rows, labels = random.Random(11), [], []
        for i in range(600):  # "w30 w31" is toxic, in 20 documents; either word alone is as common in both classes
            text = rng.choices(self.WORDS[:60], k=40)
            text = [w for a, w in zip(["", *text], text) if (a, w) != ("w30", "w31")]
            rows.append((i, " ".join(text + ["w30", "w31"] if i % 5 == 0 and i < 125 else text)))
            labels.append((i, int(i % 5 == 0)))
        model = toxicity.fit(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
        pair = toxicity._pairs(np.array([words.hash_word(w) for w in ("w30", "w31")], np.uint64), np.array([0, 2]))[0][1]
        at = np.flatnonzero(model.pairs == pair)
        assert len(at) == 1 and model.pair_gain[at[0]] > 1 and len(model.pairs) <= 3

    def test_held_out_rates(self, spark):
        """Documents labelled toxic that hold a word which training documents show to be toxic are found; others cannot be."""
        sf = "/root/testdata/sf0.1"
        labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
        texts = {r.doc_id: set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r.text.translate(LOWER)))
                 for r in spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").collect() if r.doc_id in labels}
        train = [i for i in texts if zlib.crc32(str(i).encode()) % 4 != 2]
        counts = [collections.Counter(w for i in train if labels[i] == y for w in texts[i]) for y in (0, 1)]
        size = [sum(labels[i] == y for i in train) for y in (0, 1)]
        telling = {w for w, n in counts[1].items() if n >= 6 and n / size[1] > 6 * (counts[0][w] + 0.5) / size[0]}
        got = [r for r in queries.QUERIES["op9_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
        toxic, ordinary = ([r for r in got if labels[r.doc_id] == y] for y in (1, 0))
        assert np.mean([r.predicted for r in toxic if texts[r.doc_id] & telling]) >= 0.95
        assert np.mean([r.predicted for r in toxic]) >= 0.85 and np.mean([r.predicted for r in ordinary]) <= 0.005

    def test_odd_rows(self, spark):
        docs = documents(spark, [(None, None), (1, ""), (2, "a"), (2, "a")])
        none = spark.createDataFrame([(None, 1), (1, None), (2, 5)], "doc_id long, toxic int")
        model = toxicity.fit(docs, none.where("doc_id IS NOT NULL"))
        assert [r[0] for r in docs.select(toxicity.score(F.col("text"), model)).collect()] == [0.0] * 4
        both = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
        scores = [r[0] for r in docs.select(toxicity.score(F.col("text"), toxicity.fit(docs, both))).collect()]
        assert all(0 <= s <= 1 for s in scores)
        assert docs.limit(0).select(toxicity.score(F.col("text"), model)).count() == 0


class TestGru:
    def model(self, hidden=5):
        return gru.Gru(np.array([50, 30, 20, 10, 5, 5, 2, 1]), hidden, 3)

    def test_trees_of_large_classes(self, monkeypatch):
        monkeypatch.setattr(gru, "FEW", 2)
        assert self.model().deep.any() and not self.model().deep.all()
        plain = np.exp(self.model().log_probabilities(np.zeros((8, 5), np.float32), np.arange(8)))
        assert plain == pytest.approx(np.array([51, 31, 21, 11, 6, 6, 3, 2]) / 131, abs=1e-5)  # starts from the counts
        self.test_gradient()
        self.test_probabilities_sum_to_one_and_lanes_do_not_matter()
        model = self.model()
        gru.train(model, [np.array([1, 5, 5, 0, 7])], 3, 0.01)
        other = self.model()
        other.load(model.rows())
        assert all((other.p[k] == v).all() for k, v in model.p.items())

    def test_gradient(self):
        model, rng = self.model(), np.random.default_rng(0)
        x, y = rng.integers(0, 8, (6, 4)), rng.integers(0, 8, (6, 4))
        fresh = rng.random((6, 4)) < 0.2
        h = rng.normal(0, 0.5, (4, 5)).astype(np.float32)
        for k in model.p:
            model.p[k] = model.p[k].astype(np.float64) + rng.normal(0, 0.3, model.p[k].shape)
        taken = {}
        model._step = lambda grads, rate: taken.update(grads)
        model.learn(x, y, fresh, h, 0.1)

        def value():
            states, _ = model.run(x, fresh, h)
            return model.log_probabilities(states.reshape(-1, 5).astype(np.float64), y.ravel()).mean()

        for k, v in model.p.items():
            for at in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(6)]:
                old = v[at]
                v[at] = old + 1e-3
                up = value()
                v[at] = old - 1e-3
                down = value()
                v[at] = old
                assert (up - down) / 2e-3 == pytest.approx(taken[k][at], abs=3e-4)

    @pytest.mark.parametrize("few", [2, 64])
    def test_against_a_forward_pass_word_by_word(self, monkeypatch, few):
        """Plain scalar sums: gates, class, then the word by softmax or by halving its class."""
        monkeypatch.setattr(gru, "FEW", few)
        model, rng = self.model(), np.random.default_rng(9)
        for k in model.p:
            model.p[k] = (model.p[k] + rng.normal(0, 0.4, model.p[k].shape)).astype(np.float32)
        p, H, end = {k: v.astype(float) for k, v in model.p.items()}, 5, 3
        sigmoid = lambda v: 1 / (1 + math.exp(-v))
        dot = lambda a, b: sum(x * y for x, y in zip(a, b))

        def chosen(scores, k):
            return scores[k] - math.log(sum(math.exp(x) for x in scores))

        def log_likelihood(words):
            h, before, total = [0.0] * H, end, 0.0
            for w in [*words, end]:
                g, hu = p["table"][before], [dot(h, p["u"][:, j]) for j in range(3 * H)]
                z, r = ([sigmoid(g[k * H + j] + hu[k * H + j]) for j in range(H)] for k in (0, 1))
                new = [math.tanh(g[2 * H + j] + r[j] * hu[2 * H + j]) for j in range(H)]
                h = [new[j] + z[j] * (h[j] - new[j]) for j in range(H)]
                c = model.word_class[w]
                total += chosen([dot(h, p["wc"][:, j]) + p["bc"][j] for j in range(p["wc"].shape[1])], c)
                a, b = model.class_start[c], model.class_start[c + 1]
                if b - a <= few:
                    total += chosen([dot(h, p["wo"][i]) + p["bo"][i] for i in range(a, b)], w - a)
                else:
                    while b - a > 1:
                        m = (a + b) // 2
                        side = dot(h, p["wo"][m]) + p["bo"][m]
                        total += math.log(sigmoid(side if w >= m else -side))
                        a, b = (m, b) if w >= m else (a, m)
                before = w
            return total

        texts = [[], [0], [7, 7, 1], rng.integers(0, 8, 150).tolist(), [3, 5, 2, 6, 4]]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        got = gru.log_likelihoods(model, np.concatenate([np.array(t, np.int64) for t in texts]), bounds, end, lanes=2, window=4)
        assert got == pytest.approx([log_likelihood(t) for t in texts], rel=1e-4, abs=1e-4)

    def test_probabilities_sum_to_one_and_lanes_do_not_matter(self):
        model, rng = self.model(), np.random.default_rng(2)
        state = rng.normal(0, 1, (1, 5)).astype(np.float32)
        assert np.exp([model.log_probabilities(state, np.array([w]))[0] for w in range(8)]).sum() == pytest.approx(1, abs=1e-5)
        texts = [rng.integers(0, 8, n) for n in (0, 1, 7, 300, 2, 64, 65, 1000)]
        flat, bounds = np.concatenate(texts), np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        many = gru.log_likelihoods(model, flat, bounds, 3, lanes=3, window=16)
        alone = [gru.log_likelihoods(model, t, np.array([0, len(t)]), 3)[0] for t in texts]
        assert many == pytest.approx(alone, rel=1e-4)
        assert len(gru.log_likelihoods(model, flat[:0], np.array([0]), 3)) == 0

    def test_large_trees(self, monkeypatch):
        """Levels reckoned for a whole class and levels fetched word by word, against halving each class by itself."""
        monkeypatch.setattr(gru, "FEW", 40)
        monkeypatch.setattr(gru, "PATHS", 32)
        model, rng = gru.Gru(np.round(3000 / np.arange(1, 401)), 5, 4), np.random.default_rng(4)
        assert model.top >= 3 and len(model.nodes) > model.top + 1 and not model.deep.all()
        for k in model.p:
            model.p[k] = model.p[k].astype(np.float64) + rng.normal(0, 0.3, model.p[k].shape)
        states, y, weight = rng.normal(0, 1, (90, 5)), np.minimum(rng.integers(0, 400, 90), rng.integers(0, 400, 90)), rng.random(90)
        p, start = model.p, model.class_start

        def log_probability(s, w):
            c = model.word_class[w]
            scores = s @ p["wc"] + p["bc"]
            out = scores[c] - np.log(np.exp(scores).sum())
            a, b = start[c], start[c + 1]
            if b - a <= 40:
                scores = p["wo"][a:b] @ s + p["bo"][a:b]
                return out + scores[w - a] - np.log(np.exp(scores).sum())
            while b - a > 1:
                m = (a + b) // 2
                out -= np.log1p(np.exp((p["wo"][m] @ s + p["bo"][m]) * (-1 if w >= m else 1)))
                a, b = (m, b) if w >= m else (a, m)
            return out

        value = lambda: sum(v * log_probability(s, w) for s, w, v in zip(states, y, weight))
        logs, back, grads = model._output(states, y, weight)
        assert logs == pytest.approx([log_probability(s, w) for s, w in zip(states, y)])
        assert model.log_probabilities(states, y) == pytest.approx(logs)
        assert len(set(grads["wo"].at.tolist())) == len(grads["wo"].at)
        for table, got in [(states, back), *((p[k], grads[k]) for k in ("wc", "bc", "wo", "bo"))]:
            for at in [tuple(rng.integers(0, n) for n in table.shape) for _ in range(25)]:
                old = table[at]
                table[at] = old + 1e-4
                up = value()
                table[at] = old - 1e-4
                down = value()
                table[at] = old
                assert (up - down) / 2e-4 == pytest.approx(got[at], abs=1e-5)

    def test_sums_of_runs(self):
        rng = np.random.default_rng(6)
        size = rng.choice([1, 2, 3, gru.RUN - 1, gru.RUN, gru.RUN + 1, 500], 60)
        rows, heads = rng.normal(0, 1, (size.sum(), 3)), np.cumsum(size) - size
        order = rng.permutation(len(rows))
        assert gru._sums(rows, heads) == pytest.approx(np.add.reduceat(rows, heads, axis=0))
        assert gru._sums(rows, heads, order) == pytest.approx(np.add.reduceat(rows[order], heads, axis=0))
        assert gru._sums(rows[:1], np.array([0])) == pytest.approx(rows[:1])

    def test_scores_that_might_overflow(self):
        model = self.model()
        for k in ("wc", "wo"):
            model.p[k] = model.p[k] * np.float32(3000)
        logs = model.log_probabilities(np.ones((8, 5), np.float32), np.arange(8))
        assert np.isfinite(logs).all() and np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)

    def test_training_learns_from_every_word(self):
        model, seen = self.model(), []
        plain = model._output

        def output(states, y, weight):
            seen.extend(y[weight > 0].tolist())
            return plain(states, y, weight)

        model._output = output
        texts = [np.random.default_rng(k).integers(0, 8, n) for k, n in enumerate((700, 0, 3, 330))]
        want = [w for t in texts for w in [*t.tolist(), 3]]
        assert gru.train(model, texts, 3, 0.01, lanes=10, window=16) == len(want) == 1037
        assert sorted(seen) == sorted(want)


TOKEN = re.compile(r"[^\x20\x09-\x0D]+")


class TestLm:
    def brute(self, rows, train):
        split = {k: TOKEN.findall((t or "").translate({c: c + 32 for c in range(65, 91)})) + ["\0end"] for k, (_, t) in enumerate(rows)}
        c = collections.Counter(w for k in train for w in split[k])
        n, v = sum(c.values()), len(c)
        return {k: (len(ws), sum(c[w] > 0 for w in ws), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for k, ws in split.items()}, n

    @pytest.mark.parametrize("head", [lm.HEAD, 20])
    def test_counts_and_base_match_brute_force_and_the_model_learns(self, spark, monkeypatch, head):
        monkeypatch.setattr(lm.count, "__defaults__", (head,))
        monkeypatch.setattr(lm.Vocabulary.__init__, "__defaults__", (15,))
        rng = random.Random(9)
        rows = []
        for k in range(240):  # two "languages" in alternating order of words: the state tells which
            own = [f"{'AB'[k % 2]}{j}" for j in range(30)]
            rows.append((k, " ".join(rng.choice(own[:12] if rng.random() < 0.9 else own) for _ in range(rng.choice((3, 50, 200))))))
        rows += [(1000, None), (1001, ""), (1002, "unseen\twords ÀB"), (1002, "unseen\twords ÀB"), (None, "a0 a0")]
        docs = documents(spark, rows)
        scored, corpus = lm.score(docs, F.col("doc_id") % 4 != 1)
        want, total = self.brute(rows, [k for k, (i, _) in enumerate(rows) if i is None or i % 4 != 1])
        got = sorted(scored.collect(), key=lambda r: (str(r.id), r.base_score))
        keys = sorted(range(len(rows)), key=lambda k: (str(rows[k][0]), want[k][2]))
        assert corpus.total == total and len(got) == len(rows)
        for r, k in zip(got, keys):
            assert (r.n_tokens, r.n_known) == want[k][:2] and r.base_score == pytest.approx(want[k][2])
        held = [r for r in got if r.id is not None and r.id % 4 == 1 and r.id < 1000]
        assert sum(r.score for r in held) > sum(r.base_score for r in held)

    def test_first_texts_are_drawn_by_all_tasks_and_exactly(self, spark):
        rows = [(k, "copy" if k % 3 == 0 else f"text {k}") for k in range(3000)]
        texts = spark.createDataFrame(rows, "id long, text string").repartition(6)
        got = lm.first_texts(texts, 3000, 90)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" in plan and "Coalesce" not in plan
        drawn = [r.text for r in got.collect()]
        assert len(drawn) == 90 and 10 <= drawn.count("copy") <= 55
        assert sorted(drawn) == sorted(r.text for r in lm.first_texts(texts.repartition(2), 3000, 90).collect())
        assert got.rdd.getNumPartitions() == 1 and lm.first_texts(texts, 3000, 5000).count() == 3000

    @pytest.mark.parametrize("n", [0, 1, 2, 1000])
    def test_names_are_found(self, n):
        rng = np.random.default_rng(n)
        names = np.unique(np.concatenate([rng.integers(0, 2 ** 64 - 1, n, np.uint64), np.arange(20 if n > 2 else 0, dtype=np.uint64) + np.uint64(5 << 40)]))
        asked = np.concatenate([names, names + np.uint64(1), rng.integers(0, 2 ** 64 - 1, 500, np.uint64), np.array([0, 2 ** 64 - 1], np.uint64)])
        at, known = lm.Names(names).find(asked)
        assert (known == np.isin(asked, names)).all() and (at[~known] == len(names)).all()
        assert (names[at[known]] == asked[known]).all()

    def test_vocabulary_grows_with_the_corpus(self, spark):
        rng, sizes = random.Random(3), []
        for n in (2_000, 40_000):
            words_ = [f"w{int(rng.paretovariate(0.15))}" for _ in range(n * 10)]
            corpus = lm.count(spark.createDataFrame([(" ".join(words_[k::200]),) for k in range(200)], "text string"))
            voc = lm.Vocabulary(corpus)
            counted = collections.Counter(words_)
            known = sum(c for w, c in counted.items() if voc.number(np.array([words.hash_word(w)], np.uint64))[0] != voc.other)
            assert known >= min(lm.SHARE * n * 10, sum(c for c in counted.values() if c > 1)) - 200
            sizes.append(len(voc.names))
        assert sizes[1] > 3 * 1022 and sizes[1] > 3 * sizes[0]

    def test_no_training_text_and_no_text(self, spark):
        docs = documents(spark, [(1, "a b"), (2, None)])
        scored, corpus = lm.score(docs, F.lit(False))
        assert corpus.total == 0 and {(r.id, r.n_tokens, r.n_known, r.score) for r in scored.collect()} == {(1, 3, 0, 0.0), (2, 1, 0, 0.0)}
        assert lm.score(docs.limit(0), F.lit(True))[0].count() == 0

    def test_other_words_share_one_entry_that_sums_to_one(self, spark):
        corpus = lm.count(spark.createDataFrame([("a a a b b c d e",), ("a f g",)], "text string"))
        voc = lm.Vocabulary(corpus, size=2)
        rare = [1, 1, 1, 1, 1]
        assert voc.rest_mass == sum(c + 1 for c in rare) + 1


def test_registered_language_model_query(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op8_lm_scoring"](spark, sf)
    assert got.dtypes[:7] == [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"),
                              ("base_score", "double"), ("score", "double")]
    texts = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER)) + [None]
             for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = collections.Counter(w for i, t in texts.items() if i not in out for w in t)
    total, kinds = sum(counts.values()), len(counts)
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == set(texts)
    for i, t in texts.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in out, len(t), sum(w in counts for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in t), rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
