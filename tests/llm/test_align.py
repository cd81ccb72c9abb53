import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from vetline.llm import align, queries

JSON = open(public_tokenizers.path(queries.BYTE_VOCABULARY), encoding="utf-8").read()
MODEL = open(public_tokenizers.path(queries.PIECE_VOCABULARY), "rb").read()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def brute():
    """Alignment of whole texts, token bytes taken from the libraries themselves."""
    a = Tokenizer.from_str(JSON)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
    letters = {v: k for k, v in enumerate_letters().items()}

    def one(text):
        if not text:
            return None
        whole = (" " + text).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        own_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        own_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if b"".join(own_a) != whole or b"".join(own_b) != whole:
            return None
        ends = lambda own: [sum(map(len, own[:k + 1])) for k in range(len(own))]
        ea, eb = ends(own_a), ends(own_b)
        links = [(ids_a[i], ids_b[j]) for i, x in enumerate(ea) for j, y in enumerate(eb) if x == y]
        groups, low = [], 0
        for cut in sorted(set(ea) & set(eb)):
            groups.append(",".join(str(i) for i, e in zip(ids_a, ea) if low < e <= cut) + "|" + ",".join(str(i) for i, e in zip(ids_b, eb) if low < e <= cut))
            low = cut
        return ids_a, ids_b, links, ";".join(groups)

    def all_of(texts):
        got = [one(t) for t in texts]
        count = Counter(x for g in got if g for x in g[2])
        high = defaultdict(int)
        for (_, j), n in count.items():
            high[j] = max(high[j], n)
        out = []
        for g in got:
            if g is None:
                out.append((0, 0, 0, 0, 0, 0, ""))
                continue
            out.append((len(g[0]), len(g[1]), g[3].count(";") + 1, len(g[2]), sum(count[x] == high[x[1]] for x in g[2]),
                        sum(count[x] for x in g[2]), hashlib.sha256(g[3].encode()).hexdigest()))
        return out
    return all_of


def enumerate_letters():
    """Byte to letter, by the rule: what is neither printable ASCII nor printable Latin-1 moves up, in order."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


TEXTS = [None, "", " ", "a", "the cat sat", "  two  spaces ", "tab\tand\nline \n x", "x▁y plain", "<|endoftext|> is text <s> </s> <0x41>",
         "naïve café 漢字　wide \U0001F600 smile", "no break   em", "the cat sat", "\u0000nul \u001c sep", "it's we'll  they've 12 345",
         "word " * 3000 + "end", "x" * 5000, "퟿ ﻿ bom"]


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(k, t, "x", 5) for k, t in enumerate(texts)], "doc_id long, text string, links string, n_a int")
    rows = align.align(docs, JSON, MODEL)
    got = align.with_counts(rows, align.pair_counts(rows), **kw).collect()
    return [tuple(r)[1:5] + (r.n_best, r.count_sum, r.groups_sha256) for r in sorted(got, key=lambda r: r.id)]


@pytest.mark.parametrize("head", [0, 5, align.HEAD])
def test_matches_brute_force_on_odd_texts(spark, brute, head):
    assert run(spark, TEXTS, head=head) == brute(TEXTS)


def test_random_mixtures(spark, brute):
    rng = random.Random(3)
    bits = [" ", "  ", "\n", "\t", "a", "the", "The", "ing", "'s", "é", "　", "12", "!", " ", "\u0085", "zq", "\U0001F600", "▁"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    assert run(spark, texts) == brute(texts)


def test_memory_of_parts_may_be_dropped(spark, brute, monkeypatch):
    both = align.Aligner(JSON, MODEL)
    assert both.cuts
    monkeypatch.setattr(align, "CACHED", 3)
    for text in ["a b c d e", "e d c b a", "a f", "f a b"]:
        parts = both.parts([text, text])
        assert parts[0] == parts[1] and sum(p[0] for p in parts[0]) == brute([text])[0][0]
        assert len(both.known) + len(both.before) <= 10


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.aligned(docs, JSON, MODEL).count() == 0
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_links for r in align.aligned(docs, JSON, MODEL).collect()) == [0, 2, 2]


def test_registered_query(spark, brute):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op13_cross_tokenizer_alignment"](spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    short = {k: t for k, t in texts.items() if len(t) < 3000}
    rows = {r.doc_id: r for r in got.collect()}
    assert set(rows) == set(texts)
    want = dict(zip(short, brute(list(short.values()))))
    for k in short:
        assert (rows[k].n_a, rows[k].n_b, rows[k].n_groups, rows[k].n_links, rows[k].groups_sha256) == want[k][:4] + want[k][6:]
