import hashlib
import random
import re
import time
from html.parser import HTMLParser

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from vetline.llm import bpe, decontaminate, html_text, licences, queries, words

TOKENS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
MACHINE = bpe.transducer(TOKENS, public_tokenizers.PATTERN)
WANTED = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
BITS = ["a", "b", "ab", "th", "er", "é", "漢", "\n", " ", "  ", "😀", "x", "7", "'s", "!!", "'", "'ll", "'r", "\t", " '", "　", "٣", "\0", "ÃÂ"]


def test_registered_bpe_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.QUERIES["op2_byte_bpe"](spark, "/root/testdata/sf0.001")
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = WANTED.encode_ordinary(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_decoding_is_a_stream(spark, monkeypatch):
    """Portions end inside characters; what is no UTF-8 becomes the replacement character, as it does when decoded whole."""
    rng = random.Random(3)
    monkeypatch.setattr(bpe, "PORTION", 1)
    odd = [[rng.randrange(256) for _ in range(rng.randrange(12))] for _ in range(200)] + [WANTED.encode_ordinary("é漢😀" * 5)]
    for ids in odd:
        assert bpe.decoded(MACHINE, np.array(ids, np.int64)) == b"".join(TOKENS[i] for i in ids).decode("utf-8", "replace")
    df = spark.createDataFrame([(ids,) for ids in odd] + [(None,)], "ids array<int>")
    got = [bytes(r[0]) for r in df.select(bpe.decode(df.ids, TOKENS, public_tokenizers.PATTERN)).collect()]
    assert got == [b"".join(TOKENS[i] for i in ids).decode("utf-8", "replace").encode() for ids in odd] + [b""]
    clash = bpe.encode(spark.createDataFrame([("a b", 7)], "text string, ids int"), TOKENS, public_tokenizers.PATTERN)
    assert clash.columns == ["text", "ids", "_ids"] and clash.first()["_ids"] == WANTED.encode_ordinary("a b")


class TestBpe:
    def texts(self):
        rng = random.Random(11)
        made = ["".join(rng.choice(BITS) for _ in range(rng.randrange(14))) for _ in range(3000)]
        return [*made, "a" * 3000, " " * 2000 + "x", "ab" * 900, "=" * 700, "", None]

    def test_ids_match_the_public_library(self, spark):
        texts = self.texts()
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "ids long, text string")
        got = df.select("ids", bpe.encode_decode(df.text, TOKENS, public_tokenizers.PATTERN).alias("b")).collect()
        assert all(r.b.ids == WANTED.encode_ordinary(texts[r.ids] or "") for r in got)
        assert all(bytes(r.b.decoded) == (texts[r.ids] or "").encode() for r in got)

    def test_piecewise_encoding_agrees(self):
        assert all(MACHINE.encode(t or "") == WANTED.encode_ordinary(t or "") for t in self.texts())

    def test_tokens_are_settled_before_the_end(self):
        read = []

        def data():
            for byte in b"the" * 2000:
                read.append(byte)
                yield byte

        stream = MACHINE.run(data())
        next(stream)
        assert len(read) < 6 * MACHINE.longest

    def test_stream_decoding_holds_back_unfinished_characters(self):
        text = "é漢😀 x" * 50
        ids = MACHINE.encode(text)
        decoder = bpe.StreamDecoder(MACHINE)
        assert "".join([decoder.feed([i]) for i in ids]) + decoder.finish() == text
        assert bpe.StreamDecoder.unfinished(b"\xf0\x9f\x98") == 3 and bpe.StreamDecoder.unfinished(b"\xe0\x80") == 0

    def test_empty_table(self, spark):
        df = spark.createDataFrame([], "text string")
        assert bpe.encode(df, TOKENS, public_tokenizers.PATTERN).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_hits(text, items, window=13):
    own = WORD.findall((text or "").translate(LOW))
    hit, ids = set(), set()
    for item, body in items:
        ws = WORD.findall((body or "").translate(LOW))
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            for p in range(len(own) - n + 1):
                if own[p:p + n] == ws[k:k + n]:
                    hit.update(range(p, p + n))
                    ids.add("" if item is None else str(item))
    return len(own), hit, sorted(ids)


class TestDecontaminate:
    @pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])
    def test_matches_brute_force(self, spark, block):
        rng = random.Random(2)
        vocabulary = ["the", "of", "Ünd", "x1", "die", "ab", "q"]
        items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((1, 2, 3, 12, 13, 20, 40))))) for k in range(14)]
        items += [(3, "again the of"), (None, "null id item"), (90, None), (91, "...")]
        docs = [(None, None), (1, ""), (2, "?!"), (3, "null id ITEM"), (3, "null id ITEM")]
        for k in range(60):
            parts = [rng.choice(vocabulary) for _ in range(rng.randrange(120))]
            if k % 2:
                parts[3:3] = (rng.choice(items)[1] or "").split()
            docs.append((k + 10, ", ".join(parts)))
        df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, hits string")
        got = decontaminate.judge(df, spark.createDataFrame(items, "item_id long, text string"), "found", block_bytes=block).collect()
        assert len(got) == len(docs)
        for r in got:
            n, hit, ids = brute_hits(r.text, items)
            mine = {p for a, k in zip(r.found.hit_start, r.found.hit_words) for p in range(a, a + k)}
            assert (r.found.n_words, mine, sorted(r.found.item_ids)) == (n, hit, ids)
            assert (r.found.longest > 0) == bool(hit)

    def test_longest_match_goes_beyond_the_window(self, spark):
        item = " ".join(f"w{k}" for k in range(40))
        docs = spark.createDataFrame([("a b " + " ".join(f"w{k}" for k in range(5, 30)) + " c",)], "text string")
        (row,) = decontaminate.judge(docs, spark.createDataFrame([(1, item)], "item_id int, text string"), "f").collect()
        assert (row.f.hit_start, row.f.hit_words, row.f.longest) == ([2], [25], 25)

    def test_filter_and_empty_tables(self, spark):
        bench = spark.createDataFrame([(1, "one two three")], "item_id int, text string")
        long = " ".join(["pad"] * 57)
        docs = spark.createDataFrame([(1, f"one two three {long}"), (2, f"one two three {long} pad"), (3, None)], "doc_id int, text string")
        assert [r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()] == [2, 3]
        assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 3
        assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0

    def test_suffix_array_orders_all_suffixes(self):
        rng = np.random.default_rng(0)
        for alphabet in (2, 50):
            codes = (rng.integers(1, alphabet + 1, 500).astype(np.uint64)) << np.uint64(55)
            order = decontaminate.suffix_array(codes, 16)
            keys = [tuple(codes[p:p + 16].tolist()) for p in order]
            assert keys == sorted(keys) and sorted(order.tolist()) == list(range(500))


class _Words(HTMLParser):
    """Visible words of simple pages, by the standard library's parser."""

    def __init__(self):
        super().__init__()
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "template")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "template")

    def handle_data(self, data):
        if not self.off:
            self.words += data.split()


class TestHtml:
    def test_words_of_all_pages_match_another_parser(self):
        pages = duckdb.sql("SELECT html FROM read_parquet('/root/testdata/sf0.01/pages.parquet')").fetchall()
        for (page,) in pages:
            parser = _Words()
            parser.feed(page)
            parser.close()
            # Marks of list items are the renderer's own; text that only inline tags part may be joined.
            mine = re.sub(r"(?m)^(\s*)(- |\d+\. )+", r"\1", html_text.extract(page))
            assert "".join(mine.split()) == "".join(parser.words)

    @pytest.mark.parametrize("page, text", [
        ("", ""),
        ("a  b\n c", "a b c"),
        ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
        ("<h1>T</h1>x<br>y<br><br>z", "T\n\nx\ny\n\nz"),
        ("<ul><li>a<li>b<ol start=9><li>c<li>d</ol><li>e</ul>", "- a\n- b\n  9. c\n  10. d\n- e"),
        ("<table><tr><th>Name<th>N<tr><td>pear<td>10<tr><td rowspan=2>x<td>1<tr><td>2</table>", "Name  N\npear  10\nx     1\n      2"),
        ("<table><tr><td>a<br>b<td>c<tr><td colspan=2>wide cell</table>", "a  c\nb\nwide cell"),
        ("<table><tr><td><table><tr><td>in<td>ner</table><td>out</table>", "in  ner  out"),
        ("<pre>\n a\n  b</pre>", " a\n  b"),
        ("<p hidden>no</p><p style='color:red; display : none'>no</p><script>no</script><!-- no --><b>yes</b>", "yes"),
        ("<details><summary>s</summary>no</details><details open><summary>t</summary>yes</details>", "s\nt\nyes"),
        ("<head><title>no</title><body>yes", "yes"),
        ("1 < 2 &amp; <x", "1 < 2 & <x"),
        ("<b>bo<i>th</b></i> x</p>y", "both x\n\ny"),
        ("<a href='a>b'>l</a><title>no", "l"),
    ])
    def test_layout(self, page, text):
        assert html_text.extract(page) == text

    def test_depth_nulls_and_columns(self, spark):
        assert html_text.extract("<div>" * 20_000 + "x" + "<li>" * 3000) == "x"
        df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "<p>a", "k")], "page_id int, html string, text string")
        assert [r.seen for r in html_text.extract_text(df, into="seen").orderBy("page_id").collect()] == [None, "", "a"]
        assert html_text.extract_text(df.limit(0)).count() == 0
        kept = html_text.extract_text(df)
        assert kept.columns == ["page_id", "html", "text", "_text"]
        assert [(r.text, r["_text"]) for r in kept.orderBy("page_id").collect()] == [("k", None), ("k", ""), ("k", "a")]

    @pytest.mark.parametrize("page", ["<div>" * 200_000, "<span>" * 100_000 + "</b>" * 100_000, "<p><button>" + "<div>" * 180_000,
                                      "<b>" * 90_000 + "</i>" * 90_000 + "<div>" * 90_000, "<table>" + "<tr><td>" * 120_000, "<li>x" * 180_000])
    def test_a_megabyte_of_tags_takes_seconds(self, page):
        began = time.process_time()
        html_text.extract(page)
        assert time.process_time() - began < 10

    def test_registered_query(self, spark):
        got = queries.QUERIES["op6_html_extraction"](spark, "/root/testdata/sf0.001")
        assert got.columns == ["page_id", "url", "text"]
        pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
        rows = got.collect()
        assert len(rows) == len(pages) and all((r.url, r.text) == (pages[r.page_id].url, html_text.extract(pages[r.page_id].html)) for r in rows)


@pytest.mark.parametrize("pattern", [r"\p{L}{1,3}|\p{N}|[^\p{L}\p{N}]+", r"(\s?)\S+|\s+", public_tokenizers.PATTERN])
def test_pieces_follow_the_pattern(pattern):
    texts = ["International words, 12345 of them", "", "it's  naïve \n\n x", "\u00e9\u4e2d 7 "]
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})
    ids, bounds = bpe.transducer(TOKENS, pattern).encode_slice(*words.text_buffer(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [own.encode(t) for t in texts]
    assert bpe.CUT == public_tokenizers.PATTERN


class TestLicences:
    MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated\n"
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation\n"
           "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and\n"
           "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
           "The above copyright notice and this permission notice shall be included in all copies or substantial portions\n"
           "of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING\n"
           "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.")

    def test_rules(self, spark):
        bsd = [licences.SENTENCES[k] for k in (501, 502, 503, 504)]
        cases = {1: (None, []), 2: ("", []), 3: (self.MIT, ["MIT"]), 4: ("foo | bar\nReleased under the MIT License.\nx", ["MIT"]),
                 5: (". ".join(bsd), ["BSD-3-Clause"]), 6: (". ".join(bsd[:3]), ["BSD-2-Clause"]),
                 7: (". ".join([*bsd, *bsd[:3]]), ["BSD-2-Clause", "BSD-3-Clause"]), 8: (". ".join(reversed(bsd)), []),
                 9: ("Not licensed under the MIT License.", []), 10: ("Licensed under CC BY-NC 4.0.\n" * 3000, ["CC-BY-NC-4.0"])}
        df = spark.createDataFrame([(k, t, "z") for k, (t, _) in cases.items()], "doc_id long, text string, licence_scan string")
        got = licences.scan(df)
        assert got.columns == ["doc_id", "text", "licence_scan", "licence_sentences", "licences"]
        assert {r.doc_id: r.licences for r in got.collect()} == {k: v for k, (_, v) in cases.items()}
        assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
        assert licences.scan(df.limit(0)).count() == 0
        clash = licences.scan(df.withColumnRenamed("licence_scan", "Licences"))
        assert clash.columns == ["doc_id", "text", "Licences", "licence_sentences", "_licences"]
        assert {r.doc_id: (r.Licences, r["_licences"]) for r in clash.collect()} == {k: ("z", v) for k, (_, v) in cases.items()}

    APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\n"
              "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
              "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\n"
              "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
              "See the License for the specific language governing permissions and\nlimitations under the License.\n")
    GPL = ("This program is free software{a} you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
           "the Free Software Foundation{b} either version {n} of the License, or\n(at your option) any later version.\n\n"
           "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY{c} without even the implied warranty of\n"
           "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n")
    BSD = ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n"
           "1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
           "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n"
           "   and/or other materials provided with the distribution.\n")
    MPL = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v{} 2.0."
    MPL_COPY = " If a copy of the MPL was not distributed with this\nfile, You can obtain one at {}://mozilla.org/MPL/2.0/.\n"
    #: Public notices word for word, and the licences that a reader finds in them.
    PUBLIC = [
        ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
        (APACHE, ["Apache-2.0"]), (APACHE.replace("http:", "https:"), ["Apache-2.0"]),
        ("".join(f"# {line}".rstrip() + "\n" for line in APACHE.splitlines()), ["Apache-2.0"]),
        ("".join(f" * {line}".rstrip() + "\n" for line in APACHE.replace("http:", "https:").splitlines()), ["Apache-2.0"]),
        (APACHE.replace(" at\n\n   ", " at"), ["Apache-2.0"]), (APACHE.replace(" at\n\n   ", " at").replace("http:", "https:"), ["Apache-2.0"]),
        ("# SPDX-License-Identifier: Apache-2.0\nimport os\n", ["Apache-2.0"]), ("// SPDX-License-Identifier:Apache-2.0\n", ["Apache-2.0"]),
        ("/* SPDX-License-Identifier: MIT */", ["MIT"]), ("SPDX-License-Identifier:MIT", ["MIT"]),
        ("-- SPDX-License-Identifier: GPL-3.0-only\r\n", ["GPL-3.0-only"]), ("SPDX-License-Identifier:GPL-3.0-only", ["GPL-3.0-only"]),
        ("SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0-or-later"]), ("SPDX-License-Identifier:GPL-3.0-or-later", ["GPL-3.0-or-later"]),
        ("# SPDX-License-Identifier: GPL-2.0-only\n", ["GPL-2.0-only"]), ("SPDX-License-Identifier:GPL-2.0-only", ["GPL-2.0-only"]),
        ("SPDX-License-Identifier: Zlib\n", []), ("MIT", []), ("Version 2.0. Only Apache 2.0.", []),
        ("This code is released under the MIT License.\nReleased under the MIT License.", ["MIT"]), ("Licensed under the MIT License.", ["MIT"]), (MIT, ["MIT"]),
        ("This work is licensed under the GNU General Public License version 3.", ["GPL-3.0-only"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0-only"]),
        (GPL.format(a=":", b=",", c=";", n=3), ["GPL-3.0-or-later"]), (GPL.format(a=":", b=";", c=";", n=3), ["GPL-3.0-or-later"]),
        (GPL.format(a=",", b=",", c=",", n=3), ["GPL-3.0-or-later"]), (GPL.format(a=",", b=",", c=",", n=2), ["GPL-2.0-or-later"]),
        (GPL.format(a=";", b=";", c=";", n=2), ["GPL-2.0-or-later"]), (GPL.format(a=";", b=",", c=";", n=2), ["GPL-2.0-or-later"]),
        ("".join(f"# {line}".rstrip() + "\n" for line in GPL.format(a=";", b=";", c=";", n=2).splitlines()), ["GPL-2.0-or-later"]),
        ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("Licensed under CC BY 4.0.", ["CC-BY-4.0"]), ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
        ("This work is licensed under a Creative Commons\nAttribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]),
        ("To the extent possible under law, the author has waived all copyright and related\nor neighboring rights to this work.", ["CC0-1.0"]),
        (BSD, ["BSD-2-Clause"]),
        (BSD + "\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n"
         "   this software without specific prior written permission.\n", ["BSD-3-Clause"]),
        (MPL.format("."), ["MPL-2.0"]), (MPL.format(".") + MPL_COPY.format("https"), ["MPL-2.0"]), (MPL.format(".") + MPL_COPY.format("http"), ["MPL-2.0"]),
        (MPL.format("") + MPL_COPY.format("https"), ["MPL-2.0"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense"])]

    def test_every_rule_finds_its_public_text(self, spark):
        df = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(self.PUBLIC)], "doc_id long, text string")
        got = {r.doc_id: r.licences for r in licences.scan(df).collect()}
        assert [(t, got[k]) for k, (t, _) in enumerate(self.PUBLIC)] == self.PUBLIC
        cuts = df.select("doc_id", *[licences.sentence_ids(df.text, ends).alias(name) for name, ends in
                                     (("line", licences.BY_LINE), ("paragraph", licences.BY_PARAGRAPH))]).collect()
        seen = [("".join(f"<{i}>" for i in ids), self.PUBLIC[r.doc_id][1]) for r in cuts for ids in (r.line, r.paragraph)]
        unused = [rule for rule in licences.RULES if not any(licences.Rule(rule[0], tuple(rule[1])).pattern in ids and rule[0] in want for ids, want in seen)]
        assert unused == []
        docs = df.toPandas()  # noqa: F841 - read by DuckDB
        rows = duckdb.sql(licences.duckdb_sql("docs")).fetchall()
        assert {r[0]: r[1] for r in rows} == {k: ",".join(v) for k, v in got.items()}

    def test_markers_cover_every_sentence(self):
        marks = licences.marker_words(licences.SENTENCES)
        assert all(any(m in s for m in marks) for s in licences.SENTENCES.values())


class TestWords:
    def test_edges_and_hashes(self):
        texts = ["Ab cd", None, "", "cdé 1x-AB", "x" * 50]
        buf, offsets = words.text_buffer(pa.array(texts))
        hashes, bounds = words.words_of(buf, offsets, words.ALNUM)
        want = [words.hash_word(w) for t in texts for w in WORD.findall((t or "").translate(LOW))]
        assert hashes.tolist() == want and bounds.tolist() == [0, 2, 2, 2, 5, 6]

    def test_slices_cover_all_rows(self):
        buf, offsets = words.text_buffer(pa.array(["a" * 10, "", "b" * 30, "c"]))
        assert [(a, b) for a, b, _, _ in words.slices(buf, offsets, 12)] == [(0, 2), (2, 3), (3, 4)]


