"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into sentences twice: once with every line break ending a
sentence, once with only blank lines doing so (for notices wrapped over several
lines). Sentences are normalised (lower case, everything but a-z and
digits one space), mapped to the identifiers of known licence sentences, and
all others dropped. A licence rule is an ordered list of identifiers; it
matches where they follow one another in a document's sequence. A rule that
only repeats a part of a longer rule, and matches no more often, is dropped.

The scan is one projection per document without a shuffle, so neither a hot
source nor a line that many documents share costs more than its own text.

Defined cases: null or empty texts have no sentences and no licence; repeated
sentences give repeated identifiers; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.llm.frames import fresh

# Sentences of public licence texts and notices, normalised; a sentence's identifier is its key.
# A sentence that runs across a mark or a blank line is held as the parts that the cuts below make of it, and whole for
# spellings without the mark.
SENTENCES = {
    101: "licensed under the apache license version 2 0",
    102: "licensed under the apache license version 2 0 the license",
    103: "you may not use this file except in compliance with the license",
    104: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    105: "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
         "an as is basis without warranties or conditions of any kind either express or implied",
    106: "see the license for the specific language governing permissions and limitations under the license",
    107: "spdx license identifier apache 2 0",
    108: "apache 2 0",
    109: "you may obtain a copy of the license at",
    110: "http www apache org licenses license 2 0",
    111: "https www apache org licenses license 2 0",
    112: "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or "
         "agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
         "conditions of any kind either express or implied",
    113: "you may obtain a copy of the license at https www apache org licenses license 2 0 unless required by applicable law or "
         "agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
         "conditions of any kind either express or implied",
    114: "you may obtain a copy of the license at https www apache org licenses license 2 0",
    201: "released under the mit license",
    202: "licensed under the mit license",
    203: "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
         "documentation files the software to deal in the software without restriction including without limitation the "
         "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
         "persons to whom the software is furnished to do so subject to the following conditions",
    204: "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
         "the software",
    205: "the software is provided as is without warranty of any kind express or implied including but not limited to the "
         "warranties of merchantability fitness for a particular purpose and noninfringement",
    206: "spdx license identifier mit",
    207: "mit",
    301: "this work is licensed under the gnu general public license version 3",
    302: "this work is licensed under the gnu general public license version 2",
    303: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
         "license as published by the free software foundation either version 3 of the license or at your option any "
         "later version",
    304: "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
         "license as published by the free software foundation either version 2 of the license or at your option any "
         "later version",
    305: "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
         "warranty of merchantability or fitness for a particular purpose",
    306: "see the gnu general public license for more details",
    307: "spdx license identifier gpl 3 0 only",
    308: "spdx license identifier gpl 3 0 or later",
    309: "spdx license identifier gpl 2 0 only",
    310: "gpl 3 0 only",
    311: "gpl 3 0 or later",
    312: "gpl 2 0 only",
    313: "this program is free software",
    314: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
         "software foundation either version 3 of the license or at your option any later version",
    315: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
         "software foundation either version 2 of the license or at your option any later version",
    316: "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
         "software foundation",
    317: "either version 3 of the license or at your option any later version",
    318: "either version 2 of the license or at your option any later version",
    319: "this program is distributed in the hope that it will be useful but without any warranty",
    320: "without even the implied warranty of merchantability or fitness for a particular purpose",
    401: "licensed under cc by nc 4 0",
    402: "licensed under cc by 4 0",
    403: "licensed under cc by sa 4 0",
    404: "this work is licensed under a creative commons attribution 4 0 international license",
    405: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    406: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    407: "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    501: "redistribution and use in source and binary forms with or without modification are permitted provided that the "
         "following conditions are met",
    502: "redistributions of source code must retain the above copyright notice this list of conditions and the following "
         "disclaimer",
    503: "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
         "disclaimer in the documentation and or other materials provided with the distribution",
    504: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
         "products derived from this software without specific prior written permission",
    601: "this source code form is subject to the terms of the mozilla public license v 2 0",
    602: "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    603: "this source code form is subject to the terms of the mozilla public license v",
    604: "2 0",
    605: "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    701: "this is free and unencumbered software released into the public domain",
    801: "spdx license identifier",
}

# Ordered rules, each the licence it stands for (SPDX identifier) and its sentences.
RULES = [
    ("Apache-2.0", [101]),
    ("Apache-2.0", [107]),
    ("Apache-2.0", [801, 108]),
    ("Apache-2.0", [102, 103, 104, 105, 106]),
    ("Apache-2.0", [102, 103, 114, 105, 106]),
    ("Apache-2.0", [102, 103, 109, 110, 105, 106]),
    ("Apache-2.0", [102, 103, 109, 111, 105, 106]),
    ("Apache-2.0", [102, 103, 112, 106]),
    ("Apache-2.0", [102, 103, 113, 106]),
    ("Apache-2.0", [102, 103]),
    ("MIT", [201]),
    ("MIT", [202]),
    ("MIT", [206]),
    ("MIT", [801, 207]),
    ("MIT", [203, 204, 205]),
    ("GPL-3.0-only", [301]),
    ("GPL-3.0-only", [307]),
    ("GPL-3.0-only", [801, 310]),
    ("GPL-2.0-only", [302]),
    ("GPL-2.0-only", [309]),
    ("GPL-2.0-only", [801, 312]),
    ("GPL-3.0-or-later", [308]),
    ("GPL-3.0-or-later", [801, 311]),
    ("GPL-3.0-or-later", [303, 305, 306]),
    ("GPL-3.0-or-later", [313, 314, 319, 320, 306]),
    ("GPL-3.0-or-later", [313, 316, 317, 319, 320, 306]),
    ("GPL-2.0-or-later", [304, 305, 306]),
    ("GPL-2.0-or-later", [313, 315, 319, 320, 306]),
    ("GPL-2.0-or-later", [313, 316, 318, 319, 320, 306]),
    ("CC-BY-NC-4.0", [401]),
    ("CC-BY-NC-4.0", [405]),
    ("CC-BY-4.0", [402]),
    ("CC-BY-4.0", [404]),
    ("CC-BY-SA-4.0", [403]),
    ("CC-BY-SA-4.0", [406]),
    ("CC0-1.0", [407]),
    ("BSD-2-Clause", [501, 502, 503]),
    ("BSD-3-Clause", [501, 502, 503, 504]),
    ("MPL-2.0", [601, 602]),
    ("MPL-2.0", [601]),
    ("MPL-2.0", [603, 604, 602]),
    ("MPL-2.0", [603, 604, 605]),
    ("MPL-2.0", [603, 604]),
    ("Unlicense", [701]),
]

#: Ends of sentences: closing marks before white space or the end, and line breaks or blank lines.
BY_LINE = r"[.!?:;]+([ \t\r\n\f]+|$)|[\r\n]+"
BY_PARAGRAPH = r"[.!?:;]+([ \t\r\n\f]+|$)|\r?\n[ \t]*\r?\n[ \t\r\n\f]*"
NOT_WORD = r"[^a-z0-9\x1e]+"


@dataclass(frozen=True)
class Rule:
    licence: str
    sentences: tuple[int, ...]

    @property
    def pattern(self) -> str:
        return "".join(f"<{s}>" for s in self.sentences)


def marker_words(sentences: dict[int, str]) -> list[str]:
    """Long words of which every sentence holds at least one: a text without any of them holds no sentence."""
    left, chosen = list(sentences.values()), []
    while left:
        words = {w for s in left for w in s.split() if len(w) >= min(7, max(map(len, s.split())))}
        best = max(sorted(words), key=lambda w: sum(w in s for s in left))
        chosen.append(best)
        left = [s for s in left if best not in s]
    return chosen


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sentence_ids(text: Column, ends: str, sentences: dict[int, str] = SENTENCES) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    names = F.array(*[F.lit(s) for s in sentences.values()])
    ids = F.array(*[F.lit(i) for i in sentences])

    def recognised(low: Column) -> Column:
        marked = F.regexp_replace(F.regexp_replace(low, ends, "\x1e"), NOT_WORD, " ")
        at = F.transform(F.split(marked, "\x1e"), lambda s: F.array_position(names, F.trim(s)))
        return F.transform(F.filter(at, lambda k: k > 0), lambda k: F.element_at(ids, k.cast("int")))

    maybe = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in marker_words(sentences)])
    return F.when(maybe, _bound(lowered, recognised)).otherwise(F.array().cast("array<int>"))


def _times(sequence: Column, pattern: str) -> Column:
    return (F.length(sequence) - F.length(F.replace(sequence, F.lit(pattern), F.lit("")))) / len(pattern)


def matched(ids: Column, rules: list[tuple[str, list[int]]] = RULES) -> Column:
    """Licences of the rules that match a sequence of identifiers, shorter rules within longer ones left out."""
    own = [Rule(name, tuple(s)) for name, s in rules]

    def licences(sequence: Column) -> Column:
        found = []
        for rule in own:
            here = F.contains(sequence, F.lit(rule.pattern))
            for other in own:
                if other.licence != rule.licence and len(other.pattern) > len(rule.pattern) and rule.pattern in other.pattern:
                    here = here & (_times(sequence, rule.pattern) > _times(sequence, other.pattern))
            found.append(F.when(here, F.lit(rule.licence)))
        return F.array_distinct(F.array_compact(F.array(*found)))

    sequence = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i.cast("string"), F.lit(">"))), "")
    return F.when(F.size(ids) == 0, F.array().cast("array<string>")).otherwise(_bound(sequence, licences))


def scan(docs: DataFrame, into: str = "licences", ids_into: str = "licence_sentences", text_col: str = "text") -> DataFrame:
    """``docs`` with the sorted licences of each text and the sentence identifiers they were found by.

    The identifiers are those of the line-wise cut; licences come from both
    cuts. A result whose name a column of ``docs`` has gets underscores in front.
    """
    into, ids_into = fresh(docs, into), fresh(docs, ids_into)
    text = F.col(text_col)
    both = F.array(sentence_ids(text, BY_LINE), sentence_ids(text, BY_PARAGRAPH))
    found = _bound(both, lambda cuts: F.struct(F.element_at(cuts, 1).alias("ids"), F.array_sort(
        F.array_union(matched(F.element_at(cuts, 1)), matched(F.element_at(cuts, 2)))).alias("licences")))
    held = fresh(docs, "licence_scan")
    return docs.withColumn(held, found).select(*docs.columns, F.col(held)["ids"].alias(ids_into), F.col(held)["licences"].alias(into))


def duckdb_sql(table: str = "documents", sentences: dict[int, str] = SENTENCES, rules: list[tuple[str, list[int]]] = RULES) -> str:
    """The scan in DuckDB SQL, licences and identifiers joined by commas."""
    names = "[" + ", ".join(f"'{s}'" for s in sentences.values()) + "]"
    ids = "[" + ", ".join(map(str, sentences)) + "]"
    own = [Rule(name, tuple(s)) for name, s in rules]

    def cut(ends: str) -> str:
        marked = f"regexp_replace(regexp_replace(lower(coalesce(text, '')), '{ends}', chr(30), 'g'), '{NOT_WORD}', ' ', 'g')"
        parts = f"[list_position({names}, trim(s)) FOR s IN string_split({marked}, chr(30))]"
        return f"[{ids}[p] FOR p IN {parts} IF p > 0]"

    def times(sequence: str, pattern: str) -> str:
        return f"(length({sequence}) - length(replace({sequence}, '{pattern}', ''))) / {len(pattern)}"

    def hits(sequence: str) -> list[str]:
        out = []
        for rule in own:
            tests = [f"contains({sequence}, '{rule.pattern}')"]
            tests += [f"{times(sequence, rule.pattern)} > {times(sequence, other.pattern)}" for other in own
                      if other.licence != rule.licence and len(other.pattern) > len(rule.pattern) and rule.pattern in other.pattern]
            out.append(f"CASE WHEN {' AND '.join(tests)} THEN '{rule.licence}' END")
        return out

    either = ", ".join(hits("line_seq") + hits("paragraph_seq"))
    return f"""
WITH cuts AS (SELECT doc_id, {cut(BY_LINE)} AS line_ids, {cut(BY_PARAGRAPH)} AS paragraph_ids FROM {table}),
sequences AS (
  SELECT doc_id, line_ids, concat('', array_to_string(['<' || i || '>' FOR i IN line_ids], '')) AS line_seq,
         concat('', array_to_string(['<' || i || '>' FOR i IN paragraph_ids], '')) AS paragraph_seq FROM cuts),
matches AS (SELECT doc_id, line_ids, list_sort(list_distinct([x FOR x IN [{either}] IF x IS NOT NULL])) AS found FROM sequences)
SELECT doc_id, concat('', array_to_string(found, ',')) AS licences, concat('', array_to_string(line_ids, ',')) AS licence_sentences,
       len(found)::BIGINT AS n_licences
FROM matches"""
