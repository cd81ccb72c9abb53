import json
import random

import pytest

from vetline.llm import chat, queries

TOOLS = {"f": {"type": "object", "required": ["x"], "additionalProperties": False,
               "properties": {"x": {"type": ["integer", "null"], "minimum": 0}, "s": {"type": "string", "maxLength": 3, "pattern": "^a"},
                              "l": {"type": "array", "items": {"enum": [1, "b"]}, "maxItems": 2}}}}


def frames(spark, calls, results):
    return (spark.createDataFrame([(*c, "extra") for c in calls], "conv_id long, turn long, call_id string, name string, arguments string, wave string"),
            spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"))


class TestValues:
    def test_canonical(self):
        assert chat.canonical({"b": [1.0, 1e30, 0.5, True, None], "a": "é\n", "\U0001f600": 1, "￿": 2}) == \
            '{"a":"é\\n","b":[1,1e+30,0.5,true,null],"\U0001f600":1,"￿":2}'
        deep = json.loads("[" * 500 + "]" * 500)
        assert chat.canonical(deep) == "[" * 500 + "]" * 500

    def test_violations(self):
        check = lambda v: chat.violations(v, TOOLS["f"])
        assert check({"x": 3, "s": "abc", "l": [1, "b"]}) == [] and check({"x": None}) == []
        assert check([]) == ["$: type"] and check({}) == ["$.x: required"]
        assert check({"x": -1, "y": 0, "s": "bcde", "l": [1, 2, 1.0]}) == [
            "$.l: maxItems", "$.l[1]: enum", "$.s: maxLength", "$.s: pattern", "$.x: minimum", "$.y: additionalProperties"]
        assert check({"x": {"$ref": "c"}}) == [] and check({"x": True}) == ["$.x: type"]


    def test_what_has_no_canonical_form(self):
        for text in ('{"x":"\\ud800"}', '{"\\udfff":1}', '{"x":NaN}', '{"x":-Infinity}', '{"x":1e999}', "", "[" * 9000, None):
            got = chat.read_arguments("f", text, TOOLS)
            assert got == {"json": chat.canonical(text), "needs": [], "errors": ["$: json"]}
        assert chat.read_arguments("f", '{"x":1,"s":"a\\ud83d\\ude00"}', TOOLS)["json"] == '{"s":"a\U0001f600","x":1}'

    def test_only_strings_refer(self):
        for odd in ("5", "null", '["a"]', '{"$ref":"a"}'):
            got = chat.read_arguments("f", '{"x":{"$ref":%s}}' % odd, TOOLS)
            assert got["errors"] == ["$.x: type"] and got["needs"] == (["a"] if "a\"}" in odd else [])
        assert chat.read_arguments("f", '{"x":{"$ref":"a"}}', TOOLS)["errors"] == []

    @pytest.mark.parametrize("schema", [{"anyOf": []}, {"exclusiveMinimum": 1}, {"properties": {"a": {"multipleOf": 2}}}, {"items": [{}]},
                                        {"items": {"type": "text"}}, {"additionalProperties": {"not": {}}}, {"pattern": "("}, True])
    def test_schemas_that_would_not_be_checked_are_refused(self, spark, schema):
        with pytest.raises(ValueError, match="g.*(unknown|pattern|object)"):
            chat.link(*frames(spark, [], []), {**TOOLS, "g": schema})


class TestOrder:
    def by_place(self, rows):
        return [r.call_id for r in sorted(rows, key=lambda r: (r.wave, r.turn is not None, r.turn or 0, r.call_id))]

    def test_null_turns_come_first_or_in_a_later_wave(self, spark):
        ref = lambda i: json.dumps({"x": {"$ref": i}})
        calls = [(1, None, "a", "f", ref("b")), (1, 5, "b", "f", '{"x":1}'), (2, None, "a", "f", '{"x":1}'), (2, 0, "b", "f", ref("a")),
                 (3, None, "b", "f", ref("a")), (3, None, "a", "f", '{"x":1}'), (4, 0, "a", "f", ref("b")), (4, None, "b", "f", '{"x":1}')]
        got = chat.link(*frames(spark, calls, []), TOOLS).collect()
        order = {c: self.by_place([r for r in got if r.conv_id == c]) for c in (1, 2, 3, 4)}
        assert order == {1: ["b", "a"], 2: ["a", "b"], 3: ["a", "b"], 4: ["b", "a"]}
        assert {r.wave for r in got if r.conv_id in (2, 3, 4)} == {0}

    @pytest.mark.parametrize("peeled", [0, 100_000])
    def test_in_tasks_and_in_rounds(self, spark, peeled):
        rng = random.Random(6)
        names = [f"c{k}" for k in range(9)]
        needs = {(conv, n): sorted(rng.sample(names, rng.choice([0, 0, 1, 2]))) for conv in range(12) for n in names}
        rows = [(conv, k, n, [*needs[conv, n], "nowhere"]) for conv in range(12) for k, n in enumerate(names)]
        calls = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, needs array<string>")
        got = {(r.conv_id, r.call_id): r.wave for r in chat.waves(calls, peeled).collect()}
        want = {}
        for conv in range(12):
            if all(names.index(m) < k for k, n in enumerate(names) for m in needs[conv, n]):
                want |= {(conv, n): 0 for n in names}
                continue
            left, wave = set(names), 0
            while ready := {n for n in left if not left & set(needs[conv, n])}:
                want |= {(conv, n): wave for n in ready}
                left, wave = left - ready, wave + 1
            want |= {(conv, n): None for n in left}
        assert got == want

    def test_a_chain_of_a_thousand_calls_takes_few_jobs(self, spark):
        rows = [(1, k, f"c{k:04}", [f"c{k + 1:04}"] if k < 999 else []) for k in range(1000)]
        calls = spark.createDataFrame(rows, "conv_id long, turn long, call_id string, needs array<string>")
        spark.sparkContext.setJobGroup("chain", "chain")
        try:
            assert {r.call_id: r.wave for r in chat.waves(calls).collect()} == {f"c{k:04}": 999 - k for k in range(1000)}
            assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain")) < 30
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    def test_long_texts_pass_whole(self, spark):
        text = "word " * 400_000
        calls, results = frames(spark, [(1, 0, "a", "f", json.dumps({"x": 1, "s": text}))], [(1, 1, "a", text)])
        got = chat.link(calls, results, TOOLS).first()
        assert json.loads(got.message) == {"arguments": {"s": text, "x": 1}, "call_id": "a", "content": text, "name": "f"}


class TestLink:
    def test_status_order_and_errors(self, spark):
        ref = lambda *ids: json.dumps({"x": 1, "l": [{"$ref": i} for i in ids]})
        calls = [(1, 0, "a", "f", '{"x": 1.0}'), (1, 0, "a", "f", '{"x": 2}'), (1, 2, "b", "f", ref("a")), (1, 4, "c", "g", "{"),
                 (2, 0, "a", "f", ref("b")), (2, 1, "b", "f", ref("c")), (2, 2, "c", "f", '{"x":null}'),
                 (3, 0, "a", "f", ref("b")), (3, 1, "b", "f", ref("a")), (3, 2, "c", "f", ref("b")), (3, 3, "d", "f", '{"x":0}'),
                 (4, 0, "a", "f", ref("nowhere")), (4, 1, "b", "f", None), (None, 0, "z", "f", "{}"), (5, 0, None, "f", "{}")]
        results = [(1, 1, "a", "r1"), (1, 3, "a", "r2"), (1, 3, "b", None), (9, 0, "q", "late \"quote\""), (9, None, None, "gone")]
        got = {(r.conv_id, r.call_id): r for r in chat.link(*frames(spark, calls, results), TOOLS).collect()}
        assert len(got) == 13
        a = got[1, "a"]
        assert (a.status, a.calls, a.results, a.wave) == ("linked", 2, 2, 0)
        assert a.message == '{"arguments":{"x":1},"call_id":"a","content":"r1","name":"f"}'
        assert got[1, "b"].status == "linked" and got[1, "b"].errors == [] and got[1, "c"].errors == ["$: json"]
        assert [got[2, c].wave for c in "abc"] == [2, 1, 0]
        assert [got[3, c].wave for c in "abcd"] == [None, None, None, 0]
        assert got[4, "a"].errors == ["$ref: nowhere"] and got[4, "a"].status == "unanswered"
        assert got[9, "q"].status == "orphan" and json.loads(got[9, "q"].message)["content"] == "late \"quote\""
        assert all(chat.canonical(json.loads(r.message)) == r.message for r in got.values())

    def test_empty(self, spark):
        assert chat.link(*frames(spark, [], []), TOOLS).count() == 0

    def test_query_against_brute_force(self, spark):
        rows = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect()
        got = {(r.conv_id, r.call_id): r for r in queries.QUERIES["op1_chat_formatting"](spark, "/root/testdata/sf0.01").collect()}
        user = {(r.conv_id, r.turn): r.text for r in rows if r.role == "user"}
        answer = {(r.conv_id, r.turn - 1): r.text for r in rows if r.role == "assistant"}
        assert set(got) == {(c, f"call_{c}_{t}") for c, t in {*user, *answer}}
        for (c, t), text in user.items():
            r = got[c, f"call_{c}_{t}"]
            arguments = {"question": text, "turn": t} | ({"after": {"$ref": f"call_{c}_{t - 2}"}} if t >= 2 else {})
            assert json.loads(r.message) == {"arguments": arguments, "call_id": f"call_{c}_{t}", "content": answer.get((c, t)), "name": "answer"}
            want = ["$.question: " + ("minLength" if len(text) < 8 else "maxLength")] if not 8 <= len(text) <= 400 else []
            assert r.errors == "; ".join(want + ([f"$ref: call_{c}_{t - 2}"] if t >= 2 and (c, t - 2) not in user else []))
            assert r.status == ("linked" if (c, t) in answer else "unanswered")
