import json
import random
from hashlib import sha256

import pytest

from sparktree.llm.chat import PROBE_TEXT, Template, digests, format_conversation, format_conversations, spans_by_prefixes

TEXTS = ["", "plain", "\\### Assistant: </turn> ok", "<turn assistant>\n", "\\", "\\\\<", "a\\", ">", "</turn>\n<turn user>\n", "é ü\n\n", "\r\n", "<|im_end|>"]


def test_spans_are_found_without_knowing_the_template():
    rnd = random.Random(1)
    for n in (0, 1, 2, 63, 64, 65, 200):
        turns = [(rnd.choice(("user", "assistant", "system", "a<b>\\")), rnd.choice(TEXTS)) for _ in range(n)]
        for stretch in (1, 2, 64, 1000):
            output, mask, rewrites = format_conversation(turns, stretch=stretch)
            assert rewrites is None and output == Template().render(turns)
            assert [Template.unescape(output[a:b]) for a, b in mask] == [t for r, t in turns if r == "assistant"]


def test_templates_that_rewrite_history_are_told():
    strips = lambda turns: "".join(f"{r}:{t if k == len(turns) - 1 else t.split('|')[-1]};" for k, (r, t) in enumerate(turns))
    turns = [("user", "q"), ("assistant", "thought|answer"), ("user", "next"), ("assistant", "x")]
    assert spans_by_prefixes(strips, turns).rewrites == 2
    counts = lambda turns: f"{len(turns)} " + "".join(t for _, t in turns)
    assert spans_by_prefixes(counts, turns).rewrites == 1 and spans_by_prefixes(counts, turns).spans == []


def test_templates_that_look_further_back_than_a_stretch():
    turns = [("assistant" if k % 2 else "user", f"t{k}") for k in range(150)]
    numbers = lambda turns: "".join(f"[{k // 2}] {r}: {t}\n" for k, (r, t) in enumerate(turns))
    f = spans_by_prefixes(numbers, turns)
    assert f.rewrites is None and f.output == numbers(turns)
    assert [f.output[a:b] for a, b in f.spans] == [f"[{k // 2}] {r}: {t}\n" for k, (r, t) in enumerate(turns)]
    truncates = lambda turns: "".join(f"{r}: {t}\n" for r, t in turns[-100:])
    f = spans_by_prefixes(truncates, turns)
    assert f.rewrites == 100 and f.spans == [] and f.output == truncates(turns)

    def user_first(turns):
        if turns and turns[0][0] != "user":
            raise ValueError("a conversation starts with its user")
        return "".join(f"{r}: {t}\n" for r, t in turns)

    f = spans_by_prefixes(user_first, turns)
    assert f.rewrites is None and f.output == user_first(turns) and len(f.spans) == 150


def test_a_rewriting_that_is_undone_later_is_seen():
    turns = [("assistant" if k % 2 else "user", f"t{k}") for k in range(300)]
    # between 100 and 200 turns the first ones are left out
    hides = lambda turns: "".join(f"{r}: {t}\n" for k, (r, t) in enumerate(turns) if not (100 <= len(turns) < 200 and k < 30))
    f = spans_by_prefixes(hides, turns)
    assert f.rewrites == 99 and f.spans == [] and f.output == hides(turns)


def test_digests_read_by_the_template_itself(spark):
    class Plain:
        """Another template: a line of JSON for each turn."""

        def render(self, turns):
            return "".join(f"{json.dumps(list(t))}\n" for t in turns)

        def unescape(self, text):
            return json.loads(f'"{text}"')

        def read(self, output):
            return [tuple(json.loads(x)) for x in output.splitlines()]

        def find(self, output, span):
            role, text = json.loads(output[slice(*span)])
            return role, (span[1] - 3 - len(json.dumps(text)) + 2, span[1] - 3)

    rows = [(1, 0, "user", "a \"quote\" \\ é\n"), (1, 1, "assistant", "b \"quote\" \\ é\n"), (1, 2, "assistant", "")]
    got = digests(format_conversations(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), Plain(), probe=False), Plain()).collect()[0]
    assert tuple(got[1:5]) == digest([r[2:] for r in rows])


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    h = lambda s: sha256(s.encode()).hexdigest()
    return len(turns), h("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), h(loss)


@pytest.mark.parametrize("probe", [True, False])
def test_round_trip(spark, probe):
    rows = [(k, t, r, x, 0) for k in range(6) for t, (r, x) in enumerate((("system", "s"), ("user", TEXTS[k]), ("assistant", TEXTS[-k - 1])))]
    rows += [(50, 1, None, None, 0), (50, 0, "assistant", None, 0), (51, None, "user", "first", 0), (51, 0, "assistant", "b", 0), (51, 0, "assistant", "a", 0), (None, 3, "user", "x", 0), (52, 0, "user", "twice", 0), (52, 0, "user", "twice", 0)]
    rows += [(53, t, "user" if t % 2 else "assistant", f"<{t}>", 0) for t in range(300)]
    d = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, turns int").repartition(4)
    got = {r["conv_id"]: r for r in digests(format_conversations(d, probe=probe)).collect()}
    want = {}
    for c in {r[0] for r in rows}:
        held = sorted((r for r in rows if r[0] == c), key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or ""))
        want[c] = [(r[2] or "", r[3] or "") for r in held]
    if probe:
        want[-7] = [("user", PROBE_TEXT), ("assistant", PROBE_TEXT)]
    assert set(got) == set(want)
    for c, turns in want.items():
        assert tuple(got[c][1:5]) == digest(turns) and got[c]["formatted_chars"] == len(Template().render(turns)) and got[c]["rewrites_at"] is None
    assert digests(format_conversations(d.limit(0), probe=probe)).count() == int(probe)
