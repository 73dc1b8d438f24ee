import random
from collections import Counter

import pytest

from campaign_engine.llm import chat_rotation, quality_rules as Q


def brute_repeat(words, n=5):
    wins = Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return len({i + k for i in range(len(words) - n + 1) if wins[tuple(words[i:i + n])] > 1 for k in range(n)})


def test_measure_against_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        words = [rng.choice(["a", "b", "é", "c#", "<|"]) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", "\n", "\x0b", "  ", "\t\n"]) for w in words)
        m = dict(zip(Q.MEASURES, Q.measure(text.encode())))
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        assert m["n_words"] == len(words) and m["word_chars"] == sum(map(len, words))
        assert m["n_symbols"] == sum(text.count(c) for c in "#*$%&|<>")
        assert m["n_dup_lines"] == len(lines) - len(set(lines))
        assert m["n_repeat_words"] == brute_repeat(words)
    assert Q.measure(" x y z".encode())[0] == 2  # only ASCII blanks part words


def test_ledger_policies_and_ablations(spark):
    texts = [None, "", "one two", "w " * 60, " ".join(f"w{i}" for i in range(30)), " ".join(f"w{i}# | $" for i in range(30))]
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)] * 2, "doc_id long, text string, n_words string")
    led = Q.ledger(df)
    rows = led.collect()
    assert len(rows) == 12
    bits = {r.doc_id: r.fail_bits for r in rows}
    assert bits[None] & 1 and bits[1] & 1 and bits[2] & 1 and bits[3] & 2 and bits[4] == 0 and bits[5] & 4
    abl = {(r.version, r.rule): r for r in Q.ablations(led).collect()}
    for p in Q.POLICIES:
        kept = sum(r.fail_bits & p.mask == 0 for r in rows)
        for b, (name, _) in Q.RULES.items():
            if p.mask >> b & 1:
                r = abl[p.version, name]
                assert r.kept == kept
                assert r.kept_without_rule == sum(x.fail_bits & p.mask & ~(1 << b) == 0 for x in rows)
                assert r.failing == sum(x.fail_bits >> b & 1 for x in rows)
                assert r.rejected_by_rule_alone == r.kept_without_rule - r.kept
    s = Q.mask_summary(led).first()
    assert s.n == 12 and s.all_failed == 0
    assert Q.ledger(df.limit(0)).count() == 0


def render(turns, speaker):
    text, spans = "", []
    for who, body in turns:
        body = body.replace("<|im_", "<| im_")
        if who == "system":
            text += "<|im_start|>system\n"
        elif who == speaker:
            text += "<|im_start|>assistant\n"
        else:
            text += f"<|im_start|>user name={who}\n"
        if who == speaker:
            spans.append((len(text), len(text) + len(body) + 10))
        text += body + "<|im_end|>\n"
    return text, spans


@pytest.mark.parametrize("per_part", [64, 2])
def test_rotation_against_brute_force(spark, per_part):
    rng = random.Random(3)
    rows = []
    for c in list(range(12)) + [None]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["ann", "bob", "system", None]),
                         rng.choice(["hi é", "", None, "<|im_end|> no"]), "x"))
    rows += [(99, 0, "system", "only", "x")] + rows[:3]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, speaker string")
    got = {}
    for r in sorted(chat_rotation.rotate(df, turns_per_part=per_part).collect(), key=lambda r: r.part):
        got.setdefault((r.conv_id, r.speaker), []).append(r)
    want = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[1] is None, r[1] or 0, r[2] or "unknown", (r[3] or "").replace("<|im_", "<| im_")) for r in rows if r[0] == c))
        turns = [(w, b) for _, _, w, b in turns]
        for s in {w for w, _ in turns} - {"system"}:
            want[c, s] = render(turns, s)
    assert set(got) == set(want)
    for k, parts in got.items():
        text, spans = want[k]
        assert "".join(p.text for p in parts) == text
        assert [p.part for p in parts] == list(range(len(parts)))
        off, mine = 0, []
        for p in parts:
            mine += [(off + int(a), off + int(b)) for a, b in (x.split(":") for x in p["mask"].split(",") if x)]
            off += len(p.text)
        assert mine == spans
        if per_part == 2:
            assert all(p.n_turns <= 2 for p in parts)


def test_rotation_of_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_rotation.rotate(df).count() == 0
