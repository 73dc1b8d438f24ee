import random
import re

from campaign_engine.llm import pii_crf as P


def brute(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_rules_against_plain_patterns():
    rng = random.Random(11)
    bits = ["a@b.c", "_x.y@m-1.org", "@", ".", "12", "255.1.2.3", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
            "4111111111111111", "-", " ", "+1 (906) 555-7738", "+", "(", ")", "é", "٣", "a", "000001.2.3.4", "\n", "a.b@c"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_stay_linear():
    for text in ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + "(" * 300_000, "a@" * 100_000, "1 " * 200_000,
                 "a at " * 60_000]:
        P.base_spans(text)
    crf = P.Crf()
    for text in ["12 " * 20_000, "a at b " * 5_000, "1" * 100_000]:
        P.find(crf, text)


def test_decode_is_the_best_segmentation():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 6)
        segs = [(i, j, k, [f"s{i}{j}{k}"]) for i in range(n) for j in range(i, n) for k in (0, 2) if rng.random() < 0.5]
        crf = P.Crf({f"s{i}{j}{k}": rng.uniform(-2, 2) for i in range(n) for j in range(n) for k in (0, 2)}
                    | {f"step:{a}>{b}": rng.uniform(-1, 1) for a in (-1, 0, 2) for b in (-1, 0, 2)})
        by = {}
        for s in segs:
            by.setdefault(s[0], []).append(s)
        paths = []

        def walk(at, label, score, chosen):
            if at == n:
                paths.append((score, chosen))
                return
            walk(at + 1, -1, score + crf._trans(label, -1), chosen)
            for i, j, k, f in by.get(at, []):
                walk(j + 1, k, score + crf._trans(label, k) + crf.score(f), chosen + [(i, j, k)])

        walk(0, -1, 0.0, [])
        best = max(p[0] for p in paths)
        got = crf.decode(n, segs)
        assert any(abs(s - best) < 1e-9 and c == got for s, c in paths)
        import math
        z, seg, _ = crf.expectations(n, segs)
        assert abs(z - math.log(sum(math.exp(s) for s, _ in paths))) < 1e-9
        for s, p in zip(segs, seg):
            assert abs(p - sum(math.exp(x - z) for x, c in paths if s[:3] in c)) < 1e-9


def test_held_out_accuracy_and_added_spans(spark):
    crf = P.train()
    tp = fp = fn = 0
    for n, segs, gold in P.examples(["and so it was then of them"], lines=200, seed=99):
        got = set(crf.decode(n, segs))
        tp, fp, fn = tp + len(got & gold), fp + len(got - gold), fn + len(gold - got)
    assert tp / (tp + fp) > 0.95 and tp / (tp + fn) > 0.95
    text = "ask jo.doe (at) mail (dot) org or +1 (269) 555-3296 4524132264652876 on 2024-05-17, 1.2.3.4 too"
    base, spans = P.find(crf, text)
    assert set(base) <= set(spans) and [k for _, k, _ in base] == [1]
    assert P.redact(text, spans) == "ask [EMAIL] or [PHONE] [CARD] on 2024-05-17, [IP] too"
    rows = [(1, text), (None, None), (2, ""), (2, ""), (3, "no data here at all 12"), (4, "é 1.2.3.4 a@b.c")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    got = P.detect(df, crf).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[4].base == "ip:2:9,email:10:15" and by[4].spans == by[4].base
    assert by[None].spans == "" and by[3].spans == "" and by[1].n_added == 3 and by[1].n_ip == 1
    assert P.detect(df.limit(0), crf).count() == 0


def test_digits_one_by_one_are_found():
    crf = P.train()
    for text, want in [("the host is 8 . 8 . 8 . 8 now", (12, 1, 25)), ("call 5 5 5 . 1 2 3 . 4 5 6 7 today", (5, 3, 28))]:
        assert want in P.find(crf, text)[1], (text, P.find(crf, text))


def test_islands_hold_every_candidate():
    rng = random.Random(3)
    bits = ["8", " . ", "12", "word", " ", "  ", "jo", " at ", " dot ", "(at)", "com", "-", "+", "\n", "é", "@", "a" * 200, "/", "."]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 120)))
        every = {(p[i][0], k, p[j][1]) for p, segs in [P.candidates(text, 0, len(text))] for i, j, k, _ in segs}
        inside = {(p[i][0], k, p[j][1]) for lo, hi in P.islands(text) for p, segs in [P.candidates(text, lo, hi)] for i, j, k, _ in segs}
        assert every == inside, text


def test_contexts_come_from_the_whole_text():
    text = " ".join(f"w{i} and {i % 10} {i % 7}" for i in range(20000))
    pool, plain = P.contexts_of(text, "seed", 10, 5)
    at = [text.index(x) for x in pool]
    assert len(pool) == 10 and max(at) > len(text) / 2 and pool == P.contexts_of(text, "seed", 10, 5)[0]
    assert P.contexts_of("", "x") == ([], [])
