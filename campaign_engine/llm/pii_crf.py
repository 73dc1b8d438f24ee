"""Personal data: exact base rules plus a semi-Markov conditional random field.

The base rules find e-mail addresses, IPv4 addresses, card numbers and phone
numbers. The CRF adds spellings that they miss (``jo (at) mail (dot) org``, a
phone number without a plus, a dotted card). It scores whole candidate spans,
and dynamic programming over entities of bounded length chooses boundaries
and types jointly. It is trained here, on entities written into contexts from
a bounded sample of documents, by the conditional log-likelihood.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_right
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, hash_sample, ship_package

KINDS = ("email", "ip", "card", "phone")
MAX_PIECES = 24  # pieces (words, digit runs, punctuation marks) in one entity
SAMPLE_DOCS = 300  # bound on the documents that lend contexts for training,
PHRASES, PLAIN = 40, 20  # and on what each of them lends: runs of words, islands as they are
TRAIN_LINES, ROUNDS, RATE = 900, 8, 0.4

# ------------------------------------------------------------------ base rules
#: fixed values: the base patterns, in forms that never scan a run twice
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_END = re.compile(r"[^A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 3 or len(s) == 3 and int(s) <= 255


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            lo = at
            while lo > done and not _LOCAL_END.match(text, lo - 1):
                lo -= 1
            if lo < at:
                yield lo, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base rules, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGITS.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_octet, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                d = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(d) <= 19 and luhn(d):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return sorted(out)


# ------------------------------------------------------------- pieces, islands
_PIECE = re.compile(r"[0-9]+|[^\W\d_]+|[^\w\s]|_|\d+")
# every entity holds an @, a spelled-out at or dot, or two digits with at most three marks or blanks between them
_ANCHOR = re.compile(r"[0-9](?:[^\w]|_){0,3}[0-9]+|[(\[{]\s?(?:at|dot)\s?[)\]}]|@|\s(?:at|dot)\s(?=\S+\s(?:dot)\s)", re.I)
_REACH = MAX_PIECES + 3  # pieces on both sides of an anchor: a longest entity and the words that cue it


def _before(text: str, at: int, floor: int) -> int:
    """Start of the ``_REACH``-th piece before ``at``, or ``floor`` if there are fewer."""
    chars = 128
    while True:
        lo = max(floor, at - chars)
        while lo > floor and (text[lo - 1].isalnum() and text[lo].isalnum()):
            lo = max(floor, lo - 64)  # not inside a word
        starts = [m.start() for m in _PIECE.finditer(text, lo, at)]
        if lo == floor or len(starts) > _REACH:
            return starts[-_REACH] if len(starts) > _REACH else floor
        chars *= 4


def _after(text: str, at: int) -> int:
    """End of the ``_REACH``-th piece from ``at`` on, or of the text."""
    for n, m in enumerate(_PIECE.finditer(text, at), 1):
        if n == _REACH:
            return m.end()
    return len(text)


def islands(text: str):
    """Windows of the text outside of which nothing can be an entity: ``_REACH`` pieces to both
    sides of every anchor, merged where they meet."""
    lo = hi = None
    for m in _ANCHOR.finditer(text):
        if hi == len(text):
            break
        a, b = _before(text, m.start(), 0 if hi is None else min(hi, m.start())), _after(text, m.end())
        if hi is None or a > hi:
            if hi is not None:
                yield lo, hi
            lo, hi = a, b
        else:
            hi = max(hi, b)
    if hi is not None:
        yield lo, hi


_AT = re.compile(r"^(.*?)(\s?[(\[{]\s?at\s?[)\]}]\s?|\sat\s|\s?@\s?)(.*)$", re.I | re.S)
_DOT = re.compile(r"\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s|\.", re.I)
_LOCAL, _HOST = re.compile(r"[A-Za-z0-9._%+-]+$"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
_NUMERIC = re.compile(r"[+(]?[0-9][0-9 ().\-/+]*$")


def span_features(text: str, start: int, end: int, pieces, i: int, j: int) -> dict[int, list[str]]:
    """Whole-span features of text[start:end] (pieces i..j) per kind index. A kind
    whose basic form the span lacks is left out."""
    s = text[start:end]
    out: dict[int, list[str]] = {}
    left = text[start - 1] if start else " "
    right = text[end] if end < len(text) else " "
    # digits glued to the span by a mark continue a number; a final dot ends a sentence
    tied = (left.isalnum() or left in "+(_=-/." and start > 1 and text[start - 2].isalnum()
            or right.isalnum() or right in "_-/.@=" and end + 1 < len(text) and text[end + 1].isalnum())
    cue = next((text[pieces[k][0]:pieces[k][1]].lower() for k in range(i - 1, max(-1, i - 4), -1)
                if text[pieces[k][0]].isalpha()), "")
    common = [f"tied={tied}", f"cue={cue}" if len(cue) < 12 else "cue=?"]
    if s[0].isalnum() and s[-1].isalpha() and j > i + 2 and (m := _AT.match(s)):
        host = _DOT.sub(".", m[3])
        if _LOCAL.match(_DOT.sub(".", m[1])) and _HOST.match(host) and "@" not in m[3]:
            mark = re.sub(r"\s", "", m[2]).lower()
            local = re.search(r"[\s(\[{]", m[1]) is not None
            out[0] = [*common, f"at={mark}", f"gap={m[2][0].isspace()}", f"labels={min(4, host.count('.'))}",
                      f"dots={'word' if 'dot' in m[3].lower().split() or '(' in m[3] or '[' in m[3] else 'mark'}",
                      f"tld={min(4, len(host.rsplit('.', 1)[1]))}", f"local={local}"]
    if s[-1].isdigit() and (s[0].isdigit() or s[0] in "+(") and _NUMERIC.match(s):
        digits = re.sub(r"\D", "", s)
        if 4 <= len(digits) <= 19:
            groups = [len(g) for g in re.findall(r"[0-9]+", s)]
            marks = "".join(sorted(set(re.sub(r"[0-9]", "", s))))
            shape = "-".join(map(str, groups)) if len(groups) < 6 else "many"
            common += [f"groups={min(6, len(groups))}", f"marks={marks}"]
            if 12 <= len(digits):
                out[2] = [*common, f"luhn={luhn(digits)}", f"shape={shape}", f"n={len(digits)}"]
            if 7 <= len(digits) <= 15:
                out[3] = [*common, f"shape={shape}", f"n={len(digits)}", f"plus={s[0] == '+'}", f"paren={'(' in s}"]
            if len(groups) == 4 and max(groups) <= 3:
                ok = all(int(g) <= 255 for g in re.findall(r"[0-9]+", s))
                out[1] = [*common, f"octets={ok}", f"plain={len(marks) == 1}"]
    return {k: [f"{KINDS[k]}:bias", *(f"{KINDS[k]}:{f}" for f in fs)] for k, fs in out.items()}


def candidates(text: str, lo: int, hi: int, blocked=()) -> tuple[list, list]:
    """Pieces of an island, and its segments (i, j, kind, features), at most
    MAX_PIECES pieces long, that touch no blocked span."""
    pieces = [(m.start(), m.end()) for m in _PIECE.finditer(text, lo, hi)]
    starts = [b[0] for b in blocked]
    out = []
    for i, (s, e) in enumerate(pieces):
        numeric = "0" <= text[s] <= "9" or text[s] in "+("
        if not numeric and not text[s].isalpha():
            continue
        n_digits = 0
        seen_at = False
        for j in range(i, min(len(pieces), i + MAX_PIECES)):
            a, b = pieces[j]
            word = text[a:b]
            if j > i and pieces[j][0] - pieces[j - 1][1] > 1:
                break  # entities hold single blanks only
            seen_at = seen_at or word == "@" or word.lower() == "at"
            n_digits += b - a if "0" <= word[0] <= "9" else 0
            if not seen_at and n_digits > 19:
                break
            if not (word[-1].isalnum()) or not seen_at and n_digits < 4:
                continue
            k = bisect_right(starts, b - 1)
            if k and blocked[k - 1][2] > s:
                continue
            for kind, feats in span_features(text, s, b, pieces, i, j).items():
                out.append((i, j, kind, feats))
    return pieces, out


# ------------------------------------------------------------------------ CRF
class Crf:
    """Semi-Markov CRF: segments score their features; a step between kinds (or
    outside, kind -1) scores a transition weight; outside pieces score 0."""

    def __init__(self, weights=None):
        self.w = defaultdict(float, weights or {})

    def score(self, feats) -> float:
        w = self.w
        return sum(w[f] for f in feats if f in w)

    def _trans(self, a: int, b: int) -> float:
        return self.w.get(f"step:{a}>{b}", 0.0)

    def decode(self, n: int, segments) -> list[tuple[int, int, int]]:
        """Best segmentation of ``n`` pieces: the chosen (i, j, kind)."""
        ends = defaultdict(list)
        for i, j, kind, feats in segments:
            ends[j].append((i, kind, self.score(feats)))
        labels = range(-1, len(KINDS))
        best = [{-1: (0.0, None)}]
        for j in range(n):
            at = {}
            prev = best[j]
            at[-1] = max(((v + self._trans(a, -1), (j, a, None)) for a, (v, _) in prev.items()), key=lambda x: x[0])
            for i, kind, sc in ends.get(j, ()):
                v, back = max(((v + self._trans(a, kind) + sc, (i, a, (i, j, kind))) for a, (v, _) in best[i].items()),
                              key=lambda x: x[0])
                if kind not in at or v > at[kind][0]:
                    at[kind] = (v, back)
            best.append(at)
        out, pos = [], n
        label = max(best[n], key=lambda a: best[n][a][0])
        while pos > 0:
            _, back = best[pos][label]
            if back[2]:
                out.append(back[2])
            pos, label = back[0], back[1]
        assert label in labels
        return out[::-1]

    def expectations(self, n: int, segments):
        """log Z and expected counts of segments and transitions (forward-backward)."""
        by_end, by_start = defaultdict(list), defaultdict(list)
        for k, (i, j, kind, feats) in enumerate(segments):
            sc = self.score(feats)
            by_end[j].append((i, kind, sc, k))
            by_start[i].append((j, kind, sc, k))
        K = len(KINDS) + 1  # label -1 at index 0

        def lse(xs):
            m = max(xs)
            return m if m == -math.inf else m + math.log(sum(math.exp(x - m) for x in xs))

        tr = [[self._trans(a - 1, b - 1) for b in range(K)] for a in range(K)]
        fw = [[-math.inf] * K for _ in range(n + 1)]
        fw[0][0] = 0.0
        for j in range(n):
            fw[j + 1][0] = lse([fw[j][a] + tr[a][0] for a in range(K)])
            acc = defaultdict(list)
            for i, kind, sc, _ in by_end.get(j, ()):
                acc[kind + 1].append(sc + lse([fw[i][a] + tr[a][kind + 1] for a in range(K)]))
            for b, xs in acc.items():
                fw[j + 1][b] = lse(xs)
        bw = [[-math.inf] * K for _ in range(n + 1)]
        bw[n] = [0.0] * K
        for i in range(n - 1, -1, -1):
            for a in range(K):
                xs = [tr[a][0] + bw[i + 1][0]]
                xs += [tr[a][kind + 1] + sc + bw[j + 1][kind + 1] for j, kind, sc, _ in by_start.get(i, ())]
                bw[i][a] = lse(xs)
        z = lse(fw[n])
        seg, step = [0.0] * len(segments), defaultdict(float)
        for i in range(n):
            for a in range(K):
                if fw[i][a] == -math.inf:
                    continue
                step[a - 1, -1] += math.exp(fw[i][a] + tr[a][0] + bw[i + 1][0] - z)
                for j, kind, sc, k in by_start.get(i, ()):
                    p = math.exp(fw[i][a] + tr[a][kind + 1] + sc + bw[j + 1][kind + 1] - z)
                    seg[k] += p
                    step[a - 1, kind] += p
        return z, seg, step

    def fit(self, examples, rounds: int = ROUNDS, rate: float = RATE, ridge: float = 1e-4):
        """Stochastic ascent of the conditional log-likelihood with per-weight rates."""
        size = defaultdict(lambda: 1e-6)
        for _ in range(rounds):
            for n, segments, gold in examples:
                _, seg, step = self.expectations(n, segments)
                grad = defaultdict(float)
                for (i, j, kind, feats), p in zip(segments, seg):
                    d = ((i, j, kind) in gold) - p
                    if abs(d) > 1e-6:
                        for f in feats:
                            grad[f] += d
                at, label = 0, -1
                for i, j, kind in [*sorted(gold), (n, n, None)]:
                    while at < i:
                        grad[f"step:{label}>-1"] += 1
                        at, label = at + 1, -1
                    if kind is not None:
                        grad[f"step:{label}>{kind}"] += 1
                        at, label = j + 1, kind
                for (a, b), p in step.items():
                    grad[f"step:{a}>{b}"] -= p
                for f, g in grad.items():
                    g -= ridge * self.w[f]
                    size[f] += g * g
                    self.w[f] += rate * g / math.sqrt(size[f])
        return self


# ------------------------------------------------------------------- training
def _card(rng: random.Random, ok: bool = True) -> str:
    d = [rng.choice("3456")] + [rng.choice("0123456789") for _ in range(14)]
    last = next(c for c in "0123456789" if luhn("".join(d) + c) == ok)
    return "".join(d) + last


def _entity(rng: random.Random) -> tuple[int | None, str]:
    """An entity (kind, text), or a look-alike (None, text)."""
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    name = lambda: "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8)))
    kind = rng.randrange(9)
    if kind in (0, 1):
        at = rng.choice([" (at) ", " [at] ", "(at)", "[at]", " at ", " @ ", "@"])
        dot = rng.choice([" dot ", " (dot) ", " [dot] ", "(dot)", "[dot]"]) if at != "@" else rng.choice([" (dot) ", "[dot]"])
        if at == " at ":
            dot = " dot "
        return 0, name() + rng.choice(["", num(2), "." + name()]) + at + name() + dot + rng.choice(["com", "org", "net", "de", "fr", "es"])
    if kind == 2:
        sep = rng.choice([" . ", "-", "[.]"])
        top = rng.choice([9, 99, 255, 255])
        text = sep.join(str(rng.randint(0, top)) for _ in range(4))
        return (1, text) if sep == " . " else (None, text)
    if kind == 3:
        c, sep = _card(rng), rng.choice([".", "/"])
        return 2, sep.join(c[i:i + 4] for i in range(0, 16, 4))
    if kind in (4, 5):
        a, b, c = num(3), num(3), num(4)
        if rng.random() < 0.2:  # spelled digit by digit
            return 3, rng.choice([" . ", " - ", " "]).join(" ".join(x) for x in (a, b, c))
        return 3, rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}) {b} {c}", f"00{num(2)} {a} {b} {c}", f"{a}.{b}.{c}"])
    c = _card(rng, False)
    return None, rng.choice([
        f"{rng.randint(1900, 2099)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{num(2)}/{num(2)}/{num(4)}",
        f"{num(2)}:{num(2)}:{num(2)}", f"{num(1)}.{num(1)}.{num(2)}", f"{num(rng.randint(4, 11))}", c,
        ".".join(c[i:i + 4] for i in range(0, 16, 4)), f"{num(3)},{num(3)}.{num(2)}", f"{num(4)}-{num(4)}",
        f"{name()}{num(9)}{name()}", f'"{num(3)}{name()}{num(12)}"', f"{name()} at {name()} {num(3)}",
        f"{num(1)} {num(2)} {num(3)} {num(1)}", f"{rng.randint(300, 999)} . {num(2)} . {num(3)} . {num(2)}",
        f"{num(3)} {num(3)} {num(3)}", f"id {num(8)}-{num(2)}", f"{name()}[{num(2)}]", f"{num(5)} {num(5)}"])


def contexts_of(text: str, seed: str, phrases: int = PHRASES, plain: int = PLAIN) -> tuple[list[str], list[str]]:
    """What a document lends to the training: at most ``phrases`` runs of its words and ``plain`` of its
    islands, both drawn from the whole text."""
    rng, held = random.Random(seed), ([], [])
    runs = (m[0] for m in re.finditer(r"[^\s]+(?:\s[^\s]+){3,9}", text))
    for out, items, most in ((held[0], runs, phrases), (held[1], (text[a:b] for a, b in islands(text)), plain)):
        for i, x in enumerate(items):  # a reservoir: every item has the same chance
            if len(x) > 4000:
                continue
            if len(out) < most:
                out.append(x)
            elif (j := rng.randrange(i + 1)) < most:
                out[j] = x
    return held


def examples(pool: list[str], plain: list[str] = (), lines: int = TRAIN_LINES, seed: int = 7):
    """Training islands (n pieces, segments, gold): entities written into runs of words (``pool``) and, as they
    are, islands of documents (``plain``) in which only the base spans are personal data."""
    rng, out = random.Random(seed), []
    pool = list(pool) or ["and then it was of the"]
    cues = {0: ["mail", "write", "email"], 1: ["host", "ip", "address"], 2: ["card", "visa", "pay"], 3: ["call", "phone", "tel", "fax"]}
    for _ in range(lines):
        text, gold = "", []
        for _ in range(rng.randint(1, 3)):
            words = rng.choice(pool).split()
            text += " ".join(words[: rng.randint(1, len(words))]) + " "
            kind, s = _entity(rng)
            if kind is not None and rng.random() < 0.4:
                text += rng.choice(cues[kind]) + rng.choice([" ", ": "])
            if kind == 3 and rng.random() < 0.5:  # two entities in a row, which the greedy base rules run together
                s = f"+{rng.randint(1, 99)} " + rng.choice(["({}) {}-{}", "{} {} {}", "{}-{}-{}"]).format(
                    *(rng.randint(200, 999), rng.randint(200, 999), rng.randint(1000, 9999)))
                gold.append((len(text), 3, len(text) + len(s)))
                text, kind, s = text + s + " ", 2, _card(rng)
            if kind is not None:
                gold.append((len(text), kind, len(text) + len(s)))
            text += s + rng.choice([" ", ". ", ", "])
        out += _islands_of(text + rng.choice(pool), gold)
    for t in plain:
        out += _islands_of(t, [])
    return out


def _islands_of(text: str, gold):
    base = base_spans(text)
    gold = [g for g in gold if not any(b[0] < g[2] and g[0] < b[2] for b in base)]
    out = []
    for lo, hi in islands(text):
        pieces, segs = candidates(text, lo, hi, base)
        if not segs:
            continue
        want = {(i, j, k) for i, j, k, _ in segs for s, kind, e in gold
                if k == kind and (pieces[i][0], pieces[j][1]) == (s, e)}
        out.append((len(pieces), segs, want))
    return out


def train(docs: DataFrame | None = None, key: str = "doc_id", text: str = "text", sample: int = SAMPLE_DOCS,
          phrases: int = PHRASES, plain: int = PLAIN) -> Crf:
    """Fit on contexts of at most ``sample`` documents (those with the smallest md5 of their key), of
    each at most ``phrases`` runs of words and ``plain`` islands, drawn from the whole text by the
    executors. Without documents plain filler words are used."""
    pool: list[str] = []
    islands_: list[str] = []
    if docs is not None:
        ship_package(docs.sparkSession)
        arrow_batches(docs.sparkSession)

        def draw(batches):
            for b in batches:
                got = [contexts_of(t or "", str(k), phrases, plain) for k, t in zip(b["k"], b["t"])]
                yield pd.DataFrame({"k": b["k"], "pool": [p for p, _ in got], "plain": [x for _, x in got]})

        rows = hash_sample(docs.select(F.col(key).cast("string").alias("k"), F.col(text).cast("string").alias("t")),
                           F.col("k"), sample)
        for r in sorted(rows.mapInPandas(draw, "k string, pool array<string>, plain array<string>").collect(),
                        key=lambda r: (r.k is None, r.k or "", r.pool, r.plain)):
            pool += r.pool
            islands_ += r.plain
    return Crf().fit(examples(pool, islands_))


def crf_spans(model: Crf, text: str, base) -> list[tuple[int, int, int]]:
    """Spans that the CRF adds to the base spans (they never overlap these)."""
    out = []
    reach, blocked = 0, []
    for s, k, e in base:  # merged, so that one look to the left finds any overlap
        if blocked and s < reach:
            blocked[-1] = (blocked[-1][0], k, max(reach, e))
        else:
            blocked.append((s, k, e))
        reach = blocked[-1][2]
    for lo, hi in islands(text):
        pieces, segs = candidates(text, lo, hi, blocked)
        if segs:
            out += [(pieces[i][0], k, pieces[j][1]) for i, j, k in model.decode(len(pieces), segs)]
    return out


def find(model: Crf, text: str):
    """(base spans, all spans) of a text, each (start, kind index, end), sorted."""
    base = base_spans(text)
    return base, sorted(base + crf_spans(model, text, base))


def notation(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def detect(df: DataFrame, model: Crf, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``
    (base spans), ``base`` and ``spans`` (kind:start:end in code points, end
    exclusive, by start then kind), ``n_added`` (spans the CRF adds).

    Null text counts as empty. Null keys and repeated rows stay as they are.
    Other columns are not read. An empty table gives an empty result. Time is
    linear in the length of a text; long runs are scanned once.
    """
    ship_package(df.sparkSession)
    arrow_batches(df.sparkSession)
    weights = dict(model.w)

    def run(batches):
        crf = Crf(weights)
        for b in batches:
            rows = []
            for t in b["body"]:
                base, spans = find(crf, t) if t else ([], [])
                n = [sum(k == i for _, k, _ in base) for i in range(len(KINDS))]
                rows.append((*n, notation(base), notation(spans), len(spans) - len(base)))
            out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in KINDS), "base", "spans", "n_added"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("body"))
    return rows.mapInPandas(run, f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS)
                            + ", base string, spans string, n_added long")


def redact(text: str, spans) -> str:
    """The text with every span replaced by its kind in square brackets."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])
