"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; the ledger keeps one failure bit
per rule next to the measurements. Policies are versioned bit masks applied
to the ledger later, and ablations (what a policy would keep without one of
its rules) come from counts per distinct mask, never from the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, ship_package

#: bit -> (rule, SQL condition over the measurements that means failure)
RULES = {
    0: ("few_words", "n_words < 10"),
    1: ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    2: ("symbols", "10 * n_symbols > 3 * n_words"),
    3: ("long_words", "word_chars > 20 * n_words"),
    4: ("short_words", "word_chars < 2 * n_words"),
    5: ("duplicate_lines", "2 * n_dup_lines > n_lines"),
    6: ("shouting", "2 * n_shout > n_words"),
}
BASE_MASK = 0b11


@dataclass(frozen=True)
class Policy:
    """A version and the mask of the rules that reject under it."""

    version: str
    mask: int


POLICIES = (Policy("base-1", BASE_MASK), Policy("strict-1", 0b1111111))
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_shout"]
#: fixed values: the symbol characters
SYMBOLS = b"#*$%&|<>"
WINDOW = 5


def repeat_words(ids: np.ndarray, n: int = WINDOW) -> int:
    """Words inside windows of ``n`` words that occur at least twice. Windows are
    compared exactly, by joining ranks of neighbouring parts."""
    if len(ids) <= n:
        return 0
    key, width = ids, 1
    while width < n:  # ranks of windows of growing width
        step = min(width, n - width)
        left, right = key[: len(ids) - width - step + 1], (key if step == width else _rank(ids, step))
        right = right[width: width + len(left)]
        _, key = np.unique(left * (int(right.max()) + 1) + right, return_inverse=True)
        width += step
    count = np.bincount(key)
    hit = np.flatnonzero(count[key] > 1)
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, hit, 1)
    np.add.at(mark, hit + n, -1)
    return int(np.count_nonzero(np.cumsum(mark[:-1])))


def _rank(ids: np.ndarray, width: int) -> np.ndarray:
    key = ids
    for k in range(1, width):
        left = key[: len(ids) - k]
        _, key = np.unique(left * (int(ids.max()) + 1) + ids[k: k + len(left)], return_inverse=True)
    return key


def measure(data: bytes) -> tuple[int, ...]:
    """The measurements of one UTF-8 text, in the order of MEASURES."""
    words = data.split()  # bytes.split() cuts at exactly space and 0x09-0x0D
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    chars = len(b"".join(words).decode("utf-8"))
    symbols = sum(map(data.count, (bytes([c]) for c in SYMBOLS)))
    lines: set[bytes] = set()
    n_lines = dup = 0
    for line in data.split(b"\n"):
        if line.strip():  # bytes.strip() strips the same characters
            n_lines += 1
            dup += line in lines
            lines.add(line)
    repeats = 0 if len(seen) == len(words) else repeat_words(ids)
    counts = np.bincount(ids, minlength=len(seen))
    shout = int(sum(counts[i] for w, i in seen.items() if len(w) > 1 and w.isupper()))
    return len(words), chars, symbols, n_lines, dup, repeats, shout


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` (the key), the measurements, and
    ``fail_bits`` with bit r set where rule r of ``RULES`` fails.

    Null text counts as empty (zero words, fails ``few_words``). Null keys and
    repeated rows stay as they are; other columns are not read; an empty table
    gives an empty ledger. Whole texts are measured, one at a time.
    """
    spark = df.sparkSession
    ship_package(spark)
    arrow_batches(spark)

    def run(batches):
        for b in batches:
            m = np.array([measure(bytes(t) if t is not None else b"") for t in b["body"]], np.int64)
            out = pd.DataFrame(m.reshape(len(b), len(MEASURES)), columns=MEASURES)
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).cast("binary").alias("body"))
    got = rows.mapInPandas(run, ", ".join([f"doc_id {kind}", *(f"{m} long" for m in MEASURES)]))
    bits = sum((F.expr(cond).cast("long") * F.lit(1 << b) for b, (_, cond) in RULES.items()), F.lit(0).cast("long"))
    return got.withColumn("fail_bits", bits)


def apply_policy(led: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    return led.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(led: DataFrame, policies=POLICIES) -> DataFrame:
    """Per policy and rule: documents kept by the policy, kept without the rule,
    failing the rule, and rejected by this rule alone. ``led`` is first reduced
    to one row per distinct mask (at most 2 to the number of rules)."""
    masks = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    rows = F.explode(F.array(*[F.struct(F.lit(p.version).alias("version"), F.lit(p.mask).cast("long").alias("mask"),
                                        F.lit(RULES[b][0]).alias("rule"), F.lit(1 << b).cast("long").alias("bit"))
                               for p in policies for b in RULES if p.mask >> b & 1]))
    j = masks.select("fail_bits", "n", rows.alias("p")).select("fail_bits", "n", "p.*")
    on = F.col("fail_bits").bitwiseAND(F.col("mask"))
    rest = on.bitwiseAND(F.bitwise_not(F.col("bit")))
    n = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return j.groupBy("version", "rule").agg(
        n(on == 0).alias("kept"), n(rest == 0).alias("kept_without_rule"),
        n(F.col("fail_bits").bitwiseAND(F.col("bit")) != 0).alias("failing"),
        n((on != 0) & (rest == 0)).alias("rejected_by_rule_alone"))


def mask_summary(led: DataFrame) -> DataFrame:
    """Bitwise totals over the whole ledger: bits that any, and that every, document fails."""
    return led.agg(F.coalesce(F.bit_or("fail_bits"), F.lit(0)).alias("any_failed"),
                   F.coalesce(F.bit_and("fail_bits"), F.lit(0)).alias("all_failed"),
                   F.count("*").alias("n"))


