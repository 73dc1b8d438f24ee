"""Oracle SQL text: the same questions as the Spark queries, written as plain
ANSI SQL over the driver tables (runs unchanged in DuckDB).

Every query starts from the ``ads`` view and the ``derived`` CTE below; column
names and rounding match the Spark side exactly.
"""

from __future__ import annotations

from ..sources.tables import ADS_SQL

SEED = 2025
TEST_SIZE = 0.2

# ne0/eq0 of the Spark side: a missing number is "!= 0" and never "== 0".
_EQ0 = "coalesce({c} = 0, false)"


def eq0(c: str) -> str:
    return _EQ0.format(c=c)


def ne0(c: str) -> str:
    return f"NOT {eq0(c)}"


BASE_CTES = f"""
ads AS ({ADS_SQL}),
raw AS (
  SELECT *,
         CASE WHEN {ne0('cost')} AND {eq0('converions')} THEN cost
              WHEN {ne0('cost')} AND {ne0('converions')} THEN cost / converions
              ELSE CAST(0 AS DOUBLE) END AS cpa_raw
  FROM ads),
med AS (SELECT median(cpa_raw) AS cpa_median FROM raw),
derived AS (
  SELECT raw.*,
         CASE WHEN {eq0('cost')} AND {eq0('converions')} THEN med.cpa_median
              ELSE cpa_raw END AS CPA,
         CASE WHEN {eq0('clicks')} AND {eq0('cost')} THEN CAST(0 AS DOUBLE)
              WHEN {eq0('clicks')} THEN cost
              ELSE cost / clicks END AS CPC,
         CAST(CASE WHEN {eq0('converions')} THEN 0 ELSE 1 END AS BIGINT) AS convert
  FROM raw, med)
"""


def rnd(expr: str, d: int = 6) -> str:
    """Half-up rounding by plain IEEE arithmetic (identical in every engine)."""
    return f"(floor(({expr}) * 1e{d} + 0.5) / 1e{d})"


def ieee_round(sql: str) -> str:
    """Rewrite every ``round(expr, d)`` into ``rnd(expr, d)``: SQL engines break
    exact .5 ties differently, plain IEEE arithmetic does not."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = ieee_round(sql[j + 6:comma])
        digits = int(sql[comma + 1:k].strip())
        out.append(sql[i:j] + rnd(inner, digits))
        i = k + 1


def with_base(body: str, *extra_ctes: str) -> str:
    ctes = BASE_CTES.strip()
    for e in extra_ctes:
        ctes += ",\n" + e.strip()
    return f"WITH {ctes}\n{body.strip()}"


def md5_key(col: str, seed: int = SEED) -> str:
    return f"md5(concat_ws('|', '{seed}', CAST({col} AS VARCHAR)))"


def hex_long(h: str, n: int) -> str:
    return f"CAST(('0x' || substr({h}, 1, {n})) AS BIGINT)"


def quota_ctes(src: str, stratum: str, test_size: float = TEST_SIZE) -> list[str]:
    """Largest-remainder test quota per stratum, same arithmetic as Spark."""
    return [
        f"qc AS (SELECT {stratum}, count(*) AS n FROM {src} GROUP BY {stratum})",
        f"qt AS (SELECT {stratum}, n, sum(n) OVER () AS big_n, "
        f"CAST(ceil(CAST({test_size} AS DOUBLE) * sum(n) OVER ()) AS BIGINT) AS nt FROM qc)",
        f"qb AS (SELECT *, CAST(CAST(nt AS HUGEINT) * n // big_n AS BIGINT) AS base, "
        f"CAST(nt AS HUGEINT) * n % big_n AS rem FROM qt)",
        "ql AS (SELECT *, nt - sum(base) OVER () AS lft FROM qb)",
        f"quota AS (SELECT {stratum}, base + CASE WHEN row_number() OVER "
        f"(ORDER BY rem DESC, {stratum}) <= lft THEN 1 ELSE 0 END AS q FROM ql)",
    ]


# Encoders are fitted on the train part of the hash folds (all folds but the first).
FIT_WHERE = f"{hex_long(md5_key('campaign_id'), 8)} % 5 <> 0"
CATS = ["category_id", "market_id", "customer_id", "publisher"]


def freq_cte(name: str, var: str, src: str = "ads", where: str = FIT_WHERE) -> str:
    return (f"{name} AS (SELECT {var} AS value, CAST(count(*) AS DOUBLE) AS enc FROM {src} "
            f"WHERE {where} AND {var} IS NOT NULL GROUP BY {var})")


def encoded(alias: str, var: str, enc: str) -> str:
    """Encoder lookup: null stays null, unseen -> 0, matched -> value."""
    return (f"CASE WHEN {alias}.{var} IS NULL THEN NULL WHEN {enc}.value IS NOT NULL "
            f"THEN {enc}.enc ELSE CAST(0 AS DOUBLE) END")


def split_ctes(src: str = "ads", test_size: float = TEST_SIZE) -> list[str]:
    return [f"sh AS (SELECT campaign_id, {md5_key('campaign_id')} AS h FROM {src})",
            f"snt AS (SELECT CAST(ceil(CAST({test_size} AS DOUBLE) * count(*)) AS BIGINT) AS nt FROM sh)",
            "splitv AS (SELECT campaign_id, CASE WHEN row_number() OVER (ORDER BY h) <= nt "
            "THEN 'test' ELSE 'train' END AS split_type FROM sh, snt)"]


EMB_CTES = [
    "ind AS (SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS i FROM "
    "(SELECT DISTINCT industry AS value FROM ads WHERE industry IS NOT NULL) "
    "UNION ALL SELECT '', (SELECT count(DISTINCT industry) FROM ads))",
    "embmap AS (SELECT ind.value, CAST(e.embedding AS DOUBLE[]) AS emb FROM ind "
    "JOIN embeddings e ON e.vec_id = ind.i)",
]
