import random
from decimal import ROUND_HALF_UP, Decimal

from crashlake.functions.numeric import pct_half_up


def exact(k: int, n: int):
    if n == 0:
        return None
    return float((Decimal(k) * 100 / Decimal(n)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def test_pct_half_up_matches_exact_decimal_rounding(spark):
    rng = random.Random(7)
    pairs = [(1, 800), (201, 20000), (23, 4000), (0, 50), (50, 50), (0, 0), (1, 3), (2, 3), (1, 8), (3, 8)]
    for _ in range(3000):
        n = rng.choice([rng.randint(1, 100), rng.randint(1, 10**6), rng.randint(1, 10**10)])
        pairs.append((rng.randint(0, n), n))
    for n in (200, 400, 800, 2000, 4000, 8000, 20000):  # exact .xx5 cases
        pairs += [(k, n) for k in range(0, n + 1, max(1, n // 97))]
    df = spark.createDataFrame(pairs, "k long, n long")
    got = {(r.k, r.n): r.p for r in df.select("k", "n", pct_half_up("k", "n").alias("p")).collect()}
    bad = [(k, n, got[(k, n)], exact(k, n)) for k, n in pairs if got[(k, n)] != exact(k, n)]
    assert not bad, bad[:5]
