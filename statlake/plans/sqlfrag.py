"""SQL text fragments for the oracle queries (DuckDB dialect)."""

from __future__ import annotations


def k2_sql(n: str, b: str, k: str) -> str:
    """K² from n, population skewness b and Pearson kurtosis k."""
    nn = f"({n})::DOUBLE"
    y = f"({b}) * sqrt(({nn}+1)*({nn}+3)/(6.0*({nn}-2)))"
    beta2 = f"3.0*({nn}*{nn}+27*{nn}-70)*({nn}+1)*({nn}+3)/(({nn}-2)*({nn}+5)*({nn}+7)*({nn}+9))"
    w2 = f"(-1.0 + sqrt(2.0*(({beta2})-1)))"
    delta = f"(1.0/sqrt(0.5*ln({w2})))"
    alpha = f"sqrt(2.0/({w2}-1))"
    zs = f"({delta}*asinh(({y})/({alpha})))"
    e = f"(3.0*({nn}-1)/({nn}+1))"
    v = f"(24.0*{nn}*({nn}-2)*({nn}-3)/(({nn}+1)*({nn}+1)*({nn}+3)*({nn}+5)))"
    x = f"((({k})-{e})/sqrt({v}))"
    bb = f"(6.0*({nn}*{nn}-5*{nn}+2)/(({nn}+7)*({nn}+9))*sqrt(6.0*({nn}+3)*({nn}+5)/({nn}*({nn}-2)*({nn}-3))))"
    a = f"(6.0+8.0/{bb}*(2.0/{bb}+sqrt(1.0+4.0/({bb}*{bb}))))"
    d = f"(1.0+{x}*sqrt(2.0/({a}-4.0)))"
    zk = f"((1.0-2.0/(9.0*{a}) - sign({d})*cbrt((1.0-2.0/{a})/abs({d})))/sqrt(2.0/(9.0*{a})))"
    return f"(({zs})*({zs}) + ({zk})*({zk}))"


def strength_sql(r: str) -> str:
    a = f"abs({r})"
    base = (f"CASE WHEN {a} < 0.2 THEN 'very weak' WHEN {a} < 0.4 THEN 'weak' "
            f"WHEN {a} < 0.6 THEN 'moderate' WHEN {a} < 0.8 THEN 'strong' ELSE 'very strong' END")
    return (f"CASE WHEN {r} IS NULL THEN NULL ELSE {base} || ' ' || "
            f"CASE WHEN {r} >= 0 THEN 'positive' ELSE 'negative' END END")


def avg_rank_sql(part: str, col: str) -> str:
    p = f"PARTITION BY {part} " if part else ""
    pc = f"PARTITION BY {part + ', ' if part else ''}{col}"
    return f"(rank() OVER ({p}ORDER BY {col}) + (count(*) OVER ({pc}) - 1) / 2.0)"


def finite(*cols: str) -> str:
    return " AND ".join(f"{c} IS NOT NULL AND isfinite({c})" for c in cols)


def norm_cdf_sql(z: str) -> str:
    """Standard normal CDF by Hart's approximation, as ``functions.safe.norm_cdf``."""
    from statlake.functions.safe import _HART_DEN, _HART_NUM
    x = f"abs({z})"

    def poly(coefs):
        e = f"{coefs[0]!r}::DOUBLE"
        for c in coefs[1:]:
            e = f"({e} * {x} + {c!r}::DOUBLE)"
        return e
    build = f"({x} + 0.65::DOUBLE)"
    for k in (4, 3, 2, 1):
        build = f"({x} + {k}.0::DOUBLE / {build})"
    bell = f"exp(-{x} * {x} / 2.0::DOUBLE)"
    tail = (f"CASE WHEN {x} > 37 THEN 0.0::DOUBLE WHEN {x} < 7.07106781186547 THEN {bell} * {poly(_HART_NUM)} / {poly(_HART_DEN)} "
            f"ELSE {bell} / {build} / 2.506628274631::DOUBLE END")
    return f"(CASE WHEN {z} > 0 THEN 1.0::DOUBLE - ({tail}) ELSE ({tail}) END)"
