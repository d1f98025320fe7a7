"""Molecules assembled from the columns of parts, and their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import molecules as M
from ..session import ship_package, table
from .base import Plans

#: What a chain ends in: SMILES, acceptors, turning bonds besides the chain's, rings, aromatic, aliphatic, saturated, polar
#: surface, and the types of its atoms and of the last chain carbon's.
ENDS = [
    ("c1ccccc1", 0, 1, 1, 1, 0, 0, 0.0, "C10 H1 H1 C21" + " C18 H1" * 5),
    ("C1CCCCC1", 0, 1, 1, 0, 1, 1, 0.0, "C1 H1 H1 C2 H1" + " C1 H1 H1" * 5),
    ("O", 1, 0, 0, 0, 0, 0, 20.23, "C3 H1 H1 O2 H2"),
    ("C(=O)O", 1, 1, 0, 0, 0, 0, 37.3, "C1 H1 H1 C5 O9 O2 H4"),
    ("c1ccc2ccccc2c1", 0, 1, 2, 2, 0, 0, 0.0, "C10 H1 H1 C21 C19 C19" + " C18 H1" * 7),
    ("C1CC2CCC1C2", 0, 1, 2, 0, 2, 2, 0.0, "C1 H1 H1" + " C2 H1" * 3 + " C1 H1 H1" * 4),
    ("N", 1, 0, 0, 0, 0, 0, 26.02, "C3 H1 H1 N1 H3 H3"),
    ("C(=O)OCC", 2, 2, 0, 0, 0, 0, 26.3, "C1 H1 H1 C5 O9 O3 C3 H1 H1 C1 H1 H1 H1"),
    ("C1=CCCCC1", 0, 1, 1, 0, 1, 0, 0.0, "C1 H1 H1 C6 C6 H1" + " C1 H1 H1" * 4),
    ("C#N", 1, 0, 0, 0, 0, 0, 23.79, "C1 H1 H1 C7 N9"),
]


def ring_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Chains as long as the part's size and two more, with an end by its key: rings, turning bonds, polar surface, logP, refractivity."""
    ship_package(spark)
    end = F.get(F.array(*(F.lit(e[0]) for e in ENDS)), (F.col("p_partkey") % len(ENDS)).cast("int"))
    rows = table(spark, d, "part").select(F.concat(F.repeat(F.lit("C"), F.col("p_size") + 2), end).alias("smiles"))
    kept = rows.groupBy("smiles").agg(F.count("*").alias("n")).select("smiles", "n", M.molecule_numbers("smiles").alias("m"))
    return kept.select("smiles", "n", *(F.col(f"m.{x}").alias(x) for x in M.WHOLE), *(F.round(f"m.{x}", 4).alias(x) for x in M.REAL))


_SHARES = "(VALUES " + ", ".join(f"('{k}', {a}::DOUBLE, {b}::DOUBLE)" for k, (a, b) in M.SHARES.items()) + ") s(type, a, b)"
_ENDS = "(VALUES " + ", ".join(f"({i}, '{e[0]}', {', '.join(str(x) for x in e[1:7])}, {e[7]}::DOUBLE, '{e[8]}')" for i, e in enumerate(ENDS)) + ") e(k, smiles, acceptors, turning, rings, aromatic, aliphatic, saturated, tpsa, types)"
PLANS: Plans = {
    "ring_numbers": (
        ring_numbers,
        f"WITH t AS (SELECT k, sum(a) AS a, sum(b) AS b FROM (SELECT k, unnest(string_split(types, ' ')) AS type FROM {_ENDS}) JOIN {_SHARES} USING (type) GROUP BY k), "
        f"c AS (SELECT max(a) FILTER (type = 'C1') AS ca, max(b) FILTER (type = 'C1') AS cb, max(a) FILTER (type = 'H1') AS ha, max(b) FILTER (type = 'H1') AS hb FROM {_SHARES}), "
        f"p AS (SELECT repeat('C', p_size + 2) || e.smiles AS s, p_size + 2 AS m, e.* EXCLUDE (smiles), t.a, t.b FROM part JOIN {_ENDS} ON k = p_partkey % {len(ENDS)} JOIN t USING (k)) "
        "SELECT s AS smiles, count(*) AS n, any_value(acceptors)::BIGINT AS h_acceptors, any_value(m - 2 + turning)::BIGINT AS rot_bonds, any_value(rings)::BIGINT AS rings, any_value(aromatic)::BIGINT AS aromatic_rings, "
        "any_value(aliphatic)::BIGINT AS aliphatic_rings, any_value(saturated)::BIGINT AS saturated_rings, round(any_value(a + ca + 3 * ha + (m - 2) * (ca + 2 * ha)), 4) AS logp, "
        "round(any_value(b + cb + 3 * hb + (m - 2) * (cb + 2 * hb)), 4) AS molar_refractivity, any_value(tpsa) AS tpsa FROM p, c GROUP BY s",
    ),
}
